"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chamberlens.llm.bpe import encode
from chamberlens.llm.common import in_letters
from chamberlens.llm.decontaminate import find_contamination
from chamberlens.llm.language_id import UNKNOWN, LanguageModel, fit_languages, identify_language
from chamberlens.llm.line_dedup import line_dedup
from chamberlens.llm.near_dedup import without_near_duplicates
from chamberlens.llm.queries import vocabulary_path
from chamberlens.session import discard, materialize

#: No SQL stands for a trained language model or the tokeniser; the tests compare the
#: stages with brute force instead.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose language cannot be told.

    That are null texts, texts without letters, and those whose predicted language has a
    score below a blind guess among the languages learned and one more (with four
    languages, 1 / 5). Where no row has a language to learn from, letters alone decide.
    """
    model: LanguageModel | None = fit_languages(docs)
    if model is None:
        return docs.where(in_letters(F.col("text")))
    found = identify_language(docs, model)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= model.doubtful)).select(*docs.columns)


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that an earlier document holds too, and documents of which that leaves
    nothing but blanks; ``n_chars`` follows the text."""
    kept = line_dedup(docs).withColumn("n_chars", F.char_length("text").cast("bigint"))
    emptied = (F.col("n_dropped") > 0) & ~F.col("text").rlike(r"\S")
    return kept.where(~emptied).select(*docs.columns)


def unique_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group whose word shingles are alike to 0.8 or more."""
    return without_near_duplicates(docs, percent=80).select(*docs.columns)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage of the benchmark."""
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where("n_hit = 0").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to."""
    encoded = encode(docs, vocabulary_path(), decoded=True)
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language_id", known_language),
    ("line_dedup", unique_lines),
    ("near_dedup", unique_documents),
    ("decontamination", uncontaminated),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each on the written result of the one before.

    The stages but the last run when called. A stage's table in the shared folder goes
    once the next one is written; the last one stays, because the result reads it.
    """
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        stale = path
        docs, path = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if stale:
            discard(spark, stale)
    return STAGES[-1][1](spark, docs, sf_dir)
