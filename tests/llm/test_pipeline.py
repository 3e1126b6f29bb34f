"""The pipeline against a plain version of its stages."""

import re

import corpus_pipeline
from chamberlens.llm.queries import vocabulary_path
from test_decontaminate import brute as contaminated
from test_line_dedup import brute as lines_of
from test_near_dedup import brute as groups_of
from tokenizers import Tokenizer


def test_stages_keep_their_contract():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_matches_the_plain_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")]
    rows = [(i, text) for i, text, _, dropped in lines_of(rows) if not dropped or re.search(r"\S", text)]
    kept = {i for i, (_, _, first) in groups_of(rows, 80).items() if first}
    rows = [(i, t) for i, t in rows if i in kept]
    rows = [(i, t) for (i, t), (_, hit, _) in zip(rows, contaminated([t for _, t in rows], items, 10)) if not hit]
    library = Tokenizer.from_file(vocabulary_path())
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in rows}
    got = corpus_pipeline.run(spark, small)
    assert {r["doc_id"]: list(r["ids"]) for r in got.collect()} == want
    assert set(got.columns) == {"doc_id", "lang", "source", "n_tokens", "ids", "decoded"}


def test_every_stage_takes_awkward_documents(spark, small, docs_of):
    text = "ordinary words in a short line of text"
    rows = [(1, None), (2, ""), (3, "12 34"), (4, text), (5, text), (5, text), (None, text), (6, "other ordinary words that stand alone here")]
    for frame in (docs_of(rows).withColumnRenamed("x", "x"), docs_of([])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, small)
            assert name == "bpe" or out.columns == frame.columns
            out.collect()
