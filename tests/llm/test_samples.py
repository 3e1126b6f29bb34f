"""The samples that models are fitted on: size, bounds and crowded keys."""

import numpy as np
from pyspark.sql import functions as F

from chamberlens.llm.common import DRAWS, draw_limit
from chamberlens.llm.language_id import fit_languages
from chamberlens.llm.quality import fit_quality


def test_share_of_any_table_size_stays_at_the_wanted_rows():
    for size in (1, 500, 501, 10**6, 3 * 10**8, 10**9, 10**13):
        drawn = draw_limit(500, size) / DRAWS * size
        assert min(500, size) <= drawn + 1e-6 and drawn <= 500 + size / DRAWS + 1e-6


def test_large_groups_are_still_learned(spark):
    many = spark.range(4_000_000).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"), F.lit("en").alias("lang"))
    assert fit_languages(many, per_language=3).languages == {"germanic": ["en"]}
    labels = many.select("doc_id", F.when(F.col("doc_id") < 9, 1).otherwise(0).alias("quality"))
    assert fit_quality(many, labels, sample=6, pairs=20) is not None


def test_a_crowded_key_neither_fills_nor_outgrows_a_sample(spark, monkeypatch):
    taken = []
    monkeypatch.setattr("chamberlens.llm.language_id._fitted", lambda x, y: taken.append(y.tolist()))
    crowd = F.when(F.col("id") % 3 > 0, F.col("id"))  # a third of the rows has no key
    lang = F.when(F.col("id") % 10 == 0, "de").otherwise("en")
    docs = spark.range(30_000).select(crowd.alias("doc_id"), F.concat(F.lit("words "), "id").alias("text"), lang.alias("lang"))
    copies = spark.range(20_000).selectExpr("CAST(null AS LONG) AS doc_id", "'the same words' AS text", "'en' AS lang")
    fit_languages(docs.union(copies), per_language=100)
    assert taken[0].count("en") == taken[0].count("de") == 100
    fit_languages(copies, per_language=100)
    assert taken[1] == ["en"]


def test_a_crowded_labelled_key_counts_once(spark, monkeypatch):
    taken = []
    monkeypatch.setattr("chamberlens.llm.quality._fitted", lambda x, labels, share, pairs: taken.append(labels.tolist()))
    texts = spark.range(6_000).select(F.greatest(F.lit(0), F.col("id") - 5_000).alias("doc_id"), F.concat(F.lit("words "), "id").alias("text"))
    docs = texts.union(texts.where("doc_id < 3"))
    labels = spark.range(1_000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    fit_quality(docs, labels, sample=2_000)
    fit_quality(docs, labels, sample=100)
    assert [(t.count(0), t.count(1)) for t in taken] == [(500, 500), (50, 50)]


def test_every_labelled_document_is_learned_from(spark, monkeypatch):
    """Marks that one document in many bears move the weights, whichever document it is."""
    from chamberlens.llm import quality

    monkeypatch.setattr(quality, "BLOCK_ROWS", 40)
    monkeypatch.setattr(quality, "LEAST_ROWS", 10)
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('plain words ', id, if(id % 10 = 0, ' ### !!!', ' and more')) AS text")
    labels = spark.range(300).selectExpr("id AS doc_id", "CAST(id % 10 != 0 AS INT) AS quality")
    plain = quality.fit_quality(docs, labels, pairs=60)
    again = quality.fit_quality(docs.repartition(7), labels.repartition(3).union(labels), pairs=60)
    assert np.allclose(plain.weights, again.weights, atol=1e-6) and abs(plain.cut - again.cut) < 1e-6
    assert quality.score_quality(docs, plain).where("predicted = 0").count() == 30
    for odd in (1, 150, 299):
        text = F.when(F.col("doc_id") == odd, F.lit("Zyxwv")).otherwise(F.col("text"))
        changed = quality.fit_quality(docs.withColumn("text", text), labels, pairs=60)
        assert np.abs(changed.weights - plain.weights).max() > 1e-4


def test_every_row_stands_in_a_pair():
    from chamberlens.llm.quality import _every_pair

    labels = np.array([0] * 90 + [1] * 7)
    for pairs in (5, 50, 200):
        better, worse = _every_pair(labels, pairs)
        assert len(better) == len(worse) == max(90, pairs)
        assert set(better) == set(range(90, 97)) and set(worse) == set(range(90))
