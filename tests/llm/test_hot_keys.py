"""Crowded lines and tokens are split: read from the final plans."""

import pytest
from pyspark.sql import functions as F

from chamberlens.llm import line_dedup as lines_module, near_dedup as near_module
from chamberlens.llm.license_scan import scan_licenses
from chamberlens.llm.line_dedup import line_dedup


@pytest.fixture()
def splitting(conf):
    for name, value in {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
    }.items():
        conf(name, value)


@pytest.fixture()
def plans(monkeypatch):
    """Final plans of the tables that a module stores."""
    seen = []

    def watch(module):
        original = module.stored

        def stored(df):
            kept = original(df)
            seen.append(df._jdf.queryExecution().executedPlan().toString())
            return kept

        monkeypatch.setattr(module, "stored", stored)
        return seen

    return watch


def test_a_line_of_every_document_is_split(spark, splitting, plans):
    seen = plans(lines_module)
    docs = spark.range(0, 6000, 1, 12).select(F.col("id").alias("doc_id"), F.concat(F.lit("the very same line\nits own line number "), "id").alias("text"))
    out = line_dedup(docs)
    assert out.agg(F.sum("n_dropped")).first()[0] == 5999
    assert any("skew=true" in plan for plan in seen)


def test_tokens_of_many_documents_are_split(spark, splitting, conf, plans):
    """One shingle of four is everybody's, so each coordinate has a token of many documents;
    over more partitions than coordinates these stand out."""
    conf("spark.sql.shuffle.partitions", "250")
    seen = plans(near_module)
    words = F.concat_ws(" ", F.lit("five words that all have"), *[F.concat(F.lit(f"w{i}"), F.col("id").cast("string")) for i in range(3)])
    docs = spark.range(0, 3000, 1, 12).select(F.col("id").alias("doc_id"), words.alias("text"))
    found = near_module.near_duplicates(docs, percent=85)
    assert found.where("kept").count() == 3000
    assert any("skew=true" in plan for plan in seen)


def test_a_callers_sentences_are_found(spark):
    own = {"x": "this gadget is free for everyone to enjoy", "y": " ".join(f"word{i}" for i in range(300))}
    text = "This gadget is free\n for EVERYONE to enjoy. And\n\n" + "\n".join(f"word{i}" for i in range(300)) + "."
    df = spark.createDataFrame([(1, text), (2, "Nothing known here.")], "doc_id long, text string")
    got = {r["doc_id"]: r["sentence_ids"] for r in scan_licenses(df, sentences=own, rules=[("X", ("x",))]).collect()}
    assert got == {1: ["x", "y"], 2: []}
