"""Running sums by ranges against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from chamberlens.functions.running import running_sums


def plain(rows, key):
    found, sums = [], {}
    for row in sorted(rows, key=key):
        sums[row[0]] = sums.get(row[0], 0) + (row[2] or 0)
        found.append((*row, sums[row[0]]))
    return sorted(found, key=str)


@pytest.mark.parametrize("groups", [1, 3, 200])
def test_sums_within_groups_of_any_size(spark, conf, groups):
    conf("spark.sql.shuffle.partitions", "7")
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    draw = random.Random(groups)
    rows = [(draw.choice([None, *range(groups)]), i, draw.choice([None, 1, 5, -2])) for i in range(1500)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "g long, o long, v long").repartition(5)
    got = running_sums(df, {"run": F.col("v")}, [F.col("o").asc()], "g")
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_equal_rows_are_spread_and_numbered_once(spark, conf):
    conf("spark.sql.shuffle.partitions", "6")
    df = spark.range(6000).select(F.lit("same").alias("name"), F.lit(0.5).alias("w"))
    got = running_sums(df, {"position": F.lit(1), "total": F.col("w")}, [F.desc("w"), F.asc("name")])
    rows = got.withColumn("part", F.spark_partition_id()).collect()
    assert sorted(r["position"] for r in rows) == list(range(1, 6001))
    assert all(r["total"] == r["position"] / 2 for r in rows)
    assert max(sum(r["part"] == p for r in rows) for p in range(6)) < 3000


def test_empty_and_clashing_names(spark):
    empty = spark.createDataFrame([], "_group long, _place string, part int")
    assert running_sums(empty, {"run": F.col("part")}, [F.col("part").asc()]).collect() == []
    df = spark.createDataFrame([(3, "a", 1), (3, "b", 2)], "_group long, _place string, part int")
    got = running_sums(df, {"run": F.col("part")}, [F.col("_place").desc()], "_group").collect()
    assert sorted(tuple(r) for r in got) == [(3, "a", 1, 3), (3, "b", 2, 2)]
