"""Exact search against sorting all scores."""

import math
import random

import pytest

from chamberlens.llm import top_k as module
from chamberlens.llm.top_k import top_k

SCHEMA = "vec_id long, embedding array<double>"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def whole(x):
    y = x * 64
    return math.floor(min(max(y, -1.7976931348623157e308), 1.7976931348623157e308))


def brute(rows, queries, k):
    good = [(i, [whole(x) for x in v]) for i, v in rows if i is not None and usable(v)]
    result = []
    for q, v in ((i, v) for i, v in good if i in queries):
        scores = sorted(((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), i) for i, w in good if i != q))
        result += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(result)


def run(spark, rows, queries, k=5, **clash):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in clash:
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return sorted(tuple(r) for r in top_k(df, df.where(df.vec_id.isin(list(queries))), k=k).collect())


@pytest.mark.parametrize("seed", range(3))
def test_matches_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(module, "QUERY_BLOCK", 4)
    monkeypatch.setattr(module, "SLICE", 30)
    monkeypatch.setattr(module, "BLOCK", 8)
    draw = random.Random(seed)
    rows = [(i, [draw.choice([0.0, 0.0, draw.uniform(-1, 1)]) for _ in range(draw.randint(1, 9))]) for i in range(120)]
    queries = set(range(0, 120, 11))
    assert run(spark, rows, queries) == brute(rows, queries, 5)


def test_ties_repeats_nulls_and_few_rows(spark):
    same = [0.5, -0.25]
    rows = [(i, same) for i in (9, 3, 7, 3, 1)] + [(4, None), (5, [None, 1.0]), (6, [math.nan, 1.0]), (8, [math.inf]), (None, same), (2, [])]
    queries = {3, 2, 4, 8}
    assert run(spark, rows, queries, rank=1, score=1, id=1, vector=1) == brute(rows, queries, 5)
    assert run(spark, rows, queries, k=2) == brute(rows, queries, 2)
    assert run(spark, [], {1}) == [] and run(spark, [(1, same)], {1}) == []


def test_scores_beyond_double_precision(spark):
    rows = [(1, [1e300, -1.0]), (2, [1e300, 5.0]), (3, [-1e300, 5.0]), (4, [2.0**55, 1.0]), (5, [2.0**-6, 2.0**52])]
    assert run(spark, rows, {1, 4, 5}) == brute(rows, {1, 4, 5}, 5)


def test_floor_is_that_of_the_double(spark):
    rows = [(1, [1.0]), (2, [-0.001]), (3, [0.015625]), (4, [0.0156249])]
    assert run(spark, rows, {1}) == [(1, 1, 3, 64), (1, 2, 4, 0), (1, 3, 2, -64)]


def test_a_crowded_id_spreads_over_slices(spark, monkeypatch):
    """A third of the rows are one row over and over: every group still holds its share."""
    monkeypatch.setattr(module, "SLICE", 50)
    monkeypatch.setattr(module, "LEAST_SLICE", 50)
    rows = [(7, [0.5, 1.0])] * 200 + [(i, [i / 64, 1.0]) for i in range(100, 500)]
    sizes = spark.sparkContext.accumulator(0)
    search = module._search

    def watched(k):
        work = search(k)

        def counted(asked, candidates):
            sizes.add(int(candidates.num_rows > 100))
            return work(asked, candidates)

        return counted

    monkeypatch.setattr(module, "_search", watched)
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in top_k(df, df.where("vec_id in (100, 480)"), k=20).collect())
    assert got == brute(rows, {100, 480}, 20) and sizes.value == 0
    own = top_k(df, df.where("vec_id = 7"), k=3)
    assert own.where("vec_id = 7").count() == 0 and own.count() == 600
