"""The tiled correlation matrix against the narrow one and against numpy."""

import math
import os

import numpy as np
import pandas as pd
import pytest

from chamberlens.operators import stats
from chamberlens.operators.stats import correlation_matrix, pair_moments
from chamberlens.session import scratch_root


def test_tiles_equal_the_narrow_matrix(spark, monkeypatch):
    monkeypatch.setattr(stats, "ROWS", 16)
    draw = np.random.default_rng(4)
    values = draw.normal(size=(150, 23)) @ draw.normal(size=(23, 23)) + 1e6
    values[draw.random(values.shape) < 0.2] = np.nan
    values[:, 5] = 0.1  # constant
    values[:, 9] = np.nan  # nothing at all
    values[::2, 11] = values[1::2, 12] = np.nan  # no row in common
    values[np.arange(150) != 3, 20] = np.nan  # one row
    frame = pd.DataFrame(values, columns=[f"a.{i}" for i in range(23)])
    df = spark.createDataFrame(frame).repartition(4)
    narrow = {(p.var_i, p.var_j): p.r for p in correlation_matrix(df).collect()}
    for tile in (7, 22):
        got = {(p.var_i, p.var_j): p.r for p in correlation_matrix(df, tile=tile).collect()}
        assert got.keys() == narrow.keys() and len(got) == 23 * 23
        for pair, r in narrow.items():
            assert got[pair] == (None if r is None else pytest.approx(r, abs=1e-9))


def test_tiles_leave_no_table_and_take_empty_input(spark):
    folder = os.path.join(scratch_root(spark).removeprefix("file:"), "chamberlens")

    def tables():
        return {f for f in os.listdir(folder) if f.startswith("columns")} if os.path.isdir(folder) else set()

    before = tables()
    df = spark.createDataFrame([], "a double, b double, c double")
    assert correlation_matrix(df, tile=2).count() == 0
    assert tables() == before


def test_a_task_reads_two_blocks_of_a_wide_table(spark):
    """1100 columns: no batch holds more than two blocks, no task more than a tile."""
    draw = np.random.default_rng(5)
    values = draw.normal(size=(200, 1100))
    frame = pd.DataFrame(values, columns=[f"x{i}" for i in range(1100)])
    seen = spark.sparkContext.accumulator(0)
    work = stats._task_moments

    def watched(first, second, width):
        inner = work(first, second, width)

        def counted(batches):
            def wide(batches):
                for batch in batches:
                    seen.add(int(batch.num_columns > 2 * stats.TILE))
                    yield batch

            return inner(wide(batches))

        return counted

    stats._task_moments = watched
    try:
        moments = pair_moments(spark.createDataFrame(frame).coalesce(2), list(frame.columns)).toPandas()
    finally:
        stats._task_moments = work
    assert seen.value == 0 and len(moments) == 1100 * 1101 // 2
    want = np.corrcoef(values.T)[moments.i, moments.j]
    got = moments.m_ij / np.sqrt(moments.m_ii * moments.m_jj)
    assert math.isclose(np.abs(got - want).max(), 0, abs_tol=1e-9)
