"""Extremes, summaries and the pairwise-complete correlation matrix."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from chamberlens.functions.columns import nan_as_null, numeric_columns, quoted, share_of, text
from chamberlens.functions.ranks import quantiles
from chamberlens.session import discard, materialize, stored

# Below this share of the raw second moment a central moment is rounding noise.
ROUNDING = 1e-12
#: Columns of a tile of a wide matrix, and rows that a task turns into products at a time.
TILE, ROWS = 512, 1024


def column_extremes(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Smallest and largest value per column, as (variable, min, max)."""
    df = nan_as_null(df)
    rows = [
        f"struct({text(c)} AS variable, CAST(min({quoted(c)}) AS DOUBLE) AS min, CAST(max({quoted(c)}) AS DOUBLE) AS max)"
        for c in columns or numeric_columns(df)
    ]
    return df.selectExpr(f"array({', '.join(rows)}) AS rows").selectExpr("inline(rows)")


def numeric_summary(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, as (statistic, value)."""
    df = nan_as_null(df)
    quartiles = quantiles(df, [col], [0.25, 0.5, 0.75])[col]
    measures = {
        "count": F.count(col),
        "mean": F.avg(col),
        "std": F.stddev_samp(col),
        "min": F.min(col),
        **{name: F.lit(q) for name, q in zip(("25%", "50%", "75%"), quartiles)},
        "max": F.max(col),
    }
    one_row = df.agg(
        F.array(
            *[F.struct(F.lit(k).alias("statistic"), v.cast("double").alias("value")) for k, v in measures.items()]
        ).alias("rows")
    )
    return one_row.select(F.inline("rows"))


def pair_moments(df: DataFrame, columns: list[str], tile: int = TILE) -> DataFrame:
    """Rows, means and central moments of every pair (i <= j), over rows where both are present.

    Each task turns its rows into one small table by matrix products; p(p-1)/2 SQL
    aggregates outgrow generated code already at p = 17. The tables, stored when called,
    merge around a common origin, so a constant column keeps a moment of exactly zero.

    More than ``tile`` columns are written as Parquet once, and each task reads two blocks
    of columns alone: it holds four tables of ``tile`` x ``tile`` numbers (8 MB at 512) and a
    batch of at most twice as many columns. The more pairs of blocks there are, the
    fewer tasks share one, so that what is stored grows with tasks x ``tile`` squared.
    """
    numbers = df.selectExpr(*[f"CAST({quoted(c)} AS DOUBLE) AS c{i}" for i, c in enumerate(columns)])
    if len(columns) <= tile:
        parts = stored(numbers.mapInArrow(_task_moments(0, 0, len(columns)), _MOMENTS))
    else:
        parts = _tiled_moments(numbers, tile)
    # one origin per pair; minima and sums combine on the map side, so no pair's tables are gathered
    origins = parts.groupBy("i", "j").agg(F.min("mean_i").alias("o_i"), F.min("mean_j").alias("o_j"))
    offset = parts.join(origins, ["i", "j"]).withColumns({"d_i": F.col("mean_i") - F.col("o_i"), "d_j": F.col("mean_j") - F.col("o_j")})
    n, s_i, s_j = F.sum("n"), F.sum(F.expr("n * d_i")), F.sum(F.expr("n * d_j"))
    raw_ii = F.sum(F.expr("m_ii + n * d_i * d_i"))
    raw_jj = F.sum(F.expr("m_jj + n * d_j * d_j"))
    raw_ij = F.sum(F.expr("m_ij + n * d_i * d_j"))

    def central(raw, left):
        moment = raw - share_of(left * left, n)
        return F.when(moment <= raw * ROUNDING, F.lit(0.0)).otherwise(moment)

    return offset.groupBy("i", "j").agg(
        n.alias("n"),
        central(raw_ii, s_i).alias("m_ii"),
        central(raw_jj, s_j).alias("m_jj"),
        (raw_ij - share_of(s_i * s_j, n)).alias("m_ij"),
    )


_MOMENTS = "i int, j int, n double, mean_i double, mean_j double, m_ii double, m_jj double, m_ij double"


def _tiled_moments(numbers: DataFrame, tile: int) -> DataFrame:
    """The tasks' tables of all pairs of column blocks, one row of blocks after the other."""
    table, path = materialize(numbers, "columns")
    names = table.columns
    starts = range(0, len(names), tile)
    tasks = table.rdd.getNumPartitions()
    parts = None
    for first in starts:
        seconds = [at for at in starts if at >= first]
        row = None
        for second in seconds:
            left = names[first : first + tile]
            right = names[second : second + tile] if second > first else []
            # every column block is read by several pairs; together they take as many tasks as one scan
            read = table.select(*left, *right).coalesce(max(1, -(-tasks // len(seconds))))
            one = read.mapInArrow(_task_moments(first, second, len(left)), _MOMENTS)
            row = one if row is None else row.union(one)
        row = stored(row)
        parts = row if parts is None else parts.union(row)
    discard(numbers.sparkSession, path)
    return parts


def _task_moments(first: int, second: int, width: int):
    """A task's table of the pairs between its first ``width`` columns, which are the
    matrix's from ``first`` on, and the rest, from ``second`` on; without a rest, of the
    pairs among the first."""

    def work(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        sums = centre = None
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                present = ~np.isnan(values)
                if centre is None:
                    # any value near the data will do; the median is exact for a constant column
                    centre = np.array([np.median(v[p]) if p.any() else 0.0 for v, p in zip(values.T, present.T)])
                moved, mask = np.where(present, values - centre, 0.0), present.astype(float)
                rest = slice(width, None) if values.shape[1] > width else slice(None)
                a, a_mask, b, b_mask = moved[:, :width], mask[:, :width], moved[:, rest], mask[:, rest]
                products = (a_mask.T @ b_mask, a.T @ b_mask, a_mask.T @ b, (a * a).T @ b_mask, a_mask.T @ (b * b), a.T @ b)
                sums = products if sums is None else tuple(old + new for old, new in zip(sums, products))
        if sums is None:
            return
        among = len(centre) == width
        left, right = centre[:width], centre if among else centre[width:]
        for i in range(width):  # a line of pairs at a time, so that no second copy of the tables is held
            at = slice(i if among else 0, None)
            n, s_i, s_j, q_i, q_j, cross = (table[i, at] for table in sums)
            size = np.where(n > 0, n, np.nan)  # a pair without common rows has no moments

            def central(q, s):
                moment = q - s * s / size
                return np.where(moment <= q * ROUNDING, 0.0 * size, moment)

            line = {
                "i": np.full(len(n), first + i, "int32"),
                "j": (second + np.arange(len(right))[at]).astype("int32"),
                "n": n,
                "mean_i": left[i] + s_i / size,
                "mean_j": right[at] + s_j / size,
                "m_ii": central(q_i, s_i),
                "m_jj": central(q_j, s_j),
                "m_ij": cross - s_i * s_j / size,
            }
            yield pa.RecordBatch.from_pydict({k: pa.array(v, from_pandas=True) for k, v in line.items()})

    return work


def correlation_matrix(df: DataFrame, columns: list[str] | None = None, tile: int = TILE) -> DataFrame:
    """Pearson matrix as (var_i, var_j, r), all ordered pairs, null for a constant column.

    Matrices of more than ``tile`` columns are computed in tiles (see :func:`pair_moments`).
    """
    columns = columns or numeric_columns(df)
    names = F.lit(columns)
    moments = pair_moments(df, columns, tile)
    r = share_of(F.col("m_ij"), F.sqrt("m_ii") * F.sqrt("m_jj"))
    r = F.when(F.col("i") == F.col("j"), F.when(F.col("m_ii") > 0, F.lit(1.0))).otherwise(
        F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    )
    half = moments.select(F.get(names, "i").alias("a"), F.get(names, "j").alias("b"), r.alias("r"))
    both = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    )
    return half.select(F.explode(both).alias("pair"), "r").select(
        F.col("pair.a").alias("var_i"), F.col("pair.b").alias("var_j"), "r"
    )


def target_correlation(correlation: DataFrame, target: str = "quality") -> DataFrame:
    """Each variable's correlation with the target, ascending, with its sign class."""
    sign = F.when(F.col("r") > 0, "positive").otherwise("negative")
    return (
        correlation.where((F.col("var_j") == target) & (F.col("var_i") != target))
        .select(F.col("var_i").alias("variable"), "r", sign.alias("sign"))
        .orderBy("r", "variable")
    )


def top_correlated(correlation: DataFrame, target: str = "quality", n: int = 10) -> DataFrame:
    """The n variables with the largest absolute correlation with the target."""
    return (
        target_correlation(correlation, target)
        .select("variable", F.abs("r").alias("abs_r"))
        .orderBy(F.col("abs_r").desc_nulls_last(), "variable")
        .limit(n)
    )


def first_rows(df: DataFrame, on: str = "date_time", n: int = 10) -> DataFrame:
    """The first n rows in time order, ties by the other columns; planned as a top-n, not a sort."""
    return df.orderBy(on, *[c for c in df.columns if c != on]).limit(n)
