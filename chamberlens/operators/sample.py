"""Seeded hold-out split and folds that repartitioning and retries do not change."""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import DataFrame, Window, functions as F

from chamberlens.functions.hashing import hash_position, in_share, row_position
from chamberlens.functions.ranks import even_sizes, holdout_size, order_statistics

COPIES_PER_TASK = 100_000


def holdout(
    df: DataFrame, key: str, frac: float = 0.2, seed: int | None = 42, exact: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(train, test). ``exact`` puts ceil(frac * n) rows into test and runs jobs when called;
    otherwise each key goes there with probability ``frac``, without a pass over the data."""
    if not exact:
        in_test = in_share([key], seed, frac)
        return df.where(~in_test), df.where(in_test)

    def sizes(n: int) -> list[int]:
        test = holdout_size(n, frac)
        return [test, n - test]

    placed = segments(df, key, sizes, seed, "_part")
    return placed.where("_part = 1").drop("_part"), placed.where("_part = 0").drop("_part")


def folds(df: DataFrame, key: str, k: int = 5, seed: int | None = 42, name: str = "fold") -> DataFrame:
    """Add the fold number 0..k-1; fold sizes differ by at most one row. Runs jobs when called."""
    label = None if seed is None else f"fold-{seed}"
    return segments(df, key, lambda n: even_sizes(n, k), label, name)


def segments(
    df: DataFrame, key: str, sizes_of: Callable[[int], list[int]], seed: str | int | None, name: str
) -> DataFrame:
    """Cut the rows, in the order of a key hash, into parts of exactly the given sizes.

    Only the hash values at the cuts are looked up, so with distinct keys the result
    is a column expression: nothing is sorted or shuffled. Where one key's rows lie
    on both sides of a cut, those rows are ordered by their whole content.
    """
    position = hash_position([key], seed)
    cuts: list[int] = []

    def ranks(_: str, n: int) -> list[int]:
        cuts.extend(accumulate(sizes_of(n)))
        return sorted({c for c in cuts[:-1] if c > 0})

    hits = order_statistics(df.select(position.alias("position")), ["position"], ranks)["position"]
    ends = [(c, hits[c]) for c in cuts[:-1] if c > 0]
    empty_before = sum(1 for c in cuts[:-1] if c == 0)
    part = F.lit(empty_before)
    for _, hit in ends:
        part = part + (position > int(hit.value)).cast("int")
    torn = {int(h.value): h.below for c, h in ends if h.below + h.at > c}
    if not torn:
        return df.withColumn(name, part)
    parts = df.where(~position.isin(list(torn))).withColumn(name, part)
    for value, below in torn.items():
        before = empty_before + sum(1 for _, h in ends if int(h.value) < value)
        inner = [c - below for c, h in ends if int(h.value) == value]
        parts = parts.unionByName(_cut_by_content(df.where(position == value), inner, before, name))
    return parts


def _cut_by_content(rows: DataFrame, cuts: list[int], before: int, name: str) -> DataFrame:
    """Cut rows that share a key; copies are counted, not moved, and split by number."""
    columns = rows.columns
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")).withColumn("_position", row_position(columns))
    hits = order_statistics(counted, ["_position"], lambda _, n: sorted({c for c in cuts if c < n}), "_copies")["_position"]
    part = F.lit(before)
    for cut in cuts:
        part = part + ((F.col("_position") > int(hits[cut].value)) if cut in hits else F.lit(False)).cast("int")
    torn = sorted({int(h.value) for h in hits.values()})
    whole = counted.where(~F.col("_position").isin(torn)).withColumn(name, part)

    # a torn position holds one distinct row (bar a hash collision) and its copies
    below = F.lit(0).cast("bigint")
    for hit in hits.values():
        below = F.when(F.col("_position") == int(hit.value), F.lit(hit.below)).otherwise(below)
    run = Window.partitionBy("_position").orderBy(*columns).rowsBetween(Window.unboundedPreceding, 0)
    ranged = counted.where(F.col("_position").isin(torn)).withColumn("_end", below + F.sum("_copies").over(run))
    start = F.col("_end") - F.col("_copies")
    edges = [0, *sorted(hits), None]
    pieces = F.array(
        *[
            F.struct(
                F.lit(before + i).alias(name),
                ((F.least(F.col("_end"), F.lit(high)) if high is not None else F.col("_end")) - F.greatest(start, F.lit(low)))
                .cast("bigint")
                .alias("_copies"),
            )
            for i, (low, high) in enumerate(zip(edges, edges[1:]))
        ]
    )
    split = (
        ranged.withColumn("_piece", F.explode(pieces))
        .select(*columns, "_position", F.col(f"_piece.{name}").alias(name), F.col("_piece._copies").alias("_copies"))
        .where("_copies > 0")
    )
    return _repeat(whole.unionByName(split, allowMissingColumns=False), columns, name)


def _repeat(counted: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Each row ``_copies`` times; many copies are handed to many tasks first."""
    per_task = F.lit(COPIES_PER_TASK)
    blocks = counted.withColumn("_block", F.explode(F.expr(f"sequence(0L, (_copies - 1) div {COPIES_PER_TASK}L)")))
    size = F.least(per_task, F.col("_copies") - F.col("_block") * per_task).cast("bigint")
    return (
        blocks.withColumn("_size", size)
        .repartition("_position", name, "_block")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_size"))))
        .select(*columns, name)
    )
