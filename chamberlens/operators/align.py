"""Bring sensors and quality onto one time axis, three ways."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chamberlens.functions.columns import hour_of, numeric_columns, quoted, rewritten, text, with_facts
from chamberlens.operators.clean import drop_gaps

# An hour of fewer measurements is never spread.
CROWDED_ROWS = 1000
STATS = {"mean": "avg", "max": "max", "min": "min", "std": "stddev_samp"}


def shift_time(df: DataFrame, col: str = "date_time", hours: int = -1) -> DataFrame:
    """Move the time axis; quality at hour H describes the sensors of H-1."""
    return rewritten(df, {col: f"{quoted(col)} + make_dt_interval(0, {int(hours)})"})


def _refuse_shared_names(x: DataFrame, y: DataFrame, on: str) -> None:
    shared = (set(x.columns) & set(y.columns)) - {on}
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")


def exact_join(x: DataFrame, y: DataFrame, on: str = "date_time") -> DataFrame:
    """Inner equi-join on the time.

    No hint: Spark broadcasts the smaller side only when its size is known to be
    small. Both sides otherwise meet in a sort-merge join straight after their
    shuffles, the shape in which adaptive execution splits an over-full time
    value by map output, copies included.
    """
    _refuse_shared_names(x, y, on)
    return x.join(y, on, "inner")


def left_align(x: DataFrame, y: DataFrame, on: str = "date_time") -> DataFrame:
    """Keep every sensor row, target null where there is no measurement.

    Repeated measurement times would multiply sensor rows, so they raise. The check is a
    scalar subquery over the keys of ``y`` and part of the join key: no choice of columns,
    not even a count, can leave it out.
    """
    _refuse_shared_names(x, y, on)
    repeated = y.where(F.col(on).isNotNull()).groupBy(on).count().where("count > 1").agg(F.count("*").alias("repeated"))
    refusal = f"raise_error({text(f'left_align: repeated values of {on} on the right side')})"
    guard = {on: f"CASE WHEN _facts.repeated > 0 THEN {refusal} ELSE {quoted(on)} END"}
    guarded = rewritten(with_facts(y, repeated), guard).drop("_facts")
    return x.join(guarded, on, "left")


def hourly_features(x: DataFrame, on: str = "date_time", stats: tuple[str, ...] = ("mean", "max", "min", "std")) -> DataFrame:
    """One row per hour with ``<column>_<stat>`` for every numeric column.

    All four statistics combine on the map side, so a crowded hour costs one
    partial row per task.
    """
    measures = [
        f"CAST({STATS[s]}({quoted(c)}) AS DOUBLE) AS {quoted(f'{c}_{s}')}" for c in numeric_columns(x, (on,)) for s in stats
    ]
    return x.sparkSession.sql(
        f"SELECT {hour_of(on)} AS {quoted(on)}, {', '.join(measures)} FROM {{x}} GROUP BY window({quoted(on)}, '1 hour')", x=x
    )


def hourly_join(
    x: DataFrame,
    y: DataFrame,
    on: str = "date_time",
    stats: tuple[str, ...] = ("mean", "max", "min", "std"),
    slices: int | None = None,
) -> DataFrame:
    """Hourly sensor features joined with each measurement of the hour, gaps dropped.

    A crowded hour of measurements is spread over several keys, so that it can reach all
    shuffle partitions: by its share of the measurements it gets as many of the ``slices``,
    by default four for each partition. The slice is the number of the map task, which a
    retry repeats and which separates copies too. Only the features of crowded hours, of
    which there are at most ``slices``, are repeated, all together at most twice as often.
    """
    slices = slices or 4 * int(x.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    features = hourly_features(x, on, stats)
    _refuse_shared_names(features, y, on)
    measured = rewritten(y, {on: hour_of(on)})
    crowds = _crowded(measured, on, slices)
    slices_of = f"coalesce(try_element_at(_facts.crowds, {quoted(on)}), 1)"
    spread = with_facts(features, crowds).withColumn("_slice", F.expr(f"explode(sequence(0, {slices_of} - 1))"))
    dealt = rewritten(with_facts(measured, crowds), {"_slice": f"spark_partition_id() % {slices_of}"})
    return drop_gaps(spread.drop("_facts").join(dealt.drop("_facts"), [on, "_slice"], "inner").drop("_slice"))


def _crowded(measured: DataFrame, on: str, slices: int) -> DataFrame:
    """One row with ``crowds``: hour to number of slices, for hours of more than
    ``CROWDED_ROWS`` rows and more than one of ``slices`` equal shares."""
    hours = measured.where(F.col(on).isNotNull()).groupBy(F.col(on).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    total = measured.where(F.col(on).isNotNull()).agg(F.count(F.lit(1)).alias("total"))
    share = f"CAST(ceil(n * {slices} / _facts.total) AS INT)"
    crowded = with_facts(hours.where(f"n > {CROWDED_ROWS}"), total).where(f"n * {slices} > _facts.total")
    entries = F.collect_list(F.struct("hour", F.expr(share).alias("slices")))
    return crowded.agg(F.map_from_entries(entries).alias("crowds"))
