"""Repair, clip and audit sensor readings; scale the target; parse times."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from chamberlens.functions.columns import (
    clipped,
    far_apart,
    floored_mean,
    has_no_gap,
    nan_as_null,
    prefixed,
    quoted,
    rewritten,
    type_names,
    with_facts,
)

# Five chambers, three probes each.
CHAMBERS = 5
PROBES = 3
TRIPLETS = [tuple(f"T_data_{i}_{j}" for j in range(1, PROBES + 1)) for i in range(1, CHAMBERS + 1)]
# Largest credible gap to a sibling probe, and the temperature range.
THRESHOLD = 50
LOWEST, HIGHEST = 0, 1200

Triplets = list[tuple[str, str, str]]


def _flag(probe: str) -> str:
    return f"flag_{probe}"


def _apart(first: str, second: str) -> str:
    return f"apart_{first}_{second}"


def _with_pairs(df: DataFrame, triplets: Triplets, threshold: float) -> tuple[DataFrame, list[str]]:
    """Add one boolean per pair of sibling probes; each serves two probes."""
    pairs = {_apart(a, b): far_apart(a, b, threshold) for t in triplets for a, b in combinations(t, 2)}
    return rewritten(nan_as_null(df), pairs), list(pairs)


def _is_off(triplet: tuple[str, str, str], position: int) -> str:
    """The probe is far from both siblings; null or false with a gap among them."""
    return " AND ".join(
        quoted(_apart(a, b)) for a, b in combinations(triplet, 2) if triplet[position] in (a, b)
    )


def anomaly_flags(df: DataFrame, triplets: Triplets = TRIPLETS, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``flag_<probe>``: the probe is far from both siblings of its chamber."""
    paired, pairs = _with_pairs(df, triplets, threshold)
    flags = {_flag(p): f"coalesce({_is_off(t, i)}, false)" for t in triplets for i, p in enumerate(t)}
    return rewritten(paired, flags).drop(*pairs)


def repair_triplets(df: DataFrame, triplets: Triplets = TRIPLETS, threshold: float = THRESHOLD) -> DataFrame:
    """Replace a probe far from both siblings by their floored mean.

    The distances are all taken on the raw readings; the replacements then run probe
    by probe, so the second probe of an incoherent chamber already sees the first one
    repaired. The generated method for 15 probes has to stay below 8000 bytes of
    bytecode, beyond which the JVM only interprets it: hence pair flags and shifts.
    """
    repaired, pairs = _with_pairs(df, triplets, threshold)
    kinds = type_names(repaired)
    for position in range(PROBES):
        changes = {}
        for t in triplets:
            first, second = (p for i, p in enumerate(t) if i != position)
            mean = floored_mean(first, second, kinds[t[position]])
            changes[t[position]] = f"CASE WHEN {_is_off(t, position)} THEN {mean} ELSE {quoted(t[position])} END"
        repaired = rewritten(repaired, changes)
    return repaired.drop(*pairs)


def clip_prefix(df: DataFrame, prefix: str = "T_", low: float = LOWEST, high: float = HIGHEST) -> DataFrame:
    """Clip every column whose name starts with ``prefix``."""
    kinds = type_names(df)
    return rewritten(df, {c: clipped(c, low, high, kinds[c]) for c in prefixed(df, prefix)})


def drop_gaps(df: DataFrame) -> DataFrame:
    """Drop rows with a gap in any column."""
    return df.where(has_no_gap(df, df.columns))


def clean_sensors(df: DataFrame | None, triplets: Triplets = TRIPLETS, threshold: float = THRESHOLD) -> DataFrame | None:
    """Repair, clip, drop rows with gaps.

    Repair and clip neither make nor fill a gap (a flag needs all three probes),
    so the gap filter is put first: it then reads raw columns and reaches the scan.
    """
    if df is None:
        return None
    return clip_prefix(repair_triplets(drop_gaps(df), triplets, threshold))


def cleaning_audit(df: DataFrame, triplets: Triplets = TRIPLETS, threshold: float = THRESHOLD) -> DataFrame:
    """Rows before, after and removed, and flags raised per chamber, in one aggregate."""
    raised = [
        f"coalesce(sum({' + '.join(f'CAST({quoted(_flag(p))} AS BIGINT)' for p in t)}), 0) AS flags_chamber_{i}"
        for i, t in enumerate(triplets, start=1)
    ]
    return anomaly_flags(df, triplets, threshold).selectExpr(
        "count(*) AS rows_before",
        f"count_if({has_no_gap(df, df.columns)}) AS rows_after",
        f"count_if(NOT ({has_no_gap(df, df.columns)})) AS rows_removed",
        *raised,
    )


def normalize(df: DataFrame | None, col: str = "quality", scale: float = 100, fit_on: DataFrame | None = None) -> DataFrame | None:
    """Min-max scale to [0, scale]; a constant column becomes null.

    The range is a scalar subquery: one aggregated row, computed once, no join.
    It comes from ``df`` itself unless ``fit_on`` (say, the training rows) is given.
    """
    if df is None:
        return None
    df = nan_as_null(df)
    source = df if fit_on is None else nan_as_null(fit_on)
    limits = source.agg(F.min(col).alias("low"), F.max(col).alias("high"))
    c = quoted(col)
    scaled = f"try_divide(CAST({c} - _facts.low AS DOUBLE), CAST(_facts.high - _facts.low AS DOUBLE)) * {scale}"
    return rewritten(with_facts(df, limits), {col: scaled}).drop("_facts")


def parse_time(df: DataFrame | None, col: str = "date_time", errors: str = "raise", fmt: str | None = None) -> DataFrame | None:
    """Text to zone-naive timestamp. A bad value raises, or is null with ``errors="null"``."""
    if df is None:
        return None
    if errors not in ("raise", "null"):
        raise ValueError("errors must be 'raise' or 'null'")
    if dict(df.dtypes)[col] == "timestamp_ntz":
        return df
    text = F.col(col).cast("string")
    if errors == "raise":
        return df.withColumn(col, F.to_timestamp_ntz(text, F.lit(fmt)) if fmt else text.cast("timestamp_ntz"))
    lenient = F.try_to_timestamp(text, F.lit(fmt)) if fmt else text
    return df.withColumn(col, lenient.try_cast("timestamp_ntz"))


def selected_features(df: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Project to the listed features as doubles, plus key or target columns as they are."""
    return df.selectExpr(*map(quoted, keep), *[f"CAST({quoted(c)} AS DOUBLE) AS {quoted(c)}" for c in columns])
