"""Scalar building blocks, as SQL text: a sensor table is wide, and one parsed
expression per column builds its plan many times faster than chained Column calls.
All of them stay inside whole-stage codegen and also accept streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
FLOATING = (T.FloatType, T.DoubleType)
WHOLE = ("tinyint", "smallint", "int", "bigint")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rewritten(df: DataFrame, changes: dict[str, str]) -> DataFrame:
    """Replace or append columns given as SQL text, all in one projection."""
    columns = [f"{changes[c]} AS {quoted(c)}" if c in changes else quoted(c) for c in df.columns]
    added = [f"{sql} AS {quoted(c)}" for c, sql in changes.items() if c not in df.columns]
    return df.selectExpr(*columns, *added)


def with_facts(df: DataFrame, facts: DataFrame) -> DataFrame:
    """Add the struct ``_facts`` holding the one row of ``facts`` (an aggregate).

    It is a scalar subquery: computed once before the scan of ``df``, no join. Being
    one column, it is planned once however many expressions read its fields.
    """
    return df.withColumn("_facts", facts.select(F.struct(*facts.columns)).scalar())


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Every numeric column but the excluded ones: the feature list of a sensor table."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def type_names(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def prefixed(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def nan_as_null(df: DataFrame) -> DataFrame:
    """One notion of a gap: NaN in a floating column becomes null.

    Spark orders NaN above every number, so a comparison with NaN would be true.
    """
    floating = {
        f.name: f"CASE WHEN NOT isnan({quoted(f.name)}) THEN {quoted(f.name)} END"
        for f in df.schema.fields
        if isinstance(f.dataType, FLOATING)
    }
    return rewritten(df, floating) if floating else df


def has_no_gap(df: DataFrame, columns: list[str]) -> str:
    """True when none of ``columns`` is null or NaN.

    Written as one IS NOT NULL per column, which the Parquet reader can use.
    """
    tests = []
    for field in df.schema.fields:
        if field.name in columns:
            tests.append(f"{quoted(field.name)} IS NOT NULL")
            if isinstance(field.dataType, FLOATING):
                tests.append(f"NOT isnan({quoted(field.name)})")
    return " AND ".join(tests) or "true"


def far_apart(first: str, second: str, threshold: float) -> str:
    """Strictly more than ``threshold`` apart; null when either is a gap."""
    return f"abs({quoted(first)} - {quoted(second)}) > {threshold}"


def floored_mean(first: str, second: str, kind: str) -> str:
    """Mean of two readings rounded towards minus infinity (``div`` truncates instead).

    Whole numbers are halved by a shift, exact and short in generated code.
    """
    if kind in WHOLE:
        return f"CAST(shiftright(CAST({quoted(first)} AS BIGINT) + {quoted(second)}, 1) AS {kind})"
    return f"CAST(floor(({quoted(first)} + {quoted(second)}) / 2) AS {kind})"


def clipped(name: str, low: float, high: float, kind: str) -> str:
    """Clip that keeps a gap a gap; ``greatest``/``least`` would skip the null."""
    c = quoted(name)
    return f"CAST(CASE WHEN {c} < {low} THEN {low} WHEN {c} > {high} THEN {high} ELSE {c} END AS {kind})"


def hour_of(name: str) -> str:
    """Start of the hour. The window keeps the zone-naive type, ``date_trunc`` does not."""
    return f"window({quoted(name)}, '1 hour').start"


def share_of(part: Column, whole: Column) -> Column:
    """Division that gives null, not an error, for an empty or constant denominator."""
    return F.try_divide(part, whole)
