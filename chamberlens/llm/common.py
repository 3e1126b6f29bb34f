"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Hashes are drawn from 0 to this number, so that small shares of large tables stay exact.
DRAWS = 1 << 62
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\f\r"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z alone.

    For plain ASCII the built-in does the same and is far faster than ``translate``.
    """
    plain = F.octet_length(c) == F.char_length(c)
    return F.when(plain, F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop the columns that an operator is about to add; names compare as Spark compares them."""
    mine = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in mine])


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Internal column names that no column of ``df`` bears."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def in_letters(c: Column) -> Column:
    """True when the text holds a letter of any script."""
    return F.coalesce(c, F.lit("")).rlike(r"\p{L}")


def draw_of(*columns: Column) -> Column:
    """A hash of the columns, from 0 to below ``DRAWS``."""
    return F.pmod(F.xxhash64(*columns), F.lit(DRAWS))


def draw_limit(wanted: int, size: int) -> int:
    """Of ``size`` rows about ``wanted``, and never fewer on average, have a draw below this."""
    return min(DRAWS, -(-wanted * DRAWS // size))
