"""Stable pseudo-random positions for rows.

They depend on the key and the seed alone, so a split is the same after any
repartitioning or retry, unlike ``rand`` or ``randomSplit``.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, functions as F


def key_digest(keys: list[str], seed: str | int | None) -> Column:
    """md5 of the key columns' text, with the seed as a suffix unless it is None."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    if seed is not None:
        parts.append(F.lit(str(seed)))
    return F.md5(F.concat_ws("|", *parts))


def hex_number(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def hash_bucket(keys: list[str], seed: str | int | None, buckets: int = 100) -> Column:
    return hex_number(key_digest(keys, seed), 8) % buckets


def in_share(keys: list[str], seed: str | int | None, share: float) -> Column:
    """True for ``share`` of the keys: whole per cents by bucket, the rest by further digits."""
    whole, rest = divmod(Fraction(str(share)) * 100, 1)
    bucket, finer = hash_bucket(keys, seed), F.conv(F.substring(key_digest(keys, seed), 9, 13), 16, 10).cast("bigint")
    return (bucket < int(whole)) | ((bucket == int(whole)) & (finer < int(rest * 2**52)))


def hash_position(keys: list[str], seed: str | int | None) -> Column:
    """Position below 2**52, so that a double holds it exactly."""
    return hex_number(key_digest(keys, seed), 13)


def row_position(columns: list[str]) -> Column:
    """Position of a row by its whole content, also below 2**52."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 12)
