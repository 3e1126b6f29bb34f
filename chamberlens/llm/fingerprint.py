"""Document fingerprints from prefix polynomial hashes.

``PrefixHashes`` keeps, per text, the polynomial hash of every prefix modulo a prime, for two bases.
The hash of any span is a difference of two prefixes, so spans compare in constant time,
and the longest common extension of two places is found by binary search.

A fingerprint is cut from such arrays: the length and hash of the whole text, the hashes
of prefixes and suffixes of fixed lengths (its rungs), and the smallest distinct hashes of
all spans of ``SPAN`` code points. Two fingerprints alone tell how alike their texts are.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from chamberlens.llm.common import draw_limit, draw_of

#: A Mersenne prime, so that remainders are shifts and sums; two bases for 62 bits.
PRIME = 2_147_483_647
BASES = (1_103_515_245, 1_220_703_125)
INVERSES = tuple(pow(b, -1, PRIME) for b in BASES)
#: Powers are kept up to this place; longer texts go on block by block.
BLOCK = 1 << 15
#: Code points of a span, span hashes kept, and bytes of each of them.
SPAN, KEPT, KEPT_BYTES = 16, 64, 6
#: Rows sampled per partition to find where to divide the documents.
SAMPLED = 20


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, in place; x lies from 0 to below 2**62."""
    for _ in range(2):
        high = x >> 31
        x &= PRIME
        x += high
    x[x == PRIME] = 0
    return x


def _column(bases: tuple[int, int], power: int) -> np.ndarray:
    return np.array([[pow(b, power, PRIME)] for b in bases])


@cache
def _powers(bases: tuple[int, int]) -> np.ndarray:
    powers = np.ones((2, BLOCK), np.int64)
    size = 1
    while size < BLOCK:
        powers[:, size : 2 * size] = powers[:, :size] * _column(bases, size) % PRIME
        size *= 2
    return powers


class PrefixHashes:
    """Modular hashes of all prefixes of a text: the sum of (c + 1) * base**place, a row
    of ``sums`` per base."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.length = len(codes)
        self.sums = np.zeros((2, self.length + 1), np.uint32)
        for at in range(0, self.length, BLOCK):
            part = codes[at : at + BLOCK].astype(np.int64) + 1
            sums = _reduced(_reduced(part * _powers(BASES)[:, : len(part)]).cumsum(1))
            if at:
                sums = _reduced(sums * _column(BASES, at) + self.sums[:, at : at + 1])
            self.sums[:, at + 1 : at + 1 + len(part)] = sums

    def span(self, start: int, end: int) -> int:
        """Hash of text[start:end], the same wherever the span stands."""
        found = 0
        for sums, inverse in zip(self.sums, INVERSES):
            shifted = int(sums[end]) - int(sums[start])
            found = found << 31 | (shifted * pow(inverse, start, PRIME) if start else shifted) % PRIME
        return found

    def spans(self, width: int) -> Iterator[np.ndarray]:
        """Hashes of all spans of ``width`` code points, by start, a block at a time."""
        for at in range(0, self.length - width + 1, BLOCK):
            end = min(at + BLOCK, self.length - width + 1)
            shifted = self.sums[:, at + width : end + width].astype(np.int64)
            shifted -= self.sums[:, at:end]
            shifted += PRIME * (shifted < 0)
            shifted = _reduced(shifted * _powers(INVERSES)[:, : end - at])
            if at:
                shifted = _reduced(shifted * _column(INVERSES, at))
            yield shifted[0] << 31 | shifted[1]


def equal_spans(a: PrefixHashes, i: int, b: PrefixHashes, j: int, length: int) -> bool:
    """Whether a's span of ``length`` from i equals b's from j; false beyond an end."""
    if i + length > a.length or j + length > b.length:
        return False
    return a.span(i, i + length) == b.span(j, j + length)


def longest_common_extension(a: PrefixHashes, i: int, b: PrefixHashes, j: int) -> int:
    """How far a from i and b from j agree, by binary search over span equality."""
    return _last(lambda n: equal_spans(a, i, b, j, n), min(a.length - i, b.length - j))


def _last(holds: Callable[[int], bool], most: int) -> int:
    """The largest number up to ``most`` that holds, where all smaller ones do too."""
    return bisect_left(range(1, most + 1), True, key=lambda n: not holds(n))


@cache
def _rungs() -> tuple[np.ndarray, np.ndarray]:
    """Lengths whose prefix and suffix a fingerprint holds, and the base to their power:
    all lengths up to 16, then each a fifth longer than the one before."""
    lengths, at = [], 1
    while at < 1 << 40:
        lengths.append(at)
        at += max(1, at // 5) if at >= 16 else 1
    return np.array(lengths), np.array([pow(BASES[0], n, PRIME) for n in lengths])


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """Spread hashes evenly over 48 bits, so that the smallest are a fair draw."""
    mixed = hashes.astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed >> np.uint64(16)


def _smallest(values: np.ndarray, n: int) -> np.ndarray:
    """The n smallest distinct values, ascending."""
    if len(values) > 4 * n:
        few = np.unique(values[values <= np.partition(values, 2 * n)[2 * n]])
        if len(few) >= n:
            return few[:n]
    return np.unique(values)[:n]


@dataclass(frozen=True)
class Fingerprint:
    """What a fingerprint's text holds: ``length`` and ``whole`` hash, hashes of the
    rungs' prefixes and suffixes, and the smallest span hashes."""

    length: int
    whole: int
    prefixes: np.ndarray
    suffixes: np.ndarray
    kept: np.ndarray

    @classmethod
    def of(cls, hashes: PrefixHashes) -> "Fingerprint":
        """Equal texts have equal fingerprints. A text shorter than ``SPAN`` is one span."""
        n, sums = hashes.length, hashes.sums[0]
        lengths, powers = _rungs()
        fitting = int(np.searchsorted(lengths, n, side="right"))
        lengths, powers = lengths[:fitting], powers[:fitting]
        back = pow(INVERSES[0], n, PRIME)
        suffixes = (int(sums[n]) - sums[n - lengths].astype(np.int64)) % PRIME * back % PRIME * powers % PRIME
        kept = np.zeros(0, np.uint64)
        if n:
            for found in hashes.spans(min(SPAN, n)):
                kept = _smallest(np.concatenate((kept, _mixed(found))), KEPT)
        return cls(n, hashes.span(0, n), sums[lengths].astype(np.int64), suffixes, kept)

    def __str__(self) -> str:
        rungs = np.concatenate((self.prefixes, self.suffixes)).astype(">u4").tobytes()
        head = np.array([self.length, self.whole], ">u8").tobytes()
        kept = self.kept.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - KEPT_BYTES :].tobytes()
        return base64.b64encode(head + rungs + kept).decode()

    @classmethod
    def parse(cls, text: str) -> "Fingerprint":
        raw = base64.b64decode(text)
        n, whole = (int(v) for v in np.frombuffer(raw, ">u8", 2))
        fitting = int(np.searchsorted(_rungs()[0], n, side="right"))
        rungs = np.frombuffer(raw, ">u4", 2 * fitting, 16).astype(np.int64)
        kept = np.frombuffer(raw, np.uint8, offset=16 + 8 * fitting).reshape(-1, KEPT_BYTES)
        padded = np.zeros((len(kept), 8), np.uint8)
        padded[:, 8 - KEPT_BYTES :] = kept
        return cls(n, whole, rungs[:fitting], rungs[fitting:], padded.view(">u8").ravel().astype(np.uint64))

    def likeness(self, other: "Fingerprint") -> float:
        """From 0 to 1, and 1 for equal texts: the larger of two estimates.

        One is the share of distinct spans in common, from the smallest of both texts'
        hashes (exact while both hold all their spans). The other is the part of the
        longer text covered by the common prefix and suffix, each found by binary search
        over the rungs and rounded down to one.
        """
        longer = max(self.length, other.length)
        if not longer or (self.length == other.length and self.whole == other.whole):
            return 1.0
        union = np.union1d(self.kept, other.kept)[:KEPT]
        both = np.intersect1d(self.kept, other.kept, assume_unique=True)
        spans = len(np.intersect1d(union, both, assume_unique=True)) / len(union)
        ends = sum(
            int(_rungs()[0][agreed - 1]) if agreed else 0
            for agreed in (_agreeing(self.prefixes, other.prefixes), _agreeing(self.suffixes, other.suffixes))
        )
        return max(spans, min(1.0, ends / longer))


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    return _last(lambda n: a[n - 1] == b[n - 1], min(len(a), len(b)))


@F.pandas_udf(T.StringType())
def fingerprint(text: pd.Series) -> pd.Series:
    """The fingerprint of every text; null counts as empty."""
    return text.map(lambda t: str(Fingerprint.of(PrefixHashes(t or ""))))


@F.pandas_udf(T.DoubleType())
def likeness(one: pd.Series, other: pd.Series) -> pd.Series:
    """How alike two texts are, told by their fingerprints; null where one is null."""
    return pd.Series([None if a is None or b is None else Fingerprint.parse(a).likeness(Fingerprint.parse(b)) for a, b in zip(one, other)], dtype="float64")


PAIRED = "n_chars bigint, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_prefix bigint"
#: Characters of results handed on at once.
YIELD = 1 << 22


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document next to an edited form of itself and to the document after it.

    Documents follow each other by falling id; after the last comes the first. ``edited``
    is the text with its last floor(n_chars / 2) code points replaced by as many from the
    start of the next document (all, if it has fewer). The result has the id, ``n_chars``,
    ``edited``, both fingerprints, the likeness of the document's fingerprint to the
    edited text's and to the next document's, and ``common_prefix``: code points up to
    which text and edited text agree.

    Null text is empty. Rows without id come last; rows that share an id follow by a hash
    of the text, and copies (same id and text) follow each other. Other columns are
    ignored. A document alone is its own next.

    Texts are shuffled once: rows of a sample divide the order into partitions, and the
    row at the end of each also goes to the next, whose first row needs it. The division
    counts copies apart by their place in ``docs``, so that many of them share several
    tasks; ``docs`` must therefore read alike twice, as a table or a stored result does.
    If it does not, the run fails rather than pair wrongly. Memory of a task: one Arrow
    batch, and for one text at a time nine times its length.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumns(
        {"mark": F.xxhash64("text"), "place": F.monotonically_increasing_id()}
    )
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = _divided(keyed, parts)
    if not bounds:
        return keyed.where("false").selectExpr(f"id AS `{id_col}`", *[f"CAST(NULL AS {t}) AS {c}" for c, t in (x.split(" ") for x in PAIRED.split(", "))])
    shared = spark.sparkContext.broadcast(bounds)

    @F.pandas_udf("int")
    def part_of(held: pd.Series, ids: pd.Series, mark: pd.Series, place: pd.Series) -> pd.Series:
        """Twice the partition, and one more where the row ends it."""
        ends = shared.value
        keys = list(zip(held.tolist(), ids.tolist(), mark.tolist(), place.tolist()))
        found = [bisect_left(ends, key) for key in keys]
        return pd.Series([2 * p + (ends[p] == key) for p, key in zip(found, keys)], dtype="int32")

    part = F.floor(F.col("code") / 2).cast("int")
    own = F.struct(part.alias("part"), F.lit(False).alias("lead"))
    also = F.struct(((part + 1) % len(bounds)).alias("part"), F.lit(True).alias("lead"))
    dealt = keyed.withColumn("code", part_of(*_key())).select(
        "id", "text", "mark", "place", F.inline(F.when(F.col("code") % 2 == 1, F.array(own, also)).otherwise(F.array(own)))
    )
    ordered = dealt.repartitionById(len(bounds), F.col("part")).sortWithinPartitions(F.desc("lead"), F.asc_nulls_first("id"), "mark", "place")
    return ordered.select("id", "text", "lead").mapInArrow(_paired, f"id {kind}, {PAIRED}").withColumnRenamed("id", id_col)


def _key() -> list[Column]:
    """Order of the rows as values without nulls; rows without id come first, as the
    successor of a row by falling id is the one before it."""
    return [F.col("id").isNotNull(), F.coalesce("id", F.lit(0).cast("string")), "mark", "place"]


def _divided(keyed: DataFrame, parts: int) -> list[tuple]:
    """Keys of the rows that end the partitions, ascending; the last is the largest of all.

    About ``SAMPLED`` rows per partition, drawn by hash, tell where to divide.
    """
    size = keyed.count()
    if not size:
        return []
    key = F.struct(*[k.alias(f"k{i}") if isinstance(k, Column) else F.col(k) for i, k in enumerate(_key())])
    drawn = draw_of(F.col("mark"), F.col("place")) < draw_limit(parts * SAMPLED, size)
    row = keyed.agg(F.max(key).alias("last"), F.collect_list(F.when(drawn, key)).alias("sample")).first()
    sample = sorted(tuple(r) for r in row["sample"])
    chosen = {sample[i * len(sample) // parts] for i in range(1, parts)} if sample else set()
    return sorted(chosen | {tuple(row["last"])})


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", *[x.split(" ")[0] for x in PAIRED.split(", ")]]
    before: tuple[str, Fingerprint, str] | None = None
    for batch in batches:
        kind = batch.schema.field(0).type
        rows, held = [], 0
        for name, text, lead in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            text = text.as_py()
            hashes = PrefixHashes(text)
            own = Fingerprint.of(hashes)
            told = str(own)
            if not lead:
                if before is None:
                    raise RuntimeError("the rows of docs changed between two readings")
                half = len(text) // 2
                edited = text[: len(text) - half] + before[0][:half]
                other = PrefixHashes(edited)
                changed = Fingerprint.of(other)
                agreed = longest_common_extension(hashes, 0, other, 0)
                rows.append(
                    (name, len(text), edited, told, str(changed), own.likeness(changed), own.likeness(before[1]), agreed)
                )
                held += len(edited)
            before = (text, own, told)
            if held > YIELD:
                yield _batch(rows, kind, names)
                rows, held = [], 0
        if rows:
            yield _batch(rows, kind, names)


def _batch(rows: list[tuple], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
