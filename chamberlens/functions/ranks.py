"""Exact order statistics without a global sort.

The built-in exact percentile keeps every distinct value of a column in one
aggregation buffer, which grows with the data. Here each pass counts values into
equal-width slices of the interval that still holds the wanted rank; counting
combines on the map side, and the driver sees a fixed number of slices. The next
pass looks only inside the one slice that holds the rank, until that slice holds
a single value. Where most rows fall into one slice, or the interval is wider than
a double can say, the next slices are of equal width in the logarithm, so values of
any magnitude take a few passes. Repeated values share a slice, so they cost nothing
extra; infinite values are counted apart.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import ceil, floor, inf, isinf, log

from pyspark.sql import DataFrame, functions as F

from chamberlens.functions.columns import quoted

SLICES_PER_PASS = 65_536


@dataclass(frozen=True)
class Hit:
    """Value at a rank, and how many rows lie below it and at it."""

    value: float
    below: int
    at: int


@dataclass(frozen=True)
class _Span:
    low: float
    high: float
    below: int
    inside: int
    crowded: bool = False

    @property
    def by_magnitude(self) -> bool:
        """Slice the logarithm: the width overflows, or the last equal slices told little."""
        return isinf(self.high - self.low) or (self.crowded and _magnitude(self.high) - _magnitude(self.low) > 1)


def _magnitude(v: float) -> float:
    """Rising with v over all finite doubles; the smallest one's logarithm is above -745."""
    return log(v) + 746 if v > 0 else -(log(-v) + 746) if v < 0 else 0.0


def _magnitude_sql(v: str) -> str:
    return f"CASE WHEN {v} > 0 THEN ln({v}) + 746D WHEN {v} < 0 THEN -(ln(-{v}) + 746D) ELSE 0D END"


def order_statistics(
    df: DataFrame,
    columns: list[str],
    ranks_of: Callable[[str, int], list[int]],
    weight: str | None = None,
) -> dict[str, dict[int, Hit]]:
    """Values at the 1-based ranks ``ranks_of(column, n)`` of each column.

    Gaps are left out. ``weight`` names a column of copies per row.
    """
    number = quoted(weight) if weight else "1L"
    values = {c: f"CAST({quoted(c)} AS DOUBLE)" for c in columns}
    def tests(v: str) -> dict[str, str]:
        return {"finite": f"abs({v}) < double('inf')", "low": f"{v} = double('-inf')", "high": f"{v} = double('inf')"}

    first = df.selectExpr(
        *[
            f"struct(min({v}) FILTER (WHERE {t['finite']}) AS low, max({v}) FILTER (WHERE {t['finite']}) AS high, "
            + ", ".join(f"coalesce(sum({number}) FILTER (WHERE {t[k]}), 0) AS n_{k}" for k in t)
            + f") AS c{i}"
            for i, (v, t) in enumerate((v, tests(v)) for v in values.values())
        ]
    ).first()

    found: dict[str, dict[int, Hit]] = {c: {} for c in columns}
    open_spans: dict[str, dict[int, _Span]] = {}
    for i, c in enumerate(columns):
        low, high, finite, n_low, n_high = first[f"c{i}"]
        n = finite + n_low + n_high
        if not n:
            continue
        for rank in ranks_of(c, n):
            if not 1 <= rank <= n:
                raise ValueError(f"rank {rank} outside 1..{n} for {c}")
            if rank <= n_low:
                found[c][rank] = Hit(-inf, 0, n_low)
            elif rank > n - n_high:
                found[c][rank] = Hit(inf, n - n_high, n_high)
            else:
                _settle(found, open_spans, c, rank, _Span(low, high, n_low, finite))

    while any(open_spans.values()):
        spans = {c: sorted({s for s in r.values()}, key=lambda s: s.low) for c, r in open_spans.items() if r}
        tallies = _slice_counts(df, values, number, spans)
        for c, wanted in open_spans.items():
            for rank, span in list(wanted.items()):
                passed = span.below
                for low, high, n in tallies[(c, span)]:
                    if passed + n >= rank:
                        del wanted[rank]
                        if (low, high) == (span.low, span.high):
                            raise RuntimeError(f"no progress between {low} and {high} for {c}")
                        _settle(found, open_spans, c, rank, _Span(low, high, passed, n, 64 * n > span.inside))
                        break
                    passed += n
    return found


def _settle(found, open_spans, column, rank, span) -> None:
    if span.low == span.high:
        found[column][rank] = Hit(span.low, span.below, span.inside)
    else:
        open_spans.setdefault(column, {})[rank] = span


def _exact(value: float) -> str:
    """A double literal that reads back as the same number."""
    return f"{value!r}D"


def _slice_counts(df, values, number, spans):
    """Per span: (low, high, rows) of each non-empty slice, in value order."""
    total = sum(len(s) for s in spans.values())
    slices = max(64, SLICES_PER_PASS // total)
    slots, entries, near = [], [], []
    for c, column_spans in spans.items():
        v = values[c]
        slot, place = [], []
        for span in column_spans:
            low, high = _exact(span.low), _exact(span.high)
            near.append(f"{v} BETWEEN {low} AND {high}")
            slot.append(f"WHEN {v} BETWEEN {low} AND {high} THEN {len(slots)}")
            if span.by_magnitude:
                start, stop = _magnitude(span.low), _magnitude(span.high)
                cut = f"CAST(floor((({_magnitude_sql(v)}) - {start!r}D) / {stop - start!r}D * {slices}) AS INT)"
            else:
                cut = f"CAST(floor(({v} - {low}) / ({high} - {low}) * {slices}) AS INT)"
            place.append(f"WHEN {v} BETWEEN {low} AND {high} THEN greatest(least({cut}, {slices - 1}), 0)")
            slots.append((c, span))
        entries.append(f"struct(CASE {' '.join(slot)} END AS slot, CASE {' '.join(place)} END AS slice, {v} AS value)")
    rows = (
        # a short test for one column; for many it would only burden the optimizer
        df.where(" OR ".join(near) if len(spans) == 1 else "true")
        .selectExpr(f"explode(array({', '.join(entries)})) AS e", f"{number} AS n")
        .where("e.slot IS NOT NULL")
        .groupBy("e.slot", "e.slice")
        .agg(F.min("e.value").alias("low"), F.max("e.value").alias("high"), F.sum("n").alias("n"))
        .collect()
    )
    tallies = {slot: [] for slot in slots}
    for row in sorted(rows, key=lambda r: (r["slot"], r["slice"])):
        tallies[slots[row["slot"]]].append((row["low"], row["high"], row["n"]))
    return tallies


def quantiles(df: DataFrame, columns: list[str], probabilities: list[float], plotting: float = 1.0) -> dict[str, list[float | None]]:
    """Interpolated exact quantiles per column, None for a column without values.

    ``plotting=1.0`` puts the q-quantile at position 1 + q(n-1), the usual linear
    rule; ``plotting=0.4`` gives the approximately unbiased rule
    (alphap = betap = 0.4) used for partial-dependence grids.
    """
    def positions(n: int) -> list[tuple[int, int, float]]:
        places = []
        for q in probabilities:
            place = n * q + plotting + q * (1 - 2 * plotting)
            lower = int(floor(min(max(place, 1), n)))
            fraction = min(max(place - lower, 0.0), 1.0)
            upper = min(lower + 1, n) if fraction > 0 else lower
            places.append((lower, upper, fraction))
        return places

    sizes: dict[str, int] = {}

    def ranks(column: str, n: int) -> list[int]:
        sizes[column] = n
        return sorted({r for lower, upper, _ in positions(n) for r in (lower, upper)})

    hits = order_statistics(df, columns, ranks)
    result: dict[str, list[float | None]] = {}
    for c in columns:
        if c not in sizes:
            result[c] = [None] * len(probabilities)
            continue
        at = hits[c]
        result[c] = [
            at[lower].value + (at[upper].value - at[lower].value) * fraction
            for lower, upper, fraction in positions(sizes[c])
        ]
    return result


def even_sizes(n: int, parts: int) -> list[int]:
    """Sizes of ``parts`` groups of n rows; the first n mod parts get one more."""
    return [n // parts + (1 if i < n % parts else 0) for i in range(parts)]


def holdout_size(n: int, fraction: float) -> int:
    return int(ceil(fraction * n))
