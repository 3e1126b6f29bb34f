"""Exact top-k search by inner product, a term at a time.

Vectors become sparse rows of integers. Blocks of queries meet slices of candidates as
groups of a cogroup. A group turns its candidates into postings per term, block by block;
every term of a query adds its weight times the posting's to a dense array of scores. A
block's best are selected, merged within the group, and the groups' lists by a window.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from chamberlens.session import stored

BLOCK, QUERY_BLOCK = 8192, 4096
#: Candidates of a group on average: at most, and at least where cores would stand idle.
SLICE, LEAST_SLICE = 65536, 4096
_LEAST, _MOST = -(2**63), 2**63 - 1


def integer_vector(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as a double, held to the finite range."""
    most = sys.float_info.max
    return F.transform(vector, lambda x: _floored(F.greatest(F.lit(-most), F.least(F.lit(most), x.cast("double") * scale))))


def _floored(x: Column) -> Column:
    """Floor that stays a double, so that large values keep their magnitude."""
    down = F.rint(x)
    return down - F.when(down > x, 1.0).otherwise(0.0)


def usable(vector: Column) -> Column:
    """Neither null itself nor holding a null or a component that is not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def _rows(vectors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, weight) of the non-zero components."""
    lengths = np.array([len(v) for v in vectors], np.int64)
    flat = np.concatenate(vectors) if len(vectors) else np.zeros(0)
    row = np.repeat(np.arange(len(vectors)), lengths)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    held = flat != 0
    return row[held], term[held], flat[held]


def _exact(values: np.ndarray, wide: bool) -> np.ndarray:
    return np.array([int(x) for x in values], object) if wide else values.astype(np.int64)


class Postings:
    """The candidates of a block by term. A term that a quarter of them hold is kept with
    its zeros, as a line that is added without looking up places."""

    def __init__(self, vectors: list[np.ndarray], wide: bool):
        row, term, weight = _rows(vectors)
        order = np.argsort(term, kind="stable")
        self.size = len(vectors)
        terms, starts = np.unique(term[order], return_index=True)
        ends = np.append(starts[1:], len(term))
        rows, weights = row[order], _exact(weight[order], wide)
        self.lists: dict[int, tuple[np.ndarray | None, np.ndarray]] = {}
        for t, a, b in zip(terms.tolist(), starts, ends):
            if 4 * (b - a) >= self.size:
                line = np.zeros(self.size, weights.dtype)
                line[rows[a:b]] = weights[a:b]
                self.lists[t] = None, line
            else:
                self.lists[t] = rows[a:b], weights[a:b]

    def scores(self, terms: np.ndarray, weights: np.ndarray, wide: bool) -> np.ndarray:
        """The dense scores of one query: every term scatters its weighted posting."""
        total = np.zeros(self.size, object if wide else np.int64)
        for t, w in zip(terms.tolist(), weights.tolist()):
            places, held = self.lists.get(t, (None, None))
            if places is not None:
                total[places] += held * w
            elif held is not None:
                total += held * w
        return total


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest scores, ties to the smaller id, in that order."""
    if len(scores) > k:
        if scores.dtype != object:
            bound = np.partition(scores, len(scores) - k)[len(scores) - k]
        else:
            bound = sorted(scores)[-k]
        at = np.flatnonzero(scores >= bound)
        scores, ids = scores[at], ids[at]
    order = np.argsort(ids, kind="stable")
    order = order[np.argsort(-scores[order], kind="stable")][:k]
    return scores[order], ids[order]


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    scale: int = 64,
) -> DataFrame:
    """Each query's ``k`` best rows: ``query_id``, ``rank`` (from 1), the row's id, ``score``.

    Components become floor(scale * x); the score is the inner product, where a shorter
    vector counts as filled up with zeros. A query's own id is no candidate. Scores beyond
    the range of a long are held at its ends. Ties go to the smaller id.

    Rows without id, and vectors that are null or hold a null or a component that is not
    finite, take no part. Rows that share an id are candidates each, but none is one for
    a query of that id; every row of ``queries`` is asked and has ranks of its own, also
    when its id repeats. Other columns are ignored.

    Every block of about ``QUERY_BLOCK`` queries is sent to every slice of at most about
    ``SLICE`` candidates, both by a hash of the row's number, so that neither crowded ids
    nor repeated vectors crowd a group. Nothing but the two counts reaches the driver.
    Memory of a task: a block of queries, a slice, and ``k`` rows per query of the block.
    Queries and candidates are stored when called.
    """
    context = vectors.sparkSession.sparkContext

    def prepared(df: DataFrame) -> DataFrame:
        id_and_vector = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"))
        whole = id_and_vector.where(F.col("id").isNotNull() & usable(F.col("vector"))).select("id", integer_vector(F.col("vector"), scale).alias("vector"))
        return stored(whole.withColumn("number", F.monotonically_increasing_id()))

    asked, rows = prepared(queries), prepared(vectors)
    n_rows = rows.count()
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    busy = min(-(-n_rows // LEAST_SLICE), -(-4 * context.defaultParallelism // blocks))
    slices = max(1, -(-n_rows // SLICE), busy)

    def spread(df: DataFrame, own: str, parts: int, other: str, copies: int) -> DataFrame:
        placed = df.withColumn(own, F.pmod(F.xxhash64("number"), F.lit(parts)))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).groupBy(F.col("block").cast("long"), F.col("slice").cast("long"))

    found = spread(asked, "block", blocks, "slice", slices).cogroup(spread(rows, "slice", slices, "block", blocks)).applyInArrow(_search(k), FOUND)
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


FOUND = "query long, query_id long, id long, score long"


def _vectors(table: pa.Table) -> list[np.ndarray]:
    lists = pa.concat_arrays(table.column("vector").chunks)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return np.split(flat, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))[:-1])


def _search(k: int):
    def work(asked: pa.Table, candidates: pa.Table) -> pa.Table:
        if not asked.num_rows or not candidates.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in ("query", "query_id", "id", "score")})
        query_ids = asked.column("id").to_pylist()
        numbers = asked.column("number").to_numpy()
        row, term, weight = _rows(_vectors(asked))
        bounds = np.searchsorted(row, np.arange(len(query_ids) + 1))
        terms_most = int(np.bincount(row).max()) if len(row) else 0
        query_most = float(np.abs(weight).max()) if len(weight) else 0.0
        best: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(query_ids)
        ids, every = candidates.column("id").to_numpy(), _vectors(candidates)
        for at in range(0, len(ids), BLOCK):
            block, block_ids = every[at : at + BLOCK], ids[at : at + BLOCK]
            most = max((float(np.abs(v).max()) for v in block if len(v)), default=0.0)
            wide = most >= 2**53 or query_most >= 2**53 or most * query_most * terms_most >= 2**62
            postings = Postings(block, wide)
            weights = _exact(weight, wide)
            present = set(block_ids.tolist())
            for q, name in enumerate(query_ids):
                mine = slice(bounds[q], bounds[q + 1])
                scores = postings.scores(term[mine], weights[mine], wide)
                if name in present:
                    others = block_ids != name
                    got = _best(scores[others], block_ids[others], k)
                else:
                    got = _best(scores, block_ids, k)
                if best[q] is not None:
                    got = _best(np.concatenate((best[q][0], got[0])), np.concatenate((best[q][1], got[1])), k)
                best[q] = got
        lengths = [len(ids) for _, ids in best]
        scores = [min(max(int(s), _LEAST), _MOST) for held, _ in best for s in held]
        return pa.table(
            {
                "query": pa.array(np.repeat(numbers, lengths), pa.int64()),
                "query_id": pa.array(np.repeat(np.array(query_ids, np.int64), lengths), pa.int64()),
                "id": pa.array(np.concatenate([ids for _, ids in best]), pa.int64()),
                "score": pa.array(scores, pa.int64()),
            }
        )

    return work
