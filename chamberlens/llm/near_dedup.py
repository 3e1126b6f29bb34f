"""Near-duplicate groups by a signature-coordinate inverted join.

1. Every document gets a MinHash signature of its word shingles; documents with equal
   sets become one class. A signature value carries its coordinate, so a value alone
   names a coordinate-value pair.
2. Classes are posted under their pairs. Two classes whose signatures agree in at least
   ``match`` coordinates must meet under one of each class's rarest pairs (the prefix);
   the long postings are skipped and their collisions counted from the signatures.
3. Two rounds compare the classes under each posting with its most central one only and
   tie the linked ones together, so a group of copies costs about its size. A posting
   whose classes are all in one component is done.
4. What is left under the other postings is compared in full, in blocks of bounded size
   within tasks: collisions are counted by products of incidence matrices, and only
   the links that join components leave a task. So no link is lost and no pairs are listed.
5. Pairs at or above the match threshold are confirmed on their full shingle sets.

Sets hold 64-bit hashes of shingles; apart from hash collisions they are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from chamberlens.llm.common import free_names
from chamberlens.session import stored

SHINGLE, COORDINATES, MISS = 5, 64, 1e-6
ROUNDS, BLOCK_MEMBERS, BLOCK_SHINGLES, _WIDE = 2, 1024, 1 << 20, 4096
_STEP = np.uint64(0x9E3779B97F4A7C15)
_AT_ONCE = 2048


def match_threshold(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """The largest number of equal coordinates that a pair just at the similarity falls
    short of with a probability of at most ``miss``."""
    p, below = percent / 100, 0.0
    for m in range(coordinates + 1):
        below += comb(coordinates, m) * p**m * (1 - p) ** (coordinates - m)
        if below > miss:
            return max(1, m)
    return coordinates


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, words: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of ``words`` consecutive words, A-Z in lower case; a shorter
    text's whole sequence is one. Words are separated by ASCII white space."""
    split = (text or "").encode("utf-8", "replace").lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, split), np.uint64, len(split))
    wide = min(words, len(h))
    n = len(h) - wide + 1
    total = np.full(n, np.uint64(wide), np.uint64)
    for k in range(wide):
        total = total * _STEP + h[k : k + n]
    return np.unique(_mixed(total))


def _coordinate_keys(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20)
    return draw.integers(0, 1 << 63, coordinates, np.uint64), draw.integers(0, 1 << 63, coordinates, np.uint64) | np.uint64(1)


def signature(shingles: np.ndarray, keys: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least hash of each coordinate; its lowest bits are the coordinate's number."""
    flip, times = keys
    least = np.full(len(flip), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _AT_ONCE):
        part = shingles[at : at + _AT_ONCE, None]
        np.minimum(least, ((part ^ flip) * times).min(0), out=least)
    mask = np.uint64((1 << (len(flip) - 1).bit_length()) - 1)
    return ((least & ~mask) | np.arange(len(flip), dtype=np.uint64)).view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int, coordinates: int) -> DataFrame:
    """(id, n_shingles, key, signature) of each row; key and signature null for an empty set."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = _coordinate_keys(coordinates)
        for batch in batches:
            sizes, names, signed = [], [], []
            for text in batch.column(1):
                found = shingle_set(text.as_py(), words)
                sizes.append(len(found))
                names.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                signed.append(signature(found, keys) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(signed, pa.list_(pa.int64()))],
                names=["id", "n_shingles", "key", "signature"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(work, f"id {id_type}, n_shingles long, key binary, signature array<long>")


def _shingles(rows: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of rows (id, text)."""
    id_type = rows.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), words).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    return rows.mapInArrow(work, f"node {id_type}, shingles array<long>")


def _parts(rows: int, at_once: int = 100_000) -> int:
    """Partitions for a table of so many rows; few rows in many partitions are mostly files."""
    return max(1, -(-rows // at_once))


def _stored(df: DataFrame, most: int) -> tuple[DataFrame, int]:
    """A table of at most about ``most`` rows, stored, and its size."""
    table = stored(df.coalesce(_parts(most)))
    rows = table.count()
    return table.coalesce(_parts(rows)), rows


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b) but the roots; a root is the least
    node of its component.

    Rounds of large-star and small-star steps: each node's neighbours are tied to the
    least one. Only minima are aggregated, so a node with many neighbours is no large group.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    rows, mark = edges.count(), None
    edges = edges.coalesce(_parts(rows))
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(tied.union(lowest.toDF("a", "b")).distinct().coalesce(_parts(rows)))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.toDF("node", "root")
        mark = now


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 80,
    words: int = SHINGLE,
    coordinates: int = COORDINATES,
) -> DataFrame:
    """One row per document: its id, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked when 100 * |intersection| >= ``percent`` * |union| of their
    sets of ``words``-word shingles; ``component_id`` is the smallest id reachable, and the
    document of that id is kept. A pair just at the similarity is missed with a
    probability of at most ``MISS``, a closer one less.

    Null, empty and blank texts have no shingles and no links. A row without id links to
    nothing, has no component and is kept. Rows that share an id are one document with
    several texts. Other columns are ignored. Runs jobs when called: the intermediate
    tables are checkpointed.
    """
    match = match_threshold(percent, coordinates)
    signed = stored(signatures(docs, id_col, text_col, words, coordinates))
    classes = (
        signed.where("key IS NOT NULL AND id IS NOT NULL")
        .groupBy("key")
        .agg(F.min("id").alias("node"), F.first("signature").alias("signature"))
    )

    pairs_posted = classes.select("node", F.explode("signature").alias("token"))
    # counted tables are stored: above an aggregate adaptive execution would not split a crowded token
    frequent = stored(pairs_posted.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"))
    met = pairs_posted.join(frequent, "token").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("met"))
    prefix = met.where(F.size("met") >= match).select(
        "node",
        F.aggregate("met", F.lit(0).cast("bigint"), lambda n, p: n + p["df"]).alias("weight"),
        F.explode(F.slice("met", F.lit(1), F.size("met") - match + 1)).alias("pair"),
    )
    postings = stored(prefix.select(F.col("pair.token").alias("token"), "node", "weight", F.col("node").alias("label")))
    rows = postings.count()
    postings = postings.coalesce(_parts(rows))
    labels, n_nodes = _stored(postings.select("node", F.col("node").alias("label")).distinct(), rows)
    held = stored(classes.join(labels.select("node"), "node", "left_semi").select("node", "signature").coalesce(_parts(n_nodes, 2_000)))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sets = stored(_shingles(texts.join(labels.select(F.col("node").alias("id")), "id", "left_semi"), words))

    for turn in range(ROUNDS + 1):
        # postings whose classes are all in one component are done
        ends = postings.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        open_tokens, _ = _stored(ends.where("lo <> hi").select("token"), rows)
        postings, rows = _stored(postings.join(open_tokens, "token"), rows)
        if not rows:
            break
        if turn < ROUNDS:
            rank = F.row_number().over(Window.partitionBy("token").orderBy(F.desc("weight"), "node", "label"))
            first, _ = _stored(postings.withColumn("rank", rank).where("rank = 1").select("token", "node", "label"), rows)
            lead = first.toDF("token", "lead", "lead_label")
            pairs = postings.join(lead, "token").where("label <> lead_label").select("lead", "node", "lead_label", "label").distinct()
            linked, n_linked = _stored(_confirmed(pairs, held, sets, match, percent), rows)
            postings = postings.join(first, ["token", "node", "label"], "left_anti")
        else:
            linked, n_linked = _stored(_in_blocks(postings, held.join(sets, "node"), match, percent), rows)
        if n_linked:
            moved = components(linked.toDF("a", "b")).toDF("label", "root")
            labels, _ = _stored(_relabelled(labels, moved, "node"), n_nodes)
            postings = _relabelled(postings, moved, "token", "node", "weight")

    nodes = classes.select("key", "node").join(labels, "node", "left").select("key", F.coalesce("label", "node").alias("root"))
    found = signed.select("id", "n_shingles", "key").join(nodes, "key", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
    return found.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _confirmed(pairs: DataFrame, held: DataFrame, sets: DataFrame, match: int, percent: int) -> DataFrame:
    """Labels of the pairs whose signatures agree often enough and whose sets are close enough."""

    def beside(table: DataFrame, column: str) -> DataFrame:
        ours, theirs = table.toDF("lead", f"{column}_a"), table.toDF("node", f"{column}_b")
        return candidates.join(ours, "lead").join(theirs, "node")

    candidates = pairs
    agreeing = F.size(F.array_intersect("signature_a", "signature_b")) >= match
    candidates = beside(held, "signature").where(agreeing).select("lead", "node", "lead_label", "label").distinct()
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    union = F.size("shingles_a") + F.size("shingles_b") - F.col("common")
    close = 100 * F.col("common") >= percent * union
    return beside(sets, "shingles").withColumn("common", common).where(close).select("lead_label", "label").distinct()


def _in_blocks(postings: DataFrame, members: DataFrame, match: int, percent: int) -> DataFrame:
    """Links (label, label) between the components under each posting; every pair of its
    classes is compared. A crowded posting is dealt into blocks, and a group is two of them."""
    sized = postings.join(members.select("node", F.size("shingles").alias("n")), "node")
    share = F.greatest(F.ceil(F.count("*") / BLOCK_MEMBERS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    blocks = sized.groupBy("token").agg(share.alias("blocks"))
    dealt = postings.join(blocks, "token").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    groups = met.select(
        "token", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "node", "label"
    ).join(members, "node")
    label = groups.schema["label"].dataType.simpleString()

    def compare(table: pa.Table) -> pa.Table:
        labels = table.column("label").to_pylist()
        number = {v: i for i, v in enumerate(sorted(set(labels)))}
        names = list(number)
        found = _links(
            np.array([number[v] for v in labels]),
            table.column("block").to_numpy(),
            _arrays(table.column("signature")),
            _arrays(table.column("shingles")),
            match,
            percent,
        )
        kind = table.schema.field("label").type
        return pa.table({"a": pa.array([names[a] for a, _ in found], kind), "b": pa.array([names[b] for _, b in found], kind)})

    return groups.groupBy("token", "one", "two").applyInArrow(compare, f"a {label}, b {label}").distinct()


def _arrays(lists: pa.ChunkedArray) -> list[np.ndarray]:
    return [row for chunk in lists.chunks for row in np.split(chunk.flatten().to_numpy(), np.cumsum(pc.list_value_length(chunk).to_numpy())[:-1])]


def _common(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """How many elements each of the ``rows`` shares with each of the ``columns``, by
    products of incidence matrices over the elements that occur more than once."""
    used = np.union1d(rows, columns)
    owner = np.repeat(used, [len(sets[i]) for i in used])
    _, element, times = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True, return_counts=True)
    shared = times[element] > 1
    owner, element = owner[shared], np.unique(element[shared], return_inverse=True)[1]
    total = np.zeros((len(rows), len(columns)), np.float32)
    order = np.argsort(element, kind="stable")
    owner, element = owner[order], element[order]
    for at in range(0, element[-1] + 1 if len(element) else 0, _WIDE):
        part = slice(*np.searchsorted(element, [at, at + _WIDE]))
        held = np.zeros((used[-1] + 1, min(_WIDE, element[-1] + 1 - at)), np.float32)
        held[owner[part], element[part] - at] = 1
        total += held[rows] @ held[columns].T
    return total


def _links(labels, blocks, signatures, sets, match: int, percent: int) -> list[tuple[int, int]]:
    """Label pairs that tie the group's components together, at most one less than labels."""
    if len(set(labels.tolist())) < 2:
        return []
    one, two = blocks.min(), blocks.max()
    rows, columns = np.flatnonzero(blocks == one), np.flatnonzero(blocks == two)
    likely = (_common(signatures, rows, columns) >= match) & (labels[rows][:, None] != labels[columns])
    rows, columns, likely = rows[likely.any(1)], columns[likely.any(0)], likely[likely.any(1)][:, likely.any(0)]
    if not len(rows):
        return []
    sizes = np.array([len(s) for s in sets])
    common = _common(sets, rows, columns).astype(np.int64)
    union = sizes[rows][:, None] + sizes[columns] - common
    at, to = np.nonzero(likely & (100 * common >= percent * union))
    pairs = np.unique(np.sort(np.stack([labels[rows[at]], labels[columns[to]]], 1), axis=1), axis=0)
    root = list(range(int(labels.max()) + 1))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    links = []
    for a, b in pairs.tolist():
        if top(a) != top(b):
            root[top(b)] = top(a)
            links.append((a, b))
    return links


def _relabelled(table: DataFrame, moved: DataFrame, *columns: str) -> DataFrame:
    return table.join(moved, "label", "left").select(*columns, F.coalesce("root", "label").alias("label"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """The documents that :func:`near_duplicates` keeps, with all their columns. Rows
    without id stay, and so does an id of which any row is kept."""
    groups = near_duplicates(docs, id_col, text_col, percent)
    (gone,) = free_names(docs, "_gone")
    dropped = groups.groupBy(F.col(id_col).alias(gone)).agg(F.bool_or("kept").alias("any")).where(~F.col("any")).select(gone)
    return docs.join(dropped, F.col(id_col) == F.col(gone), "left_anti")
