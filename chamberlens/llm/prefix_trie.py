"""A trie of conversations that share their first turns.

A rebuilt conversation is the head of its base conversation followed by its own later
turns. Its prefixes are known by fingerprints: a turn's is a number, a sequence's a
:class:`Product`, and two products combine into that of the sequences put together, so
the texts of a rebuilt conversation never come together anywhere. Turns are stored under
their content reference; equal fingerprints count as one prefix only after all members
agree in the reference of the last turn and in the prefix before it.

Conversations of any length are cut wherever a partition ends: a partition's share of
one is summarised by products again, and the driver combines one summary per partition.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib
from collections.abc import Iterator
from dataclasses import astuple, dataclass, field, replace

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chamberlens.functions.running import running_sums
from chamberlens.session import discard, materialize, stored

MODULUS = 2**127 - 1
#: Tried one after the other, should two prefixes have one fingerprint.
BASES = (0x3B9ACA07_2F6E2B1D_61C88647_9E3779B9, 0x1F83D9AB_5BE0CD19_6A09E667_BB67AE85, 0x510E527F_9B05688C_3C6EF372_A54FF53A)
#: Characters of ids hashed, and rows handed on, at once.
CHUNK, ROWS = 1 << 16, 1 << 13
NODE = ["depth", "node"]


@dataclass(frozen=True)
class Product:
    """Fingerprint of a sequence of turns: ``value`` is its polynomial, ``power`` the base
    to the number of turns. Products form a monoid under ``then``, with ``Product()`` as one."""

    value: int = 0
    power: int = 1

    def then(self, other: "Product") -> "Product":
        return Product((self.value * other.power + other.value) % MODULUS, self.power * other.power % MODULUS)


def turn(reference: bytes, base: int) -> Product:
    return Product(int.from_bytes(reference, "big") % MODULUS, base)


@dataclass(frozen=True)
class _State:
    """Where a walk over the sorted turns stands: the head of the base conversation as
    (reference, words), the conversation, its turns so far and the product of those kept."""

    base: int | None = None
    head: tuple = ()
    conv: int | None = None
    count: int = 0
    suffix: Product = field(default_factory=Product)


@dataclass(frozen=True)
class _Share:
    """What a partition holds of its last conversation: its number of turns there, their
    product without the first 0, 1, ... of them, and its part of the base's head."""

    base: int
    conv: int
    count: int
    products: tuple
    head: tuple


def head_turns(conv: int, heads: int) -> int:
    """How many turns of its base a conversation takes over."""
    return zlib.crc32(str(conv).encode()) % heads


def ordered_turns(conversations: DataFrame, group: int) -> DataFrame:
    """(base, conv, reference, words) sorted by base, its own conversation first, and turn.

    Stored as sorted, so that every later pass sees the same partitions.
    """
    spark = conversations.sparkSession
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        F.col("conv_id").alias("conv"),
        "turn",
        role.alias("role"),
        F.substring(F.unhex(F.sha2(told.cast("binary"), 256)), 1, 16).alias("reference"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
        F.monotonically_increasing_id().alias("place"),
    )
    order = ["base", F.col("conv") != F.col("base"), "conv", F.asc_nulls_first("turn"), "role", "reference", "place"]
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return stored(turns.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("base", "conv", "reference", "words"))


# The walk over the turns

_SHARE = pa.schema([("part", pa.int32()), ("conv", pa.int64()), ("share", pa.binary())])
_MEMBER = pa.schema(
    [("conv", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("reference", pa.binary())]
    + [("words", pa.int64()), ("ends", pa.bool_())]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _shares(base_number: int, heads: int):
    """Task that tells its first conversation and its share of the last one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = first = share = None
        for part, base, conv, reference, words in _rows(batches):
            if first is None:
                first = conv
            if share is None or conv != share.conv or base != share.base:
                head = share.head if share and share.base == base else ()
                share = _Share(base, conv, 0, (Product(),) * heads, head)
            kept = turn(reference, base_number)
            products = tuple(p.then(kept) if share.count >= dropped else p for dropped, p in enumerate(share.products))
            head = share.head
            if conv == base and len(head) < heads - 1:
                head = (*head, (reference, words))
            share = _Share(base, conv, share.count + 1, products, head)
        if share is not None:
            yield _batch([(part, first, pickle.dumps(astuple(share)))], _SHARE)

    return work


def _after(state: _State, share: _Share, heads: int) -> _State:
    """The state behind a partition that began in ``state``."""
    known = state.head if state.base == share.base else ()
    head = (*known, *share.head)[: heads - 1]
    continued = (state.base, state.conv) == (share.base, share.conv)
    before = state.count if continued else 0
    dropped = min(max(head_turns(share.conv, heads) - before, 0), heads - 1)
    suffix = share.products[dropped]
    return _State(share.base, head, share.conv, before + share.count, state.suffix.then(suffix) if continued else suffix)


class _Walk:
    """Turns one by one into members: (conv, depth, node, parent, reference, words, ends)."""

    def __init__(self, state: _State, base_number: int, heads: int):
        self.state, self.base_number, self.heads = state, base_number, heads

    def head(self) -> tuple[list[Product], int]:
        """Products of the head's prefixes, from the empty one, and the turns taken over."""
        taken = self.state.head[: head_turns(self.state.conv, self.heads)]
        products = [Product()]
        for reference, _ in taken:
            products.append(products[-1].then(turn(reference, self.base_number)))
        return products, len(taken)

    def step(self, base: int, conv: int, reference: bytes, words: int) -> tuple | None:
        """Take a turn, and return its member if the rebuilt conversation keeps it."""
        s = self.state
        if (base, conv) != (s.base, s.conv):
            s = _State(base, s.head if base == s.base else (), conv)
        if conv == base and len(s.head) < self.heads - 1:
            s = replace(s, head=(*s.head, (reference, words)))
        s = self.state = replace(s, count=s.count + 1)
        own = s.count - head_turns(conv, self.heads)
        if own <= 0:
            return None
        products, taken = self.head()
        parent = products[-1].then(s.suffix)
        self.state = replace(s, suffix=s.suffix.then(turn(reference, self.base_number)))
        node = products[-1].then(self.state.suffix)
        return conv, taken + own, _key(node), _key(parent), reference, words

    def finish(self) -> list[tuple]:
        """Members of the root and of the head, once the conversation is over."""
        s = self.state
        products, taken = self.head()
        short = s.count <= head_turns(s.conv, self.heads)
        rows = [(s.conv, 0, _key(products[0]), None, None, 0, short and not taken)]
        for depth, (reference, words) in enumerate(s.head[:taken], 1):
            rows.append((s.conv, depth, _key(products[depth]), _key(products[depth - 1]), reference, words, short and depth == taken))
        return rows


def _key(product: Product) -> bytes:
    return product.value.to_bytes(16, "big")


def _members(starts, base_number: int, heads: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = held = following = None
        rows: list[tuple] = []
        for part, base, conv, reference, words in _rows(batches):
            if walk is None:
                state, following = starts.value[part]
                walk = _Walk(state, base_number, heads)
            elif conv != walk.state.conv:
                rows += [(*held, True)] if held else []
                rows += walk.finish()
                held = None
            if held:
                rows.append((*held, False))
            held = walk.step(base, conv, reference, words)
            if len(rows) >= ROWS:
                yield _batch(rows, _MEMBER)
                rows = []
        if walk is not None:
            over = following != walk.state.conv
            rows += [(*held, over)] if held else []
            rows += walk.finish() if over else []
            if rows:
                yield _batch(rows, _MEMBER)

    return work


def rebuilt_members(turns: DataFrame, heads: int, base_number: int) -> DataFrame:
    """A row per rebuilt conversation and prefix of it, the empty one included."""
    spark = turns.sparkSession
    numbered = turns.select(F.spark_partition_id().alias("part"), "base", "conv", "reference", "words")
    found = numbered.mapInArrow(_shares(base_number, heads), "part int, conv bigint, share binary").collect()
    state, starts = _State(), {}
    found = sorted(found, key=lambda r: r["part"])
    for here, after in zip(found, [*found[1:], None]):
        starts[here["part"]] = (state, after["conv"] if after else None)
        base, conv, count, products, head = pickle.loads(here["share"])
        state = _after(state, _Share(base, conv, count, tuple(Product(*p) for p in products), head), heads)
    shared = spark.sparkContext.broadcast(starts)
    schema = "conv bigint, depth bigint, node binary, parent binary, reference binary, words bigint, ends boolean"
    return numbered.mapInArrow(_members(shared, base_number, heads), schema)


# The trie


def prefix_trie(conversations: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """A row per distinct prefix (node) of the rebuilt conversations.

    ``conversations`` has conv_id (a whole number), turn, role and text. Conversation c
    is rebuilt as the first h turns of conversation c - c % group, then its own turns
    after its first h, where h is the CRC-32 of c in decimal, modulo ``heads``. The
    result has ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id`` (null at
    the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (over the
    node's subtree, words of the last turn for every member but one), ``n_ends`` and
    ``ends_sha256`` (of the members that end here, ids ascending, joined by commas).

    Turns go by ``turn``, null first; equal ones by role, then by a hash of the content,
    and copies of a row are turns of their own. Null role or text is empty. Rows without
    conv_id take no part; other columns are ignored. An empty table has no node.

    The driver holds one row per partition. One task hashes the ids that end at a node,
    as SHA-256 goes on from byte to byte, but sorting and writing them out is spread.
    """
    turns = ordered_turns(conversations, group)
    for base_number in BASES:
        members, members_path = materialize(rebuilt_members(turns, heads, base_number), "members")
        nodes, nodes_path = materialize(_nodes(members), "nodes")
        if nodes.groupBy(*NODE).count().where("count > 1").isEmpty():
            return _measured(members, nodes)
        discard(conversations.sparkSession, members_path)
        discard(conversations.sparkSession, nodes_path)
    raise ArithmeticError("prefixes with one fingerprint under every base")


def _nodes(members: DataFrame) -> DataFrame:
    """Groups of members that agree in everything; two groups under one fingerprint would
    be a collision."""
    return members.groupBy(*NODE, "parent", "reference").agg(
        F.min("conv").alias("owner"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"),
        F.count_if("ends").alias("n_ends"),
    )


def _measured(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Subtree figures without walking the tree.

    The smallest member of a node owns it. What a conversation owns is the lower end of
    its path, so a node's subtree is made of the chains owned by its members: each whole,
    but for its own owner's, of which the part above the node is taken off.
    """
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    saved = ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
    counted = nodes.join(children, NODE, "left").select(
        *NODE, "parent", "owner", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"), "n_ends", saved
    )
    chains = running_sums(counted, {"so_far": F.col("saved")}, [F.col("depth").asc()], "owner")
    owners = stored(
        chains.groupBy(F.col("owner").alias("conv")).agg(
            F.sum("saved").alias("chain"), F.max((F.col("n_children") == 0).cast("bigint")).alias("leaf")
        )
    )
    # from stored tables, so that adaptive execution splits a conversation or parent with many rows
    below = members.select("conv", *NODE).join(owners, "conv").groupBy(*NODE).agg(F.sum("chain").alias("below"), F.sum("leaf").alias("n_leaves"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("owner").alias("parent_conv_id"))
    named = nodes.select(*NODE, "parent").join(parents, ["depth", "parent"]).select(*NODE, "parent_conv_id")
    result = (
        chains.select(*NODE, "owner", "n_convs", "n_children", "n_ends", (F.col("so_far") - F.col("saved")).alias("above"))
        .join(below, NODE)
        .join(named, NODE, "left")
        .join(_end_digests(members), NODE, "left")
    )
    return result.select(
        F.col("owner").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("below") - F.col("above")).alias("saved_tokens"),
        "n_ends",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def _end_digests(members: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node: sorted by ranges and written out in
    chunks, which one task per node then hashes in order."""
    parts = max(1, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ends = members.where("ends").select(*NODE, "conv")
    chunks = ends.repartitionByRange(parts, *NODE, "conv").sortWithinPartitions(*NODE, "conv").mapInArrow(_chunked, "depth bigint, node binary, first bigint, ids string")
    dealt = chunks.repartition(parts, *NODE).sortWithinPartitions(*NODE, "first")
    return dealt.select(*NODE, "ids").mapInArrow(_digested, "depth bigint, node binary, ends_sha256 string")


_CHUNK = pa.schema([("depth", pa.int64()), ("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
_DIGEST = pa.schema([("depth", pa.int64()), ("node", pa.binary()), ("ends_sha256", pa.string())])


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, first id, ids joined by commas) in chunks of about ``CHUNK`` characters."""
    key, ids, size, rows, held = None, [], 0, [], 0
    for depth, node, conv in _rows(batches):
        if (depth, node) != key or size >= CHUNK:
            if ids:
                rows.append((*key, int(ids[0]), ",".join(ids)))
                held += size
            key, ids, size = (depth, node), [], 0
            if len(rows) >= ROWS or held >= 64 * CHUNK:
                yield _batch(rows, _CHUNK)
                rows, held = [], 0
        ids.append(str(conv))
        size += len(ids[-1]) + 1
    if ids:
        yield _batch([*rows, (*key, int(ids[0]), ",".join(ids))], _CHUNK)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state, rows = None, None, []
    for depth, node, ids in _rows(batches):
        if (depth, node) == key:
            state.update(b"," + ids.encode())
            continue
        if state:
            rows.append((*key, state.hexdigest()))
        if len(rows) >= ROWS:
            yield _batch(rows, _DIGEST)
            rows = []
        key, state = (depth, node), hashlib.sha256(ids.encode())
    if state:
        yield _batch([*rows, (*key, state.hexdigest())], _DIGEST)
