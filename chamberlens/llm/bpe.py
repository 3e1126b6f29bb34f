"""Byte-level BPE with word ends: encoding by a segment tree over adjacent pair ranks.

The tree's leaves are the ranks of the pairs of neighbouring symbols, with the place
as second key; its root is the leftmost pair of lowest rank. A merge changes at most
three leaves and their paths to the root. Many words of like length are merged together,
one tree per row of an array; long words get a tree of their own.

Texts are split at white space, the distinct chunks of a batch into words, and every
distinct word is merged once. Letters and numbers are those of the installed Unicode
tables; code points that those do not know count as other characters.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, types as T

from chamberlens.llm.common import without

#: White space as the tokeniser's pattern engine sees it.
SPACES = r"\t-\r \x85\xa0  -     　"
#: The tokeniser's word pattern.
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACES}\p{{L}}\p{{N}}]+"

FULL = np.int64(1) << 60
TOGETHER = 64
MOST_CHUNKS = 250_000
#: White space to other engines, not to the tokeniser.
ODD = regex.compile(r"[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it has one, else
    the next free code point from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and special strings read from a tokeniser file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            written = json.load(file)
        model = written["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in written["added_tokens"]}
        self.tokens = np.full(max([*ids.values(), *self.special.values()]) + 1, "", object)
        for token, i in chain(ids.items(), self.special.items()):
            self.tokens[i] = token
        symbols = byte_symbols()
        self.inner = np.array([ids[s] for s in symbols], np.int64)
        self.last = np.array([ids[s + end] for s in symbols], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        self.rank_of = {int(k): r for r, k in reversed(list(enumerate(keys)))}
        self.rank_order = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_order]
        self.words = regex.compile(WORDS)
        self.specials = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``FULL`` where it does not merge."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.rank_order[at], FULL)

    def folded(self, text: str) -> str:
        """Normalised as the tokeniser does; letter by letter, so that the whole-string
        rule for a final sigma does not apply."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def around_specials(self, text: str) -> list[tuple[bool, str]]:
        """The text in parts: (is a special string, part)."""
        parts, at = [], 0
        for m in self.specials.finditer(text):
            parts += [(False, text[at : m.start()]), (True, m.group())]
            at = m.end()
        return [*parts, (False, text[at:])]


def merge_long(symbols: list[int], v: Vocabulary) -> list[int]:
    """Merge one word by a segment tree in a flat list."""
    n = len(symbols)
    size = 1 << (n - 1).bit_length() if n > 1 else 1
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    none = (len(v.rank_of), 0)
    tree = [none] * (2 * size)

    def rank(i: int) -> tuple[int, int]:
        j = after[i]
        r = v.rank_of.get(symbols[i] << 32 | symbols[j]) if j < n else None
        return none if r is None else (r, i)

    def put(i: int, leaf: tuple[int, int]) -> None:
        i += size
        tree[i] = leaf
        while i > 1:
            i >>= 1
            low = min(tree[2 * i], tree[2 * i + 1])
            if tree[i] == low:
                return
            tree[i] = low

    tree[size : size + n] = [rank(i) for i in range(n)]
    for i in range(size - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])
    alive = [True] * n
    while tree[1] != none:
        r, i = tree[1]
        j = after[i]
        symbols[i] = int(v.made[r])
        alive[j] = False
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        put(j, none)
        put(i, rank(i))
        if before[i] >= 0:
            put(before[i], rank(before[i]))
    return [s for s, a in zip(symbols, alive) if a]


def merge_together(symbols: np.ndarray, lengths: np.ndarray, v: Vocabulary) -> np.ndarray:
    """Merge many words at once, a row each; places beyond a word's length, and those
    merged away, come back as -1."""
    n_words, width = symbols.shape
    size = 1 << max(0, width - 1).bit_length()
    deep = size.bit_length() - 1
    places = np.arange(width)
    after = np.broadcast_to(places + 1, symbols.shape).ravel().copy()
    before = np.broadcast_to(places - 1, symbols.shape).ravel().copy()
    tree = np.full((n_words, 2 * size), FULL)
    if width > 1:
        ranks = v.ranks(symbols[:, :-1], symbols[:, 1:])
        ranks[places[1:] >= lengths[:, None]] = FULL
        tree[:, size : size + width - 1] = np.where(ranks < FULL, ranks * size + places[:-1], FULL)
    for i in range(size - 1, 0, -1):
        tree[:, i] = np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1])
    symbols = np.where(places < lengths[:, None], symbols, -1).ravel()
    tree = tree.ravel()

    def put(words: np.ndarray, place: np.ndarray, leaf: np.ndarray) -> None:
        base, at = words * (2 * size), place + size
        tree[base + at] = leaf
        for _ in range(deep):
            at >>= 1
            pair = base + 2 * at
            tree[base + at] = np.minimum(tree[pair], tree[pair + 1])

    def leaf(words: np.ndarray, place: np.ndarray) -> np.ndarray:
        here = words * width
        right = after[here + place]
        inside = right < lengths[words]
        ranks = v.ranks(symbols[here + place], symbols[here + np.where(inside, right, 0)])
        return np.where(inside & (ranks < FULL), ranks * size + place, FULL)

    w = np.flatnonzero(tree[1 :: 2 * size] < FULL)
    while len(w):
        root = tree[w * (2 * size) + 1]
        place, rank = root % size, root // size
        row = w * width
        gone = after[row + place]
        beyond = after[row + gone]
        symbols[row + place] = v.made[rank]
        symbols[row + gone] = -1
        after[row + place] = beyond
        linked = beyond < lengths[w]
        before[row[linked] + beyond[linked]] = place[linked]
        put(w, gone, FULL)
        put(w, place, leaf(w, place))
        earlier = before[row + place]
        has = earlier >= 0
        put(w[has], earlier[has], leaf(w[has], earlier[has]))
        w = w[tree[w * (2 * size) + 1] < FULL]
    return symbols.reshape(n_words, width)


def merge_words(words: list[str], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words in a row, number of ids of each word)."""
    raw = [w.encode("utf-8", "replace") for w in words]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    counts = np.zeros(len(raw), np.int64)
    pieces: list[tuple[np.ndarray, np.ndarray]] = []  # (word of each id, ids)
    width = 4
    lower = 0
    while lower < TOGETHER:
        group = np.flatnonzero((lengths > lower) & (lengths <= width))
        for part in np.array_split(group, len(group) // 8192 + 1):
            if not len(part):
                continue
            flat = np.frombuffer(b"".join(raw[i].ljust(width, b"\0") for i in part), np.uint8).reshape(-1, width)
            long = lengths[part]
            ends = np.arange(width) == long[:, None] - 1
            merged = merge_together(np.where(ends, v.last[flat], v.inner[flat]), long, v)
            alive = merged >= 0
            counts[part] = alive.sum(1)
            pieces.append((np.repeat(part, counts[part]), merged[alive]))
        lower, width = width, width * 2
    for i in np.flatnonzero(lengths > lower):
        known = np.frombuffer(raw[i], np.uint8)
        ids = merge_long([*v.inner[known[:-1]].tolist(), int(v.last[known[-1]])], v)
        counts[i] = len(ids)
        pieces.append((np.full(len(ids), i), np.array(ids, np.int64)))
    if not pieces:
        return np.zeros(0, np.int32), counts
    owner, ids = np.concatenate([p[0] for p in pieces]), np.concatenate([p[1] for p in pieces])
    return ids[np.argsort(owner, kind="stable")].astype(np.int32), counts


class Encoder:
    """Encodes batches of texts; forgets the merged chunks before a batch if it knows more
    than ``MOST_CHUNKS``."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.forget()

    def forget(self) -> None:
        self.number: dict = {}
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        special = self.vocabulary.special
        self._add([(s,) for s in special], np.array(list(special.values()), np.int32), np.ones(len(special), np.int64))

    def _learn(self, chunks: list[str]) -> None:
        """Split new chunks (between white space) into words, merge each distinct word once."""
        split = [self.vocabulary.words.findall(c) for c in chunks]
        number: dict[str, int] = {}
        for w in chain.from_iterable(split):
            number.setdefault(w, len(number))
        ids, counts = merge_words(list(number), self.vocabulary)
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        word = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        self._add(chunks, *gathered(ids, np.cumsum(counts) - counts, counts, word, sizes))

    def _add(self, names: list, ids: np.ndarray, counts: np.ndarray) -> None:
        for name in names:
            self.number[name] = len(self.number)
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(counts) - counts))
        self.ids = np.concatenate((self.ids, ids))
        self.counts = np.concatenate((self.counts, counts))

    def _slowly(self, text: str) -> list:
        """The chunks of a text that holds special strings or characters that are white
        space to the fast splitter alone; special strings are keys of their own kind."""
        v = self.vocabulary
        parts = v.around_specials(text)
        return [c for special, part in parts for c in ([(part,)] if special else v.words.findall(v.folded(part)))]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text); null is empty."""
        if len(self.number) > MOST_CHUNKS:
            self.forget()
        v = self.vocabulary
        slow = {i: self._slowly(t) for i, t in enumerate(texts) if t and (ODD.search(t) or v.specials.search(t))}
        plain = ["" if i in slow or not t else v.folded(t) for i, t in enumerate(texts)]
        lists = pc.utf8_split_whitespace(pa.array(plain, pa.large_string()))
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.dictionary_encode(lists.flatten())
        chunks = coded.dictionary.to_pylist()
        fresh = dict.fromkeys(c for c in chain(chunks, *slow.values()) if c not in self.number)
        if fresh:
            self._learn(list(fresh))
        numbers = np.fromiter(map(self.number.__getitem__, chunks), np.int64, len(chunks))
        picks = numbers[coded.indices.to_numpy(zero_copy_only=False)]
        if slow:
            each = np.split(picks, np.cumsum(sizes)[:-1])
            for i, found in slow.items():
                each[i] = np.array([self.number[c] for c in found], np.int64)
            picks, sizes = np.concatenate(each), np.array([len(e) for e in each])
        return gathered(self.ids, self.starts, self.counts, picks, sizes)


def gathered(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray, picks: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The id runs that ``picks`` names, one after the other, and how many ids each run
    of ``sizes`` picks has."""
    wide = counts[picks]
    ends = np.cumsum(wide)
    at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - wide, wide) + np.repeat(starts[picks], wide)
    return ids[at], np.diff(np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(sizes)))])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file, read once."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _parts(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _decoded(lists: pa.Array, tokens: np.ndarray) -> pa.Array:
    """The tokens of each list of ids joined by one blank; ids outside the vocabulary give nothing."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    known = (flat >= 0) & (flat < len(tokens))
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    if not known.all():
        ends = np.concatenate(([0], np.cumsum(known)))[ends]
        flat = flat[known]
    words, ends = tokens[flat].tolist(), ends.tolist()
    return pa.array([" ".join(words[a:b]) for a, b in zip([0, *ends], ends)], pa.string())


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", decoded: bool = False) -> DataFrame:
    """The documents with ``ids``, the token ids of the whole text, and if asked for also
    ``decoded``, as :func:`decode` gives it from the ids, in the same pass.

    ``vocabulary`` is the path of a tokeniser file, the same on every machine. Special
    strings of the file count as their tokens. A null or empty text has no ids. Rows are
    encoded one by one; input columns with the names of the results are replaced.
    """
    added = ["ids", "decoded"] if decoded else ["ids"]
    base = without(docs, *added)
    text_at, names = base.columns.index(text_col), [*base.columns, *added]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in _parts(batch)):
            ids, counts = encoder(vocabulary).encode(part.column(text_at).to_pylist())
            lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(counts))).astype(np.int32), pa.array(ids, pa.int32()))
            texts = [_decoded(lists, encoder(vocabulary).vocabulary.tokens)] if decoded else []
            yield pa.RecordBatch.from_arrays([*part.columns, lists, *texts], names=names)
        encoder(vocabulary).forget()  # a reused worker keeps nothing of a finished task

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return base.mapInArrow(work, T.StructType([*base.schema.fields, *fields[: len(added)]]))


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """The rows with ``decoded``: the tokens of ``ids_col`` joined by one blank, as for
    vocabularies without a decoder. Null or empty ids decode to the empty text, ids
    outside the vocabulary to nothing; an input column named ``decoded`` is replaced."""
    base = without(encoded, "decoded")
    ids_at, names = base.columns.index(ids_col), [*base.columns, "decoded"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in _parts(batch)):
            lists = part.column(ids_at).fill_null([])
            yield pa.RecordBatch.from_arrays([*part.columns, _decoded(lists, encoder(vocabulary).vocabulary.tokens)], names=names)

    return base.mapInArrow(work, T.StructType([*base.schema.fields, T.StructField("decoded", T.StringType())]))
