"""FM-index, phrase search and span removal against plain search."""

import tracemalloc

import numpy as np
import pytest

from chamberlens.llm.decontaminate import Phrases, _blocks, find_contamination, remove_spans, search_shard, words_of
from chamberlens.llm.fm_index import FMIndex, suffix_array


def brute(texts, items, window):
    result = []
    for text in texts:
        words = words_of(text)
        hit, names = [False] * len(words), set()
        for item, phrase_text in items:
            phrase = words_of(phrase_text)
            for at in range(max(1, len(phrase) - window + 1) if phrase else 0):
                part = phrase[at : at + window]
                for s in range(len(words) - len(part) + 1):
                    if words[s : s + len(part)] == part:
                        names.add(item)
                        hit[s : s + len(part)] = [True] * len(part)
        result.append((len(words), sum(hit), sorted(names)))
    return result


@pytest.mark.parametrize("n", [0, 1, 2, 7, 60, 300])
@pytest.mark.parametrize("size", [2, 3, 9])
def test_index_finds_what_search_finds(n, size):
    draw = np.random.default_rng(n * 10 + size)
    text = draw.integers(0, size, n)
    assert suffix_array(text).tolist() == sorted(range(n), key=lambda i: text[i:].tolist())
    index = FMIndex(text, size)
    for _ in range(20):
        length = int(draw.integers(1, 5))
        pattern = draw.integers(1, size, length)
        low, high = index.search(pattern[None, :], np.array([length]))
        found = sorted(index.locate(np.arange(low[0], high[0])).tolist())
        assert found == [i for i in range(n - length + 1) if (text[i : i + length] == pattern).all()]


def test_shards_match_plain_search():
    draw = np.random.default_rng(5)
    for _ in range(60):
        names = [f"w{i}" for i in range(draw.integers(2, 6))]
        text = lambda most: " ".join(draw.choice(names, draw.integers(0, most)))
        items = [(i, text(9)) for i in range(4)]
        texts = [text(25), None, "", text(40), text(3), text(25)]
        texts.append(texts[0])
        hits = search_shard(texts, Phrases.of(items, 5))
        got = [(int(n), sum(b - a for a, b in s), i) for n, s, i in zip(hits.n_words, hits.spans, hits.items)]
        assert got == brute(texts, items, 5)


ITEM = "one two three four five six seven eight nine ten eleven"


def test_awkward_rows(spark, docs_of, by_id):
    bench = spark.createDataFrame([(10, ITEM), (9, ITEM), (8, None), (None, "x y"), (7, "!!"), (6, "tiny item"), (6, "other tiny")], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, f"x {ITEM.upper()} y"), (4, ITEM.replace(" ", "\n, ")), (5, "a tiny item, another tiny"), (6, "tiny-item"), (3, ITEM)]
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in find_contamination(docs_of(rows), bench).collect())
    assert got == [(1, 0, 0, []), (2, 0, 0, []), (3, 11, 11, [9, 10]), (3, 13, 11, [9, 10]), (4, 11, 11, [9, 10]), (5, 5, 2, [6]), (6, 2, 2, [6])]


def test_blocks_of_the_benchmark_agree_with_one(spark, docs_of):
    draw = np.random.default_rng(2)
    names = [f"w{i}" for i in range(4)]
    items = [(i, " ".join(draw.choice(names, 12))) for i in range(12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, " ".join(draw.choice(names, 200))) for i in range(10)]
    one = sorted(map(tuple, find_contamination(docs_of(rows), bench, window=5).collect()))
    many = sorted(map(tuple, find_contamination(docs_of(rows), bench, window=5, block_bytes=60, shard_bytes=500).collect()))
    assert one == many
    assert [(r[5], r[7], list(r[8])) for r in one] == brute([t for _, t in sorted(rows)], items, 5)


def test_spans_are_cut_and_clean_text_is_untouched(spark, docs_of, by_id):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    rows = [(1, f"Before; {ITEM}. After"), (2, "Clean,  as it\nis."), (3, None)]
    found = remove_spans(find_contamination(docs_of(rows), bench))
    assert {i: r["text"] for i, r in by_id(found).items()} == {1: "Before; . After", 2: "Clean,  as it\nis.", 3: None}


def test_empty_tables_and_clashing_columns(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert find_contamination(docs_of([]), bench).count() == 0
    got = find_contamination(docs_of([(1, ITEM)]), none).first()
    assert (got["n_words"], got["n_hit"], list(got["items"])) == (11, 0, [])
    clash = docs_of([(1, ITEM)]).selectExpr("*", "'a' AS spans", "'b' AS Items", "'c' AS item_id", "'d' AS n_hit")
    got = find_contamination(clash, bench).first()
    assert (got["n_hit"], list(got["items"]), got["item_id"]) == (11, [1], "c")


def test_a_very_long_text(spark, docs_of):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    text = "one two " * 150_000 + ITEM
    got = find_contamination(docs_of([(1, text)]), bench).first()
    assert (got["n_words"], got["n_hit"]) == (300_011, 11)


@pytest.mark.parametrize("block_bytes", [1, 7, 40, 10_000])
def test_items_longer_than_a_block_lose_no_window(spark, docs_of, block_bytes):
    draw = np.random.default_rng(4)
    long_item = [f"v{i}" for i in draw.integers(0, 50, 60)]
    items = [(3, " ".join(long_item)), (2, "short one"), (1, " ".join(long_item[20:25]))]
    bench = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    rows = [(i, "a b " + " ".join(long_item[i : i + 6]) + " c short one") for i in range(55)]
    found = find_contamination(docs_of(rows), bench, window=5, block_bytes=block_bytes) if block_bytes > 7 else None
    blocks = list(_blocks(bench, "item_id", "text", 5, block_bytes))
    pieces = [(item, words_of(text)) for block in blocks for item, text in block]
    windows = sorted((item, tuple(w[s : s + 5])) for item, w in pieces for s in range(max(1, len(w) - 4)))
    assert windows == sorted((i, tuple(words_of(t)[s : s + 5])) for i, t in items for s in range(max(1, len(words_of(t)) - 4)))
    if found is not None:
        got = [(r["n_words"], r["n_hit"], list(r["items"])) for r in sorted(found.collect(), key=lambda r: r["doc_id"])]
        assert got == brute([t for _, t in rows], items, 5)


@pytest.mark.parametrize("n_names", [20, 100_000])
def test_a_full_block_stays_small(n_names):
    draw = np.random.default_rng(6)
    names = np.array([f"w{i:x}" for i in range(n_names)])
    words = 60 * (1 << 10)
    items = [(i, " ".join(names[draw.integers(0, n_names, 60)])) for i in range(words // 60)]
    tracemalloc.start()
    phrases = Phrases.of(items, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(phrases.windows) == 51 * (1 << 10) and phrases.windows.dtype == np.int32
    assert peak < 400 * words
