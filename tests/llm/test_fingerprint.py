"""Fingerprints against plain slicing, and documents next to their neighbours."""

import hashlib
import random

from pyspark.sql import functions as F

from chamberlens.llm.fingerprint import (
    BLOCK,
    KEPT,
    SPAN,
    Fingerprint,
    PrefixHashes,
    compare_with_next,
    equal_spans,
    fingerprint,
    likeness,
    longest_common_extension,
)
from chamberlens.llm.queries import LLM_QUERIES


def brute(rows):
    """{row: (n_chars, edited)} as sorted pairs; rows have distinct ids or are copies."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    found = []
    for (i, text), (_, after) in zip(ordered, [*ordered[1:], ordered[0]]):
        text, after = text or "", after or ""
        half = len(text) // 2
        found.append((i, len(text), text[: len(text) - half] + after[:half]))
    return sorted(found, key=str)


def run(df):
    return sorted((tuple(r) for r in compare_with_next(df).select("doc_id", "n_chars", "edited").collect()), key=str)


def test_spans_and_extensions_match_slices():
    draw = random.Random(2)
    for size in (0, 1, 17, 300, 2 * BLOCK + 9):
        a = "".join(draw.choice("abé😀") for _ in range(size))
        b = "xy" + a[: size // 2] + "Z" + a[size // 2 :]
        one, two = PrefixHashes(a), PrefixHashes(b)
        for _ in range(50):
            i, j, n = draw.randint(0, size), draw.randint(0, size), draw.choice([0, 1, 3, 40])
            inside = i + n <= len(a) and j + n <= len(b)
            assert equal_spans(one, i, two, j, n) == (inside and a[i : i + n] == b[j : j + n])
            plain = 0
            while i + plain < len(a) and j + plain < len(b) and a[i + plain] == b[j + plain]:
                plain += 1
            assert longest_common_extension(one, i, two, j) == plain
        if size > SPAN:
            spans = [int(h) for block in one.spans(SPAN) for h in block]
            assert spans == [one.span(i, i + SPAN) for i in range(size - SPAN + 1)]


def test_kept_spans_are_the_smallest_distinct_ones():
    draw = random.Random(3)
    for text in ("".join(draw.choice("abcdef") for _ in range(5000)), "same line over again\n" * 900, "x" * 5000):
        found = Fingerprint.of(PrefixHashes(text))
        distinct = {text[i : i + SPAN] for i in range(len(text) - SPAN + 1)}
        every = sorted(int(k) for s in distinct for k in Fingerprint.of(PrefixHashes(s)).kept)
        assert found.kept.tolist() == every[:KEPT]
        again = Fingerprint.parse(str(found))
        assert str(again) == str(found) and again.likeness(found) == 1.0


def test_likeness_tells_copies_edits_and_strangers_apart():
    draw = random.Random(4)

    def text(n):
        return " ".join("".join(draw.choice("abcdefghijklmno") for _ in range(5)) for _ in range(n))

    def alike(a, b):
        return Fingerprint.of(PrefixHashes(a)).likeness(Fingerprint.of(PrefixHashes(b)))

    a, b = text(600), text(600)
    assert alike(a, a) == 1.0 and alike("", "") == 1.0 and alike("", a) == 0.0
    assert alike(a, b) < 0.05
    assert 0.8 < alike(a, a.replace(a[1000:1005], "zzzzz", 1)) <= 1.0
    assert 0.7 < alike(a, "new start " + a) <= 1.0
    assert 0.3 < alike(a, a[: len(a) // 2] + b[len(b) // 2 :]) < 0.65
    assert alike("short", "shore") >= 0.8 and alike("ab", "xy") == 0.0


def test_columns_and_nulls(spark):
    df = spark.createDataFrame([("one text", "one text"), (None, ""), ("a", None)], "a string, b string")
    got = df.select(fingerprint("a").alias("x"), fingerprint("b").alias("y")).select("x", "y", likeness("x", "y").alias("l")).collect()
    assert [r["x"] == r["y"] for r in got] == [True, True, False] and [r["l"] for r in got] == [1.0, 1.0, 0.0]
    assert df.select(likeness(F.lit(None).cast("string"), fingerprint("a")).alias("l")).first()["l"] is None


def test_neighbours_match_brute_force(docs_of, conf):
    conf("spark.sql.shuffle.partitions", "6")
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    draw = random.Random(5)
    rows = [(i * 3 - 200, "".join(draw.choice("abé😀 \n") for _ in range(draw.choice([0, 1, 2, 30, 90])))) for i in range(150)]
    draw.shuffle(rows)
    assert run(docs_of(rows).repartition(4)) == brute(rows)


def test_nulls_ties_and_copies(docs_of, conf):
    conf("spark.sql.shuffle.partitions", "5")
    rows = [(1, None), (2, ""), (3, "odd"), (7, "even text"), (None, "without id"), (9, "last one here")]
    assert run(docs_of(rows)) == brute(rows)
    copies = [(5, "many copies of this")] * 300 + [(None, None)] * 200 + [(4, "before"), (6, "after, longer than the rest")]
    assert run(docs_of(copies).repartition(6)) == brute(copies)
    shared = docs_of([(5, f"text {i} of one id") for i in range(40)])
    got = compare_with_next(shared).collect()
    assert sorted(r["edited"][:7] for r in got) == sorted(f"text {i} of one id"[:7] for i in range(40))


def test_copies_share_several_tasks(docs_of, conf):
    conf("spark.sql.shuffle.partitions", "6")
    df = docs_of([(5, "many copies of this")] * 3000).repartition(6)
    sizes = [r["count"] for r in compare_with_next(df).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1500 and sum(sizes) == 3000


def test_one_empty_and_very_long(docs_of):
    assert run(docs_of([])) == []
    assert run(docs_of([(1, "alone")])) == brute([(1, "alone")])
    rows = [(1, "long text " * 200_000), (2, "x" * 300_001)]
    assert run(docs_of(rows)) == brute(rows)


def test_clashing_names(docs_of):
    df = docs_of([(1, "one text here"), (2, "another text there")])
    for name in ("id", "mark", "place", "code", "part", "lead", "edited", "N_CHARS_", "fingerprint"):
        df = df.selectExpr("*", f"'x' AS `{name}`")
    assert run(df) == brute([(1, "one text here"), (2, "another text there")])


def test_the_query_matches_brute_force(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = LLM_QUERIES["op12_fingerprints"](spark, small).collect()
    want = [(i, n, hashlib.sha256(t.encode()).hexdigest()) for i, n, t in brute(docs)]
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == sorted(want, key=str)
    texts = dict(docs)
    by_print = {}
    for r in got:
        assert by_print.setdefault(r["fingerprint"], texts[r["doc_id"]]) == texts[r["doc_id"]]
        assert 0 <= r["near_next"] <= 1 and r["near_edited"] >= 0.3
    assert len(by_print) == len(set(texts.values()))
