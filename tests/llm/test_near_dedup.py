"""Near duplicates against all pairs on small sets."""

import random

import pytest

from chamberlens.llm.near_dedup import components, match_threshold, near_duplicates, shingle_set, without_near_duplicates


def plain_sets(rows):
    sets = {}
    for i, text in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for c in "\t\n\x0b\f\r":
            words = words.replace(c, " ")
        words = [w for w in words.split(" ") if w]
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    return sets


def brute(rows, percent):
    sets = plain_sets(rows)
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            union = len(sets[a] | sets[b])
            if union and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * union:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: (len(sets[i]), top(i), top(i) == i) for i in ids}


def run(df, **options):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(df, **options).collect()}


def families(seed, groups, members):
    """Groups of texts that differ from a common one, or from one another in a chain, by a few words."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randint(0, 5000)}"
    rows = []
    for g in range(groups):
        text = [word() for _ in range(draw.randint(3, 120))]
        for _ in range(members):
            changed = list(text)
            for _ in range(draw.randint(0, 3)):
                changed[draw.randrange(len(changed))] = word()
            if g % 3 == 0:
                text = changed
            rows.append((len(rows), " ".join(changed)))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("percent", [85, 80])
def test_matches_all_pairs(docs_of, percent):
    rows = families(percent, 12, 14)
    assert run(docs_of(rows), percent=percent) == brute(rows, percent)


def test_a_shared_passage_is_no_link(docs_of):
    draw = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, " ".join(f"q{draw.randint(0, 10**6)}" for _ in range(60)) + " " + passage) for i in range(50)]
    assert run(docs_of(rows)) == {i: (96, i, True) for i in range(50)}


def test_awkward_rows(docs_of):
    text = "a b c d e f g h"
    rows = [(5, text), (2, text.upper()), (9, text.replace(" ", "\n\t ")), (1, None), (3, ""), (4, " \n"), (6, "a b"), (7, "A  b"), (8, "a b c")]
    got = run(docs_of(rows))
    assert got == brute(rows, 80)
    assert got[5][1] == 2 and got[9][1] == 2 and got[7][1] == 6 and got[8][1] == 8 and got[1] == (0, 1, True)
    repeated = near_duplicates(docs_of([(1, text), (1, text), (None, text), (2, text), (2, "quite other words stand here now")])).collect()
    assert sorted((r[0] or -1, r[2] or -1, r[3]) for r in repeated) == [(-1, -1, True), (1, 1, True), (1, 1, True), (2, 1, False), (2, 2, True)]


def test_empty_table_and_clashing_columns(docs_of):
    assert run(docs_of([])) == {}
    df = docs_of([(1, "same words"), (2, "same words")])
    for name in ("id", "key", "node", "token", "label", "weight", "df", "_gone", "kept"):
        df = df.selectExpr(*[c for c in df.columns], f"'x' AS `{name}`")
    assert run(df) == {1: (1, 1, True), 2: (1, 1, False)}
    assert [r["node"] for r in without_near_duplicates(df).collect()] == ["x"]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 200), (300, 300)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)} | {201: 200}
    assert got == want


def test_threshold_and_sets():
    assert 1 <= match_threshold(80) < match_threshold(85) < 64
    assert len(shingle_set("a b c d e f")) == 2 and len(shingle_set("a b")) == 1 and len(shingle_set(None)) == 0
    assert shingle_set("a b c")[0] != shingle_set("a b c d")[0]


def test_a_very_long_text(docs_of):
    text = " ".join(str(i) for i in range(100_000))
    assert run(docs_of([(1, text), (2, text + " more")])) == {1: (99_996, 1, True), 2: (99_997, 1, False)}
