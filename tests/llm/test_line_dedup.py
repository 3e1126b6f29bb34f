"""Line deduplication: a brute-force version, and the awkward inputs."""

import random

from chamberlens.llm.line_dedup import line_dedup

BLANKS = " \t\n\x0b\f\r"


def brute(rows, least=10):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))

    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(i)
    result = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == i]
        result.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(result, key=str)


def run(df):
    return sorted((tuple(r) for r in line_dedup(df).select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)


def test_matches_brute_force(docs_of):
    draw = random.Random(3)
    pool = ["a shared long line", "A SHARED LONG LINE  ", "\tÉcole ouverte ici", "école ouverte ici", "short", "", "unique line one", "   "]
    rows = [(i, "\n".join(draw.choice(pool) for _ in range(draw.randint(1, 6)))) for i in range(60)]
    assert run(docs_of(rows)) == brute(rows)


def test_nulls_empties_repeats_and_ties(docs_of):
    line = "the very same line"
    rows = [(1, None), (2, ""), (3, "\n\n"), (5, line), (4, line), (4, line), (None, line), (6, f"{line}\n{line}\nown words here"), (7, line + "\r")]
    assert run(docs_of(rows)) == brute(rows)


def test_a_very_long_text_of_shared_lines(docs_of):
    text = "\n".join(f"line number {i} of many" for i in range(30000))
    got = {r[0]: r for r in run(docs_of([(1, text), (2, text + "\nits own last line")]))}
    assert got[1][3] == 0 and got[2][1] == "its own last line" and got[2][3] == 30000


def test_empty_table_and_clashing_columns(spark, docs_of):
    assert run(docs_of([])) == []
    df = docs_of([(1, "some long line here"), (2, "some long line here")])
    for name in ("id", "mark", "pos", "h1", "first", "gone", "_lines", "_gone", "N_LINES", "key"):
        df = df.selectExpr("*", f"'x' AS `{name}`")
    out = line_dedup(df)
    assert {r["doc_id"]: (r["text"], r["n_dropped"], r["first"]) for r in out.collect()} == {1: ("some long line here", 0, "x"), 2: ("", 1, "x")}


def test_higher_threshold(docs_of):
    rows = [(i, "line in three places") for i in (1, 2, 3)] + [(4, "line in two places"), (5, "line in two places")]
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup(docs_of(rows), min_docs=3).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0, 5: 0}
