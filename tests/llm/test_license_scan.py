"""Licence sentences and rules against a plain Python reading of them."""

import re

from chamberlens.llm.license_scan import LICENCE_RULES, SENTENCES, scan_licenses

MIT = f"""Copyright (c) 2020 Some Body. {SENTENCES["mitGrant"].capitalize()}:

{SENTENCES["mitNotice"].capitalize()}.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
warranties of merchantability, fitness for a particular purpose and
 # noninfringement."""


def brute(text):
    known = {s: i for i, s in SENTENCES.items()}
    text = re.sub(r"\n[ \t]*(?:#+|//+|\*+|--+|;+)?[ \t]*([a-z])", r" \1", text or "")
    parts = re.sub(r"[.!?]+(?:[ \t\n\x0b\f\r]+|$)", "\n", text).split("\n")
    ids = [known[n] for n in (re.sub("[^a-z0-9]+", " ", p.lower()).strip(" ") for p in parts) if n in known]
    names, at = [], list(ids)
    for name, rule in LICENCE_RULES:
        place = 0
        while place + len(rule) <= len(at):
            if at[place : place + len(rule)] == list(rule):
                at[place : place + len(rule)] = [None]
                if name not in names:
                    names.append(name)
            place += 1
    return ids, names, sum(i is not None for i in at)


def run(df):
    return {r["doc_id"]: (list(r["sentence_ids"]), list(r["licenses"]), r["n_unexplained"]) for r in scan_licenses(df).collect()}


def test_matches_brute_force(docs_of, medium, spark):
    texts = [
        MIT,
        "Licensed under the Apache License, Version 2.0.",
        "x\nReleased under the MIT License.\nmore",
        "Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0! All rights reserved.",
        SENTENCES["gplRedistribute"] + ". " + SENTENCES["gplHope"] + ". " + SENTENCES["gplSee"] + ".",
        SENTENCES["gplHope"] + ".",
        SENTENCES["mitNotice"] + ". " + SENTENCES["mitGrant"] + ".",
        "See the license for no language",
        "SPDX-License-Identifier: MIT",
    ]
    got = run(docs_of(list(enumerate(texts))))
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    assert got[0][1] == ["MIT"] and got[0][2] == 0 and got[4][1] == ["GPL-3.0-or-later"] and got[6] == (["mitNotice", "mitGrant"], [], 2)


def test_every_known_sentence_is_found_alone(docs_of):
    got = run(docs_of(list(enumerate(SENTENCES.values()))))
    assert [got[i][0] for i in range(len(SENTENCES))] == [[i] for i in SENTENCES]
    named = {i for _, rule in LICENCE_RULES for i in rule}
    assert named <= set(SENTENCES)


def test_nulls_empties_repeats_long_texts_and_clashing_names(docs_of):
    long = "word " * 200_000 + "end.\nReleased under the MIT License.\n" + "tail " * 1000
    rows = [(1, None), (2, ""), (3, long), (3, long)]
    df = docs_of(rows).selectExpr("*", "1 AS licenses", "2 AS _parts", "3 AS _found", "4 AS row")
    got = [(r["doc_id"], list(r["licenses"]), r["row"], r["_parts"]) for r in scan_licenses(df).collect()]
    assert sorted(got) == [(1, [], 4, 2), (2, [], 4, 2), (3, ["MIT"], 4, 2), (3, ["MIT"], 4, 2)]
    assert scan_licenses(docs_of([])).count() == 0
