"""Licence recognition by sentences: known sentences get identifiers, rules match their order.

Everything is one projection: no shuffle, whatever the texts hold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chamberlens.llm.common import free_names, without

#: Known licence sentences, normalised: lower case, runs of other characters as one blank.
SENTENCES = {
    "apacheName": "licensed under the apache license version 2 0",
    "apacheGrant": "licensed under the apache license version 2 0 the license",
    "apacheUse": "you may not use this file except in compliance with the license",
    "apacheCombined": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apacheObtain": "you may obtain a copy of the license at",
    "apacheWarranty": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apacheSee": "see the license for the specific language governing permissions and limitations under the license",
    "mitName": "released under the mit license",
    "mitNameTitle": "the mit license",
    "mitTitle": "mit license",
    "mitLicensed": "licensed under the mit license",
    "mitGrant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mitNotice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mitWarranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "gpl3Name": "this work is licensed under the gnu general public license version 3",
    "gpl2Name": "this work is licensed under the gnu general public license version 2",
    "gplRedistribute": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2Redistribute": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gplHope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gplSee": "see the gnu general public license for more details",
    "bsdGrant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsdSource": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsdBinary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsdEndorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "iscGrant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mplName": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "ccByNc4": "licensed under cc by nc 4 0",
    "ccBy4": "licensed under cc by 4 0",
    "ccBySa4": "licensed under cc by sa 4 0",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "spdxMit": "spdx license identifier mit",
    "spdxApache": "spdx license identifier apache 2 0",
    "spdxGpl3": "spdx license identifier gpl 3 0 only",
    "spdxBsd3": "spdx license identifier bsd 3 clause",
    "reserved": "all rights reserved",
    "mitLiability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "bsdWarranty": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsdLiability": "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "lgpl21Redistribute": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl3Redistribute": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl3RedistributeProgram": "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgplHope": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgplSee": "see the gnu lesser general public license for more details",
    "agplRedistribute": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agplSee": "see the gnu affero general public license for more details",
    "epl1Name": "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html",
    "epl2Name": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "unlicenseFree": "this is free and unencumbered software released into the public domain",
    "unlicenseAnyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "zlibWarranty": "this software is provided as is without any express or implied warranty",
    "zlibLiability": "in no event will the authors be held liable for any damages arising from the use of this software",
    "zlibGrant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "boostName": "distributed under the boost software license version 1 0",
    "boostAccompany": "see accompanying file license 1 0 txt or copy at http www boost org license 1 0 txt",
    "perlTerms": "you can redistribute it and or modify it under the same terms as perl itself",
    "artistic2Name": "licensed under the artistic license 2 0",
    "artistic2Terms": "you can redistribute it and or modify it under the terms of the artistic license 2 0",
}

#: Licence and the sequence of sentence identifiers that proves it; the first rule wins its sentences.
LICENCE_RULES = (
    ("MIT", ("mitGrant", "mitNotice", "mitWarranty", "mitLiability")),
    ("MIT", ("mitGrant", "mitNotice", "mitWarranty")),
    ("MIT", ("mitGrant", "mitNotice")),
    ("Apache-2.0", ("apacheCombined", "apacheObtain", "apacheWarranty", "apacheSee")),
    ("Apache-2.0", ("apacheGrant", "apacheUse", "apacheObtain")),
    ("GPL-3.0-or-later", ("gplRedistribute", "gplHope", "gplSee")),
    ("GPL-2.0-or-later", ("gpl2Redistribute", "gplHope", "gplSee")),
    ("AGPL-3.0-or-later", ("agplRedistribute", "gplHope", "agplSee")),
    ("LGPL-2.1-or-later", ("lgpl21Redistribute", "lgplHope", "lgplSee")),
    ("LGPL-3.0-or-later", ("lgpl3Redistribute", "lgplHope", "lgplSee")),
    ("LGPL-3.0-or-later", ("lgpl3RedistributeProgram", "gplHope", "lgplSee")),
    ("BSD-3-Clause", ("bsdGrant", "bsdSource", "bsdBinary", "bsdEndorse", "bsdWarranty", "bsdLiability")),
    ("BSD-2-Clause", ("bsdGrant", "bsdSource", "bsdBinary", "bsdWarranty", "bsdLiability")),
    ("Zlib", ("zlibWarranty", "zlibLiability", "zlibGrant")),
    ("Unlicense", ("unlicenseFree", "unlicenseAnyone")),
    ("BSL-1.0", ("boostName", "boostAccompany")),
    ("BSD-3-Clause", ("bsdGrant", "bsdSource", "bsdBinary", "bsdEndorse")),
    ("BSD-2-Clause", ("bsdGrant", "bsdSource", "bsdBinary")),
    ("GPL-3.0-or-later", ("gplRedistribute",)),
    ("GPL-2.0-or-later", ("gpl2Redistribute",)),
    ("Apache-2.0", ("apacheCombined",)),
    ("Apache-2.0", ("apacheGrant",)),
    ("Apache-2.0", ("apacheName",)),
    ("Apache-2.0", ("spdxApache",)),
    ("MIT", ("mitName",)),
    ("MIT", ("mitLicensed",)),
    ("MIT", ("mitNameTitle",)),
    ("MIT", ("mitTitle",)),
    ("MIT", ("spdxMit",)),
    ("GPL-3.0-only", ("gpl3Name",)),
    ("GPL-3.0-only", ("spdxGpl3",)),
    ("GPL-2.0-only", ("gpl2Name",)),
    ("BSD-3-Clause", ("spdxBsd3",)),
    ("ISC", ("iscGrant",)),
    ("MPL-2.0", ("mplName",)),
    ("CC-BY-NC-4.0", ("ccByNc4",)),
    ("CC-BY-SA-4.0", ("ccBySa4",)),
    ("CC-BY-4.0", ("ccBy4",)),
    ("CC0-1.0", ("cc0",)),
    ("AGPL-3.0-or-later", ("agplRedistribute",)),
    ("LGPL-2.1-or-later", ("lgpl21Redistribute",)),
    ("LGPL-3.0-or-later", ("lgpl3Redistribute",)),
    ("LGPL-3.0-or-later", ("lgpl3RedistributeProgram",)),
    ("EPL-1.0", ("epl1Name",)),
    ("EPL-2.0", ("epl2Name",)),
    ("Zlib", ("zlibGrant",)),
    ("Unlicense", ("unlicenseFree",)),
    ("BSL-1.0", ("boostName",)),
    ("Artistic-2.0", ("artistic2Name",)),
    ("Artistic-2.0", ("artistic2Terms",)),
    ("Artistic-1.0-Perl OR GPL-1.0-or-later", ("perlTerms",)),
)

#: A line break before a lower-case letter, past comment marks, does not end a line either.
SOFT_BREAK = r"\n[ \t]*(?:#+|//+|\*+|--+|;+)?[ \t]*([a-z])"
NOT_WORD = r"[^a-z0-9]+"
#: Sentences are told apart by this character until they are split; lines within them stay.
_END = "\x1e"
_MARK = r"[ \t]*(?:#+|//+|\*+|--+|;+)?[ \t]*"
#: What ends a sentence besides its mark: blank lines and the numbers of list items.
_BLANK_LINES = rf"\r?\n(?:{_MARK}\r?\n)+"
_LIST_ITEM = rf"\n{_MARK}(?:\(?[0-9]{{1,2}}[.)]|\([a-z]\)|[-\x{{2022}}])[ \t]+"
_VERSION_DOT = r"(?i)\b(v|ver)\.([\s\x0B]{0,9}[0-9])"
_SENTENCE_MARK = rf"[.!?]+(?:[\s\x0B{_END}]+|\z)"
#: What each pattern becomes, in this order; a number in braces stands for a group.
BREAKS = ((_VERSION_DOT, "{1} {2}"), (_BLANK_LINES, _END), (_LIST_ITEM, _END), (SOFT_BREAK, " {1}"), (_SENTENCE_MARK, _END))

#: An SPDX tag and its expression on one line: identifiers joined by operators, perhaps in parentheses.
_SPDX_ID = r"[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\+?"
_SPDX_TERM = rf"(?:\([ \t]*)*{_SPDX_ID}(?:[ \t]*\))*"
SPDX = rf"(?i:SPDX-License-Identifier):[ \t]*({_SPDX_TERM}(?:[ \t]+(?:AND|OR|WITH)[ \t]+{_SPDX_TERM})*)"
SPDX_EXCEPTION = rf"[ \t]+WITH[ \t]+{_SPDX_ID}"
#: Identifiers of the GNU licences before they told "only" from "or later".
SPDX_LATER, SPDX_ONLY = r"^((?:A|L)?GPL-[0-9.]+)\+$", r"^((?:A|L)?GPL-[0-9.]+)$"
SPDX_NO_LICENCE = ("AND", "OR", "NONE", "NOASSERTION")
#: Characters that may stand before a known sentence in its first line, and the words up to which one is a title.
LEAD_IN, TITLE_WORDS = 40, 4


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), NOT_WORD, " "))


def _lines(sentence: Column) -> Column:
    """Normalised lines, each word after a blank, without those that hold no word."""
    lines = F.transform(F.split(sentence, "\n", -1), lambda w: F.concat(F.lit(" "), normalised(w)))
    return F.filter(lines, lambda w: w != " ")


def _known_in(lines: Column, sentences: Mapping[str, str]) -> Column:
    """Identifiers in one sentence, given by its lines.

    From the last line back, the longest known sentence that ends with a line counts if it
    begins a line or, unless it is as short as a title, follows a short lead-in in a line.
    """
    ordered = sorted(sentences.items(), key=lambda x: -len(x[1]))
    longest_first = F.array(*[
        F.struct(F.lit(i).alias("id"), F.lit(f" {s}").alias("words"), F.lit(LEAD_IN if s.count(" ") >= TITLE_WORDS else 0).alias("room"))
        for i, s in ordered
    ])

    most = max(len(s.split(" ")) for s in sentences.values())  # a line holds a word at least

    def fitting(j: Column, s: Column) -> Column:
        back = F.sequence(F.lit(1), F.least(j, F.lit(most)))
        runs = F.transform(back, lambda k: F.struct(k.alias("k"), F.array_join(F.slice(lines, j - k + 1, k), "").alias("words")))
        size = F.char_length(s["words"])
        run = F.get(F.filter(runs, lambda r: F.char_length(r["words"]) >= size), F.lit(0))
        fits = F.endswith(run["words"], s["words"]) & (F.char_length(run["words"]) <= size + s["room"])
        return F.struct(s["id"].alias("id"), F.when(fits, run["k"]).alias("k"))

    def ending(j: Column) -> Column:
        line = F.element_at(lines, j)
        maybe = F.filter(longest_first, lambda s: F.endswith(line, s["words"]) | F.endswith(s["words"], line))
        return F.get(F.filter(F.transform(maybe, lambda s: fitting(j, s)), lambda hit: hit["k"].isNotNull()), F.lit(0))

    def step(state: Column, j: Column) -> Column:
        def add(hit: Column) -> Column:
            more = F.struct((j - hit["k"]).alias("free"), F.concat(F.array(hit["id"]), state["ids"]).alias("ids"))
            return F.when(hit.isNull(), state).otherwise(more)

        return F.when(j > state["free"], state).otherwise(F.get(F.transform(F.array(ending(j)), add), F.lit(0)))

    start = F.struct(F.size(lines).alias("free"), F.array().cast("array<string>").alias("ids"))
    places = F.reverse(F.transform(lines, lambda w, i: i + 1))
    return F.aggregate(places, start, step, lambda state: state["ids"])


def cues(sentences: Mapping[str, str]) -> str:
    """Pattern of words of which each known sentence holds one, so that others need no look."""
    words = sorted({max(s.split(" "), key=len) for s in sentences.values()})
    return rf"(?:^|[^a-z0-9])(?:{'|'.join(words)})"


def spdx_licenses(expressions: Column, known: Sequence[str]) -> Column:
    """Licences named in SPDX expressions, exceptions left out, in order and repeated."""
    spelling = F.create_map(*[F.lit(x) for name in sorted(set(known)) for x in (name.lower(), name)])

    def named(expression: Column) -> Column:
        plain = F.regexp_replace(expression, SPDX_EXCEPTION, "")
        return F.filter(F.regexp_extract_all(plain, F.lit(_SPDX_ID), F.lit(0)), lambda i: ~i.isin(*SPDX_NO_LICENCE))

    def current(i: Column) -> Column:
        i = F.regexp_replace(F.regexp_replace(i, SPDX_LATER, "$1-or-later"), SPDX_ONLY, "$1-only")
        return F.coalesce(F.try_element_at(spelling, F.lower(i)), i)

    return F.transform(F.flatten(F.transform(expressions, named)), current)


def scan_licenses(
    docs: DataFrame,
    text_col: str = "text",
    sentences: Mapping[str, str] = SENTENCES,
    rules: Sequence[tuple[str, Sequence[str]]] = LICENCE_RULES,
) -> DataFrame:
    """The documents with ``sentence_ids``, ``licenses``, ``n_unexplained``, ``spdx_expressions``.

    A sentence ends with its mark, at a blank line or before a list item, not where a line
    wraps. ``sentence_ids`` are the known sentences of the whole text in order; ``licenses`` the
    distinct licences in the order of the rules. Each rule takes every place where its
    identifiers stand in a row, and what it took is closed to later rules.
    ``n_unexplained`` counts sentences that no rule took. ``spdx_expressions`` are those
    that follow a tag on its line; the licences they name, whatever joins them and without
    exceptions, follow those of the rules. Null and empty texts have none of all this.
    Rows are judged one by one, so repeated rows give repeated results; input columns with
    the names of the results are replaced.
    """
    base = without(docs, "sentence_ids", "licenses", "n_unexplained", "spdx_expressions")
    parts, found, tags = free_names(base, "_parts", "_found", "_tags")
    text = whole = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit(_END), F.lit(" "))
    for pattern, by in BREAKS:
        text = F.regexp_replace(text, pattern, by.format("", "$1", "$2"))
    shortest = min(map(len, sentences.values()))
    # most texts hold no cue and need not be cut into sentences
    pieces = F.when(F.lower(whole).rlike(cues(sentences)), F.split(text, _END, -1)).otherwise(F.array().cast("array<string>"))
    likely = F.filter(pieces, lambda s: (F.char_length(s) >= shortest) & F.lower(s).rlike(cues(sentences)))
    ids = F.flatten(F.transform(F.transform(likely, _lines), lambda lines: _known_in(lines, sentences)))

    written = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(_row(seq)).alias("row")) for name, seq in rules])
    start = F.struct(F.col(found)["row"].alias("row"), F.array().cast("array<string>").alias("names"))

    def take(state: Column, rule: Column) -> Column:
        hit = F.contains(state["row"], rule["row"])
        return F.when(
            hit,
            F.struct(
                F.replace(state["row"], rule["row"], F.lit("|")).alias("row"),
                F.concat(state["names"], F.array(rule["name"])).alias("names"),
            ),
        ).otherwise(state)

    listed = base.withColumn(parts, ids)
    row = F.concat(F.lit("|"), F.array_join(F.transform(parts, lambda i: F.concat(F.lit("<"), i, F.lit(">"))), ""), F.lit("|"))
    stated = listed.withColumn(found, F.struct(row.alias("row")))
    matched = F.when(F.size(parts) > 0, F.aggregate(written, start, take)).otherwise(start)
    tagged = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(SPDX), F.lit(1))
    return stated.withColumns({found: matched, tags: tagged}).select(
        *base.columns,
        F.col(parts).alias("sentence_ids"),
        F.array_distinct(F.concat(F.col(found)["names"], spdx_licenses(F.col(tags), [n for n, _ in rules]))).alias("licenses"),
        (F.char_length(F.col(found)["row"]) - F.char_length(F.replace(F.col(found)["row"], F.lit("<"), F.lit(""))))
        .cast("bigint")
        .alias("n_unexplained"),
        F.col(tags).alias("spdx_expressions"),
    )


def _row(identifiers: Sequence[str]) -> str:
    return "".join(f"<{i}>" for i in identifiers)
