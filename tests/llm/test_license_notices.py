"""The usual licence notices as they stand in files, wrapped and behind comment marks."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chamberlens.llm.oracles import LLM_ORACLES
from chamberlens.llm.license_scan import SENTENCES, scan_licenses

GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
APACHE = """Copyright 2020 Some Body and all the others who had a part in it
Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
MIT = """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD.replace("met:\n\n1. R", "met:\n1. R") + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
NOTICES = [
    (GPL, ["GPL-3.0-or-later"], ["gplRedistribute", "gplHope", "gplSee"]),
    (MPL, ["MPL-2.0"], ["mplName"]),
    (APACHE, ["Apache-2.0"], ["apacheCombined", "apacheObtain", "apacheWarranty", "apacheSee"]),
    (MIT, ["MIT"], ["mitTitle", "mitGrant", "mitNotice", "mitWarranty"]),
    (BSD, ["BSD-2-Clause"], ["bsdGrant", "bsdSource", "bsdBinary"]),
    (BSD3, ["BSD-3-Clause"], ["bsdGrant", "bsdSource", "bsdBinary", "bsdEndorse"]),
    ("MIT License\nNote: licensed under\nthe MIT License.", ["MIT"], ["mitTitle", "mitLicensed"]),
    ("Licensed under the Apache License,\nVersion 2.0\nAuthor: Some Body\nSPDX-License-Identifier:\nMIT\nThe rest", ["Apache-2.0", "MIT"], ["apacheName", "spdxMit"]),
    ("The project is\nreleased under the\nMIT License.", ["MIT"], ["mitName"]),
]


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_wrapped_notices_are_recognised(docs_of, mark):
    texts = ["".join(f"{mark}{line}".rstrip() + "\n" for line in text.split("\n")) for text, _, _ in NOTICES]
    got = {r["doc_id"]: (list(r["licenses"]), list(r["sentence_ids"])) for r in scan_licenses(docs_of(list(enumerate(texts)))).collect()}
    assert got == {i: (names, ids) for i, (_, names, ids) in enumerate(NOTICES)}


def test_long_lead_ins_and_words_after_a_sentence_do_not_count(docs_of):
    rows = [(1, "word " * 30 + SENTENCES["mitName"] + "."), (2, SENTENCES["mitName"] + " or not."), (3, "xmit license"), (4, "no MIT license")]
    assert all(not r["sentence_ids"] for r in scan_licenses(docs_of(rows)).collect())


LGPL = GPL.replace("program", "library").replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1")
AGPL = GPL.replace("GNU General", "GNU Affero General")
EPL = """All rights reserved. This program and the accompanying materials
are made available under the terms of the Eclipse Public License v1.0
which accompanies this distribution, and is available at
http://www.eclipse.org/legal/epl-v10.html
"""
BSD_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
"""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.
"""
BOOST = """Distributed under the Boost Software License, Version 1.0.
   (See accompanying file LICENSE_1_0.txt or copy at
         http://www.boost.org/LICENSE_1_0.txt)
"""
PERL = """This library is free software; you can redistribute it and/or modify
it under the same terms as Perl itself.
"""
MORE = [
    (LGPL, ["LGPL-2.1-or-later"], 0),
    (AGPL, ["AGPL-3.0-or-later"], 0),
    (EPL, ["EPL-1.0"], 1),
    (BSD3 + BSD_DISCLAIMER, ["BSD-3-Clause"], 0),
    (BSD + BSD_DISCLAIMER, ["BSD-2-Clause"], 0),
    (ZLIB, ["Zlib"], 0),
    (UNLICENSE, ["Unlicense"], 0),
    (BOOST, ["BSL-1.0"], 0),
    (PERL, ["Artistic-1.0-Perl OR GPL-1.0-or-later"], 0),
]
TAGS = [
    ("// SPDX-License-Identifier: Apache-2.0 OR MIT\nint x;", ["Apache-2.0 OR MIT"], ["Apache-2.0", "MIT"]),
    ("/* SPDX-License-Identifier: GPL-2.0-only */", ["GPL-2.0-only"], ["GPL-2.0-only"]),
    ("# spdx-license-identifier: (gpl-2.0+ WITH Classpath-exception-2.0) AND mit.", ["(gpl-2.0+ WITH Classpath-exception-2.0) AND mit"], ["gpl-2.0+", "MIT"]),
    ("SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note", ["GPL-2.0 WITH Linux-syscall-note"], ["GPL-2.0-only"]),
    ("SPDX-License-Identifier: LGPL-2.1+\nSPDX-License-Identifier: MIT", ["LGPL-2.1+", "MIT"], ["MIT", "LGPL-2.1-or-later"]),
    ("SPDX-License-Identifier: NONE", ["NONE"], []),
    ("SPDX-License-Identifier: LicenseRef-own and more", ["LicenseRef-own"], ["LicenseRef-own"]),
    ("SPDX-License-Identifier: \nno licence here", [], []),
    ("Licensed under the MIT License. SPDX-License-Identifier: Zlib OR (ISC AND MIT)", ["Zlib OR (ISC AND MIT)"], ["MIT", "Zlib", "ISC"]),
]


@pytest.mark.parametrize("mark", ["", " * "])
def test_further_notices_are_recognised_and_explained(docs_of, mark):
    texts = ["".join(f"{mark}{line}".rstrip() + "\n" for line in text.split("\n")) for text, _, _ in MORE]
    got = {r["doc_id"]: (list(r["licenses"]), r["n_unexplained"]) for r in scan_licenses(docs_of(list(enumerate(texts)))).collect()}
    assert got == {i: (names, left) for i, (_, names, left) in enumerate(MORE)}


def test_spdx_expressions(docs_of):
    rows = [*enumerate(t for t, _, _ in TAGS), (90, None), (91, "")]
    got = {r["doc_id"]: (list(r["spdx_expressions"]), list(r["licenses"])) for r in scan_licenses(docs_of(rows)).collect()}
    assert got == {i: (e, n) for i, (_, e, n) in enumerate(TAGS)} | {90: ([], []), 91: ([], [])}


def test_operator_equals_its_sql(docs_of):
    plain = [text for text, _, _ in NOTICES + MORE + TAGS]
    marked = ["".join(f"{m}{line}\n" for line in t.split("\n")) for t in plain for m in ("# ", "\t// ", "\r")]
    joined = [" ".join(t.split()) for t in plain] + [a + b for a, b in zip(plain, reversed(plain))] + ["words before " + t for t in plain]
    odd = [None, "", "\n\n", ".", "\x1e mit license", "MIT License v. 2", "The MIT License\n- MIT License\n\u2022 MIT License (c) MIT License\x0b. MIT license!\u2028"]
    rows = list(enumerate(plain + marked + joined + odd))
    found = scan_licenses(docs_of(rows)).select(
        "doc_id",
        F.size("sentence_ids").alias("n_sentences"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
        "n_unexplained",
    )
    base = duckdb.connect()
    base.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    expected = sorted(base.sql(f"SELECT doc_id, n_sentences, sentence_ids, licenses, n_unexplained FROM ({LLM_ORACLES['op5_license_scan']})").fetchall())
    assert sorted(map(tuple, found.collect())) == expected
