import duckdb
import pytest

from talentmatch.llm import licenses as LI
from talentmatch.llm.oracles import ORACLES

MIT = """Copyright (c) 2020 Somebody

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
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
ENDORSE = """3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software without
   specific prior written permission.
"""
CASES = [
    (MIT, "MIT", "[COPYRIGHT][MIT-GRANT][MIT-NOTICE][MIT-WARRANTY][MIT-LIABILITY]", 1),
    (BSD, "BSD-2-Clause", "[BSD-GRANT][BSD-SOURCE][BSD-BINARY]", 0),
    (BSD + ENDORSE, "BSD-3-Clause", "[BSD-GRANT][BSD-SOURCE][BSD-BINARY][BSD-ENDORSE]", 0),
    ("Some text.\nLicensed under CC BY-NC 4.0.", "CC-BY-NC-4.0", "[?][REF-CC-BY-NC-4.0]", 0),
    ("no stop here\nReleased under the MIT License.\nmore", "MIT", "[REF-MIT][?]", 0),
    ("This work is licensed under the GNU General Public License, version 3. And on.", "GPL-3.0", "[REF-GPL-3.0][?]", 0),
    ("Licensed under the Apache License, Version 2.0.\nLicensed under the MIT license", "Apache-2.0,MIT", "[REF-Apache-2.0][REF-MIT]", 0),
    ("Licensed under the Apache License, Version 2.0 (the \"License\"); you", "", "", 0),
    ("Licensed under nothing known.", "", "", 0),
    ("The licence of a poet. All rights reserved.", "", "[?][RESERVED]", 1),
    ("Copyright 2001 Me.\nAll rights reserved.", "Proprietary", "[COPYRIGHT][RESERVED]", 0),
    ("", "", "", 0), (None, "", "", 0), ("{MIT} [MIT-GRANT] (x) \x01 y", "", "", 0), ("word " * 50_000 + ". Released under the MIT License.", "MIT", "[?][REF-MIT]", 0),
]


@pytest.fixture(scope="module")
def found(documents):
    rows = [(i, c[0]) for i, c in enumerate(CASES)] + [(0, MIT), (None, MIT)]
    return rows, LI.scan(documents(rows, extra=True)).collect()


def test_cases(found):
    rows, got = found
    assert len(got) == len(rows)
    by = {r["id"]: r for r in got}
    for i, (_, licences, sequence, unmatched) in enumerate(CASES):
        r = by[i]
        assert (",".join(r["licences"]), r["sequence"], r["n_unmatched"]) == (licences, sequence, unmatched), i
    assert by[None]["sequence"] == by[0]["sequence"]


def test_the_oracle_agrees_on_every_case(found):
    import pandas as pd
    rows, got = found
    documents = pd.DataFrame({"doc_id": pd.array([i for i, _ in rows], dtype="Int64"), "text": [t for _, t in rows]})
    con = duckdb.connect()
    con.register("documents", documents)
    want = con.execute(ORACLES["op1_licenses"]).fetchall()
    key = lambda rows_: sorted(map(str, rows_))
    assert key(want) == key([(r["id"], r["sequence"], ",".join(r["licences"]), r["n_known"], r["n_unmatched"]) for r in got])


def test_marks_cover_every_known_sentence(spark):
    import re
    for sentence in LI.SENTENCES:
        assert re.search(LI.MARKS, sentence), sentence
    ids = set(LI.SENTENCES.values()) | {f"REF-{x}" for x in LI.NAMES.values()} | {"COPYRIGHT"}
    assert all(i in ids for _, seq in LI.RULES for i in seq)


def test_no_python_and_empty_table(documents):
    plan = LI.scan(documents([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))
    assert LI.scan(documents([])).count() == 0


def test_known_sentences_pass_the_gate_however_they_are_wrapped(documents):
    import re
    for sentence in LI.SENTENCES:
        assert re.search(LI.GATE, sentence.replace(" ", "\n")), sentence
    texts = {"This work is in the public\ndomain.": ("[PUBLIC-DOMAIN]", "Public-Domain"),
             "This work is in the public  domain.": ("[PUBLIC-DOMAIN]", "Public-Domain"),
             "This is free and unencumbered software released into the public-domain.": ("[UNLICENSE-HEAD]", "Unlicense")}
    got = LI.scan(documents(list(enumerate(texts)))).collect()
    assert {r["id"]: (r["sequence"], ",".join(r["licences"])) for r in got} == dict(enumerate(texts.values()))


def test_tags_titles_and_attributes(documents):
    texts = {"# SPDX-License-Identifier: Apache-2.0\nimport os": ("[REF-Apache-2.0][?]", "Apache-2.0"),
             "// SPDX-License-Identifier: GPL-2.0-or-later": ("[REF-GPL-2.0-or-later]", "GPL-2.0-or-later"),
             "This project is MIT licensed.": ("[REF-MIT]", "MIT"),
             "BSD 3-Clause License\n\nCopyright (c) 2020, X": ("[REF-BSD-3-Clause][COPYRIGHT]", "BSD-3-Clause"),
             "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n": ("[GPL-TITLE][GPL3-DATE]", "GPL-3.0"),
             "Apache License\nVersion 2.0, January 2004": ("[APACHE-TITLE][APACHE2-DATE]", "Apache-2.0"),
             "It is licensed under the EPL-2.0.": ("[REF-EPL-2.0]", "EPL-2.0"),
             "He is a licensed driver. He has a driving license": ("", ""),
             "Version 3, 29 June 2007": ("[GPL3-DATE]", "")}
    rows = list(enumerate(texts))
    got = LI.scan(documents(rows)).collect()
    assert {r["id"]: (r["sequence"], ",".join(r["licences"])) for r in got} == dict(enumerate(texts.values()))
    import pandas as pd
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]}))
    want = {r[0]: (r[1], r[2]) for r in con.execute(ORACLES["op1_licenses"]).fetchall()}
    assert want == dict(enumerate(texts.values()))
