import re

import duckdb
import pytest

from promptloom.llm.licences import HINTS, NOTICE, RULES, SENTENCES, licence_report
from promptloom.llm.sql import LICENCE_SQL
from tests.llm.rows import documents, nothing

MIT = """MIT License

Copyright (c) 2020 Someone

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
SOFTWARE."""


def licences(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [row.licences for row in sorted(licence_report(docs).collect())]


def test_tables():
    known = {form for forms in SENTENCES.values() for form in forms}
    assert all(any(hint in form for hint in HINTS) for form in known)
    assert len(known) == sum(map(len, SENTENCES.values()))
    assert {name for _, names in RULES for name in names} <= SENTENCES.keys()


def test_licences(spark):
    sentences = [s + "." for s in MIT.replace("\n", " ").split(". ")]
    assert licences(
        spark,
        MIT,
        "Released under the MIT License.\nThis work is licensed under the GNU General Public License, version 3.",
        "Some prose. Licensed under CC BY-NC 4.0. More prose.",
        "This file is distributed under the terms of the Apache License, Version 2.0.",
        "The licensed driver under the bridge was of general public interest, version 3.",
        " ".join(reversed(sentences)),
        None,
        "",
    ) == ["MIT", "GPL-3.0-only;MIT", "CC-BY-NC-4.0", "Apache-2.0", "", "", "", ""]


GNU = """This {0} is free software{1} you can redistribute it and/or
modify it under the terms of the GNU {2}General Public
License as published by the Free Software Foundation{3} either
version {4} of the License, or (at your option) any later version.

This {0} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
HEADERS = {
    MPL: "MPL-2.0",
    MPL.replace("\n", " "): "MPL-2.0",
    "Licensed under the Mozilla Public License, v. 2.0.": "MPL-2.0",
    GNU.format("program", ";", "", ";", "2"): "GPL-2.0-or-later",
    GNU.format("program", ":", "", ",", "3"): "GPL-3.0-or-later",
    GNU.format("library", ";", "Lesser ", ";", "2.1"): "LGPL-2.1-or-later",
    GNU.format("library", ":", "Lesser ", ",", "3"): "LGPL-3.0-or-later",
    GNU.format("program", ":", "Affero ", ",", "3"): "AGPL-3.0-or-later",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0",
    "This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": "CC-BY-NC-4.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.": "CC-BY-NC-SA-4.0",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.": "CC-BY-ND-4.0",
    "This project is licensed under the MIT License - see the LICENSE file for details.": "MIT",
    "This project is licensed under the MIT License - see the [LICENSE.md](LICENSE.md) file for details": "MIT",
    "The project is licensed under the GNU General Public License v3.0.": "GPL-3.0-only",
    "All files of it are licensed under the BSD 3-Clause License.": "BSD-3-Clause",
    "Copyright (c) 2020 J. Smith\nLicensed under the Apache License,\nVersion 2.0.": "Apache-2.0",
    "The project is not licensed under the MIT License.": "",
    "Licensed under the Mozilla Public License, v. 1.1.": "",
}


@pytest.mark.parametrize("mark", ["", "// ", " * ", "# ", ";; ", "-- ", "dnl "])
def test_official_headers(spark, mark):
    texts = [f"{mark}Copyright (C) 2020 Someone\n" + "\n".join(mark + line for line in text.split("\n")) for text in HEADERS]
    assert dict(zip(HEADERS, licences(spark, *texts), strict=True)) == HEADERS
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id bigint, text varchar)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    assert [row[3] for row in sorted(connection.execute(LICENCE_SQL).fetchall())] == list(HEADERS.values())


def test_notices_in_normal_form():
    for form in (form for forms in SENTENCES.values() for form in forms):
        assert re.sub(NOTICE, "under ", form) == form


def test_order_of_sentences(spark):
    a, b, c, d = (SENTENCES[name][0] for name in ("bsd-conditions", "bsd-source", "bsd-binary", "bsd-no-warranty"))
    e = SENTENCES["bsd-no-endorsement"][0]
    two, three, wrong = (". ".join(parts) + "." for parts in ((a, b, c, d), (a, b, c, e, d), (a, c, b, d)))
    assert licences(spark, two, three, wrong, two + " " + three) == [
        "BSD-2-Clause", "BSD-3-Clause", "", "BSD-2-Clause;BSD-3-Clause"
    ]


@pytest.mark.parametrize("text", ["word. " * 200_000, "licence " * 100_000])
def test_long_text(spark, text):
    assert licences(spark, text + "Released under the MIT License.")[0] in ("MIT", "")
    assert licences(spark, text + "\nReleased under the MIT License.") == ["MIT"]


def test_rows(spark):
    docs = documents(spark)
    assert sorted(str(row.doc_id) for row in licence_report(docs).collect()) == sorted(str(r.doc_id) for r in docs.collect())
    assert licence_report(nothing(spark)).collect() == []
