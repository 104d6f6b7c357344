"""Sharding and licences: small cases beside their SQL twins."""

import re
import textwrap
import zlib

import duckdb
from pyspark.sql import functions as F

from checks.compare import compare
from ferrylog.llm import licences, sharding


def jump(key, shards):
    """The published loop with 64-bit arithmetic."""
    key %= 1 << 64
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash(spark):
    keys = [0, 1, -1, 7, 2**62, -2**63, 2**63 - 1, *range(1000, 1300)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for shards in (1, 2, 40, 41, 500):
        got = {r.k: r.s for r in df.select("k", sharding.jump_hash(F.col("k"), shards).alias("s")).collect()}
        assert got == {k: jump(k, shards) for k in keys}


def test_a_new_shard_only_takes_rows(spark):
    df = sharding.assign_shards(spark.range(3000), "id", 40).collect()
    assert all(r.grown_shard in (r.shard, 40) for r in df) and 30 < sum(r.grown_shard == 40 for r in df) < 130


def test_shard_edges(spark):
    rows = [(1, "é"), (2, None), (3, ""), (4, "x" * 100000), (4, "x" * 100000), (None, "n")]
    df = spark.createDataFrame([(i, t, 9, "q") for i, t in rows], "doc_id long, text string, shard int, slot string")
    out = sharding.shard_documents(df).collect()
    assert len(out) == 6 and {r.law for r in out} == {"key"}
    facts = {(r.doc_id, r.size, r.text_crc32) for r in out}
    assert facts == {(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows}
    by_shard = {}
    for r in out:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert sharding.shard_documents(df.limit(0)).count() == 0


def test_licences(spark):
    notice = "Licensed under the Apache License, Version 2.0.\nYou may not use this file except in compliance with the License. You may obtain a copy of the License at"
    rows = [(1, "Text. Released under the MIT License.\nMore"), (2, notice), (3, None), (4, ""), (5, "released under the mit license, or not"),
            (6, "RELEASED -- UNDER the MIT license!! Released under the MIT License."), (7, "z " * 200000),
            (8, "You may not use this file except in compliance with the License. Licensed under the Apache License, Version 2.0.")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, licences string")
    out = {r.doc_id: (r.n_sentences, r.sentence_ids, r.licences) for r in licences.licence_report(df).collect()}
    assert out[1] == (1, "4", "mit") and out[2] == (3, "3 8 9", "apache-2.0 apache-2.0-notice")
    assert out[6] == (2, "4 4", "mit") and out[8] == (2, "8 3", "apache-2.0")
    assert all(out[i] == (0, "", "") for i in (3, 4, 5, 7))
    assert licences.licence_report(df.limit(0)).count() == 0
    assert licences.scan_licences(df).columns == ["doc_id", "text", "licences", "sentence_ids"]


def test_licences_in_padded_sentences(spark, tmp_path):
    """Runs of other characters are one blank, however long; the twin agrees."""
    texts = ["-" * 400 + " Released under the MIT License.", "Released" + " " * 900 + "under the MIT License" + "*" * 500,
             "All\t" + "\u2014 " * 300 + "rights reserved!", "-" * 100 + " Released under the MIT License.", "word " * 100 + "Released under the MIT License."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r.sentence_ids for r in licences.licence_report(df).collect()}
    assert out == {0: "4", 1: "4", 2: "14", 3: "4", 4: ""}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare(con, licences.licence_report(df), licences.LICENCE_SQL) is None


MIT = """MIT License

Copyright (c) 2020 A. Writer

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

APACHE = """Copyright 2020 A. Writer

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""

_USEFUL = """
This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
""" + _USEFUL
GPL2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.
""" + _USEFUL

_BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
%s
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES."""
BSD2 = _BSD % ""
BSD3 = _BSD % """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""

CC_NOTICE = """This work is licensed under the Creative Commons
Attribution-ShareAlike 4.0 International License. To view a copy of this
license, visit http://creativecommons.org/licenses/by-sa/4.0/ or send a letter."""
CC_CODE = """Creative Commons Attribution-NonCommercial 4.0 International Public License

By exercising the Licensed Rights (defined below), You accept and agree to be
bound by the terms and conditions of this Creative Commons
Attribution-NonCommercial 4.0 International Public License ("Public License")."""

LICENCE_TEXTS = [
    (MIT, "mit-text"), (APACHE, "apache-2.0 apache-2.0-notice"), (GPL3, "gpl gpl-3.0-or-later"), (GPL2, "gpl gpl-2.0-or-later"),
    (BSD2, "bsd bsd-2-clause"), (BSD3, "bsd bsd-3-clause"), (CC_NOTICE, "cc-by-sa-4.0"), (CC_CODE, "cc-by-nc-4.0")]
# Titles are lines of their own and aren't wrapped otherwise.
LICENCE_TITLES = [
    ("Apache License\n   Version 2.0, January 2004\n   http://www.apache.org/licenses/\n", "apache-2.0"),
    ("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\nCopyright", "gpl-3.0")]


def rewrapped(text, width):
    """Paragraphs in lines of another width; none if it is 0."""
    parts = [re.sub(r"\s+", " ", p).strip() for p in re.split(r"\n\s*\n", text)]
    return "\n\n".join(textwrap.fill(p, width) if width else p for p in parts)


def test_licence_texts(spark):
    """The licences' own wording, as they wrap it, wrapped otherwise, in comments and between other lines."""
    forms = [lambda t: t, lambda t: "Some heading\n" + t + "\nand a line after it", lambda t: t.replace("\n", "\r\n"), lambda t: "/*\n" + re.sub("^", " * ", t, flags=re.M) + "\n */\nint main() {}",
             *[lambda t, c=c: re.sub("^", c, t, flags=re.M) for c in ("# ", "// ", ";; ", "! ", "    ")]]
    wrapped = [lambda t, w=w: rewrapped(t, w) for w in (0, 30, 50, 100)]
    rows = [(f"{want} {j}", form(text), want) for texts, ways in ((LICENCE_TEXTS, forms + wrapped), (LICENCE_TITLES, forms))
            for text, want in texts for j, form in enumerate(ways)]
    out = licences.licence_report(spark.createDataFrame(rows, "doc_id string, text string, want string")).collect()
    got = {r.doc_id: r.licences for r in out}
    assert {i: got[i] for i, _, want in rows if got[i] != want} == {}


def test_licence_lines(spark):
    """A known line counts by itself, the longer sentence before it; blank lines and final punctuation part sentences."""
    rows = ["A line\nReleased under the MIT License\nand another", "Released\nunder the\n-- MIT License", "Released\n\nunder the MIT License",
            "Released.\nunder the MIT License", "Released under the MIT License\nAll rights reserved",
            "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this book", "Not released\nunder the MIT License",
            "Released under\n***\nthe MIT License", "x released under the\nMIT License"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    out = {r.doc_id: r.sentence_ids for r in licences.licence_report(df).collect()}
    assert [out[i] for i in range(len(rows))] == ["4", "4", "", "", "4 14", "5", "", "", ""]
    assert licences.scan_licences(df, sentences=()).selectExpr("max(size(sentence_ids))").first()[0] == 0


MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
AGPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published
by the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
ONE_LINE = [("Licensed under the MIT license.", "mit"), ("# SPDX-License-Identifier: MIT\nimport os", "mit"), ("This is released under the MIT License.", "mit"),
            ("Mozilla Public License Version 2.0", "mpl-2.0"), ("// SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2.0-or-later"),
            ("This project is licensed under the BSD 3-Clause License.", "bsd-3-clause"), ("Distributed under the\nApache License, Version 2.0.", "apache-2.0")]


def test_more_licences(spark, tmp_path):
    """Further texts, tags and one-line forms; sentences that a rule does not name may stand in between. The twin agrees."""
    parted = MIT.replace("subject to the following conditions:\n", "subject to the following conditions:\n\nAll rights reserved.\n")
    cases = [*LICENCE_TEXTS, *LICENCE_TITLES, (MPL, "mpl-2.0"), (ISC, "isc"), (LGPL, "lgpl-2.1-or-later"), (AGPL, "agpl-3.0-or-later"), *ONE_LINE,
             (parted, "mit-text all-rights-reserved"), ("MIT license", ""), ("SPDX-License-Identifier: mit or else", ""), (None, ""),
             ("this\nall\nlicensed", ""), ("Z X Zx", "")]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.licences for r in licences.licence_report(df).collect()}
    assert {i: (got[i], want) for i, (_, want) in enumerate(cases) if got[i] != want} == {}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare(con, licences.licence_report(df), licences.LICENCE_SQL) is None
