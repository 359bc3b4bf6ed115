"""Licence scan by canonical digest lookup, in DataFrame operations only.

A text is made canonical: lower case, equivalent spellings made one, lines that only claim copyright
taken out, everything but letters and digits turned into single spaces. Its SHA-256 is looked up by a
hash join among the digests of known licences; whole texts are compared, and also each line that
speaks of rights or licences, so that one-line notices are found within longer documents.

Defined results: null is treated as the empty text; a text whose canonical form is empty has no
licence. Documents without a find stay, with null ``license_id`` and empty ``notices``. Repeated rows
stay repeated; an empty table gives no rows. If two known texts share a canonical form, the first name counts. Other columns of the
input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Equivalent spellings, as the public matching guidelines for licence texts list them.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"), ("authorisation", "authorization"),
    ("authorise", "authorize"), ("calibre", "caliber"), ("cancelled", "canceled"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("emphasised", "emphasized"), ("favour", "favor"), ("fulfil ", "fulfill "), ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"),
    ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"), ("maximise", "maximize"), ("modelled", "modeled"), ("modelling", "modeling"),
    ("noncommercial", "non commercial"), ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"),
    ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("sub license", "sublicense"), ("utilisation", "utilization"),
    ("whilst", "while"), ("wilful", "willful"),
]
#: A line that only claims copyright: the word or sign with a year or another sign, or nothing but the reservation, so that no line
#: of running text is taken for one, however it is wrapped. The same pattern serves Java, RE2 and Python.
COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*(?:©[^\n]*|copyright[^a-z0-9\n]*(?:\(c\)|©|by\b)[^\n]*|(?:copyright|\(c\))[^\n]*\b(?:19|20)[0-9][0-9]\b[^\n]*|all rights reserved[^a-z0-9\n]*)$"
NOT_WORD = r"[^\p{L}\p{N}]+"
#: Lines worth a lookup; it only spares work, as every known notice matches it.
NOTICE_HINT = r"(?i)licen[cs]e|rights reserved|public domain|copyright"

#: Known texts of licences, and one-line notices.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
GPL3_HEADER = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
KNOWN = [
    ("Apache-2.0-header", APACHE_HEADER), ("BSD-2-Clause", BSD_HEAD + BSD_TAIL), ("BSD-3-Clause", BSD_HEAD + BSD_NAMES + BSD_TAIL), ("GPL-3.0-or-later-header", GPL3_HEADER), ("ISC", ISC),
    ("ISC", "ISC License\n\n" + ISC), ("MIT", MIT), ("MIT", "MIT License\n\n" + MIT), ("MIT", "The MIT License (MIT)\n\n" + MIT), ("Zlib", ZLIB), ("Zlib", "zlib License\n\n" + ZLIB),
]
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("LicenseRef-all-rights-reserved", "All rights reserved."), ("MIT", "Released under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("LicenseRef-public-domain", "This work is in the public domain."),
]


def canonical(text: Column, drop_copyright: bool = True) -> Column:
    """The canonical form; lines that claim copyright are kept only if they are what is looked up."""
    t = F.lower(text)
    if drop_copyright:
        t = F.regexp_replace(t, COPYRIGHT_LINE, " ")
    t = F.concat(F.lit(" "), F.regexp_replace(t, NOT_WORD, " "), F.lit(" "))
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.trim(t)


def digest(text: Column, drop_copyright: bool = True) -> Column:
    """SHA-256 of the canonical form; null if that is empty."""
    return F.nullif(F.sha2(canonical(text, drop_copyright), 256), F.lit("e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"))


def known_digests(spark: SparkSession, known: list[tuple[str, str]], drop_copyright: bool = True) -> DataFrame:
    """(digest, license_id): one row for each canonical form."""
    rows = spark.createDataFrame(known, "license_id string, text string")
    return rows.select(digest(F.col("text"), drop_copyright).alias("digest"), "license_id").where("digest IS NOT NULL").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame | None = None, notices: list[tuple[str, str]] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, license_id, notices array<string>) for each row of docs.

    known: (digest, license_id), by default of the built-in texts; Spark broadcasts it if its size
    allows, else both sides are dealt out by digest. notices: one-line texts, as many as the caller's list has; their
    digests become a constant of the plan, so finding them moves no rows (long lists belong in known).
    """
    spark = docs.sparkSession
    known = known_digests(spark, KNOWN) if known is None else known
    named = [(r["digest"], r["license_id"]) for r in known_digests(spark, notices, False).collect()] if notices else []
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(NOTICE_HINT))
    found = F.array().cast("array<string>")
    if named:
        names = F.create_map(*(F.lit(x) for pair in sorted(named) for x in pair))
        found = F.array_sort(F.array_distinct(F.filter(F.transform(lines, lambda x: F.try_element_at(names, digest(x, False))), lambda x: x.isNotNull())))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    read = rows.select("id", digest(F.col("text")).alias("digest"), found.alias("notices"))
    return read.join(known.select("digest", "license_id"), "digest", "left").select("id", "digest", "license_id", "notices").withColumnRenamed("id", id_col)


def oracle(known: list[tuple[str, str]] = KNOWN, notices: list[tuple[str, str]] = NOTICES) -> str:
    """SQL for the rows of scan() over documents, notices joined by commas."""

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def canon(x: str, drop: bool) -> str:
        t = f"lower({x})"
        if drop:
            t = f"regexp_replace({t}, {quoted(COPYRIGHT_LINE)}, ' ', 'g')"
        t = f"concat(' ', regexp_replace({t}, {quoted(NOT_WORD)}, ' ', 'g'), ' ')"
        for a, b in SPELLINGS:
            t = f"replace({t}, {quoted(a)}, {quoted(b)})"
        return f"trim({t})"

    def values(rows):
        return ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in rows)

    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
    known AS (SELECT c, min(name) AS name FROM (SELECT name, {canon("t", True)} AS c FROM (VALUES {values(known)}) v(name, t)) GROUP BY c),
    notice AS (SELECT c, min(name) AS name FROM (SELECT name, {canon("t", False)} AS c FROM (VALUES {values(notices)}) v(name, t)) GROUP BY c),
    line AS (SELECT rid, {canon("l", False)} AS c FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, {quoted(NOTICE_HINT)})),
    per AS (SELECT rid, string_agg(DISTINCT name, ',' ORDER BY name) AS notices FROM line JOIN notice USING (c) GROUP BY rid),
    whole AS (SELECT rid, doc_id, {canon("t", True)} AS c FROM d)
    SELECT doc_id, CASE WHEN c <> '' THEN sha256(c) END AS digest, name AS license_id, coalesce(notices, '') AS notices
    FROM whole LEFT JOIN known USING (c) LEFT JOIN per USING (rid)"""
