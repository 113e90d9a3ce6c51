"""License scan: canonical digests of whole texts, joined by hash to those of known licences.

A text's canonical form has no copyright lines, no case, no punctuation, one spelling for
words with several, and single spaces. Units that are looked up are the whole text, each of
its lines as an entire text of its own and each run of lines, so a notice or a whole licence
inside a document is found too, wrapped or not. Of a line that starts as a copyright line
the sentences after the first are lines of their own.
"""

from __future__ import annotations

import json
from itertools import product
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The notices and short licences that are known here, by SPDX name.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
]
# Names of licences in notices, and the notices they stand in.
NAMES = [
    ("MIT", "the MIT License", "MIT License", "the MIT License (MIT)", "MIT"),
    ("Apache-2.0", "the Apache License, Version 2.0", "the Apache License 2.0", "Apache License 2.0", "Apache-2.0"),
    ("BSD-2-Clause", "the BSD 2-Clause License", "BSD-2-Clause"),
    ("BSD-3-Clause", "the BSD 3-Clause License", "BSD-3-Clause"),
    ("ISC", "the ISC License", "ISC"),
    ("0BSD", "0BSD"),
    ("GPL-2.0-only", "the GNU General Public License, version 2", "GPL-2.0-only"),
    ("GPL-3.0-only", "the GNU General Public License, version 3", "GPL-3.0-only"),
    ("GPL-2.0-or-later", "GPL-2.0-or-later"),
    ("GPL-3.0-or-later", "GPL-3.0-or-later"),
    ("LGPL-2.1-only", "the GNU Lesser General Public License, version 2.1", "LGPL-2.1-only"),
    ("LGPL-3.0-only", "the GNU Lesser General Public License, version 3", "LGPL-3.0-only"),
    ("MPL-1.1", "the Mozilla Public License, version 1.1", "MPL-1.1"),
    ("MPL-2.0", "the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0", "MPL-2.0"),
    ("CC0-1.0", "CC0 1.0", "CC0 1.0 Universal"),
    *[(f"CC-{c}-4.0", f"CC {c} 4.0", f"the Creative Commons {full} 4.0 International License", f"a Creative Commons {full} 4.0 International License") for c, full in (
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC", "Attribution-NonCommercial"),
        ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))],
]
STANDS_IN = ["Licensed under {}.", "Released under {}.", "Distributed under {}.", *[f"This {x} is {y} under {{}}." for x, y in product(
    ("work", "software", "project", "code", "program", "document", "text", "file"), ("licensed", "released", "distributed"))]]
HEADERS = [
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    *[(f"GPL-{v}.0-or-later", f"""This program is free software{mark} you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version.""")
      for v, mark in ((2, ";"), (3, ":"))],
]
TITLES = {"MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"), "ISC": ("ISC License", "The ISC License"), "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
          "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License"), "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License")}
BSD = ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
       "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
       "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
       "Neither the name of the copyright {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
       """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT {} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""]
# Spellings that count as one.
SPELLINGS = [("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"), ("non commercial", "noncommercial"),
             ("merchantibility", "merchantability"), ("favour", "favor"), ("organisation", "organization"), ("per cent", "percent")]
# Fixed patterns; both engines of the checks know them.
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright\b|\(c\)|©|all rights reserved)[^\n]*$"
NO_LETTER = r"[^\p{L}\p{N}]+"


# A line that starts so has its further sentences looked up apart.
COPYRIGHT_START = r"(?i)^[ \t]*(copyright\b|\(c\)|©|all rights reserved)"
SENTENCE_END = r"(?<=[.;])[ \t]+"


def known_texts() -> list[tuple[str, str]]:
    """(licence, text): KNOWN, the whole texts in known_licences, BSD and their titles, headers and notices."""
    whole = [(f.stem, f.read_text(encoding="utf-8")) for f in sorted((Path(__file__).parent / "known_licences").glob("*.txt"))]
    whole = [(k, t.split("\n", 1)[1] if k == "MIT" else t) for k, t in whole]  # its title is among TITLES
    for clauses, marks, who in product((2, 3), (("1.", "2.", "3."), ("", "", "")), ("holder", "owner")):
        items = [f"{m} {t}" for m, t in zip(marks, BSD[1:clauses + 1])]
        whole.append((f"BSD-{clauses}-Clause", "\n".join([BSD[0], *items, BSD[-1]]).replace("{}", who)))
    whole += [x for x in KNOWN if x[0] in ("ISC", "0BSD")]
    titled = [(k, f"{title}\n{t}") for k, t in whole for title in TITLES.get(k, ())]
    notices = [(k, form.format(name)) for k, *names in NAMES for form in STANDS_IN for name in names]
    notices += [(k, f"SPDX-License-Identifier: {k}") for k, *_ in NAMES]
    return list(dict.fromkeys([*KNOWN, *whole, *titled, *HEADERS, *notices]))


def canonical(text: Column) -> Column:
    """Null counts as empty."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    return _spelled(F.btrim(F.regexp_replace(out, NO_LETTER, " ")))


def _spelled(words: Column) -> Column:
    out = F.concat(F.lit(" "), words, F.lit(" "))
    for spelled, as_ in SPELLINGS:
        out = F.replace(out, F.lit(f" {spelled} "), F.lit(f" {as_} "))
    return F.btrim(out)


def canonical_digest(text: Column) -> Column:
    return F.md5(canonical(text))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, licence, first, letters), one licence per digest: the first in code point order; known_texts() if none are given.

    first: the first word, letters: the number of characters without spaces; they tell which runs of lines can be the text.
    """
    texts = spark.createDataFrame(known_texts() if known is None else known, "licence string, text string").select("licence", canonical(F.col("text")).alias("text"))
    return texts.groupBy(F.md5("text").alias("digest")).agg(
        F.min("licence").alias("licence"), F.min(F.substring_index("text", " ", 1)).alias("first"), F.min(F.length(F.replace("text", F.lit(" "), F.lit("")))).alias("letters"))


def _let(value: Column, use) -> Column:
    """use(value) with value worked out once."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column) -> Column:
    """Sums up to and with each value. Blocks of a root of their number are summed first, so that no long array grows item by item."""
    def in_order(x: Column) -> Column:
        return F.aggregate(x, F.array().cast("array<long>"), lambda acc, v: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + v)))

    width = F.greatest(F.ceil(F.sqrt(F.size(values))), F.lit(1)).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / width).cast("int")), lambda b: in_order(F.slice(values, b * width + 1, width)))
    before = lambda sums: in_order(F.transform(sums, lambda x: F.element_at(x, -1)))
    placed = lambda sums: _let(before(sums), lambda ends: F.flatten(F.transform(
        sums, lambda x, b: F.transform(x, lambda v: v + F.when(b == 0, F.lit(0)).otherwise(F.get(ends, b - 1))))))
    return _let(blocks, placed)


def _runs(texts: Column, lengths: Column) -> Column:
    """Digests of the runs of two and more lines that begin with a known text's first word and have as many letters; texts: canonical lines, none empty.

    Letters do not depend on where words are split, so a run is found by a sum. Sums grow by the
    letters of the shortest line at least, so a text of n letters can end in so many lines only: the work
    grows with the lines, not with their square.
    """
    letters = F.transform(texts, lambda t: F.length(F.replace(t, F.lit(" "), F.lit(""))).cast("long"))

    def ends(e: Column, least: Column) -> Column:
        def at(t: Column, i: Column) -> Column:
            before = F.when(i == 0, F.lit(0)).otherwise(F.get(e, i - 1))

            def found(of: Column) -> Column:
                near = F.slice(e, i + 1, (F.floor(F.array_max(of) / least) + 1).cast("int"))
                return _let(near, lambda x: F.transform(F.array_intersect(x, F.transform(of, lambda n: before + n)), lambda v: F.array_position(x, v).cast("int")))

            of = F.element_at(lengths, F.substring_index(t, " ", 1))
            counts = F.when(of.isNotNull(), _let(of, found)).otherwise(F.array().cast("array<int>"))  # of lines in each run
            return F.transform(F.filter(counts, lambda k: k > 1), lambda k: F.md5(_spelled(F.array_join(F.slice(texts, i + 1, k), " "))))

        return F.flatten(F.transform(texts, at))

    begins = F.exists(texts, lambda t: F.element_at(lengths, F.substring_index(t, " ", 1)).isNotNull())
    runs = _let(letters, lambda n: _let(F.array_min(n), lambda least: _let(_running(n), lambda e: ends(e, least))))
    return F.when(begins & (F.size(texts) > 1), runs).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, known: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, licence, notices, n_notices), a row per row of docs.

    digest: of the whole canonical text; licence: the known one it is, else null. notices:
    the different licences that lines and runs of lines are, in code point order, joined by
    commas (empty without any); n_notices: how many lines and runs (a licence under its title
    is one run with and one without it; a run that is the whole text counts as ``licence`` only). Null and empty texts have the digest of the
    empty text and find nothing, as do lines without a letter or digit. Rows with equal text
    find the same, so repeated rows and null ids are no matter; other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    empty = F.md5(F.lit(""))
    parts = F.flatten(F.transform(F.split("text", "\n"), lambda x: F.when(x.rlike(COPYRIGHT_START), F.split(x, SENTENCE_END)).otherwise(F.array(x))))
    # a row per first word of the known texts
    firsts = known.where("first <> ''").groupBy("first").agg(F.sort_array(F.collect_set("letters")).alias("letters")).orderBy("first").collect()
    lengths = F.from_json(F.lit(json.dumps({r[0]: r[1] for r in firsts})), "map<string,array<bigint>>")
    runs = lambda t: _let(canonical_digest(F.col("text")), lambda whole: F.filter(_runs(t, lengths), lambda d: d != whole))  # noqa: E731  the whole text is digested once
    lines = _let(F.filter(F.transform(parts, canonical), lambda t: t != ""), lambda t: F.concat(F.transform(t, F.md5), runs(t)))
    wholes = known.select(F.col("digest").alias("of"), "licence").where(F.col("of") != empty)
    # equal texts find the same: what is found is kept once per text and joined back by the text's own digest
    units = rows.select(F.monotonically_increasing_id().alias("row"), F.md5("text").alias("raw"), lines.alias("lines")).select("row", "raw", F.explode("lines").alias("of"))
    found = units.join(wholes, "of").groupBy("row", "raw").agg(
        F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("notices"), F.count("*").alias("n_notices"))
    found = found.groupBy("raw").agg(F.min("notices").alias("notices"), F.min("n_notices").alias("n_notices"))
    out = rows.select("doc_id", F.md5("text").alias("raw"), canonical_digest(F.col("text")).alias("digest"))
    out = out.join(found.select("raw", "notices", "n_notices"), "raw", "left")
    out = out.join(wholes, out["digest"] == wholes["of"], "left")
    return out.select("doc_id", "digest", "licence", F.coalesce("notices", F.lit("")).alias("notices"), F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"))
