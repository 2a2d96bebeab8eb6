"""Licence scans by canonical digest: DataFrame functions only.

A text is brought to a canonical form: lines that state a copyright go, letters become lower-case, equivalent spellings
become one, and what is neither letter nor digit becomes one space. Lines that only reserve all rights go too, and so does a
title such as "The MIT License (MIT)" where the text begins with it, unless nothing else is there. The SHA-256 of the form is looked up among the
digests of known licences and licence notices by a hash join. That is done for each whole text and for each line of it,
since notices stand alone in a line.

Known are the notices below for every licence in ``NAMES``, and the full texts in ``licence_texts.jsonl``. AGPL-3.0,
CC-BY-4.0, CC-BY-NC-4.0 and CC-BY-ND-4.0 have no full text there: they are found by their notices only.

Known texts are few; their table is broadcast after its size is checked. Each document's matches are counted in the task
that read it, so one row per document is shuffled, without its text.

Defined results: a null text has no digest and no licence; an empty text, and a line without letters or digits, match
nothing. Texts of any length are read whole. Every row gets its own result, also when rows or ids repeat. Only the
two columns named are read, so other columns do not matter; an empty table gives an empty result.
"""

import json
import pkgutil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm.common import col
from corpusprep.work import broadcast_if_small

#: Spellings that mean the same in a licence, as patterns over canonical text, and the one that is used.
SPELLINGS = (
    ("\\b(sub ?|re ?)?licenc(e|es|ed|ing|er|ers|or|ors)\\b", "$1licens$2"),
    ("\\b(sub|non|re) (licens|infring|commercial)", "$1$2"),
    ("\\b(organ|recogn|author|modern|util|custom|real)is(e|es|ed|ing|ation|ations)\\b", "$1iz$2"),
    ("\\b(fav|hon|col|lab)our(s|ed|able)?\\b", "$1or$2"),
    ("\\backnowledgement(s?)\\b", "acknowledgment$1"),
    ("\\bcopyright (owner|holder)(s?)\\b", "copyright owner$2"),
    ("\\b(version|v) ?(\\d)", "v$2"),
    ("\\b(\\d) 0\\b", "$1"),
    ("\\bhttps? ", "http "),
)
#: One of the words that the patterns above can change; most lines have none.
MAY_CHANGE = (
    "licenc|sub licens|re licens|non infring|non commercial|is(e|es|ed|ing|ation|ations)\\b|our(s|ed|able)?\\b|"
    "acknowledgement|copyright holder|copyright owner|version|\\bv ?\\d|\\d 0\\b|http"
)
#: Canonical lines that a licence may have or not. A title counts as such only where the text begins.
RIGHTS_LINE = "all rights reserved"
TITLE_LINE = (
    "^((the )?(mit|mit x11|expat|isc|(new |simplified |modified )?bsd( [23] clause)?|[23] clause bsd) )?license( mit| isc)?$"
)
COPYRIGHT_LINE = "^[^\\p{L}\\p{N}]*(copyright|\\(c\\)|©)"
NOT_WORD = "[^\\p{L}\\p{N}]+"

#: Names of licences in running text.
NAMES = {
    "Apache-2.0": ("the Apache License, Version 2.0", "the Apache 2.0 License", "Apache-2.0"),
    "MIT": ("the MIT License", "MIT"),
    "BSD-2-Clause": ("the BSD 2-Clause License", "the Simplified BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("the BSD 3-Clause License", "the New BSD License", "BSD-3-Clause"),
    "ISC": ("the ISC License", "ISC"),
    "MPL-2.0": ("the Mozilla Public License, v. 2.0", "the Mozilla Public License 2.0", "MPL-2.0"),
    "GPL-2.0": ("the GNU General Public License, version 2", "the GNU GPL v2", "GPL-2.0"),
    "GPL-3.0": ("the GNU General Public License, version 3", "the GNU GPL v3", "GPL-3.0"),
    "LGPL-3.0": ("the GNU Lesser General Public License, version 3", "LGPL-3.0"),
    "AGPL-3.0": ("the GNU Affero General Public License, version 3", "AGPL-3.0"),
    "CC0-1.0": ("CC0 1.0", "CC0-1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "a Creative Commons Attribution-NoDerivatives 4.0 International License"),
}
NOTICES = (
    "Licensed under {}.",
    "Released under {}.",
    "Distributed under {}.",
    "This work is licensed under {}.",
    "This project is licensed under {}.",
    "SPDX-License-Identifier: {}",
    "License: {}",
)
#: Whole texts of short licences and of notices; full texts of others are in FULL_TEXTS.
TEXTS = {
    "MIT": """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}


FULL_TEXTS = "licence_texts.jsonl"


def full_texts() -> list[tuple[str, str]]:
    """(licence, text) of the data file; a licence has several when it is published in several forms."""
    rows = map(json.loads, pkgutil.get_data(__package__, FULL_TEXTS).decode().rstrip("\n").split("\n"))
    return [(row["licence"], row["text"]) for row in rows]


def known_texts(spark: SparkSession) -> DataFrame:
    """(licence, text): the licences and notices that this package knows. Users may add rows of their own."""
    rows = [*TEXTS.items(), *full_texts()]
    rows += [(licence, form.format(name)) for licence, names in NAMES.items() for name in names for form in NOTICES]
    return spark.createDataFrame(rows, "licence string, text string")


def canonical_line(line: Column) -> Column:
    """The canonical form of a text without line breaks; null for a line that states a copyright."""
    lower = F.lower(line)
    plain = F.trim(F.regexp_replace(lower, NOT_WORD, " "))
    changed = plain
    for pattern, spelling in SPELLINGS:
        changed = F.regexp_replace(changed, pattern, spelling)
    form = F.when(plain.rlike(MAY_CHANGE), changed).otherwise(plain)
    return F.when(~lower.rlike(COPYRIGHT_LINE), form)


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text, without the empty ones; null if the text is."""
    lines = F.transform(F.split(text, "\n"), canonical_line)
    return F.filter(lines, lambda line: line != "")


def whole_form(lines: Column) -> Column:
    """The canonical form of a text from its canonical lines, without the title line and lines that reserve rights."""
    lines = F.filter(lines, lambda line: line != RIGHTS_LINE)
    titled = (F.size(lines) > 1) & F.coalesce(F.get(lines, F.lit(0)).rlike(TITLE_LINE), F.lit(False))
    return F.array_join(F.when(titled, F.slice(lines, F.lit(2), F.size(lines) - 1)).otherwise(lines), " ")


def digest(form: Column) -> Column:
    """The digest of a canonical form; null for an empty one."""
    return F.when(form != "", F.sha2(form, 256))


def known_digests(known: DataFrame) -> DataFrame:
    """(digest, licence) for a table of known texts (licence, text); of equal digests the licence that sorts first."""
    digests = known.select(digest(whole_form(canonical_lines(F.col("text")))).alias("digest"), "licence")
    return digests.dropna().groupBy("digest").agg(F.min("licence").alias("licence"))


def scan(
    docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: the id, ``text_digest`` of its canonical form, ``licence`` that the whole text is,
    ``n_licence_lines``, and ``licences``, the sorted names of all that were found, joined by commas ('' for none)."""
    spark = docs.sparkSession
    table = broadcast_if_small(known_digests(known_texts(spark) if known is None else known))
    lines = docs.select(
        F.monotonically_increasing_id().alias("row"),
        col(id_col).alias("id"),
        canonical_lines(col(text_col)).alias("lines"),
    )
    units = lines.select(
        "row",
        "id",
        F.posexplode(
            F.concat(
                F.array(digest(whole_form(F.col("lines")))),
                F.transform(F.coalesce("lines", F.array().cast("array<string>")), digest),
            )
        ).alias("pos", "digest"),
    )
    found = units.join(table, "digest", "left")
    whole, line = F.col("pos") == 0, F.col("pos") > 0
    per_row = found.groupBy("row").agg(
        F.max("id").alias(id_col),
        F.max(F.when(whole, F.col("digest"))).alias("text_digest"),
        F.max(F.when(whole, F.col("licence"))).alias("licence"),
        F.count(F.when(line, F.col("licence"))).alias("n_licence_lines"),
        F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("licences"),
    )
    return per_row.drop("row")
