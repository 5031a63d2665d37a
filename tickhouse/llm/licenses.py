"""License scan: MinHash bands over text windows retrieve templates, exact containment verifies.

DataFrame functions only. Words are lower-cased runs of letters and digits, shingles are five words.
A template of ``n`` words belongs to the scale ``s``, the first of a geometric series that is at
least ``n``. Texts are cut into windows of ``2 s`` words every ``s`` words, so any stretch as long
as the template lies within one. A window that holds 0.8 of a template's shingles then has a Jaccard
similarity of at least ``0.8 t / (w + 0.2 t)`` with it (``t`` and ``w`` shingles); bands of one row
collide with that probability each, and ``miss`` gives the chance that none of ``BANDS`` does: below
1e-4 for templates of five words, and vanishing for longer ones. A match is a window whose
containment, counted on the shingles themselves, is at least 0.8.

Texts and windows that hold none of a template's anchors are passed over without hashing. This loses
nothing: anchors are words that more than a fifth of its shingles contain, so a match has one.

Null and empty texts match nothing; repeated rows are scanned each for themselves; an empty table
gives an empty result; further columns are ignored. Templates are a list given by the caller (of
at least five words each), which bounds everything that is broadcast.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.functions.lets import once
from tickhouse.llm.common import numbered, saved

SHINGLE = 5
BANDS = 64
# The usual notices, file headers and whole texts of common licenses, word for word.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
                 "software and associated documentation files (the \"Software\"), to deal in the "
                 "Software without restriction."),
    ("BSD-text", "Redistribution and use in source and binary forms, with or without modification, "
                 "are permitted provided that the following conditions are met."),
    ("MIT-whole", """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC-whole", """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
    ("BSD-2-Clause-whole", """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Apache-2.0-header", """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""),
    ("GPL-header", """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>."""),
    ("LGPL-header", """
This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later
version.
This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more
details."""),
    ("MPL-2.0-header", """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("Unlicense-whole", """
This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
)


def scale(n: int) -> int:
    size = SHINGLE
    while size < n:
        size = max(size + 1, size * 5 // 4)
    return size


def miss(n: int, bands: int = BANDS) -> float:
    """The chance that no band of a template of ``n`` words meets a window that holds 0.8 of it."""
    t, w = n - SHINGLE + 1, 2 * scale(n) - SHINGLE + 1
    common = -(-8 * t // 10)
    return (1 - common / (w + t - common)) ** bands


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def anchors(words: list[str]) -> list[str]:
    """Longest words first, until more than a fifth of the shingles contain one."""
    shingles = [words[i:i + SHINGLE] for i in range(len(words) - SHINGLE + 1)]
    chosen: list[str] = []
    for word in sorted(set(words), key=lambda w: (-len(w), w)):
        if 5 * sum(any(a in s for a in chosen) for s in shingles) > len(shingles):
            break
        chosen.append(word)
    return chosen


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles_of(words: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(words) - SHINGLE + 1),
                       lambda i: F.array_join(F.slice(words, i, SHINGLE), " "))


def signature(shingles: Column, bands: int) -> Column:
    return once(F.transform(shingles, lambda s: F.xxhash64(s)), lambda hashes: F.transform(
        F.sequence(F.lit(1), F.lit(bands)),
        lambda band: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, band)))))


def template_table(spark: SparkSession, templates, bands: int) -> DataFrame:
    rows = []
    for name, text in templates:
        words = template_words(text)
        if len(words) < SHINGLE:
            raise ValueError(f"template {name} has fewer than {SHINGLE} words")
        rows.append((name, scale(len(words)), words))
    table = spark.createDataFrame(rows, "license_id string, scale int, words array<string>")
    own = F.array_distinct(shingles_of(F.col("words")))
    return table.select("license_id", "scale", own.alias("shingles")).withColumn(
        "signature", signature(F.col("shingles"), bands))


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES,
    bands: int = BANDS,
) -> DataFrame:
    """Per document and license: containment, matching windows, first matching word."""
    spark = docs.sparkSession
    rows = numbered(docs, doc_id=id_col, text=text_col)
    marks = sorted({a for _, text in templates for a in anchors(template_words(text))})
    scales = sorted({scale(len(template_words(text))) for _, text in templates})
    known = F.array(*[F.lit(m) for m in marks])
    texts = rows.where(F.lower("text").rlike("|".join(marks))).select(
        "rid", "doc_id", words_of(F.col("text")).alias("words")).where(F.size("words") >= SHINGLE)
    each = texts.select("*", F.explode(F.array(*[F.lit(s) for s in scales])).alias("scale")).select(
        "*", F.explode(F.sequence(F.lit(0), F.size("words") - SHINGLE, F.col("scale"))).alias("start"))
    windows = each.select(
        "rid", "doc_id", "scale", "start",
        F.slice("words", F.col("start") + 1, 2 * F.col("scale")).alias("words"),
    ).where((F.size("words") >= SHINGLE) & F.arrays_overlap("words", known)).select(
        "rid", "doc_id", "scale", "start", shingles_of(F.col("words")).alias("found"))
    windows = saved(windows.withColumn("signature", signature(F.col("found"), bands)))
    table = template_table(spark, templates, bands)
    bands_of = lambda t, *names: t.select(
        *names, F.posexplode("signature").alias("band", "value"))
    met = bands_of(windows, "rid", "scale", "start").join(
        F.broadcast(bands_of(table, "license_id", "scale")), ["scale", "band", "value"]
    ).select("rid", "scale", "start", "license_id").distinct()
    pairs = windows.drop("signature").join(met, ["rid", "scale", "start"]).join(
        F.broadcast(table.drop("signature", "scale")), "license_id")
    common = F.size(F.array_intersect("shingles", "found"))
    at = F.array_position(F.transform("found", lambda s: F.array_contains("shingles", s)), True)
    verified = pairs.select(
        "rid", "doc_id", "license_id", common.alias("common"), F.size("shingles").alias("total"),
        (F.col("start") + at - 1).cast("long").alias("word"),
    ).where("10 * common >= 8 * total")
    return verified.groupBy("rid", "doc_id", "license_id").agg(
        F.max(F.col("common") / F.col("total")).alias("containment"),
        F.count(F.lit(1)).alias("n_windows"), F.min("word").alias("first_word"),
    ).drop("rid")


def oracle(templates=TEMPLATES) -> str:
    """The same in DuckDB's SQL, without bands: every window against every template."""
    rows = ", ".join(
        f"('{name}', {scale(len(words))}, {words!r})"
        for name, words in ((name, template_words(text)) for name, text in templates))
    return f"""
WITH t AS (SELECT name, scale, w FROM (VALUES {rows}) AS v(name, scale, w)),
ts AS (SELECT DISTINCT name, scale, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM t)),
n AS (SELECT name, scale, count(*) AS total FROM ts GROUP BY name, scale),
d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents),
p AS (SELECT r, doc_id, i - 1 AS pos, array_to_string(w[i:i + 4], ' ') AS s, len(w) AS n
      FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM d)),
h AS (SELECT r, doc_id, name, scale, pos, s, n FROM p JOIN ts USING (s)),
x AS (SELECT *, k * scale AS start FROM (
        SELECT *, unnest([pos // scale, pos // scale - 1]) AS k FROM h)
      WHERE k >= 0 AND pos + 5 <= k * scale + 2 * scale),
m AS (SELECT r, doc_id, name, scale, start, count(DISTINCT s) AS common, min(pos) AS word
      FROM x GROUP BY r, doc_id, name, scale, start)
SELECT doc_id, name AS license_id, max(common / total) AS containment, count(*) AS n_windows,
       min(word)::BIGINT AS first_word
FROM m JOIN n USING (name, scale) WHERE 10 * common >= 8 * total GROUP BY r, doc_id, name
"""
