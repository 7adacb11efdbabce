"""Licence scan (operator 9), in DataFrame functions only.

Lines, paragraphs and whole texts are normalised to words and compared to
licence templates by the Dice coefficient over sets of word bigrams. Two
bounds prune before any bigram is made. Sizes: a coefficient of t needs sizes
within a factor of t / (2 - t). Anchors: such a match holds at least that
share of the template's bigrams, so of a set of words that touches more than
the rest of them it must hold one.

Longer templates are also found as runs of words inside a text, across line
ends and blank lines: a text with enough of a template's bigrams gives the run
in which they lie densest (each adds one, each other bigram takes one), and
that run is compared as a unit. Templates are notices and short licences as
written below, and the complete texts in ``licence_texts``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the two BSD licences share.
_BSD_CONDITIONS = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_DISCLAIMER = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
# Identifiers and the public wording of short licences and of the notices of long ones.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ),
    "ISC": ('Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Distributed under the BSD 3-Clause License.",
        f'{_BSD_CONDITIONS} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. {_BSD_DISCLAIMER}',
    ),
    "BSD-2-Clause": ("Distributed under the BSD 2-Clause License.", f"{_BSD_CONDITIONS} {_BSD_DISCLAIMER}"),
    "Zlib": ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0.",),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to http://unlicense.org/',
    ),
}
#: Complete licences as files: the name of a file is the licence, the older names of the GNU family stand for their versions.
TEXTS = Path(__file__).with_name("licence_texts")
VERSIONS = {"GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-3": "LGPL-3.0"}
THRESHOLD = 0.9
#: Templates with this many bigrams are also looked for as runs of words.
RUN_BIGRAMS = 12


@cache
def catalogue() -> dict[str, tuple[str, ...]]:
    """Licence -> its templates: those above, and the complete texts."""
    out = dict(TEMPLATES)
    for path in sorted(TEXTS.glob("*.txt")):
        name = VERSIONS.get(path.stem, path.stem)
        out[name] = (*out.get(name, ()), path.read_text(encoding="utf-8"))
    return out


def normal_words(text: str) -> list[str]:
    """Lower-case runs of letters and digits."""
    return re.findall(r"[^\W_]+", text.lower())


@dataclass(frozen=True)
class Template:
    number: int
    licence: str
    bigrams: frozenset[str]


def templates(of: dict[str, tuple[str, ...]] | None = None) -> list[Template]:
    texts = [(name, normal_words(t)) for name, ts in (of or catalogue()).items() for t in ts]
    return [Template(i, name, frozenset(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))) for i, (name, w) in enumerate(texts)]


def anchors(known: list[Template], threshold: float) -> set[str]:
    """Words of which every text that matches a template holds at least one: for each template, words that
    touch more of its bigrams than a match may lack, long words first."""
    found: set[str] = set()
    for t in known:
        most, lacking = (1 - threshold / (2 - threshold)) * len(t.bigrams), 0
        left = set(t.bigrams)
        for word in sorted({w for b in t.bigrams for w in b.split()}, key=lambda w: (-len(w), w)):
            if lacking > most + 1e-9:
                break
            touched = {b for b in left if word in b.split()}
            left -= touched
            lacking += len(touched)
            found.add(word)
    return found


def matches(docs: DataFrame, *, threshold: float = THRESHOLD, of: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """doc_id, row_key, unit (line:n, paragraph:n, text:0 or words:from-to), licence and dice of every unit that reaches ``threshold``.

    A unit's best template counts (ties: the first in the list). The templates
    are a fixed list, so the broadcast side is bounded; a hot line or copy
    meets it where it lies, and nothing but matches is shuffled.
    """
    known, spark = templates(of), docs.sparkSession
    low = min(threshold / (2 - threshold) * len(t.bigrams) for t in known)
    high = max((2 - threshold) / threshold * len(t.bigrams) for t in known)
    anchor = F.lit(sorted(anchors(known, threshold)))
    apart = r"[^\p{L}\p{N}]+"
    text = F.lower("text")
    near = docs.where(F.arrays_overlap(F.split(text, apart), anchor)).select("doc_id", F.xxhash64("text").alias("row_key"), text.alias("text"))

    def units(kind: str, parts: Column) -> Column:
        return F.transform(parts, lambda p, i: F.struct(F.concat(F.lit(f"{kind}:"), i).alias("unit"), F.filter(F.split(p, apart), lambda w: w != "").alias("w")))

    lines, paragraphs = F.split("text", "\n"), F.split("text", r"\n[\x20\t\r]*+\n")
    # a paragraph of one line was compared as that line, and a text of one paragraph as that paragraph
    several = F.when(F.size(lines) > 1, units("paragraph", paragraphs)).otherwise(F.array().cast("array<struct<unit:string,w:array<string>>>"))
    whole = F.when(F.size(paragraphs) > 1, units("text", F.array("text"))).otherwise(F.array().cast("array<struct<unit:string,w:array<string>>>"))
    # words are made inside the exploded array: what follows reads them and does not make them again
    each = near.select("doc_id", "row_key", F.inline(F.concat(units("line", lines), several, whole)))
    # sets are no larger than the count of bigrams; the lower bound holds for the count too
    sized = each.where((F.size("w") >= 2) & (F.size("w") - 1 >= low) & F.arrays_overlap("w", anchor))
    pairs = F.array_distinct(F.zip_with(F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w") - 1), lambda x, y: F.concat_ws(" ", x, y)))
    sets = sized.select("doc_id", "row_key", "unit", F.explode(F.array(pairs)).alias("b")).where(F.size("b") <= high).dropDuplicates(["doc_id", "row_key", "unit"])
    listed = spark.createDataFrame([(t.number, t.licence, len(t.bigrams), b) for t in known for b in sorted(t.bigrams)], "number int, licence string, size int, bigram string")
    shared = sets.select("doc_id", "row_key", "unit", F.size("b").alias("n"), F.explode("b").alias("bigram")).join(F.broadcast(listed), "bigram")
    bounded = shared.where((F.col("n") >= threshold / (2 - threshold) * F.col("size")) & (F.col("n") <= (2 - threshold) / threshold * F.col("size")))
    dice = bounded.groupBy("doc_id", "row_key", "unit", "n", "number", "licence", "size").agg(F.count("*").alias("both")).withColumn("dice", 2 * F.col("both") / (F.col("n") + F.col("size"))).where(F.col("dice") >= threshold)
    best = lambda df: df.groupBy("doc_id", "row_key", "unit").agg(F.max_by(F.struct("licence", "dice"), F.struct("dice", -F.col("number"))).alias("best")).select("doc_id", "row_key", "unit", "best.licence", "best.dice")
    whole_units = best(dice)
    long = listed.where(F.col("size") >= RUN_BIGRAMS)
    each_run = near.select("doc_id", "row_key", F.filter(F.split("text", apart), lambda w: w != "").alias("w"))
    found = _runs(each_run, long, threshold)
    # a licence that a line, paragraph or text holds is not told again as a run
    seen = whole_units.select(F.col("doc_id").alias("_doc"), F.col("row_key").alias("_key"), F.col("licence").alias("_licence")).distinct()
    fresh_runs = best(found).join(seen, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("row_key") == F.col("_key")) & (F.col("licence") == F.col("_licence")), "left_anti")
    return whole_units.unionByName(fresh_runs)


def _bigrams(words: Column) -> Column:
    return F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda x, y: F.concat_ws(" ", x, y))


def _runs(texts: DataFrame, listed: DataFrame, threshold: float) -> DataFrame:
    """doc_id, row_key, unit, number, licence and dice of the densest run of each template in each of ``texts`` (doc_id, row_key, w).

    Only texts with as many of a template's bigrams as a match must hold are
    looked at further; positions are those of one text, so their list is
    bounded by it. ``listed`` (number, licence, size, bigram) is fixed.
    """
    least = threshold / (2 - threshold)
    # bigrams are made inside the exploded array: what follows reads them and does not make them again
    hits = texts.where(F.size("w") > RUN_BIGRAMS).select("doc_id", "row_key", F.posexplode(_bigrams(F.col("w"))).alias("at", "bigram")).join(F.broadcast(listed), "bigram")
    places = hits.groupBy("doc_id", "row_key", "number", "licence", "size").agg(F.collect_list("at").alias("at")).where(F.size("at") >= least * F.col("size")).withColumn("at", F.array_sort("at"))
    start = F.struct(*[F.lit(0).alias(n) for n in ("first", "last", "held", "best", "from", "to")])

    def step(s: Column, p: Column) -> Column:
        held = s["held"] + 2 + s["last"] - p  # one more hit, less the bigrams passed over
        fresh = (s["best"] == 0) | (held < 1)
        first, now = F.when(fresh, p).otherwise(s["first"]), F.when(fresh, 1).otherwise(held)
        better = now > s["best"]
        return F.struct(first.cast("int").alias("first"), p.alias("last"), now.cast("int").alias("held"), F.greatest(now, s["best"]).cast("int").alias("best"), F.when(better, first).otherwise(s["from"]).cast("int").alias("from"), F.when(better, p).otherwise(s["to"]).cast("int").alias("to"))

    runs = places.select("doc_id", "row_key", "number", "licence", "size", F.aggregate("at", start, step).alias("r")).select(F.col("doc_id").alias("_doc"), F.col("row_key").alias("_key"), "number", "licence", "size", "r.from", "r.to")
    cut = texts.join(runs, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("row_key") == F.col("_key"))).dropDuplicates(["doc_id", "row_key", "number"])
    sets = cut.select("doc_id", "row_key", "number", "licence", "size", F.concat_ws("-", F.concat(F.lit("words:"), "from"), F.col("to") + 1).alias("unit"), F.array_distinct(_bigrams(F.slice("w", F.col("from") + 1, F.col("to") - F.col("from") + 2))).alias("b"))
    shared = sets.select("doc_id", "row_key", "unit", "number", "licence", "size", F.size("b").alias("n"), F.explode("b").alias("bigram")).join(F.broadcast(listed.select("number", "bigram")), ["number", "bigram"])
    dice = shared.groupBy("doc_id", "row_key", "unit", "n", "number", "licence", "size").agg(F.count("*").alias("both"))
    return dice.withColumn("dice", 2 * F.col("both") / (F.col("n") + F.col("size"))).where(F.col("dice") >= threshold)


def scan(docs: DataFrame, *, threshold: float = THRESHOLD, of: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text): doc_id, licence (its best), dice, licences (all, sorted, ``;`` between), n_units.

    Defined cases: null and empty texts, and texts with no match, have a null
    licence and dice, no licences and 0 units; rows alike are scanned alike
    and each returned; an empty table gives no rows.
    """
    per = matches(docs, threshold=threshold, of=of).groupBy("doc_id", "row_key").agg(F.max_by("licence", F.struct("dice", "licence")).alias("licence"), F.max("dice").alias("dice"), F.array_join(F.array_sort(F.collect_set("licence")), ";").alias("licences"), F.count("*").alias("n_units"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("row_key")).alias("d")
    joined = rows.join(per.alias("m"), F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.row_key") == F.col("m.row_key")), "left")
    return joined.select("d.doc_id", "licence", "dice", F.coalesce("licences", F.lit("")).alias("licences"), F.coalesce("n_units", F.lit(0)).cast("long").alias("n_units"))
