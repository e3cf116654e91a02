"""Licence scan: Dice coefficient over word bigrams, in SQL functions only.

Lines, sentences, paragraphs and whole texts are normalised to lower-case words and compared with
licence templates. A Dice coefficient of ``t`` needs a number of bigrams between
``t / (2 - t)`` and ``(2 - t) / t`` times the template's, so few templates are compared.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import plain_columns

# Names and public wording of licences and of their usual notices.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": (
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of the "
        "GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        'in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License.",
    ),
    "BSD-2-Clause": (
        "Released under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
        "in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
        "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
        "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
        "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
        "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the "
        "LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
        "in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
        "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
        "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
        "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
        "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file "
        "LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and "
        "neighboring rights to this software to the public domain worldwide. This software is distributed "
        "without any warranty. You should have received a copy of the CC0 Public Domain Dedication along "
        "with this software. If not, see <http://creativecommons.org/publicdomain/zero/1.0/>.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or (at your option) any later version. This program is distributed in the hope that it "
        "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY "
        "or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You "
        "should have received a copy of the GNU General Public License along with this program; if not, "
        "write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA "
        "02110-1301 USA.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the "
        "GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
        "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    "LGPL-3.0": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version. This library is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the "
        "GNU Lesser General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
        "modify, publish, use, compile, sell, or distribute this software, either in source code form or "
        "as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the "
        "authors be held liable for any damages arising from the use of this software. Permission is "
        "granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this "
        "software must not be misrepresented; you must not claim that you wrote the original software. If "
        "you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required. 2. Altered source versions must be plainly marked as such, and "
        "must not be misrepresented as being the original software. 3. This notice may not be removed or "
        "altered from any source distribution.",
    ),
}

# Words that are poor evidence of a licence, because they are frequent anywhere.
COMMON_WORDS = frozenset(
    "a an and any are as at be by can for from if in into is it may more not of on one or that the "
    "this to under use was with you your".split()
)


# A line that holds no more than comment marks ends a paragraph.
PARAGRAPH_END = "\n[ \t\r*#/;%-]*\n"
# What ends a sentence within a line, with the blanks that follow.
SENTENCE_END = "([.!?;:])[ \t]+"


def template_words(text: str) -> list[str]:
    return "".join(c.lower() if c.isascii() and c.isalnum() else " " for c in text).split()


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def normalized(text: Column) -> Column:
    """ASCII letters and digits in lower case, everything else one space."""
    return F.trim(F.lower(F.regexp_replace(text, "[^A-Za-z0-9]+", " ")))


def witness_words(grams: list[str], threshold: float, chosen: set[str]) -> set[str]:
    """Words of which every text that reaches the threshold has at least one.

    A match holds at least ``t / (2 - t)`` of the template's bigrams; words that cover
    more bigrams than it may lack therefore cannot all be missing. Returns ``chosen``,
    the words of other templates, with the words this one needs besides; rare and long
    words first.
    """
    low, _ = _bounds(len(grams), threshold)
    missing = len(grams) - low  # a match shares at least as many as the smallest match has
    chosen = set(chosen)
    left = [pair for pair in (gram.split(" ") for gram in grams) if not chosen & set(pair)]
    while len(grams) - len(left) <= missing:
        weights: dict[str, int] = {}
        for gram in left:
            for word in set(gram):
                weight = 1 if word in COMMON_WORDS or word.isdigit() else 100 * len(word)
                weights[word] = weights.get(word, 0) + weight
        best = max(sorted(weights), key=lambda word: weights[word])
        chosen.add(best)
        left = [gram for gram in left if best not in gram]
    return chosen


def _bounds(size: int, threshold: float) -> tuple[int, int]:
    """The smallest and largest number of bigrams that can reach the threshold."""
    fits = [
        n for n in range(1, int(size * 2 / threshold) + 2) if 2.0 * min(n, size) / (n + size) >= threshold
    ]
    return fits[0], fits[-1]


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
    threshold: float = 0.8,
) -> DataFrame:
    """One row per unit of a text that matches a template at ``threshold`` or more.

    A unit is a line, a sentence of a line with several, a paragraph of several lines or
    the whole text where it has several paragraphs. A paragraph ends at a line without a letter or digit but
    for comment marks. Returns the id column, ``unit``, ``position`` (number of the unit, from 0), ``license``,
    ``template`` (its number within the licence), ``n_bigrams``, ``dice`` and ``best``
    (no other template matches this unit better; ties go by licence name and number).

    Every text is read whole, in one pass without a shuffle. Null and empty texts match
    nothing; repeated rows and equal ids each give rows of their own; a null id is kept.
    Templates are a fixed list and travel in the plan.
    """
    listed = []
    witnesses: set[str] = set()
    low_all, high_all = 1 << 30, 0
    for name, texts in sorted(templates.items()):
        for number, text in enumerate(texts):
            grams = template_bigrams(text)
            if not grams:
                raise ValueError(f"template {number} of {name} has fewer than two words")
            low, high = _bounds(len(grams), threshold)
            low_all, high_all = min(low_all, low), max(high_all, high)
            witnesses = witness_words(grams, threshold, witnesses)
            listed.append(
                F.struct(
                    F.lit(name).alias("license"),
                    F.lit(number).alias("template"),
                    F.lit(low).alias("low"),
                    F.lit(high).alias("high"),
                    F.array(*map(F.lit, grams)).alias("grams"),
                )
            )
    if not listed:
        raise ValueError("no templates")
    def may_match(lowered: Column) -> Column:
        return F.exists(F.array(*map(F.lit, sorted(witnesses))), lambda w: F.contains(lowered, w))

    candidates = (
        plain_columns(docs, id=id_col, text=text_col)
        .select("id", *_once(text=F.col("text"), lowered=F.lower("text")))
        .filter(may_match(F.col("lowered")))
    )
    units = (
        candidates.select("id", F.inline(_units(F.col("text"))))
        .select("id", "unit", *_once(position=F.col("position"), part=F.col("part"), lowered=F.lower("part")))
        .filter(may_match(F.col("lowered")))
    )
    # a part of w words has at most w - 1 bigrams, and repeats only make them fewer
    words = units.select(
        "id", "unit", "position", *_once(words=F.split(normalized(F.col("part")), " "))
    ).filter(F.size("words") > low_all)
    grams = words.select(
        "id", "unit", "position", *_once(g=F.array_distinct(_bigrams(F.col("words"))))
    ).filter(F.size("g").between(low_all, high_all))
    fitting = F.filter(
        F.array(*listed), lambda t: (F.size("g") >= t["low"]) & (F.size("g") <= t["high"])
    )
    scored = F.transform(
        fitting,
        lambda t: F.struct(
            (
                F.lit(2.0)
                * F.size(F.array_intersect(F.col("g"), t["grams"]))
                / (F.size("g") + F.size(t["grams"]))
            ).alias("dice"),
            t["license"].alias("license"),
            t["template"].alias("template"),
        ),
    )
    matched = F.filter(scored, lambda s: s["dice"] >= threshold)
    found = grams.select(
        "id", "unit", "position", *_once(n_bigrams=F.size("g"), matched=matched)
    ).filter(F.size("matched") > 0)
    top = F.array_max(F.transform("matched", lambda s: s["dice"]))
    winner = F.array_min(
        F.transform(
            F.filter("matched", lambda s: s["dice"] == top),
            lambda s: F.struct(s["license"], s["template"]),
        )
    )
    rows = found.withColumn("winner", winner).select(
        "id", "unit", "position", "n_bigrams", "winner", F.inline("matched")
    )
    return rows.select(
        F.col("id").alias(id_col),
        "unit",
        F.col("position").cast("bigint").alias("position"),
        "license",
        "template",
        F.col("n_bigrams").cast("bigint").alias("n_bigrams"),
        "dice",
        (F.struct("license", "template") == F.col("winner")).alias("best"),
    )


def _units(text: Column) -> Column:
    """Lines, their sentences, paragraphs of several lines and the text of several paragraphs."""

    def numbered(parts: Column, kind: str) -> Column:
        return F.transform(
            parts,
            lambda part, i: F.struct(
                F.lit(kind).alias("unit"), i.alias("position"), part.alias("part")
            ),
        )

    lines = F.split(text, "\n")
    sentences = F.flatten(
        F.transform(
            F.filter(lines, lambda line: line.rlike(SENTENCE_END + "[^ \t\r]")),
            lambda line: F.split(F.regexp_replace(line, SENTENCE_END, "$1\n"), "\n"),
        )
    )
    paragraphs = F.split(text, PARAGRAPH_END)
    several = F.filter(
        numbered(paragraphs, "paragraph"), lambda p: F.contains(p["part"], F.lit("\n"))
    )
    whole = F.when(F.size(paragraphs) > 1, F.array(text)).otherwise(
        F.array().cast("array<string>")
    )
    return F.concat(
        numbered(lines, "line"), numbered(sentences, "sentence"), several, numbered(whole, "text")
    )


def _once(**columns: Column) -> list[Column]:
    """The columns by way of a generator, which the optimizer never evaluates twice."""
    return [F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items()))))]


def _bigrams(words: Column) -> Column:
    return F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
