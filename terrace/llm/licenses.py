"""Licence scan: digests of canonical texts, looked up in a table of known licences.

Two texts have one canonical form if they differ only in case, punctuation, white space, copyright
lines and equivalent spellings. The unit that is looked up is an entire text: the whole document,
each of its lines as a text of its own, which finds one-line notices, and each run of lines that begins like a known text
and has as many letters, which finds texts and wrapped notices inside longer documents, with other lines or comment
marks right beside them. Built-in functions only.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.rows import text_of
from terrace.staging import stage

#: Whole licence texts by identifier; after "~" comes the number of another edition of the same text.
TEXTS = Path(__file__).with_name("license_texts")

# Spellings that count as equal, after lower-casing.
SPELLINGS = {
    "licence": "license",
    "licenced": "licensed",
    "licences": "licenses",
    "organisation": "organization",
    "recognise": "recognize",
    "merchantibility": "merchantability",
    "non infringement": "noninfringement",
    "sub license": "sublicense",
    "per cent": "percent",
    "copyright owner": "copyright holder",
    "https": "http",
}
# Titles that may stand above the first text of a licence.
TITLES = {"MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"), "ISC": ("ISC License",)}

#: Known texts that a scan takes; their first words and sizes are part of its plan.
MOST_KNOWN = 5_000

#: A line that states a copyright with a year, or reserves all rights; lower case.
COPYRIGHT = r"(?m)^[^\w\n]*(?:copyright|\(c\)|©).*\d{4}.*$|^[^\w\n]*all rights reserved[^\w\n]*$"

# Licence texts and notices by identifier.
KNOWN = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        'SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",
        "SPDX-License-Identifier: ISC",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0",
        "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
}

# Standard headers with a version, as (identifier, licence, version, later).
_GNU = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {0} as published by the "
    "Free Software Foundation; either version {1} of the License, or (at your option) any later version."
)
_WARRANTY = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details."
)
_GNU_NAMES = {"GPL": "General Public License", "LGPL": "Lesser General Public License", "AGPL": "Affero General Public License"}
_GNU_VERSIONS = {"GPL-2.0": "2", "GPL-3.0": "3", "LGPL-2.1": "2.1", "LGPL-3.0": "3", "AGPL-3.0": "3"}
# Headers of source files.
HEADERS = {
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES '
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
} | {
    f"{i}-or-later": tuple(
        text.format(_GNU_NAMES[i.split("-")[0]], version) for text in (_GNU, f"{_GNU}\n\n{_WARRANTY}")
    )
    for i, version in _GNU_VERSIONS.items()
}
# Identifiers that are known from their SPDX line, besides those above.
IDENTIFIERS = ("0BSD", "CC-BY-4.0", "CC-BY-3.0", "CC-BY-SA-3.0", "EPL-2.0", "Zlib", "BSL-1.0", "Artistic-2.0")


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, equivalent spellings, words with one space between."""
    plain = F.regexp_replace(F.lower(text), COPYRIGHT, " ")
    # Two spaces between words: each has its own on both sides, so neighbours are replaced too.
    plain = F.concat(F.lit(" "), F.regexp_replace(plain, r"[^\p{L}\p{N}]+", "  "), F.lit(" "))
    for old, new in SPELLINGS.items():
        plain = F.replace(plain, F.lit(f" {old.replace(' ', '  ')} "), F.lit(f" {new.replace(' ', '  ')} "))
    return F.trim(F.replace(plain, F.lit("  "), F.lit(" ")))


def digest(text: Column) -> Column:
    """Of the canonical form; NULL if that is empty."""
    plain = canonical(text)
    return F.when(plain != "", F.sha2(plain, 256))


def known_rows() -> list[tuple[str, str]]:
    """Identifier and text of the licences that come with this module."""
    titled = [(i, f"{title} {texts[0]}") for i, texts in KNOWN.items() for title in TITLES.get(i, ())]
    whole = [(p.stem.split("~")[0], p.read_text(encoding="utf-8")) for p in sorted(TEXTS.glob("*.txt"))]
    headers = [(i, t) for i, texts in HEADERS.items() for t in texts]
    # A line of the appendix that users fill in, which then counts as a copyright line.
    filled = [(i, t.replace("Copyright [yyyy] [name of copyright owner]", "")) for i, t in whole]
    # The paragraphs of the texts above as they are commonly set.
    set_ = [(i, t.replace(" The above copyright notice and", "\n\nThe above copyright notice and").replace(" THE SOFTWARE IS PROVIDED", "\n\nTHE SOFTWARE IS PROVIDED")) for i, t in titled + [(i, texts[0]) for i, texts in KNOWN.items()]]
    titled_set = [(i, t.replace(" Permission", "\n\nPermission", 1)) for i, t in set_]
    names = sorted({i for i, _ in whole} | set(IDENTIFIERS) | set(_GNU_VERSIONS))
    names += [f"{i}-{kind}" for i in names if "GPL-" in i or "GFDL-" in i for kind in ("only", "or-later")]
    known = [(i, t) for i, texts in KNOWN.items() for t in texts]
    said = {t for _, t in known}
    spdx = [(i, t) for i in names if (t := f"SPDX-License-Identifier: {i}") not in said]
    return list(dict.fromkeys(known + titled + set_ + titled_set + whole + filled + headers + spdx))


def known_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(known_rows(), "license_id string, text string")


def scanned(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id``, ``line``, ``digest``, ``license_id``.

    One row per input row with ``line`` -1: the digest of the whole text (NULL if no word is left),
    and its licence if known; and one row per line, counted from 0, that is a known licence text by itself, or where a
    run of lines begins that is one and leaves other words of the text out.
    A text of one line has both. If several known licences have one digest, the first name counts.
    NULL texts count as empty; equal rows give equal rows. A run begins with the first word of a line and ends with the last one of
    a line; words of other text on these lines make it another text.

    One pass over the texts. Only lines that begin like a known text, and runs from there that have as many letters as one, are brought
    into canonical form beside the whole text. The known digests are written, so that Spark knows their size: it broadcasts
    them if they are small, and can split a frequent digest otherwise. At most ``MOST_KNOWN`` texts may be known.
    """
    shapes = known.select("text").limit(MOST_KNOWN + 1).collect()
    if len(shapes) > MOST_KNOWN:
        raise ValueError(f"more than {MOST_KNOWN} known texts")
    digests = known.select(digest(F.col("text")).alias("_digest"), "license_id").where("_digest is not null")
    digests = stage(digests.groupBy("_digest").agg(F.min("license_id").alias("license_id")), "licences")
    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("_text"))
    whole = F.array(F.struct(F.lit(-1).cast("bigint").alias("line"), F.col("_text").alias("unit")))
    read = read.select("doc_id", F.inline(F.concat(whole, _inside(F.col("_text"), [r.text or "" for r in shapes]))))
    read = read.select("doc_id", "line", digest(F.col("unit")).alias("digest"))
    joined = read.join(digests, F.col("digest") == F.col("_digest"), "left")
    return joined.where("line = -1 or license_id is not null").select("doc_id", "line", "digest", "license_id")


_WORD = r"[\p{L}\p{N}]"


def _same_size() -> dict[str, str]:
    """Single words to replace, so that texts of one canonical form have equally many letters, wherever their lines are cut."""
    found = {}
    for old, new in SPELLINGS.items():
        if len(old.replace(" ", "")) != len(new.replace(" ", "")):
            found |= {a: b for a, b in zip(old.split(), new.split(), strict=True) if a != b}
    return found


def _letters(text: Column) -> Column:
    """The number of letters and digits that the canonical form has, but for single words that have spellings of unequal length."""
    plain = F.regexp_replace(F.lower(text), COPYRIGHT, " ")
    plain = F.concat(F.lit(" "), F.regexp_replace(plain, r"[^\p{L}\p{N}]+", "  "), F.lit(" "))
    for old, new in _same_size().items():
        plain = F.replace(plain, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.length(F.replace(plain, F.lit(" "), F.lit("")))


def _beginning(known: list[str]) -> str | None:
    """A pattern of the first two words of the known texts, at the beginning of a line, or of the first one alone on its line."""
    old = {new: [new, *(o for o, n in SPELLINGS.items() if n == new)] for new in SPELLINGS.values()}
    spelt = lambda word: "(?:" + "|".join(old.get(SPELLINGS.get(word, word), [word])) + ")"
    seconds: dict[str, set[str]] = {}
    for text in known:
        words = re.findall(r"[^\W_]+", re.sub(COPYRIGHT, " ", text.lower()))
        if words:
            seconds.setdefault(spelt(words[0]), set()).update(map(spelt, words[1:2]))
    if not seconds:
        return None
    other = r"[^\p{L}\p{N}\n]"
    end = rf"(?:{other}*$)"
    starts = (rf"{first}(?:{end}|{other}+(?:{'|'.join(sorted(then))})(?!{_WORD}))" if then else first + end for first, then in sorted(seconds.items()))
    return rf"(?m)^{other}*(?:{'|'.join(starts)})"


def _inside(text: Column, known: list[str]) -> Column:
    """Lines, and runs of lines, that may be a known text: ``line`` and ``unit``."""
    none = F.array().cast("array<struct<line:bigint,unit:string>>")
    begins = _beginning(known)
    if begins is None:
        return none
    spark = SparkSession.active()
    sizes = sorted({r.n for r in spark.createDataFrame([(t,) for t in known], "t string").select(_letters(F.col("t")).alias("n")).collect()} - {0})
    lines = F.split(text, "\n")
    marked = F.transform(
        lines, lambda line, i: F.struct(i.alias("at"), _letters(line).alias("n"), F.lower(line).rlike(begins).alias("begins"))
    )

    def step(state: Column, line: Column) -> Column:
        total = state["total"] + line["n"]
        started = F.when(line["begins"], F.array(F.struct(line["at"].alias("at"), state["total"].alias("before")))).otherwise(F.array().cast(_OPEN))
        held = F.filter(F.concat(state["open"], started), lambda o: total - o["before"] <= sizes[-1])
        ended = F.transform(
            F.filter(state["open"], lambda o: (total - o["before"]).isin(sizes)),
            lambda o: F.struct(o["at"].alias("a"), line["at"].alias("z"), (total - o["before"]).alias("n")),
        )
        # Lines without a letter neither begin nor end a run.
        return F.when(line["n"] == 0, state).otherwise(
            F.struct(total.alias("total"), held.alias("open"), F.concat(state["runs"], ended).alias("runs"))
        )

    start = F.struct(F.lit(0).alias("total"), F.array().cast(_OPEN).alias("open"), F.array().cast(_RUNS).alias("runs"))
    runs = F.aggregate(marked, start, step, lambda s: F.filter(s["runs"], lambda r: r["n"] < s["total"]))
    joined = F.transform(runs, lambda r: _unit(r["a"], F.array_join(F.slice(lines, r["a"] + 1, r["z"] - r["a"] + 1), "\n")))
    single = F.transform(F.filter(marked, lambda line: line["begins"]), lambda line: _unit(line["at"], F.get(lines, line["at"])))
    return F.when(F.lower(text).rlike(begins), F.concat(single, joined)).otherwise(none)


_OPEN = "array<struct<at:int,before:int>>"
_RUNS = "array<struct<a:int,z:int,n:int>>"


def _unit(line: Column, text: Column) -> Column:
    return F.struct(line.cast("bigint").alias("line"), text.alias("unit"))
