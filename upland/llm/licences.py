"""Licence scan by canonical digests, in DataFrame functions only.

A text is brought to a canonical form: lower case, lines with copyright notices dropped, punctuation and
white space to single spaces, equivalent spellings to one; its SHA-256 is looked up among the digests of known
licences. Looked up are the entire text of a document and each line of it, as a notice is a line. The
known licences are a table of fixed size: KNOWN, the texts in texts/ (whole licences and standard headers,
with the titles of TITLES and without), "SPDX-License-Identifier: " with every identifier of the SPDX list, and
notices in the words of VERBS and NAMES. It is broadcast, and no text is shuffled. Texts without any word that
a known licence must have aren't brought to the form, as they can't match.

A notice is a line that begins, after comment marks, with "copyright", "(c)", a copyright sign or "all rights
reserved", unless the next word is one that licences themselves put there ("copyright holders", "(c) you must"):
such a line is part of a wrapped sentence. A notice's second line isn't dropped.

Defined cases: null and empty texts, and those without a letter or digit, match nothing; a document of
one line that is a notice matches as document and as line; a very long text is brought to the form whole; of
licences with the same text the first by name is named; repeated rows and rows without doc_id match like others; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import cache, reduce
from operator import or_
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that count as equal.
SPELLINGS = [("licenc", "licens"), ("sub licens", "sublicens"), ("organis", "organiz"), ("authoris", "authoriz"), ("non commercial", "noncommercial"), ("copyright holder s", "copyright holders")]
COPYRIGHT = r"(^|\n)[ \t]*(?:copyright|\(c\)|©|all rights reserved)[^\n]*"
#: What OP4_SQL drops; here NOTICE holds, which keeps wrapped sentences and drops commented notices (DuckDB's expressions can't look ahead).
_BODY = "holders?|owners?|notices?|and|laws?|licen[cs]e[ds]?|line|disclaimers?|interests?|patents?|trademarks?|statements?|permissions?|treaty|doctrines|ownership|protection|on|or|of|in|is|are|as|also|like|if|each|more|then|those|resulting|including|the (?:library|software|program|work|package)"
NOTICE = rf"(^|\n)[ \t#*/;%!<>-]*(?:copyright(?![a-z])(?![^a-z0-9©]*(?:{_BODY})\b)|\(c\)(?![ \t\r\n]*(?:you|under|the licen[cs]es|representations)\b)|©|all rights reserved)[^\n]*"
MARKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F©“”‘’–—…\x{00A0}]+"

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
#: Fixed values: (licence, text) of whole licences and of the usual notices; OP4_SQL looks up these.
KNOWN = [
    ("MIT", _MIT),
    ("MIT", "MIT License\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("ISC", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n{_ISC_END}"),
    ("0BSD", f"{_ISC_GRANT}.\n{_ISC_END}"),
    ("Zlib", _ZLIB),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
]
#: Titles that stand before the text of a licence, and the words of notices.
TITLES = {
    "MIT": ["MIT", "MIT License", "MIT License (MIT)", "The MIT License", "The MIT License (MIT)", "The MIT License (Expat)"],
    "ISC": ["ISC", "ISC License", "ISC License (ISC)", "The ISC License", "The ISC License (ISC)"],
    "0BSD": ["0BSD", "BSD Zero Clause License", "Zero-Clause BSD", "BSD Zero Clause License (0BSD)"],
    "Zlib": ["zlib License", "The zlib License", "The zlib/libpng License"],
    "BSD-2-Clause": ["BSD License", "The BSD License", "BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License", "BSD 2-Clause \"Simplified\" License"],
    "BSD-3-Clause": ["BSD License", "The BSD License", "BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License", "BSD 3-Clause \"New\" or \"Revised\" License"],
    "Unlicense": ["Unlicense", "The Unlicense"],
}
VERBS = ["Licensed under", "Released under", "Distributed under", "This work is licensed under", "This project is licensed under"]
NAMES = {
    "MIT": ["the MIT License"],
    "ISC": ["the ISC License"],
    "Zlib": ["the zlib License"],
    "Unlicense": ["the Unlicense"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0", "MPL 2.0"],
    "GPL-2.0": ["the GNU General Public License, version 2", "GPL 2", "GPLv2"],
    "GPL-3.0": ["the GNU General Public License, version 3", "GPL 3", "GPLv3"],
    "LGPL-2.1": ["the GNU Lesser General Public License, version 2.1", "LGPL 2.1", "LGPLv2.1"],
    "LGPL-3.0": ["the GNU Lesser General Public License, version 3", "LGPL 3", "LGPLv3"],
    "AGPL-3.0": ["the GNU Affero General Public License, version 3", "AGPL 3", "AGPLv3"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
}
_CREATIVE = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
NAMES |= {f"CC-{a}-4.0": [f"CC {a} 4.0", f"a Creative Commons {b} 4.0 International License", f"the Creative Commons {b} 4.0 International License"] for a, b in _CREATIVE.items()}


@cache
def all_known() -> list[tuple[str, str]]:
    """(licence, text) of everything that is looked up; the driver reads it."""
    folder = Path(__file__).parent / "texts"
    whole = [(f.name.rsplit(".", 2)[0], f.read_text("utf-8")) for f in sorted(folder.glob("*.*.txt"))]
    bodies = [("MIT", _MIT), *KNOWN[3:6], *whole]
    titled = [(name, f"{title}\n{text}") for name, text in bodies for title in TITLES.get(name, [])]
    identifiers = [(i, f"SPDX-License-Identifier: {i}") for i in (folder / "identifiers.txt").read_text("utf-8").split()]
    notices = [(name, f"{verb} {words}.") for name, found in NAMES.items() for words in found for verb in VERBS]
    return KNOWN + whole + titled + identifiers + notices


def canonical(text: Column) -> Column:
    out = F.lower(text)
    drop = F.contains(out, F.lit("copyright")) | F.contains(out, F.lit("(c)")) | F.contains(out, F.lit("©")) | F.contains(out, F.lit("all rights reserved"))
    out = F.when(drop, F.regexp_replace(out, NOTICE, "\n")).otherwise(out)
    out = F.regexp_replace(out, MARKS, " ")
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.trim(out)


def known_licences(spark: SparkSession, known: list[tuple[str, str]]) -> DataFrame:
    """licence, plain, each plain once."""
    texts = spark.createDataFrame(known, "licence string, text string").select("licence", canonical(F.col("text")).alias("plain"))
    return texts.groupBy("plain").agg(F.min("licence").alias("licence"))


def key_words(texts: list[str]) -> list[str]:
    """Words such that each canonical text has one of them, few and long ones. Canonical words stand in the text
    itself, as marks only part words, so a text without any of these words is none of the known ones. Of words that
    equivalent spellings touch, only the common part of licence and license is used."""
    touched = [b.split()[-1] for _, b in SPELLINGS]
    found, left = [], []
    for text in texts:
        if "licens" not in text:
            words = {w for w in text.split() if not any(t in w or w in t for t in touched)}
            if not words:
                return []
            left.append(words)
        elif not found:
            found.append("licen")
    while left:
        many: dict[str, int] = {}
        for w in (w for words in left for w in words):
            many[w] = many.get(w, 0) + 1
        best = max(many, key=lambda w: (min(len(w), 10), many[w], w))
        found.append(best)
        left = [words for words in left if best not in words]
    return sorted(found)


def licence_scan(docs: DataFrame, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """doc_id, scope (document or line), line (from 0, null for the document), licence, digest of all matches."""
    spark = docs.sparkSession
    rows = known_licences(spark, all_known() if known is None else known).collect()  # a list of fixed size
    words = key_words([r["plain"] for r in rows])
    table = spark.createDataFrame([(r["licence"], hashlib.sha256(r["plain"].encode()).hexdigest()) for r in rows], "licence string, digest string")

    def likely(frame: DataFrame) -> DataFrame:
        hits = [F.contains(F.lower("text"), F.lit(w)) for w in words]
        return frame.where(reduce(or_, hits)) if hits else frame

    docs = likely(docs.where("text IS NOT NULL").select("doc_id", "text"))
    units = docs.select("doc_id", F.lit("document").alias("scope"), F.lit(None).cast("int").alias("line"), "text")
    lines = likely(docs.select("doc_id", F.lit("line").alias("scope"), F.posexplode(F.split("text", "\n", -1)).alias("line", "text")))
    plain = units.unionByName(lines).withColumn("plain", canonical(F.col("text"))).where("plain <> ''")
    found = plain.select("doc_id", "scope", "line", F.sha2("plain", 256).alias("digest"))
    return found.join(F.broadcast(table), "digest").select("doc_id", "scope", "line", "licence", "digest")
