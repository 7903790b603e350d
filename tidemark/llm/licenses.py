"""License scans: whole texts are looked up among the digests of known licences.

A text is brought to a canonical form, in SQL functions only: lower case, no copyright lines,
no punctuation, one spelling of words that are spelt in several ways. Its SHA-256 is then
hash-joined to the digests of the known texts. Two units are looked up: the whole document,
for licence texts, and each whole line, for notices. Every known text holds one of the
``ANCHOR`` words, so units without one are left out before any digest is made.
"""

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ANCHOR = "licen[sc]|warrant|liabl|cc[ -]by|cc0|creative commons|public domain|waived all copyright"

#: Words of running text after "copyright" or a list item "(c)"; anything else there is a holder. Fixed values.
NO_HOLDER = frozenset(
    "a act an and any are as be by claim claims disclaimer disclaimers doctrine doctrines for from has have holder holders if in interest interests is it law "
    "laws licence license licensed licenses line lines may must not notice notices of on or other owned owner owners ownership permission permissions "
    "protection right rights shall statement statements that the this to treaties treaty under which with year you your accompany convey prohibiting".split()
)


def _other_than(words: frozenset[str]) -> str:
    """The start of a lower-case word up to where it differs from all ``words``; without look-ahead, which RE2 has not."""
    nexts: dict[str, set[str]] = {}
    for word in words - {""}:
        nexts.setdefault(word[0], set()).add(word[1:])
    ways = [rf"[^{''.join(sorted(nexts))}\x00-\x2f\x3a-\x60\x7b-\x7f]"]
    for first, rests in sorted(nexts.items()):
        ways.append(first + (_other_than(frozenset(rests)) if "" in rests else f"(?:{_other_than(frozenset(rests))}|{_WORD_END})"))
    return f"(?:{'|'.join(ways)})"


_WORD_END = r"[\x00-\x09\x0b-\x2f\x3a-\x60\x7b-\x7f]|$"
_HOLDER = _other_than(NO_HOLDER)
#: "Copyright" with a sign, a year, "by" or a holder after it, "(c)" with a year or a holder, and the reservation of rights.
COPYRIGHT_LINES = (
    r"^[^a-z0-9\n]*(?:copyright(?:[^a-z0-9\n]*(?:\(c\)|©|&copy;|[12][0-9][0-9][0-9]|by )|[ \t]+[<\[{])|\(c\)[ \t]*copyright"
    r"|(?:copyright[ \t:]+|\(c\)[ \t]*)" + _HOLDER + r"|©|all rights reserved|rights reserved[^a-z0-9\n]*$)[^\n]*$"
)
NOT_WORD = r"[^\p{L}\p{N}]+"

#: Spellings that count as equal, by word. Fixed values.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense",
    "sub license": "sublicense", "sub licence": "sublicense", "https": "http",
    "acknowledgement": "acknowledgment", "acknowledgements": "acknowledgments",
    "organisation": "organization", "organisations": "organizations", "authorised": "authorized",
    "behaviour": "behavior", "favour": "favor", "fulfil": "fulfill", "judgement": "judgment",
    "merchantibility": "merchantability", "whilst": "while", "wilful": "willful", "copyright owner": "copyright holder",
    "copyright owners": "copyright holders", "non infringement": "noninfringement", "per cent": "percent",
    "non commercial": "noncommercial", "share alike": "sharealike", "noderivs": "noderivatives", "no derivatives": "noderivatives",
}

#: Notices of one line. Fixed values.
NOTICES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License, version 2."],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", "Licensed under the BSD 3-Clause License."],
    "MPL-2.0": ["Licensed under the Mozilla Public License, version 2.0."],
}

_CC_KINDS = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_CC_PORTS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic"}
_STARTS = ("Licensed under", "Released under", "This work is licensed under", "This project is licensed under")


def _cc_notices() -> dict[str, list[str]]:
    """The six Creative Commons licences in each version, and CC0, by short and by full name."""
    found = {}
    for kind, title in _CC_KINDS.items():
        for version, port in _CC_PORTS.items():
            full = f"Creative Commons {title} {version}"
            names = [f"CC {kind} {version}", f"the CC {kind} {version} license", f"a CC {kind} {version} license", full, f"{full} {port}"]
            names += [f"{article} {full} {tail}" for article in ("a", "the") for tail in ("License", f"{port} License", f"{port} Public License")]
            found[f"CC-{kind}-{version}"] = [f"{start} {name}." for start in _STARTS for name in names]
    names = [f"{article}{name}{tail}" for article in ("", "the ") for name in ("CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons CC0", "Creative Commons CC0 1.0 Universal",
             "Creative Commons Zero 1.0 Universal", "Creative Commons Zero v1.0 Universal") for tail in ("", " License", " Public Domain Dedication")]
    found["CC0-1.0"] = [f"{start} {name}." for start in (*_STARTS, "This work is marked with", "Dedicated to the public domain under") for name in names] + [
        f"To the extent possible under law, {who} waived all copyright and related or neighboring rights to this work."
        for who in ("the author has", "the author(s) have", "the authors have", "the person who associated CC0 with this work has")
    ]
    return found


NOTICES |= _cc_notices()

_MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution.\n\n"
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission.\n\n"
)
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
    "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

_UNLICENSE = (
    "This is free and unencumbered software released into the public domain.\n\n"
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
    "purpose, commercial or non-commercial, and by any means.\n\n"
    "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the "
    "public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this "
    "dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\n\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)


def _titled(titles: str, *texts: str) -> list[str]:
    return [f"{title}\n\n{text}" if title else text for title in ("", *titles.split("|")) for text in texts]


def _bullets(text: str) -> str:
    return text.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")


def _files() -> dict[str, list[str]]:
    """The texts in ``license_texts``, each also without the advice that follows its terms."""
    found = {}
    for file in resources.files("tidemark.llm").joinpath("license_texts").iterdir():
        text = file.read_text(encoding="utf-8")
        terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        found[file.name.removesuffix(".txt")] = [text, terms, terms + end] if end else [text]
    return found


_BSD_2, _BSD_3 = _BSD_TWO + _BSD_DISCLAIMER, _BSD_TWO + _BSD_THIRD + _BSD_DISCLAIMER
_ISC_TERMS = ", provided that the above copyright notice and this permission notice appear in all copies.\n\n"
_GRANTS = (_ISC_GRANT, _ISC_GRANT.replace("and/or", "and"))

#: Licence texts. Fixed values.
TEXTS = {
    "MIT": _titled("MIT License|The MIT License|The MIT License (MIT)|MIT License (MIT)|MIT", _MIT_GRANT),
    "ISC": _titled("ISC License|The ISC License|ISC License (ISC)|The ISC License (ISC)|ISC", *(grant + _ISC_TERMS + _ISC_DISCLAIMER for grant in _GRANTS)),
    "0BSD": _titled("Zero-Clause BSD|BSD Zero Clause License|Zero-Clause BSD License|0BSD", *(f"{grant}.\n\n{_ISC_DISCLAIMER}" for grant in _GRANTS)),
    "BSD-2-Clause": _titled(
        'BSD 2-Clause License|The BSD 2-Clause License|The 2-Clause BSD License|BSD 2-Clause "Simplified" License|BSD License', _BSD_2, _bullets(_BSD_2)
    ),
    "BSD-3-Clause": _titled(
        'BSD 3-Clause License|The BSD 3-Clause License|The 3-Clause BSD License|BSD 3-Clause "New" or "Revised" License|BSD License', _BSD_3, _bullets(_BSD_3)
    ),
    "Unlicense": _titled(
        "The Unlicense|Unlicense",
        *(_UNLICENSE + tail for tail in ("", *(f"\n\nFor more information, please refer to {at}unlicense.org{end}" for at in ("http://", "https://") for end in ("", "/")))),
    ),
    **_files(),
}


def canonical(text: Column) -> Column:
    """The text in lower case, without copyright lines and punctuation, in one spelling."""
    words = F.regexp_replace(F.lower(text), f"(?md){COPYRIGHT_LINES}", "")
    words = F.concat(F.lit(" "), F.regexp_replace(F.replace(words, F.lit("&"), F.lit(" and ")), NOT_WORD, "  "), F.lit(" "))
    for spelling, usual in SPELLINGS.items():  # two spaces between words leave one for each neighbour
        words = F.replace(words, F.lit(f" {spelling.replace(' ', '  ')} "), F.lit(f" {usual} "))
    return F.trim(F.regexp_replace(words, " +", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession) -> DataFrame:
    """``(known, license, unit)``: one row per canonical form; as many as there are texts above."""
    rows = [("line", name, text) for name, texts in NOTICES.items() for text in texts]
    rows += [("document", name, text) for name, texts in TEXTS.items() for text in texts]
    # one literal, as a plan with a literal per text is slow to build
    packed = F.split(F.lit("\x1e".join("\x1f".join(row) for row in rows)), "\x1e")
    fields = spark.range(1).select(F.explode(packed).alias("row")).select(F.split("row", "\x1f").alias("f"))
    table = fields.select(*(F.col("f")[i].alias(name) for i, name in enumerate(("unit", "license", "text"))))
    return table.groupBy(digest(F.col("text")).alias("known"), "unit").agg(F.min("license").alias("license"))


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, license, n_notices, notices)`` of every row.

    ``license`` is the licence that the whole text is, or null; ``notices`` are the licences
    named by its lines, distinct, sorted and comma-joined, and ``n_notices`` is the number of
    such lines. Null and empty texts have none. Rows with the same id share what any of
    them holds.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    held = rows.filter(F.lower("text").rlike(ANCHOR))
    lines = F.filter(F.split("text", "\n"), lambda line: F.lower(line).rlike(ANCHOR))
    units = F.concat(
        F.array(F.struct(F.lit("document").alias("unit"), F.col("text").alias("part"))),
        F.transform(lines, lambda line: F.struct(F.lit("line").alias("unit"), line.alias("part"))),
    )
    parts = held.select("doc_id", F.inline(units)).select("doc_id", "unit", digest(F.col("part")).alias("known"))
    found = parts.join(known_digests(docs.sparkSession), ["known", "unit"])
    whole, line = F.col("unit") == "document", F.col("unit") == "line"
    hits = found.groupBy(F.col("doc_id").alias("hit")).agg(
        F.min(F.when(whole, F.col("license"))).alias("license"),
        F.count(F.when(line, 1)).alias("n_notices"),
        F.array_join(F.array_sort(F.collect_set(F.when(line, F.col("license")))), ",").alias("notices"),
    )
    out = rows.select("doc_id").join(hits, F.col("doc_id").eqNullSafe(F.col("hit")), "left")
    return out.select(
        "doc_id", "license", F.coalesce("n_notices", F.lit(0)).alias("n_notices"), F.coalesce("notices", F.lit("")).alias("notices")
    )
