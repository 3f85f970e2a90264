"""Licence scans by canonical digest: whole texts, normalised, are looked up among known licences.

Two texts get the same digest if they differ only in case (A to Z), punctuation, white space, other signs than letters and
digits of ASCII, lines that state a copyright, and spellings that are equivalent in licences.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.support import only

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words by which a line states terms, so that it is no mere copyright statement.
_TERMS = (r"(?<![a-z0-9])(?:no|not|non|use|used|uses|using|commercial|noncommercial|licen[sc]e[sd]?|permit|permits|permitted|permissions?|"
          r"prohibited|only|must|may|shall|without|you|your|redistribut[a-z]*|distribut[a-z]*|modif[a-z]*|warrant[a-z]*|notices?|terms|"
          r"conditions?|granted|except|provided|subject|laws?|statements?|interests?|materials?|treaty|protection)(?![a-z0-9])")
#: Words that follow ``copyright`` within a sentence, where a line is broken.
_WITHIN = r"(?:holders?|owners?|and|or|in|of|to|is|are|for|as|on|by|that|which|works?)(?![a-z0-9])"
_YEAR = r"(?:[12][0-9][0-9][0-9]|[<\[{])"  # or a place to put it in
_WORDS = r"[^ \t\r\n]+(?:[ \t]+[^ \t\r\n]+){0,%d}[ \t\r]*(?![^\n])"
#: A line that is, after comment signs, a copyright statement without terms: a year or an owner must stand beside the word or sign.
COPYRIGHT = (r"\n[ \t\r*#/;>-]*(?:all rights reserved[ \t\r.!]*(?![^\n])|(?=copyright|\(c\)|©)(?![^\n]*" + _TERMS + r")(?:"
             r"(?:copyright[ \t:]*)?(?:\(c\)|©)[ \t:,]*(?:by[ \t]+)?" + _YEAR + r"|(?:copyright[ \t:]*(?:\(c\)|©)|©)[ \t:,]*" + _WORDS % 9
             + r"|\(c\)[ \t:,]*" + _WORDS % 3
             + r"|copyright[ \t:]+(?:by[ \t]+)?(?:" + _YEAR + "|(?!" + _WITHIN + ")" + _WORDS % 9 + r"))[^\n]*)")
#: What the SQL of the query takes as copyright statement. Its engine has no look-ahead.
SQL_COPYRIGHT = (r"\n[ \t\r*#/;>-]*((copyright[ \t]*)?(\(c\)|©)|copyright:?[ \t]+(by[ \t]|[12][0-9][0-9][0-9])|all rights reserved)"
             r"[^\n]*")
#: Fixed: spellings taken as equal, the first written as the second.
SPELLINGS = (
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("copyright holder", "copyright owner"),
    ("acknowledgement", "acknowledgment"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("organisation", "organization"), ("recognised", "recognized"), ("initialisation", "initialization"),
    ("favour", "favor"), ("behaviour", "behavior"), ("judgement", "judgment"), ("fulfil ", "fulfill "), ("per cent", "percent"),
    ("merchantability", "merchantibility"), ("whilst", "while"), ("programme", "program"),
)

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so"""
_MIT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED
TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED
OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use
this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
#: Fixed: short texts of well-known licences and of common one-line notices.
KNOWN = (
    ("MIT", _MIT_GRANT + """, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
""" + _MIT_WARRANTY),
    ("MIT", "MIT License\n\n" + _MIT_GRANT + """, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
""" + _MIT_WARRANTY),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
""" + _ISC_WARRANTY),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n"
     + _ISC_WARRANTY),
    ("BSD-2-Clause", "\n".join((_BSD_HEAD, _BSD_WARRANTY))),
    ("BSD-3-Clause", "\n".join((_BSD_HEAD, _BSD_NAMES, _BSD_WARRANTY))),
    ("Zlib", _ZLIB),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)

#: Titles that may stand above the short texts.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "MIT License (MIT)", "The MIT License (MIT)", "Expat License", "MIT", "License: MIT"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC", "License: ISC"),
    "0BSD": ("Zero-Clause BSD", "BSD Zero Clause License", "Zero-Clause BSD License", "BSD 0-Clause License", "Free Public License 1.0.0", "0BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License",
                     "The 2-Clause BSD License", "2-Clause BSD License", "FreeBSD License", "BSD License", "The BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License",
                     "The 3-Clause BSD License", "3-Clause BSD License", "Modified BSD License", "Revised BSD License", "The New BSD License",
                     "BSD License", "The BSD License", "BSD-3-Clause"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License", "Zlib"),
    "BSL-1.0": ("Boost Software License", "The Boost Software License"),
    "Unlicense": ("The Unlicense", "Unlicense"),
}
#: Words after which a long text only tells how to apply it.
_ENDS = ("END OF TERMS AND CONDITIONS",)


def known_texts() -> list[tuple[str, str]]:
    """``licence, text``: the short texts with and without titles, and the files beside this module with and without what follows their terms."""
    rows = list(KNOWN)
    for path in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")):
        name, text = path.stem, path.read_text("utf-8")
        wholes = [text] + [text[:text.index(end) + kept] for end in _ENDS if end in text for kept in (0, len(end))]
        rows += [(name, whole) for whole in wholes] + [(name, whole.replace("https://", "http://")) for whole in wholes if "https://" in whole]
    rows += [(name, f"{title}\n\n{text}") for name, text in rows if len(text) > 500 for title in TITLES.get(name, ())]
    return rows


def canonical(text: Column) -> Column:
    """The normalised text; empty for null."""
    plain = F.translate(F.concat(F.lit("\n"), F.coalesce(text, F.lit(""))), UPPER, LOWER)
    plain = F.regexp_replace(plain, COPYRIGHT, "\n")
    plain = F.regexp_replace(plain, "[^a-z0-9]+", " ")
    for other, usual in SPELLINGS:
        plain = F.replace(plain, F.lit(other), F.lit(usual))
    return F.trim(plain)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(licences: DataFrame) -> DataFrame:
    """``digest, licence`` of a table ``licence, text``; texts that normalise to nothing are no licence."""
    return (licences.filter(canonical(F.col("text")) != "").select(digest(F.col("text")).alias("digest"), "licence")
            .groupBy("digest").agg(F.min("licence").alias("licence")))


def scan(docs: DataFrame, licences: DataFrame | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, digest, licence`` per row; ``licence`` is null for a text that is no known licence.

    ``licences`` (``licence, text``) is by default the list of ``known_texts``. Rows of one id stay separate rows.
    """
    if licences is None:
        licences = docs.sparkSession.createDataFrame(known_texts(), "licence string, text string")
    rows = only(docs, doc_id=id_column, text=text_column).select("doc_id", digest(F.col("text")).alias("digest"))
    return rows.join(known_digests(licences), "digest", "left").select("doc_id", "digest", "licence")


def sql() -> str:
    """The scan of ``documents`` in SQL, by the short texts without titles and the plainer rule for copyright statements."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def normal(text: str) -> str:
        out = f"translate(chr(10) || coalesce({text}, ''), '{UPPER}', '{LOWER}')"
        out = f"regexp_replace({out}, {quoted(SQL_COPYRIGHT)}, chr(10), 'g')"
        out = f"regexp_replace({out}, '[^a-z0-9]+', ' ', 'g')"
        for other, usual in SPELLINGS:
            out = f"replace({out}, {quoted(other)}, {quoted(usual)})"
        return f"trim({out}, ' ')"

    rows = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in KNOWN)
    return f"""
WITH known AS (
    SELECT sha256({normal('text')}) AS digest, min(licence) AS licence FROM (VALUES {rows}) t(licence, text) GROUP BY 1)
SELECT d.doc_id, d.digest, k.licence
FROM (SELECT doc_id, sha256({normal('text')}) AS digest FROM documents) d LEFT JOIN known k ON d.digest = k.digest
"""
