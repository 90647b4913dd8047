"""Licence scans by canonical digest: whole texts, and whole lines, against known licence texts.

Case, punctuation, copyright lines and equivalent spellings are normalised with built-in string
functions; the SHA-256 of what is left of a whole text is hash-joined to the digests of known
texts. Lines that have the length of a known text are looked up in the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import UPPER, ascii_lower

#: Spellings that count as the same, as they are after punctuation is gone.
SPELLINGS = [
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("organisation", "organization"),
    ("authoris", "authoriz"),
    ("favour", "favor"),
    ("fulfil ", "fulfill "),
    ("judgement", "judgment"),
    ("acknowledgement", "acknowledgment"),
    ("wilful", "willful"),
    ("whilst", "while"),
    ("https", "http"),
    ("copyright owner", "copyright holder"),
]

COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*(copyright[ \t]*(\(c\)|©|[0-9<\[])|\(c\)[ \t]*[0-9<\[]|©|all rights reserved)[^\n]*"
PUNCTUATION = r"[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e“”‘’–—\t\r\x0b\x0c ]+"

_AS_IS = "THE SOFTWARE IS PROVIDED {q}AS IS{q}, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
_BSD_AS_IS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"

#: Fixed values: (licence, class, text). Full texts and the usual one-line notices.
KNOWN = [
    ("MIT", "permissive", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n" + _AS_IS.format(q='"') + " IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MIT", "permissive", "Released under the MIT License."),
    ("MIT", "permissive", "Licensed under the MIT License."),
    ("MIT", "permissive", "SPDX-License-Identifier: MIT"),
    ("ISC", "permissive", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", "permissive", _BSD_HEAD + _BSD_AS_IS),
    ("BSD-3-Clause", "permissive", _BSD_HEAD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n" + _BSD_AS_IS),
    ("Apache-2.0", "permissive", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "permissive", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "permissive", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "copyleft", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.\n\nYou should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("GPL-3.0", "copyleft", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "noncommercial", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "noncommercial", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "attribution", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "attribution", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "copyleft", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "public domain", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "public domain", "This is free and unencumbered software released into the public domain."),
]


#: Titles that stand above the full texts.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License"],
}

#: Fixed values: (licence, class, size, digest) of the canonical forms of long licences' full texts,
#: as Linux distributions install them.
FULL_TEXTS = [
    ("Apache-2.0", "permissive", 9887, "036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b"),
    ("Artistic-1.0", "permissive", 5833, "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("CC0-1.0", "public domain", 6692, "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "copyleft", 19578, "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b"),
    ("GFDL-1.3", "copyleft", 22013, "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d"),
    ("GPL-1.0", "copyleft", 11765, "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "copyleft", 17117, "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "copyleft", 33406, "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("LGPL-2.0", "copyleft", 24130, "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "copyleft", 25217, "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "copyleft", 7104, "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "copyleft", 22447, "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6"),
    ("MPL-2.0", "copyleft", 14342, "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d"),
]


def known_texts(known: list[tuple[str, str, str]] = KNOWN) -> list[tuple[str, str, str]]:
    """The known texts, and the full ones (of several paragraphs) below each of their titles."""
    return known + [(n, c, f"{title}\n\n{t}") for n, c, t in known if "\n\n" in t for title in TITLES.get(n, [])]


def plain(text: Column) -> Column:
    """Lower case, no copyright lines, one space for punctuation; lines stay."""
    return F.regexp_replace(F.regexp_replace(ascii_lower(text), COPYRIGHT_LINE, ""), PUNCTUATION, " ")


def spelled(text: Column) -> Column:
    for seen, settled in SPELLINGS:
        text = F.replace(text, F.lit(seen), F.lit(settled))
    return text


def one_line(base: Column) -> Column:
    return F.trim(F.regexp_replace(base, "[ \n]+", " "))


def canonical_text(text: Column) -> Column:
    """A whole text as one line, so that spellings of two words are settled across line breaks."""
    return spelled(one_line(plain(text)))


def canonical_lines(base: Column) -> Column:
    """The canonical forms of a plain text's lines, those without a word left out."""
    lines = F.transform(F.split(spelled(base), "\n"), lambda x: F.trim(x))
    return F.filter(lines, lambda x: x != "")


def known_digests(spark: SparkSession, known: list[tuple[str, str, str]] | None = None, folder: str | None = None) -> DataFrame:
    """digest, size (characters), license, license_class of the known texts, by the expressions
    used on documents, and the listed digests of long licences (only where ``known`` is not
    given). ``folder`` adds the texts of its files, such as the full texts of long
    licences, each named by its file and of class ``full text``."""
    texts = spark.createDataFrame(known_texts() if known is None else known, "license string, license_class string, text string")
    if folder:
        name = F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.txt)?$", 1)
        texts = texts.unionByName(spark.read.text(folder, wholetext=True).select(name.alias("license"), F.lit("full text").alias("license_class"), F.col("value").alias("text")))
    text = canonical_text(F.col("text"))
    found = texts.select(F.sha2(text, 256).alias("digest"), F.length(text).alias("size"), "license", "license_class")
    if known is None:
        full = spark.createDataFrame([(d, n, a, c) for a, c, n, d in FULL_TEXTS], "digest string, size int, license string, license_class string")
        found = found.unionByName(full)
    return found.groupBy("digest", "size").agg(F.min(F.struct("license", "license_class")).alias("k")).select("digest", "size", "k.*")


def possible_lengths(sizes: list[int]) -> list[tuple[int, int]]:
    """Ranges of lengths from which settling the spellings can lead to one of ``sizes`` (sorted):
    a spelling shrinks by a fifth or grows by a sixth at most."""
    ranges: list[tuple[int, int]] = []
    for n in sizes:
        low, high = n * 3 // 4, n * 4 // 3
        if ranges and low <= ranges[-1][1]:
            ranges[-1] = (ranges[-1][0], high)
        else:
            ranges.append((low, high))
    return ranges


def scan_licenses(docs: DataFrame, known: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines (lines with a word left), text_license and text_class (the whole text is a
    known one), line_licenses (known ones among whole lines, sorted, joined by commas) and
    n_license_lines, for every row. ``known`` is what ``known_digests`` gives: a list of
    licences, which the driver reads for the lines' lookup.

    Null, empty and blank texts: zeros, null and an empty string. Repeated rows and rows without
    an id: a row each. Empty table: no rows. Other columns are not read.
    """
    listed = known.collect()
    sizes = sorted({r["size"] for r in listed})
    names = F.create_map(*[F.lit(x) for r in listed for x in (r["digest"], r["license"])]) if listed else F.lit(None).cast("map<string,string>")
    base = docs.select(F.col(id_col).alias("doc_id"), plain(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("base"))
    joined = base.select("doc_id", "base", one_line(F.col("base")).alias("one"))
    near = F.lit(False)  # other lengths have no known digest
    for low, high in possible_lengths(sizes):
        near = near | F.length("one").between(low, high)
    lined = joined.select("doc_id", F.when(near, F.sha2(spelled(F.col("one")), 256)).alias("digest"), canonical_lines(F.col("base")).alias("lines"))
    met = F.filter(F.transform(F.filter("lines", lambda x: F.length(x).isin(sizes)), lambda x: F.element_at(names, F.sha2(x, 256))), lambda x: x.isNotNull())
    rows = lined.select("doc_id", "digest", F.size("lines").cast("long").alias("n_lines"), met.alias("met"))
    whole = known.select("digest", F.col("license").alias("text_license"), F.col("license_class").alias("text_class"))
    return rows.join(F.broadcast(whole), "digest", "left").select(  # the list that the driver has read
        "doc_id",
        "n_lines",
        "text_license",
        "text_class",
        F.array_join(F.array_sort(F.array_distinct("met")), ",").alias("line_licenses"),
        F.size("met").cast("long").alias("n_license_lines"),
    )


def oracle() -> str:
    """DuckDB SQL for the rows of ``scan_licenses`` over ``documents`` with the known texts."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    base = lambda x: f"regexp_replace(regexp_replace(translate({x}, '{UPPER}', '{UPPER.lower()}'), {quote(COPYRIGHT_LINE)}, '', 'g'), {quote(PUNCTUATION)}, ' ', 'g')"

    def spell(x: str) -> str:
        for seen, settled in SPELLINGS:
            x = f"replace({x}, {quote(seen)}, {quote(settled)})"
        return x

    whole = lambda x: "sha256(" + spell(f"trim(regexp_replace({x}, '[ \\n]+', ' ', 'g'))") + ")"
    values = ", ".join(f"({quote(a)}, {quote(b)}, {quote(c)})" for a, b, c in known_texts())
    full = ", ".join(f"({quote(d)}, {quote(a)}, {quote(c)})" for a, c, _, d in FULL_TEXTS)
    return f"""
    WITH known AS (SELECT DISTINCT {whole(base('t'))} AS digest, l AS license, c AS license_class FROM (VALUES {values}) AS k(l, c, t)
      UNION SELECT * FROM (VALUES {full}) AS f(d, l, c)),
    d AS (SELECT doc_id, {base("coalesce(text, '')")} AS c FROM documents),
    units AS (
      SELECT doc_id, TRUE AS whole, {whole('c')} AS digest FROM d
      UNION ALL
      SELECT doc_id, FALSE, sha256(trim(x)) FROM (SELECT doc_id, unnest(string_split({spell('c')}, chr(10))) AS x FROM d) WHERE trim(x) <> ''
    )
    SELECT doc_id,
      count(*) FILTER (NOT whole) AS n_lines,
      max(license) FILTER (whole) AS text_license,
      max(license_class) FILTER (whole) AS text_class,
      coalesce(string_agg(DISTINCT license, ',' ORDER BY license) FILTER (NOT whole), '') AS line_licenses,
      count(license) FILTER (NOT whole) AS n_license_lines
    FROM units LEFT JOIN known USING (digest) GROUP BY doc_id
    """
