"""License scans: canonical digest lookup.

A text is put into a canonical form, so that notices which differ in case,
punctuation, copyright lines or spelling become equal; its digest is then
hash-joined to the digests of known licence texts.  Entire texts are looked
up, and entire lines, since a document often ends in a one-line notice.

Known are the texts of MIT, ISC and 0BSD, alone and below their titles,
one-line notices of eleven licences, and by their digests the common texts of
Apache-2.0, BSD-2-Clause, BSD-3-Clause, BSL-1.0, BlueOak-1.0.0, CC0-1.0,
GPL-2.0, GPL-3.0, LGPL-2.1, LGPL-3.0, MPL-2.0 and the Unlicense; ``known_texts`` takes a folder
of more.  A text with anything else in it, or with another holder's name in
its clauses, has another digest.

Canonical form: lower case; copyright lines dropped; equivalent spellings
replaced; each run of characters that are neither letters nor digits one
space; no space at the ends.

Everything is built from DataFrame functions.  Only digests are joined; Spark
broadcasts the known ones where their measured size allows.

Defined cases: a null or empty text, or one of marks alone, has the digest of
the empty text and matches nothing; of known texts with one canonical form
the smallest name counts; a repeated row gets the same result; a null id stays
null; an empty table gives no row; extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafstat.llm.common import landed

# Lines that name a copyright holder, not part of a licence.
COPYRIGHT_LINE = (r"(?m)^[^\p{L}\p{N}\n]*(copyright *(\(c\)|©|[0-9<\[{])|\(c\) *[0-9]|© *[0-9]|all rights reserved)[^\n]*$")
# Equivalent spellings (pattern, replacement), applied in this order.
SPELLINGS = [
    (r"licenc(e|es|ed|ing|ee|or)\b", "licens$1"),
    (r"\b(fav|col|hon|lab|behavi|endeav)our", "$1or"),
    (r"\b(organ|author|recogn|util|initial|minim|optim|custom)is(e|es|ed|ing|ation)", "$1iz$2"),
    (r"\b(sub|non)[- ](licens|commercial)", "$1$2"),
    (r"\b(acknowledg|judg)ement", "$1ment"),
    (r"\bper cent\b", "percent"),
    (r"\bcopyright owner", "copyright holder"),
    (r"\bhttps:", "http:"),
    (r"&", " and "),
]

# Licence texts and notices by SPDX identifier.
_WARRANTY_MIT = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE.")
_WARRANTY_ISC = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE.")
KNOWN = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            'associated documentation files (the "Software"), to deal in the Software without restriction, including '
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all "
            "copies or substantial portions of the Software. " + _WARRANTY_MIT),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
            + _WARRANTY_ISC),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted. " + _WARRANTY_ISC),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal."),
]


# Titles that the files of a licence begin with.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"],
}
# SHA-256 of the canonical forms of longer licence texts, as they are commonly distributed
# (with and without title, appendix or numbering).
DIGESTS = {
    "036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b": "Apache-2.0",
    "f70a2718f78121f2da77cd6afbffffbd668d7c1fd36c85a3ef121e83cb5f48fe": "Apache-2.0",
    "e7c5260ee7e187aa32deaf9fe84733b5dbe1dd1f3c36f232c49799c716b73570": "Apache-2.0",
    "6aa661403864282a4d084f1551e8149a5f1a7b5e8b05b6db8e1a8a28d0badc64": "Apache-2.0",
    "5fcf89bde8c0c2deb999f4cc626e1aebf90e80fdc5cd334dae008152ef4a1ded": "BSL-1.0",
    "9d112ef603d3207d4e033c8a2a46961291832b2ee49b6047ca349781c7898a95": "BlueOak-1.0.0",
    "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30": "BSD-2-Clause",
    "7be8178e4e9d0dea6ff4b04bd52bd086d7ea8386a5a6e09760df916bae5d42d2": "BSD-2-Clause",
    "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15": "BSD-3-Clause",
    "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2": "BSD-3-Clause",
    "f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af": "BSD-3-Clause",
    "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa": "BSD-3-Clause",
    "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f": "CC0-1.0",
    "aa997bc1c3422ccdc7ccabdc6f9aaa9ce2ebeed7be208887d2b13ff901326c75": "GPL-2.0-only",
    "724c8299687866f11de217ce9f08e16805bc84b71e66d8c4ea1307d371e33a4f": "GPL-2.0-only",
    "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821": "GPL-2.0-only",
    "9faf4f9b13ca844eeee37346a77dec74f558096ac2b418782a99c8afe4c772da": "GPL-3.0-only",
    "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a": "GPL-3.0-only",
    "5db6a0cf025514ea4a904dd0c2731b3a48aec5259d5f1ec782685806040d7b6a": "LGPL-2.1-only",
    "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be": "LGPL-3.0-only",
    "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d": "MPL-2.0",
    "e2380bdfe57ca73b01d0b1848a4ee630998d729b260e63082b9267100b4a7229": "Unlicense",
}


def canonical_lines(text: Column) -> Column:
    """The canonical form of a text with its line ends kept, spaces at the ends of lines included."""
    t = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    for pattern, spelling in SPELLINGS:
        t = F.regexp_replace(t, pattern, spelling)
    return F.regexp_replace(t, r"[^\p{L}\p{N}\n]+", " ")


def canonical(lines: Column) -> Column:
    """The canonical form of a whole text from ``canonical_lines``."""
    return F.trim(F.regexp_replace(lines, "[ \n]+", " "))


def digest_of(form: Column) -> Column:
    """Never null, so a join on it does not filter by computing it once more."""
    return F.coalesce(F.sha2(form, 256), F.lit(""))


def titled() -> list[tuple[str, str]]:
    """The built-in texts, alone and below each title of their licence."""
    return [(name, text if title is None else f"{title}\n\n{text}") for name, text in KNOWN
            for title in [None, *(TITLES.get(name, []) if len(text) > 500 else [])]]


def known_texts(spark: SparkSession, folder: str | None = None) -> DataFrame:
    """(license_id, text): the built-in ones, and the files of a folder under their names."""
    listed = [F.struct(F.lit(name).alias("license_id"), F.lit(text).alias("text")) for name, text in titled()]
    known = spark.range(1).select(F.inline(F.array(*listed)))      # a size that Spark knows, so it may broadcast
    if folder:
        files = spark.read.option("wholetext", True).text(folder)
        known = known.unionByName(files.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("license_id"),
                                               F.col("value").alias("text")))
    return known


def digests(known: DataFrame) -> DataFrame:
    """(digest, license_id) of known texts and of the long ones that are known by
    their digests alone, one row for each canonical form."""
    form = canonical(canonical_lines(F.col("text")))
    listed = [F.struct(F.lit(d).alias("digest"), F.lit(name).alias("license_id")) for d, name in DIGESTS.items()]
    by_text = (known.where("text IS NOT NULL").select(form.alias("form"), "license_id").where("form <> ''")
               .select(digest_of(F.col("form")).alias("digest"), "license_id"))
    return (by_text.unionByName(known.sparkSession.range(1).select(F.inline(F.array(*listed))))
            .groupBy("digest").agg(F.min("license_id").alias("license_id")))


def scanned(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, canonical_sha256, license_id of the entire text (or
    null) and ``line_licenses``, the licences of its lines, sorted, with commas.

    The lines' digests are looked up before anything is shuffled; only the
    rows found are gathered, by the canonical text that they come from.
    """
    of = digests(known)
    text = F.coalesce(F.col(text_col), F.lit(""))
    forms = docs.select(F.col(id_col).alias("doc_id"), canonical_lines(text).alias("_lines"))
    # Thin rows are landed, so each text is put into canonical form once.
    each = F.array_distinct(F.transform(F.split("_lines", "\n"), lambda line: F.unhex(digest_of(F.trim(line)))))
    thin = landed(forms.select("doc_id", digest_of(canonical(F.col("_lines"))).alias("canonical_sha256"), each.alias("_each")), "licenses")
    lines = (thin.select("canonical_sha256", F.explode("_each").alias("_line"))
             .join(of.select(F.unhex("digest").alias("_line"), "license_id"), "_line")
             .groupBy("canonical_sha256")
             .agg(F.array_join(F.sort_array(F.collect_set("license_id")), ",").alias("line_licenses")))
    return (thin.select("doc_id", "canonical_sha256").join(of.withColumnRenamed("digest", "canonical_sha256"), "canonical_sha256", "left")
            .join(lines, "canonical_sha256", "left")
            .select("doc_id", "canonical_sha256", "license_id", "line_licenses"))


def oracle_sql() -> str:
    """DuckDB SQL of ``scanned`` over documents with the built-in texts."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"

    def lines(text: str) -> str:
        t = f"regexp_replace(lower({text}), {quoted(COPYRIGHT_LINE)}, '', 'g')"
        for pattern, spelling in SPELLINGS:
            t = f"regexp_replace({t}, {quoted(pattern)}, {quoted(spelling.replace('$', chr(92)))}, 'g')"
        return f"regexp_replace({t}, '[^\\p{{L}}\\p{{N}}\n]+', ' ', 'g')"

    whole = "sha256(trim(regexp_replace(l, '[ \n]+', ' ', 'g')))"
    values = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in titled())
    digested = ", ".join(f"({quoted(d)}, {quoted(n)})" for d, n in DIGESTS.items())
    return f"""
WITH known(license_id, text) AS (VALUES {values}),
     k AS (SELECT digest, min(license_id) AS license_id
           FROM (SELECT {whole} AS digest, license_id FROM (SELECT license_id, {lines("text")} AS l FROM known)
                 UNION ALL SELECT * FROM (VALUES {digested}) AS v(digest, license_id)) GROUP BY 1),
     d AS (SELECT doc_id, l, {whole} AS canonical_sha256
           FROM (SELECT doc_id, {lines("coalesce(text, '')")} AS l FROM documents)),
     x AS (SELECT DISTINCT canonical_sha256, license_id
           FROM (SELECT canonical_sha256, sha256(trim(unnest(string_split(l, '\n')), ' ')) AS digest FROM d)
           JOIN k USING (digest)),
     y AS (SELECT canonical_sha256, string_agg(license_id, ',' ORDER BY license_id) AS line_licenses FROM x GROUP BY 1)
SELECT doc_id, canonical_sha256, license_id, line_licenses
FROM d LEFT JOIN k ON digest = canonical_sha256 LEFT JOIN y USING (canonical_sha256)
"""
