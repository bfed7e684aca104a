"""Licence scan by canonical digests: DataFrame functions only.

A text is put into canonical form (lower case, copyright lines removed, equivalent spellings made
one, everything but letters and digits one space) and its SHA-256 is joined with the digests of
known licences. The same is done for every line, since notices stand on lines of their own;
a line's digest is only taken if a known text has its length.

One row per document with the digest and licence of its whole text, and one row per line that is a
known notice. Nothing is grouped, so repeated rows and null ids simply give their own rows. Null
texts have a null digest; empty and letterless texts have the digest of the empty text and no
licence. Known texts with equal canonical forms are one licence, the one with the smallest name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierlake.llm.common import read_table

# Names and texts of published licences and of the notices that point to them.
KNOWN = (
    (
        "MIT",
        "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        'the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "ISC License Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
        'SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "0BSD",
        "Zero-Clause BSD Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        'is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
        "THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
)

# Spellings that licence texts are compared without regard to.
SPELLINGS = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"),
    ("authorisation", "authorization"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("judgement", "judgment"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("http:", "https:"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright[ \t]+(\(c\)|©|[0-9]{4})|\(c\)[ \t]|©)[^\n]*"
SEPARATORS = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    text = F.regexp_replace(F.translate(text, UPPER, LOWER), COPYRIGHT_LINE, "")
    for spelling, usual in SPELLINGS:
        text = F.replace(text, F.lit(spelling), F.lit(usual))
    return F.trim(F.regexp_replace(text, SEPARATORS, " "))


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """``(digest, size, license_id)`` of the known texts."""
    rows = F.array(*[F.struct(F.lit(name).alias("license_id"), F.lit(text).alias("text")) for name, text in known])
    texts = spark.range(1).select(F.explode(rows).alias("k")).select("k.license_id", canonical(F.col("k.text")).alias("text"))
    return texts.groupBy(F.sha2("text", 256).alias("digest"), F.length("text").alias("size")).agg(
        F.min("license_id").alias("license_id")
    )


def scan(documents: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, scope (``text`` or ``line``), line_no, digest and license_id."""
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    # The table of known texts is a fixed list given with the code, a few rows.
    known = F.broadcast(known)
    whole = texts.select("doc_id", F.sha2(canonical(F.col("text")), 256).alias("digest")).join(
        known.select("digest", "license_id"), "digest", "left"
    )
    lines = texts.select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    formed = lines.select("doc_id", (F.col("at") + 1).alias("line_no"), canonical(F.col("line")).alias("form"))
    sized = formed.filter(F.length("form") > 0).join(known.select("size").distinct(), F.length("form") == F.col("size"), "left_semi")
    notices = sized.withColumn("digest", F.sha2("form", 256)).join(known.select("digest", "license_id"), "digest")
    return whole.select("doc_id", F.lit("text").alias("scope"), F.lit(0).alias("line_no"), "digest", "license_id").union(
        notices.select("doc_id", F.lit("line"), "line_no", "digest", "license_id")
    )


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"), known_digests(spark))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    text = f"regexp_replace(translate({text}, '{UPPER}', '{LOWER}'), {_quoted(COPYRIGHT_LINE)}, '', 'g')"
    for spelling, usual in SPELLINGS:
        text = f"replace({text}, {_quoted(spelling)}, {_quoted(usual)})"
    return f"trim(regexp_replace({text}, {_quoted(SEPARATORS)}, ' ', 'g'), ' ')"


ORACLE = f"""
WITH known AS (
  SELECT sha256(form) AS digest, min(license_id) AS license_id FROM (
    SELECT license_id, {_canonical_sql("text")} AS form
    FROM (VALUES {", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in KNOWN)}) v(license_id, text)
  ) GROUP BY 1
), lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM documents
), formed AS (SELECT doc_id, line_no, {_canonical_sql("line")} AS form FROM lines)
SELECT doc_id, 'text' AS scope, 0 AS line_no, digest, license_id
FROM (SELECT doc_id, sha256({_canonical_sql("text")}) AS digest FROM documents) LEFT JOIN known USING (digest)
UNION ALL
SELECT doc_id, 'line', CAST(line_no AS INTEGER), sha256(form), license_id
FROM formed JOIN known ON known.digest = sha256(form) WHERE form <> ''
"""
