"""Licence scan: canonical digests of whole texts, looked up by hash join.

A text is normalised so that copies of a licence that differ only in case,
punctuation, white space, copyright lines or equivalent spellings come out
the same; the SHA-256 of the result is joined with the digests of known
licences.  The same lookup runs on the single lines of a text, which finds
the short notices ("Released under the MIT License.").

All of it is built-in column functions and equi-joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_broadcast

# Spellings that count as the same, applied in this order to
# lower-case text in which every run of ASCII punctuation and white space is
# one space and which starts and ends with a space.
EQUIVALENT = [
    (" sub licen[cs]e", " sublicense"),
    (" (sub|)licence", " $1license"),
    (" acknowledgement", " acknowledgment"),
    (" analog(ue)? ", " analog "),
    (" cent(er|re)(s?) ", " center$2 "),
    (" copyright (owner|holder)(s?) ", " copyright holder$2 "),
    (" favou?r", " favor"),
    (" fulfil(l?)(ment|s|ed|) ", " fulfill$2 "),
    (" https ", " http "),
    (" judgement", " judgment"),
    (" non commercial", " noncommercial"),
    (" organi[sz]ation", " organization"),
    (" per cent ", " percent "),
    (" whilst ", " while "),
    (" wilful", " willful"),
]

# Lines that only state a copyright.
COPYRIGHT_LINE = r"(^|\n)[ \t#*/;-]*(copyright|\(c\)|©|all rights reserved)[^\n]*"

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted"""

_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

_BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution."""

_BSD_3RD = """3. Neither the name of the copyright holder nor the names of its contributors
may be used to endorse or promote products derived from this software without
specific prior written permission."""

_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

# Licence texts and notices (id, text).
KNOWN = [
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice\n"
     "appear in all copies.\n\n" + _ISC_END),
    ("0BSD", _ISC_GRANT + ".\n\n" + _ISC_END),
    ("BSD-2-Clause", _BSD2 + "\n\n" + _BSD_END),
    ("BSD-3-Clause", _BSD2 + "\n\n" + _BSD_3RD + "\n\n" + _BSD_END),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
]


# Any spelling of the table (all begin with a space); a text without one needs
# none of its replacements.
_ANY_SPELLING = " (?:" + "|".join(pattern[1:] for pattern, _ in EQUIVALENT) + ")"


def _respelled(t: Column) -> Column:
    for pattern, repl in EQUIVALENT:
        t = F.regexp_replace(t, pattern, repl)
    return t


def canonical(text: Column) -> Column:
    """Canonical form of a text; null reads as empty.

    The plain form is bound to a lambda's variable, so that it is worked out
    once a text although it is looked at three times."""
    t = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    t = F.regexp_replace(t, COPYRIGHT_LINE, " ")
    t = F.regexp_replace(F.concat(F.lit(" "), t, F.lit(" ")), r"[\x00-\x2F:-@\[-`{-\x7F]+", " ")
    respelled = F.transform(F.array(t), lambda x: F.when(x.rlike(_ANY_SPELLING), _respelled(x)).otherwise(x))
    return F.trim(F.element_at(respelled, 1))


def digest(text: Column) -> Column:
    """SHA-256 (hex) of the canonical form.  Never null, so that a join on it
    needs no filter that would work it out a second time."""
    return F.coalesce(F.sha2(canonical(text), 256), F.lit(""))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """(digest, license_id), one row per digest; of several ids with one
    canonical text the smallest stays.  Texts that come out empty are no
    licence.  `known` may be a table (license_id, text) of any size."""
    if not isinstance(known, DataFrame):
        known = spark.createDataFrame(known or KNOWN, "license_id string, text string")
    return (known.select(digest(F.col("text")).alias("digest"), "license_id")
            .where(F.col("digest") != F.sha2(F.lit(""), 256)).groupBy("digest").agg(F.min("license_id").alias("license_id")))


def scan_texts(docs: DataFrame, known: DataFrame, text: str = "text", to: str = "license_id") -> DataFrame:
    """`docs` with the column `to`: the licence whose whole text the row's
    whole text is, or null.  Every row stays once, whatever its other columns
    are called (a column named `to` is replaced); null and empty texts match
    nothing.  A known table above the broadcast bound is joined by shuffle,
    where AQE splits a hot digest (its other side is one row)."""
    mark = "__licence_digest"
    k = bounded_broadcast(known.select(F.col("digest").alias(mark), F.col("license_id").alias("__licence_id")))
    out = docs.withColumn(mark, digest(F.col(text))).join(k, mark, "left")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c != to], F.col("__licence_id").alias(to))


def scan_lines(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, license_id, n_lines): known notices found as single lines of the
    texts, with how often.  Rows with equal keys count together; a null key
    is a key of its own; null and empty texts have no line to match."""
    lines = docs.select(F.col(key).alias("key"), F.explode(F.split(F.col(text), "\n", -1)).alias("line"))
    hit = lines.select("key", digest(F.col("line")).alias("digest")).join(bounded_broadcast(known), "digest")
    return hit.groupBy(F.col("key").alias(key), "license_id").agg(F.count(F.lit(1)).alias("n_lines"))
