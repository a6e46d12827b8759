"""Licence texts by canonical digest: whole texts are normalised, hashed and looked up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Short public licence texts, the statements by which texts are put under a
#: licence, and spellings that count as equal.
KNOWN_LICENSES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
}
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_3 = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
KNOWN_LICENSES |= {"BSD-2-Clause": _BSD_2 + _BSD_END, "BSD-3-Clause": _BSD_2 + _BSD_3 + _BSD_END}
KNOWN_STATEMENTS = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
}
EQUIVALENT = (("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("per cent", "percent"), ("copyright owner", "copyright holder"), ("favour", "favor"), ("acknowledgement", "acknowledgment"), ("organisation", "organization"), ("whilst", "while"), ("wilful", "willful"), ("fulfilment", "fulfillment"))
#: A line that only states who holds the copyright: a mark, a year or "by" follows the word, or a year
#: ends the line. Wrapped licence prose that starts with the word stays. Lower case.
COPYRIGHT_LINE = (
    r"(?m)^[^a-z0-9\n]*(?:copyright[ \t:,.]*(?:\(c\)|©|(?:19|20)[0-9]{2}\b|[\[<{(]?year\b|by )[^\n]*|copyright [^\n]*\b(?:19|20)[0-9]{2}[^a-z0-9\n]*(?:all rights reserved[^a-z0-9\n]*)?"
    r"|(?:\(c\)|©)[^\n]*|all rights reserved[^a-z0-9\n]*)$"
)
#: A heading with the licence's name above the text, up to the first character of what follows. Lower case.
TITLE_LINE = r'^[\s#*=-]*(?:the )?(?:mit|isc|0bsd|(?:zero|[0-3])[ -]clause bsd|bsd (?:zero|[0-3])[ -]clause|bsd)(?: "[^"\n]*"(?: or "[^"\n]*")*)? licen[cs]e(?: \([^)\n]*\))?[ \t\r:*=-]*\n\s*([^ \t\r\n\f])'
#: Quotes, dashes and blanks beyond ASCII; they count as those of ASCII.
TYPOGRAPHIC = "\u00a0\u00ab\u00bb\u2000-\u206f\u3000\ufeff"
MARKS = {"\u201c": '"', "\u201d": '"', "\u00a0": " ", "\ufeff": " "}


def canonical(text: Column) -> Column:
    """Lower case without heading, copyright lines, punctuation and repeated blanks, equivalent words spelled alike. Null: empty.

    Punctuation is that of ASCII and its typographic forms, blanks any. A line that reserves all rights counts as a copyright line.
    """
    lower = F.translate(F.lower(F.coalesce(text, F.lit(""))), "".join(MARKS), "".join(MARKS.values()))
    lower = F.regexp_replace(F.regexp_replace(lower, TITLE_LINE, "$1"), COPYRIGHT_LINE, "")
    words = F.trim(F.regexp_replace(lower, rf"[\x00-/:-@\[-`{{-\x7f{TYPOGRAPHIC}]+", " "))
    return reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), EQUIVALENT, words)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(licenses: DataFrame) -> DataFrame:
    """(digest, license) of ``licenses(license, text)``; of equal texts the first name."""
    return licenses.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license").alias("license"))


def built_in(spark: SparkSession) -> DataFrame:
    rows = [*KNOWN_LICENSES.items(), *KNOWN_STATEMENTS.items()]
    return spark.createDataFrame(rows, "license string, text string")


def scan(docs: DataFrame, licenses: DataFrame) -> DataFrame:
    """(doc_id, digest, license, line_licenses) for each row of ``docs(doc_id, text)``.

    ``license`` is the known licence whose canonical text the whole text has, else null;
    ``line_licenses`` are the names of those that a whole line of it has, sorted and comma-joined,
    empty for none. Null text is empty; empty texts and lines match nothing unless an empty text is
    known. Rows are joined by digest and the known table is not assumed to be small; of the lines
    only those that match anything are shuffled where it is. Lines know their row by its id and the
    digest of the text as it stands, so that the canonical form of a text is made once only.
    """
    known = known_digests(licenses)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("raw", F.sha2("text", 256))
    rows = texts.select("doc_id", "raw", digest(F.col("text")).alias("digest"))
    lines = texts.select("doc_id", "raw", F.explode(F.array_distinct(F.split("text", "\n"))).alias("text")).select("doc_id", "raw", F.coalesce(digest(F.col("text")), F.lit("")).alias("line"))
    found = lines.join(known, lines["line"] == known["digest"]).select("doc_id", "raw", "license").distinct()
    names = found.groupBy(F.col("doc_id").alias("_id"), F.col("raw").alias("_raw")).agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("names"))
    out = rows.join(known, "digest", "left").join(names, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("raw") == F.col("_raw")), "left")
    return out.select("doc_id", "digest", "license", F.coalesce("names", F.lit("")).alias("line_licenses"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences by the digests of each whole text and of its lines."""
    return scan(table(spark, sf_dir, "documents"), built_in(spark))


def _sql() -> str:
    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    lower = f"translate(lower(coalesce(text, '')), {text(''.join(MARKS))}, {text(''.join(MARKS.values()))})"
    plain = f"regexp_replace(regexp_replace({lower}, {text(TITLE_LINE)}, '\\1'), {text(COPYRIGHT_LINE)}, '', 'g')"
    out = rf"trim(regexp_replace({plain}, '[\x00-/:-@\[-`{{-\x7f{TYPOGRAPHIC}]+', ' ', 'g'))"
    for a, b in EQUIVALENT:
        if a != b:
            out = f"replace({out}, '{a}', '{b}')"
    rows = ", ".join(f"({text(k)}, {text(v)})" for d in (KNOWN_LICENSES, KNOWN_STATEMENTS) for k, v in d.items())
    return f"""
    WITH k AS (SELECT sha256({out}) AS digest, min(license) AS license FROM (VALUES {rows}) v(license, text) GROUP BY 1),
    d AS (SELECT doc_id, sha256({out}) AS digest FROM documents),
    l AS (SELECT DISTINCT doc_id, sha256({out}) AS digest FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS text FROM documents)),
    n AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS names FROM l JOIN k USING (digest) GROUP BY doc_id)
    SELECT doc_id, d.digest, license, coalesce(names, '') AS line_licenses FROM d LEFT JOIN k USING (digest) LEFT JOIN n USING (doc_id)
    """


ORACLE_SQL = _sql()
