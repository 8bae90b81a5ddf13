"""Licence scan by canonical digests.

A text is put into canonical form (lower case, copyright lines dropped,
equivalent spellings made equal, everything but letters and digits turned
into single spaces), hashed whole, and joined by hash to the digests of known
licence texts. The same lookup over the lines of a text finds licence
notices that stand alone on a line.

Native: regular expressions and a hash join; the known side is the fixed
table below, whose size does not depend on the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts of public licences and of their usual notices.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
ZERO_BSD = ISC.replace("""is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.""", "is hereby granted.")
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""

LICENSES: tuple[tuple[str, str], ...] = (
    ("MIT", MIT),
    ("MIT", "MIT License\n\n" + MIT),
    ("MIT", "The MIT License (MIT)\n\n" + MIT),
    ("ISC", ISC),
    ("ISC", "ISC License\n\n" + ISC),
    ("0BSD", ZERO_BSD),
    ("Zlib", ZLIB),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("Apache-2.0", APACHE_HEADER),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This work is licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Released under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "Released under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)

# Spellings that count as equal, applied in this order to lower-cased words.
SPELLINGS: tuple[tuple[str, str], ...] = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("sub license", "sublicense"), ("non infringement", "noninfringement"), ("acknowledgement", "acknowledgment"),
    ("favour", "favor"), ("organisation", "organization"), ("per cent", "percent"), ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"), ("gnu gpl", "gnu general public license"), ("v2 0", "version 2 0"),
    ("v3", "version 3"), ("version 3 0", "version 3"), ("and or", "or"), ("https", "http"),
)
COPYRIGHT_LINE = (
    r"(?m)^[^\n]{0,40}?(?:copyright|\(c\)|©)[ \t,:]*(?:\(c\)|©)?[ \t,:]*[0-9]{4}[^\n]*$"
    r"|^[ \t]*all rights reserved\.?[ \t]*$")
SEPARATORS = r"[^a-z0-9\x{80}-\x{10FFFF}]+"
NOTICE_LINE = "(?i)licen[sc]|released under"  # every notice of LICENSES matches
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(text: Column) -> Column:
    """Canonical form of a text; a null text is an empty one."""
    out = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), COPYRIGHT_LINE, "")
    out = F.concat(F.lit(" "), F.regexp_replace(out, SEPARATORS, " "), F.lit(" "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(F.regexp_replace(out, " +", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_digests(spark: SparkSession, licenses: tuple[tuple[str, str], ...] = LICENSES) -> DataFrame:
    """(digest, license), one row per digest; as many rows as the fixed table has texts."""
    rows = spark.createDataFrame(list(licenses), "license string, text string")
    return rows.select(digest(F.col("text")).alias("digest"), "license").groupBy("digest").agg(F.min("license").alias("license"))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         licenses: tuple[tuple[str, str], ...] = LICENSES) -> DataFrame:
    """(id, digest, license, notices), one row per input row.

    ``license``: the licence whose text the whole text is (null: none).
    ``notices``: the licences of notice lines, sorted, comma-separated (empty: none).
    Null and empty texts match nothing; ids may be null or repeated.
    """
    known = known_digests(df.sparkSession, licenses)
    lookup = F.create_map(*[F.lit(x) for r in known.collect() for x in r])
    lines = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), "\n"), lambda x: x.rlike(NOTICE_LINE))
    notices = F.array_sort(F.array_distinct(F.array_compact(F.transform(lines, lambda x: F.try_element_at(lookup, digest(x))))))
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).select(
        "id", digest(F.col("text")).alias("digest"), F.array_join(notices, ",").alias("notices"))
    return docs.join(F.broadcast(known), "digest", "left").select("id", "digest", "license", "notices")


def op3_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return scan(docs).withColumnRenamed("id", "doc_id")


def _canonical_sql(text: str) -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    out = f"regexp_replace(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), {quoted(COPYRIGHT_LINE)}, '', 'g')"
    out = f"' ' || regexp_replace({out}, {quoted(SEPARATORS)}, ' ', 'g') || ' '"
    for old, new in SPELLINGS:
        out = f"replace({out}, {quoted(f' {old} ')}, {quoted(f' {new} ')})"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"


def oracle_sql() -> str:
    values = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in row)) for row in LICENSES)
    return f"""
WITH known AS (
  SELECT sha256({_canonical_sql('t')}) AS digest, min(l) AS license FROM (VALUES {values}) v(l, t) GROUP BY 1),
lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
found AS (
  SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
  FROM (SELECT doc_id, sha256({_canonical_sql('line')}) AS digest FROM lines
        WHERE regexp_matches(line, '{NOTICE_LINE}')) x JOIN known USING (digest) GROUP BY 1),
docs AS (SELECT doc_id, sha256({_canonical_sql('text')}) AS digest FROM documents)
SELECT doc_id, digest, license, coalesce(notices, '') AS notices
FROM docs LEFT JOIN known USING (digest) LEFT JOIN found USING (doc_id)"""
