"""Licence texts found by canonical digests, with column functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brindle.session import materialize

# Texts that licences and licence notices are known by.
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including '
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions: The above copyright notice and this permission notice shall be included in all "
    'copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
    "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
    "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
    "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
    "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
    "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission. "
)
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE."
)
_APACHE_NOTICE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
    "Unless required by applicable law or agreed to in writing, software distributed under the License is "
    'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
    "See the License for the specific language governing permissions and limitations under the License."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
    "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
    "this software for any purpose, including commercial applications, and to alter it and redistribute it "
    "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
    "you must not claim that you wrote the original software. If you use this software in a product, an "
    "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
    "versions must be plainly marked as such, and must not be misrepresented as being the original software. "
    "3. This notice may not be removed or altered from any source distribution."
)
KNOWN = [
    ("MIT", _MIT),
    ("MIT", "MIT License " + _MIT),
    ("MIT", "The MIT License " + _MIT),
    ("MIT", "The MIT License (MIT) " + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC),
    ("ISC", "ISC License " + _ISC),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("0BSD", _ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-2-Clause", "BSD 2-Clause License " + _BSD_HEAD + _BSD_TAIL),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("BSD-3-Clause", "BSD 3-Clause License " + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License " + _ZLIB),
    ("Apache-2.0", _APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
]
# Spellings that count as one, replaced in this order.
SPELLINGS = [
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"),
    ("favour", "favor"),
    ("behaviour", "behavior"),
    ("honour", "honor"),
    ("judgement", "judgment"),
    ("authoris", "authoriz"),
    ("organis", "organiz"),
    ("recognis", "recogniz"),
    ("merchantibility", "merchantability"),
    ("copyright owner", "copyright holder"),
    ("https", "http"),
]
# How the line of a holder's notice begins, which differs from copy to copy of one licence.
HOLDER = r"[^\p{L}\p{N}\n©(]*(copyright[ \t]*(\(c\)|©|[0-9]{4}|:|by )|\(c\)[ \t]*[0-9]{4}|©|all rights reserved[^\p{L}\n]*$)"
# The same anywhere in a text, behind a line break, which stays.
_HOLDER_LINE = r"\n" + HOLDER.replace("$)", r"(?=\n|$))") + r"[^\n]*"
NO_WORD = r"[^\p{L}\p{N}\n]+"


def canonical_lines(text: Column) -> Column:
    """A text in lower case without holders' lines and punctuation, equivalent spellings made one.

    Words are one space apart and line breaks stay. A line that starts with a copyright sign or
    notice and a year, name or sign is emptied, as is one that says no more than that all rights are
    reserved.
    """
    lower = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\r\n?", "\n")
    kept = F.regexp_replace(F.concat(F.lit("\n"), lower), _HOLDER_LINE, "\n")
    plain = F.regexp_replace(kept, NO_WORD, " ")
    for spelling, standard in SPELLINGS:
        plain = F.replace(plain, F.lit(spelling), F.lit(standard))
    return plain


def _digest(canonical: Column) -> Column:
    return F.sha2(F.trim(F.regexp_replace(canonical, "[ \n]+", " ")), 256)


def known_digests(spark: SparkSession) -> DataFrame:
    """`license_digest, license_id, n_chars` of the known texts, a table of fixed size."""
    rows = spark.createDataFrame(KNOWN, "license_id string, known string")
    lines = canonical_lines(F.col("known"))
    digest, length = _digest(lines).alias("license_digest"), F.length(F.trim(F.regexp_replace(lines, "[ \n]+", " ")))
    return rows.groupBy(digest).agg(F.min("license_id").alias("license_id"), F.min(length).alias("n_chars"))


def digest_table(texts: DataFrame) -> DataFrame:
    """`license_digest, license_id` of a table `license_id, known` of any size; of equal texts the
    first name counts, rows without text or name are left out."""
    rows = texts.where("known is not null and license_id is not null")
    digest = _digest(canonical_lines(F.col("known"))).alias("license_digest")
    return rows.groupBy(digest).agg(F.min("license_id").alias("license_id"))


def _names(found: Column) -> Column:
    return F.coalesce(F.array_join(F.array_sort(F.array_distinct(found)), ","), F.lit(""))


def _scan_with(docs: DataFrame, known: DataFrame) -> DataFrame:
    """`scan_licenses` by joins: the digests of texts and lines move, the texts do not."""
    known = materialize(known.select("license_digest", "license_id").dropDuplicates(["license_digest"]), "digests")
    lines = F.filter(F.split("_lines", "\n"), lambda line: F.trim(line) != "")
    digested = docs.select("doc_id", canonical_lines(F.col("text")).alias("_lines")).select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        _digest(F.col("_lines")).alias("text_digest"),
        F.array_distinct(F.transform(lines, _digest)).alias("line_digests"),
    )
    rows = materialize(digested, "text-digests")  # row numbers differ from read to read
    by_line = rows.select("row", F.explode("line_digests").alias("license_digest")).join(known, "license_digest")
    hits = by_line.groupBy("row").agg(_names(F.collect_set("license_id")).alias("line_licenses"))
    whole = known.withColumnRenamed("license_digest", "text_digest")
    found = rows.drop("line_digests").join(whole, "text_digest", "left").join(hits, "row", "left")
    return found.select("doc_id", "text_digest", "license_id", F.coalesce("line_licenses", F.lit("")).alias("line_licenses"))


def scan_licenses(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """`doc_id, text_digest, license_id, line_licenses` for every row of `docs(doc_id, text, ...)`.

    `text_digest` is the SHA-256 of the whole canonical text and `license_id` the licence known by
    it, or null. `line_licenses` names the licences known by the digest of a single line, in order of
    name and with commas between, and is empty if there is none. A null text counts as empty; an
    empty text has the digest of the empty text and no licence. Repeated rows and rows without id
    give a row each.

    `known(license_digest, license_id)`, as `digest_table` makes it, may be of any size and is joined by
    hash. Without it the digests are a list fixed in the program: they are sent to every task, the
    texts never move, and only lines as long as a known text are digested.
    """
    if known is not None:
        return _scan_with(docs, known)
    known = known_digests(docs.sparkSession)
    fixed = known.collect()
    listed = F.create_map(*[c for row in fixed for c in (F.lit(row[0]), F.lit(row[1]))])
    lengths = sorted({row["n_chars"] for row in fixed})
    rows = docs.select("doc_id", canonical_lines(F.col("text")).alias("_lines"))
    # a canonical line has its words one space apart, so only its ends can make it longer than what is digested
    lines = F.filter(F.split("_lines", "\n"), lambda line: F.length(F.trim(line)).isin(lengths))
    found = F.filter(F.transform(lines, lambda line: F.element_at(listed, _digest(line))), lambda x: x.isNotNull())
    rows = rows.select(
        "doc_id",
        _digest(F.col("_lines")).alias("text_digest"),
        found.alias("_found"),
    )
    return rows.join(F.broadcast(known), rows["text_digest"] == known["license_digest"], "left").select(
        "doc_id",
        "text_digest",
        "license_id",
        _names(F.col("_found")).alias("line_licenses"),
    )
