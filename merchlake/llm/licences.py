"""Licence scan by canonical digest.

A text is brought to a canonical form: lower case, no copyright lines,
punctuation and white space as one space, equivalent spellings made one. Its
digest is hash-joined to the digests of known licence texts, which are brought
to the same form. The same is done for every line on its own, so that a notice
inside a longer document is found as well. Only built-in functions are used.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.functions.joins import checked_broadcast

# Words of equal meaning in licence texts (pattern of a whole word, its one spelling).
SPELLINGS = [
    (r"(sub)?licence(s|d|e|es)?", r"\1license\2"),
    (r"(acknowledg|judg)ement(s)?", r"\1ment\2"),
    (r"(author|categor|emphas|initial|maxim|minim|optim|organ|real|recogn|util|summar|character)is(e|ed|es|ing|ation|ations)",
     r"\1iz\2"),
    (r"(analy)s(e|ed|es|ing)", r"\1z\2"),
    (r"(catalog|analog)ue(s)?", r"\1\2"),
    (r"(fav|lab|behavi|col)our(s|ed|ing|ite|able)?", r"\1or\2"),
    (r"(cent)re(s)?", r"\1er\2"),
    (r"(offen|defen)ce(s)?", r"\1se\2"),
    (r"(practi)s(e|ed|es|ing)", r"\1c\2"),
    (r"artefact(s)?", r"artifact\1"),
    (r"programme(s)?", r"program\1"),
    (r"(cancel|model|label|signal)l(ed|ing)", r"\1\2"),
    (r"fulfil(ment)?", r"fulfill\1"),
    (r"whilst", r"while"),
    (r"wilful(ly)?", r"willful\1"),
    (r"https", r"http"),
]
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright|\(c\)|©)[^\n]*$"
SEPARATORS = r"[^\p{L}\p{N}]+"
# The same inside a line, but for a single blank, which stays what it is.
SEPARATORS_IN_LINE = r" ?[^\p{L}\p{N}\n ][^\p{L}\p{N}\n]*| {2,}"

def _outcomes() -> re.Pattern:
    """Matches every word that a replacement may bring about."""
    words = []
    for pattern, spelling in SPELLINGS:
        for number, group in enumerate(re.findall(r"\([^)]*\)\??", pattern), start=1):
            spelling = spelling.replace(f"\\{number}", group)
        words.append(spelling)
    return re.compile("|".join(f"(?:{w})" for w in words))


# Licence notices and short licences, by SPDX id.
_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above "
    "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    'Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE."
)
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution.\n\n"
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n\n"
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_APACHE_NOTICE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
    "the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required "
    "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
    "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
    "language governing permissions and limitations under the License."
)
KNOWN = [
    ("MIT", "MIT License\n\n" + _GRANT),
    ("MIT", _GRANT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_END),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted.\n\n" + _ISC_END),
    ("BSD-2-Clause", _BSD_TWO + _BSD_END),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", _BSD_TWO + _BSD_THIRD + _BSD_END),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("Apache-2.0", _APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
]


def with_canonical_lines(rows: DataFrame, low: str) -> DataFrame:
    """Add `_lines`: the canonical form of every line of the lower-case text in column `low`.

    Words are parted by one blank, lines stay parted; NULL stays NULL. Every step
    is a column of its own, so that none is computed twice.
    """
    text = F.col(low)
    has_notice = text.contains("copyright") | text.contains("(c)") | text.contains("©")
    body = F.when(has_notice, F.regexp_replace(text, COPYRIGHT_LINE, " ")).otherwise(text)
    words = F.trim(F.regexp_replace("_body", SEPARATORS_IN_LINE, " "))
    # Few texts hold one of the words to be replaced; only these go through all replacements.
    some = f"(^|[ \\n])({'|'.join(p for p, _ in SPELLINGS)})([ \\n]|$)"
    # Words then stand between two blanks each, so that neighbours can both be replaced.
    apart = F.concat(F.lit(" "), F.replace(F.replace("_words", F.lit(" "), F.lit("  ")), F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    for pattern, spelling in SPELLINGS:
        groups = spelling.replace("\\2", "$2").replace("\\1", "$1")
        apart = F.regexp_replace(apart, f" {pattern} ", f" {groups} ")
    respelled = F.when(F.col("_words").rlike(some), F.regexp_replace(apart, " +", " ")).otherwise(F.col("_words"))
    return rows.withColumn("_body", body).withColumn("_words", words).withColumn("_lines", respelled).drop("_body", "_words")


def one_line(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, "[ \n]+", " "))


def may_match(low: Column, known: list[str]) -> Column:
    """False only for lower-case texts in which no line, nor the whole, can be one of the known texts.

    A text that equals a known one in canonical form holds each of its words; up
    to four of them, the longest that no replacement brings about, are looked for.
    """
    respelled, wanted = _outcomes(), set()
    for text in known:
        body = re.sub(COPYRIGHT_LINE, " ", text.lower())
        words = {w for w in re.findall(r"(?<![^\W_])[a-z0-9]{2,}(?![^\W_])", body) if not respelled.fullmatch(w)}
        wanted.add(tuple(sorted(words, key=lambda w: (-len(w), w))[:4]))
    some = F.lit(False)
    for words in sorted(wanted):
        every = F.lit(True)
        for word in words:
            every = every & low.contains(word)
        some = some | every
    return some


def known_licences(spark: SparkSession) -> DataFrame:
    """licence_id, text of the licences that come with the library."""
    return spark.createDataFrame(KNOWN, "licence_id string, text string")


def scan_licences(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, licence_id, notice_ids, n_notice_lines.

    licence_id is the licence whose known text equals the whole text in
    canonical form, else NULL (of several the first by name); notice_ids are the
    licences whose known text equals a line, sorted, without repetition;
    n_notice_lines counts such lines. `known` has the columns licence_id and text
    and defaults to known_licences(); it is the caller's reference table, of
    which the driver reads the texts. A NULL or empty text, or one without letters
    and digits, matches nothing. Repeated rows and NULL ids are kept. An empty
    table gives an empty result. Other input columns, whatever their names, are
    not read.
    """
    known = known_licences(docs.sparkSession) if known is None else known
    nothing = F.sha2(F.lit(""), 256)
    forms = with_canonical_lines(known.select("licence_id", F.lower(F.coalesce("text", F.lit(""))).alias("_low")), "_low")
    digests = (
        forms.select(F.col("licence_id").alias("_licence"), F.sha2(one_line(F.col("_lines")), 256).alias("_digest"))
        .where(F.col("_digest") != nothing)
        .groupBy("_digest")
        .agg(F.min("_licence").alias("_licence"))
    )
    digests = checked_broadcast(digests)
    candidate = may_match(F.col("_low"), [r["text"] or "" for r in known.select("text").collect()])
    content = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].alias("doc_id"), F.xxhash64(content).alias("_hash"), F.lower(content).alias("_low"))
    rows = with_canonical_lines(rows.withColumn("_low", F.when(candidate, F.col("_low"))), "_low").drop("_low")
    # Unit 0 is the whole text, the others are its lines; texts that cannot match have unit 0 alone, without a form.
    units = F.concat(F.array(F.regexp_replace("_lines", "[ \n]+", " ")), F.split("_lines", "\n"))
    rows = rows.select("doc_id", "_hash", F.posexplode(F.coalesce(units, F.array(F.lit(None)))).alias("_unit", "_form"))
    rows = rows.select("doc_id", "_hash", "_unit", F.sha2(F.trim("_form"), 256).alias("_own"))
    is_whole = F.col("_unit") == 0
    found = rows.join(digests, F.col("_own") == F.col("_digest"), "left").where(is_whole | F.col("_licence").isNotNull())
    # Equal rows come together here and are parted again; a set, as each of them brings the same lines.
    grouped = found.groupBy("doc_id", "_hash").agg(
        F.count_if(is_whole).alias("_rows"),
        F.max(F.when(is_whole, F.col("_licence"))).alias("licence_id"),
        F.collect_set(F.when(~is_whole, F.struct("_unit", "_licence"))).alias("_found"),
    )
    grouped = grouped.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))))
    return grouped.select(
        "doc_id",
        "licence_id",
        F.sort_array(F.array_distinct(F.col("_found._licence"))).alias("notice_ids"),
        F.size("_found").cast("long").alias("n_notice_lines"),
    )
