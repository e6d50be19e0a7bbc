"""Licence scans by canonical digest lookup, with built-in functions only.

A text is brought to a canonical form (ASCII lower case, copyright lines dropped, everything but letters
and digits a blank, equivalent spellings made one), digested whole and joined by digest to known licences.
The texts looked up are every whole document and every single line of it, as a notice is one line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart.llm import licence_table
from tidemart.llm.common import let, saved

# Equivalent spellings of the public licence matching guidelines (variant, chosen form).
SPELLINGS = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("behaviour", "behavior"), ("cancelled", "canceled"),
    ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"), ("emphasised", "emphasized"),
    ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"),
    ("licence", "license"), ("licenced", "licensed"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("modelling", "modeling"), ("noncommercial", "non commercial"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"), ("owner", "holder"), ("percent", "per cent"),
    ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"),
    ("signalling", "signaling"), ("sublicence", "sublicense"), ("sub license", "sublicense"), ("utilisation", "utilization"),
    ("whilst", "while"), ("wilful", "willful"),
]

# Short licence texts and the notice lines by which documents name a licence; more come from ``licence_table``.
KNOWN = [
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS
IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but
is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software. 3. This notice may not be removed or altered from any source distribution."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Proprietary", "All rights reserved."),
]
KNOWN += licence_table.rows(KNOWN)

COPYRIGHT_LINE = r"^[^a-z0-9]*(copyright|\(c\)|©)"


def _spelled(words: Column, pairs=SPELLINGS) -> Column:
    # Two blanks between words, so neighbouring spellings do not share one.
    out = F.concat(F.lit(" "), F.replace(F.trim(words), F.lit(" "), F.lit("  ")), F.lit(" "))
    for variant, chosen in pairs:
        out = F.replace(out, F.lit(f" {variant.replace(' ', '  ')} "), F.lit(f" {chosen.replace(' ', '  ')} "))
    return F.replace(F.trim(out), F.lit("  "), F.lit(" "))


def line_forms(text: Column) -> Column:
    """The canonical form of every line of a text; a copyright line's is empty."""
    def form(line: Column) -> Column:
        low = F.lower(line)
        return F.when(low.rlike(COPYRIGHT_LINE), F.lit("")).otherwise(_spelled(F.regexp_replace(low, r"[^\p{L}\p{N}]+", " ")))

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), form)


def whole_form(forms: Column) -> Column:
    """The canonical form of a text from those of its lines; a spelling of two words may run across a line end."""
    across = [(a, b) for a, b in SPELLINGS if " " in a]
    return _spelled(F.array_join(F.filter(forms, lambda f: f != ""), " "), across)


def known_licences(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "licence string, text string")


def digests(licences: DataFrame) -> DataFrame:
    """(digest, known_licence, n_chars) of (licence, text) rows; of several names for one text the smallest."""
    form = licences.select("licence", let(line_forms(F.col("text")), whole_form).alias("form")).filter("form != ''")
    return form.groupBy(F.sha2("form", 256).alias("digest")).agg(
        F.min("licence").alias("known_licence"), F.min(F.length("form")).alias("n_chars"))


def scan_licences(docs: DataFrame, licences: DataFrame) -> DataFrame:
    """(doc_id, digest, licence, n_notices, notices) per doc_id.

    ``licence`` is what the whole text is, null if unknown; ``notices`` names the licences of its lines,
    sorted and joined by commas, ``n_notices`` counts the lines.  A text without letters or digits has a null
    digest and matches nothing.  Rows that repeat a doc_id count as one document (smallest digest, all lines).
    """
    known = saved(digests(licences))
    sizes = [r["n_chars"] for r in known.select("n_chars").distinct().collect()]  # at most the length of the longest text

    def units_of(forms: Column) -> Column:
        lines = F.filter(forms, lambda f: F.length(f).isin(sizes))  # others cannot be equal to a known form
        unit = lambda is_whole, form: F.struct(F.lit(is_whole).alias("is_whole"), form.alias("form"))
        return F.concat(F.array(unit(True, whole_form(forms))), F.transform(lines, lambda f: unit(False, f)))

    units = docs.select("doc_id", F.inline(let(line_forms(F.col("text")), units_of)))
    units = units.select("doc_id", "is_whole", F.when(F.col("form") != "", F.sha2("form", 256)).alias("digest"))
    hits = units.join(known.select("digest", "known_licence"), "digest", "left").filter("is_whole or known_licence is not null")
    notice = F.when(~F.col("is_whole"), F.col("known_licence"))
    return hits.groupBy("doc_id").agg(
        F.min(F.when(F.col("is_whole"), F.col("digest"))).alias("digest"),
        F.min(F.when(F.col("is_whole"), F.col("known_licence"))).alias("licence"),
        F.count(notice).alias("n_notices"),
        F.array_join(F.array_sort(F.collect_set(notice)), ",").alias("notices"))
