"""License scans: sparse TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest ancestor directory.

Four kinds of units of every file are compared with the templates: the whole text, its header (the comment and empty lines
it begins with), its blocks (cut where a line without letters and digits stands) and its statements (lines, cut at sentence
ends).  The templates are notices, headers and whole texts; so a licence text is found without its title, a header over
several lines as one vector, and a one-line notice inside a long text.  A term weighs (1 + ln of its count) times its
idf, counted over all files; terms outside the templates' vocabulary only add to a unit's length, with the weight of the
rarest term.  A unit whose shared terms can't lift its cosine to the threshold, however often they occur, is not scored;
by the inequality of Cauchy and Schwarz that loses none, and a file that fails it as a whole fails it in all units.

A file's licence is that of its best unit; a template of ``FALLBACK`` ("All rights reserved") counts only where no other
template reaches the threshold.  A licence file's licence is that of its directory, and files without one of their own take
that of their nearest ancestor directory, found by joins on path prefixes: directories are resolved first, once each, then
files join their directory.

Everything is DataFrame expressions.  Templates are a parameter of bounded size (``MAX_TEMPLATES``).  Very long texts
are one array of terms in their row; an empty or null one has no unit.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textlane.llm.common import lines_of, order_hash, spread, text_of

THRESHOLD = 0.6
MAX_TEMPLATES = 1000
#: Licences that only count where no other is found.
FALLBACK = ("LicenseRef-Proprietary",)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
    "PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
    "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. ")
_BSD_NAME = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. ")
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS "
    "IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
    "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the "
    "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
    "applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
    "governing permissions and limitations under the License.")
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by "
    "the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
#: Notices, headers and whole texts of well-known licences by their public identifiers.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT license"),
    ("MIT", _MIT),
    ("ISC", _ISC),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_END),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_NAME + _BSD_END),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0-only", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0-or-later", _GNU.format("General Public License", 2)),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0-only", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0-or-later", _GNU.format("General Public License", 3)),
    ("AGPL-3.0-only", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0-or-later", _GNU.format("Affero General Public License", 3)),
    ("LGPL-3.0-only", "Licensed under the GNU Lesser General Public License, version 3"),
    ("LGPL-3.0-only", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0-or-later", _GNU.format("Lesser General Public License", 3)),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, v. 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC0-1.0", "Released into the public domain under CC0 1.0"),
    ("LicenseRef-Proprietary", "All rights reserved"),
]
#: Terms are what stands between runs of ASCII characters other than letters and digits.
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_STATEMENT_END = r"\n|[.;!?](?=\s|$)"
#: Between two blocks: separators with two line ends.  A line of a header: a comment's, or one of white space.
BLOCK_END = r"\n[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\n"
COMMENT = r"^[\x20\x09-\x0D]*(?://|/\*|\*|#|--|;|%|<!--|$)"


def terms(text: Column) -> Column:
    """Lower-cased terms in order, with empty strings where the text begins or ends in separators."""
    return F.split(F.lower(text), SEPARATOR, -1)


def term_weights(known: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """Smooth idf of each vocabulary term over all files (a row's ``known`` terms each), under ``""`` of one found nowhere."""
    rows = known.select(F.explode(F.concat("known", F.array(F.lit("")))).alias("term"))
    counts = {r.term: r.n for r in rows.groupBy("term").agg(F.count("*").alias("n")).collect()}   # a row per vocabulary term
    n = counts.get("", 0)
    return {t: math.log((n + 1) / (counts.get(t, 0) + 1)) + 1 for t in vocabulary} | {"": math.log((n + 1) / 2) + 1}


def unit_vectors(texts: list[list[str]], weights: dict[str, float]) -> list[dict[str, float]]:
    """A unit vector per template's terms."""
    out = []
    for found in texts:
        v = {t: (1 + math.log(found.count(t))) * weights[t] for t in found}
        length = math.sqrt(sum(x * x for x in v.values()))
        out.append({t: x / length for t, x in v.items()})
    return out


def header(text: Column) -> Column:
    """The comment and empty lines that the text begins with."""
    end = F.array_position(F.transform(lines_of(text), lambda x: ~x.rlike(COMMENT)), True)
    return F.array_join(F.when(end > 0, F.slice(lines_of(text), F.lit(1), F.greatest(end - 1, F.lit(0)).cast("int"))).otherwise(lines_of(text)), "\n")


def units(files: DataFrame) -> DataFrame:
    """file and terms (in order) of the whole text, the header, the blocks and the statements of every file."""
    text = text_of()
    parts = F.concat(F.array(text, header(text)), F.split(text, BLOCK_END, -1), F.split(text, _STATEMENT_END, -1))
    rows = files.select("file", F.explode(F.array_distinct(parts)).alias("unit"))
    return rows.select("file", F.array_remove(terms(F.col("unit")), "").alias("terms"))


def notices(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD,
            fallback: tuple[str, ...] = FALLBACK) -> DataFrame:
    """file, license, score: the licence of the best unit of every file that reaches the threshold (files: file, text).

    Of equal scores the least license wins.  Licences of ``fallback`` count only where no other reaches the threshold.
    """
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    spark = files.sparkSession
    # The templates' terms, by the same expression as the files' terms (bounded rows).
    cut = {r.text: r.terms for r in spark.createDataFrame(templates, "name string, text string")
           .select("text", F.array_remove(terms(F.col("text")), "").alias("terms")).collect()}
    vocabulary = sorted({t for v in cut.values() for t in v})
    all_known = F.array(*[F.lit(t) for t in vocabulary])
    weights = term_weights(files.select(F.array_intersect(terms(text_of()), all_known).alias("known")), vocabulary)
    vectors = unit_vectors([cut[text] for _, text in templates], weights)

    # Squares that each term adds to the templates: a unit's cosine is at most the root of the sum over its terms.
    # One literal (folded once per plan) instead of an expression per number.
    squares = F.from_json(F.lit(json.dumps({t: [v.get(t, 0.0) ** 2 for v in vectors] for t in vocabulary})), "map<string,array<double>>")
    none = F.lit([0.0] * len(vectors))

    def reaches(found: Column) -> Column:
        total = F.aggregate(found, none, lambda acc, t: F.zip_with(acc, F.try_element_at(squares, t), lambda a, b: a + b))
        return F.array_max(total) >= threshold * threshold - 1e-9

    # Terms are cut a second time rather than texts shuffled to a list of files: this filter stays in the scan.
    candidates = files.filter(reaches(F.array_intersect(terms(text_of()), all_known)))
    rows = units(candidates).filter(reaches(F.array_intersect("terms", all_known)))
    # Distinct units are scored once; the hot ones meet in the partial aggregation.
    rows = spread(rows.withColumn("key", F.md5(F.array_join("terms", " "))), "units")
    distinct = rows.groupBy("key").agg(F.first("terms").alias("terms"))
    bag = distinct.select("key", F.explode("terms").alias("term")).groupBy("key", "term").agg(F.count("*").alias("tf"))
    idf = spark.createDataFrame([(t, weights[t]) for t in vocabulary], "term string, idf double")
    bag = bag.join(F.broadcast(idf), "term", "left").select(   # the templates' vocabulary, bounded
        "key", "term", ((1 + F.log("tf")) * F.coalesce("idf", F.lit(weights[""]))).alias("w"))
    pairs = spark.createDataFrame([(k, name, name in fallback, t, x) for k, ((name, _), v) in enumerate(zip(templates, vectors, strict=True))
                                   for t, x in v.items()], "template int, license string, last boolean, term string, x double")
    length = bag.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dot = (bag.join(F.broadcast(pairs), "term")   # templates x terms, bounded
           .groupBy("key", "template", "license", "last").agg(F.sum(F.col("w") * F.col("x")).alias("dot")))
    best = F.min_by("best", F.struct("best.last", -F.col("best.score"), "best.license")).alias("best")
    scored = (dot.join(length, "key").withColumn("score", F.round(F.col("dot") / F.col("length"), 9))
              .filter(F.col("score") >= threshold).select("key", F.struct("last", "license", "score").alias("best"))
              .groupBy("key").agg(best))
    found = rows.select("file", "key").join(scored, "key").groupBy("file").agg(best)
    return found.select("file", "best.license", "best.score", "best.last")


def directory(path: Column) -> Column:
    """The path without its last part; empty at the top."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def scan(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """path, license, score, origin and inherited_from of every file row.

    files: path, text, is_license_file; other columns are not read.  origin is ``notice`` (own unit), ``directory``
    (the nearest ancestor directory with a licence file that has a notice; inherited_from is that directory, the own one
    first) or ``none`` (license null).  In a directory with several licence files one that is no fallback wins, then the
    best score, then the least license.  Paths are parts joined by ``/``; a null path has no directory but may have a notice of its own; repeated rows
    give a row each; an empty table gives an empty one.
    """
    rows = files.select("path", text_of().alias("text"), F.coalesce("is_license_file", F.lit(False)).alias("is_license_file"))
    rows = rows.withColumn("file", order_hash(F.col("path"), F.md5("text")))
    own = spread(notices(rows, templates, threshold), "notices")
    light = spread(rows.select("path", "file", "is_license_file", directory(F.col("path")).alias("dir")), "license-files")

    given = (light.filter(F.col("is_license_file") & F.col("path").isNotNull()).join(own, "file")
             .groupBy("dir").agg(F.min_by(F.struct("license", "score"), F.struct("last", -F.col("score"), "license")).alias("given")))
    # Each directory with its ancestors, itself included: one row per part of its path.
    dirs = light.filter(F.col("path").isNotNull()).select("dir").distinct()
    parts = F.split("dir", "/", -1)
    ups = dirs.withColumn("parts", parts).withColumn("depth", F.explode(F.sequence(F.lit(0), F.size("parts"))))
    ups = ups.filter((F.col("depth") < F.size("parts")) | (F.col("dir") != "")).select(
        "dir", "depth", F.array_join(F.slice("parts", F.lit(1), F.col("depth")), "/").alias("up"))
    nearest = (ups.join(given.withColumnRenamed("dir", "up"), "up").groupBy("dir")
               .agg(F.max_by(F.struct("up", "given"), "depth").alias("from")))
    out = light.join(own, "file", "left").join(nearest, "dir", "left")
    has = F.col("license").isNotNull()
    return out.select(
        "path", F.coalesce("license", "from.given.license").alias("license"),
        F.when(has, F.col("score")).otherwise(F.col("from.given.score")).alias("score"),
        F.when(has, "notice").when(F.col("from").isNotNull(), "directory").otherwise("none").alias("origin"),
        F.when(~has, F.col("from.up")).alias("inherited_from"))


def files_of_documents(docs: DataFrame) -> DataFrame:
    """Every document as a file of a tree: source / lang / thousands / hundreds / name.

    The tables hold no paths, so they are derived from all rows.  A document with a line of at most 100 characters that
    speaks of a licence is taken as a licence file and stands in the directory of its thousand, above the others.
    """
    licence = F.exists(lines_of(text_of()), lambda x: (F.length(x) <= 100) & F.lower(x).rlike("licen[sc]e|rights reserved"))
    n = F.coalesce("doc_id", F.lit(-1))
    path = F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")), F.expr("doc_id div 1000").cast("string"),
                       F.when(~licence, F.expr("doc_id div 100").cast("string")), n.cast("string"))
    return docs.select("doc_id", path.alias("path"), "text", licence.alias("is_license_file"))
