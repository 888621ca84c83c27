"""License scans: TF-IDF cosine to templates, then inheritance by directory.

Units to compare are header lines (lines with a license marker), runs of
neighbouring header lines and the whole text of licence files (by file name). Every
unit is a sparse vector of its words, weighted tf * idf, the idf of every word from
the count of all units that have it. Runs and whole texts are also compared with
full-length licence texts (``FULL_TEMPLATES``). The cosine with every template needs
the templates' words only, and they, their idf and the
template vectors are tables bounded by the templates. A file's own license is its
best unit at or over ``threshold``; a file without one takes that of the nearest
ancestor directory that holds a licence file, found by joining its ancestors' paths
with the directories' licenses.

Built-in functions only. The units are written once (a file's whole text only if its
name says licence file) and their words are counted with partial aggregation, by
unit; the idf of the ``COMMON`` most frequent words is broadcast and only the others
are joined by word, so no word is a hot key; the join by directory meets at most one row per
directory.

Defined cases: null text = empty; null path = the root directory and no licence
file; no unit over the threshold and no licensed ancestor: license null, score 0;
ties go to the template that comes first; two licence files in a directory: the
higher score, then the smaller path; repeated rows are scanned each; an empty table =
an empty result; further columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import written

THRESHOLD = 0.6
MARKER = r"(?i)\b(licen[cs]ed?|licenses|licensing|spdx|copyright|copyleft|warrant(y|ies)|all rights reserved|permission is hereby granted|redistribution)\b"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)([.-][^/]*)?$"

# Short public license notices, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work (CC0 1.0)"),
    ("Proprietary", "All rights reserved"),
)

_AS_IS = (' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A '
          "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
          "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. ")
_BSD_3 = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific "
          "prior written permission. ")
_BSD_END = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES '
            "OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
            "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
            "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY "
            "WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
# Full-length texts, compared with runs of lines and licence files only.
FULL_TEMPLATES = (
    ("MIT", "MIT License Copyright (c) Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
            '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or '
            "sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this "
            "permission notice shall be included in all copies or substantial portions of the Software." + _AS_IS),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + _BSD_3 + _BSD_END),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License '
                   "at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                   '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and '
                   "limitations under the License."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
                "either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
                "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have "
                "received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
)
COMMON = 20_000  # most frequent words whose idf is broadcast


def words(text: Column) -> Column:
    """Lower-case words; a version such as 2.0 is one word."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}]+|[0-9]+(?:\.[0-9]+)*"), F.lit(0))


def template_terms(spark: SparkSession) -> DataFrame:
    """template, license, whole (for runs and licence files only), term, tf."""
    rows = [(i, a, i >= len(TEMPLATES), b) for i, (a, b) in enumerate(TEMPLATES + FULL_TEMPLATES)]
    t = spark.createDataFrame(rows, "template int, license string, whole boolean, body string")
    return t.select("template", "license", "whole", F.explode(words(F.col("body"))).alias("term")).groupBy("template", "license", "whole", "term").agg(F.count(F.lit(1)).alias("tf"))


def license_units(files: DataFrame) -> DataFrame:
    """(file_id, path, text) -> file_id, unit, licence_file, whole, words. Unit 0 is a licence
    file's whole text; header lines count from 1, runs of neighbouring ones follow. ``whole``: not a
    single line."""
    text = F.coalesce("text", F.lit(""))
    is_file = F.coalesce(F.rlike(F.col("path"), F.lit(LICENCE_FILE)), F.lit(False))
    rows = files.select("file_id", is_file.alias("licence_file"), text.alias("text"))
    # One cheap test of the whole text spares most files the split into lines.
    rows = rows.filter(F.col("licence_file") | F.rlike("text", F.lit(MARKER)))
    marked = lambda x: F.rlike(x, F.lit(MARKER))
    every = F.split("text", r"\r\n|\r|\n", -1)
    rows = rows.withColumn("lines", F.filter(every, marked))
    # Other lines become empty, so header lines with one line break between them are neighbours.
    only = F.array_join(F.transform(every, lambda x: F.when(marked(x), x).otherwise("")), "\n")
    runs = F.filter(F.transform(F.split(only, "\n{2,}", -1), lambda x: F.regexp_replace(x, "^\n|\n$", "")), lambda x: F.contains(x, F.lit("\n")))
    runs = F.when(F.size("lines") > 1, runs).otherwise(F.array().cast("array<string>"))
    bodies = F.concat(F.array(F.when(F.col("licence_file"), F.col("text"))), F.col("lines"), runs)
    rows = rows.select("file_id", "licence_file", F.size("lines").alias("n"), F.posexplode_outer(bodies).alias("unit", "body")).filter("body is not null")
    whole = (F.col("unit") == 0) | (F.col("unit") > F.col("n"))
    return rows.select("file_id", "unit", "licence_file", whole.alias("whole"), words(F.col("body")).alias("words"))


def unit_scores(units: DataFrame) -> DataFrame:
    """Best template of each unit: file_id, unit, licence_file, license, score."""
    spark = units.sparkSession
    templates = F.broadcast(template_terms(spark))  # bounded by TEMPLATES
    key = ["file_id", "unit", "licence_file", "whole"]
    n = units.count()
    terms = units.withColumn("row", F.monotonically_increasing_id()).select("row", *key, F.explode("words").alias("term"))
    tf = written(terms.groupBy("row", *key, "term").agg(F.count(F.lit(1)).alias("tf")), "license-terms")
    weigh = F.log((F.lit(n) + 1.0) / (F.col("df") + 1.0)) + 1.0
    dfs = written(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "license-words")
    known = templates.select("term").distinct()
    idf = F.broadcast(known.join(dfs, "term", "left").select("term", (F.log((F.lit(n) + 1.0) / (F.coalesce("df", F.lit(0)) + 1.0)) + 1.0).alias("idf")))
    often = F.broadcast(written(dfs.orderBy(F.desc("df"), "term").limit(COMMON), "license-common"))
    rare = dfs.join(often.select("term"), "term", "left_anti")
    squares = tf.join(often, "term").select("row", (F.col("tf") * weigh).alias("w"))
    squares = squares.unionByName(tf.join(often.select("term"), "term", "left_anti").join(rare, "term").select("row", (F.col("tf") * weigh).alias("w")))
    norm = squares.groupBy("row").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    weights = templates.join(idf, "term").select("template", "license", F.col("whole").alias("for_whole"), "term", (F.col("tf") * F.col("idf")).alias("tw"))
    norms = weights.groupBy("template").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tnorm"))
    weights = F.broadcast(weights.join(norms, "template"))
    inside = tf.join(idf, "term").select("row", *key, "term", (F.col("tf") * F.col("idf")).alias("w"))
    dots = (inside.join(weights, "term").filter(F.col("whole") | ~F.col("for_whole"))
            .groupBy("row", *key, "template", "license", "tnorm").agg(F.sum(F.col("w") * F.col("tw")).alias("dot")))
    scored = dots.join(norm, "row").select("row", *key, "template", "license", F.round(F.col("dot") / (F.col("norm") * F.col("tnorm")), 9).alias("score"))
    best = F.max(F.struct(F.col("score"), (-F.col("template")).alias("first"), F.col("license"))).alias("b")
    return scored.groupBy("row", *key).agg(best).select("file_id", "unit", "licence_file", F.col("b.license").alias("license"), F.col("b.score").alias("score"))


def directory(path: Column) -> Column:
    return F.regexp_replace(F.coalesce(path, F.lit("")), r"/?[^/]*$", "")


def ancestors(path: Column) -> Column:
    """The file's directory and all above it: a/b/c.txt -> [a/b, a, ""]."""
    parts = F.filter(F.split(directory(path), "/", -1), lambda p: p != "")
    up = F.sequence(F.size(parts), F.lit(0))
    return F.transform(up, lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(file_id, path, text) -> file_id, path, license, score, found ("own", "inherited",
    "none"), license_dir (where an inherited license comes from)."""
    scored = unit_scores(written(license_units(files), "license-units")).filter(F.col("score") >= threshold)
    own = scored.groupBy("file_id").agg(F.max(F.struct("score", (-F.col("unit")).alias("u"), "license")).alias("o"))
    own = own.select("file_id", F.col("o.license").alias("own_license"), F.col("o.score").alias("own_score"))
    base = files.select("file_id", "path").join(own, "file_id", "left")
    is_file = F.coalesce(F.rlike(F.col("path"), F.lit(LICENCE_FILE)), F.lit(False))
    normal = F.array_join(F.filter(F.split(directory(F.col("path")), "/", -1), lambda p: p != ""), "/")
    # Smallest path first among the highest scores of a directory.
    dirs = (base.filter(is_file & F.col("own_license").isNotNull())
            .groupBy(normal.alias("dir")).agg(F.min(F.struct((-F.col("own_score")).alias("s"), "path", "own_license")).alias("d"))
            .select("dir", F.col("d.own_license").alias("dir_license"), (-F.col("d.s")).alias("dir_score")))
    # Files share directories: ancestors are looked up once per directory.
    homes = files.select(directory(F.col("path")).alias("home")).distinct()
    steps = homes.select("home", F.posexplode(ancestors(F.concat("home", F.lit("/x")))).alias("up", "dir"))
    near = (steps.join(dirs, "dir").groupBy("home").agg(F.min(F.struct("up", "dir", "dir_license", "dir_score")).alias("n"))
            .select("home", F.col("n.dir").alias("license_dir"), F.col("n.dir_license").alias("dir_license"), F.col("n.dir_score").alias("dir_score")))
    out = base.withColumn("home", directory(F.col("path"))).join(near, "home", "left")
    has = F.col("own_license").isNotNull()
    return out.select(
        "file_id", "path", F.coalesce("own_license", "dir_license").alias("license"),
        F.coalesce("own_score", "dir_score", F.lit(0.0)).alias("score"),
        F.when(has, "own").when(F.col("dir_license").isNotNull(), "inherited").otherwise("none").alias("found"),
        F.when(~has, F.col("license_dir")).alias("license_dir"))
