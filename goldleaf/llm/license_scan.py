"""Licence scan: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

A file's header is its lines that speak of licences, wherever they stand. Header and template terms become
sparse vectors, weighted by inverse document frequency over all headers; the products with every template come
from one join on terms (the templates' terms are a fixed, small table) and one grouped sum, the vectors'
lengths from all terms of a header. The best template from ``ACCEPT`` on is the file's own licence.

Files named LICENSE, LICENCE, COPYING or NOTICE speak for their directory. A file without a licence of its
own takes that of the nearest directory above it. This is worked out per distinct directory: its ancestors
are joined with the directories that have a licence, and the nearest is kept by a grouped minimum, so a
directory with a third of all files is one row.

Cases: null text counts as empty and has no header; a null path has no directory and inherits nothing; ties
between templates go to the first name, between licence files of a directory to the smallest path (then
name); repeated rows give repeated results; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import row_numbered, written

ACCEPT = 0.55

MIT_TEXT = """MIT License
Copyright (c)
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
MIT_LINES = """MIT License
Copyright (c)
Permission is hereby granted, free of charge, to any person obtaining a copy
The above copyright notice and this permission notice shall be included in all
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER"""
BSD_TEXT = """BSD 3-Clause License
Copyright (c) All rights reserved.
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD_LINES = """BSD 3-Clause License
Copyright (c) All rights reserved.
Redistribution and use in source and binary forms, with or without
1. Redistributions of source code must retain the above copyright notice, this
2. Redistributions in binary form must reproduce the above copyright notice,
3. Neither the name of the copyright holder nor the names of its
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE"""
BSD2_TEXT, BSD2_LINES = (re.sub(r"(?s)3\. Neither.*?(?=THIS SOFTWARE)", "", x).replace("3-Clause", "2-Clause")
                         for x in (BSD_TEXT, BSD_LINES))
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""
GNU_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
{0}General Public License as published by the Free Software Foundation, either version {1} of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public
License for more details. You should have received a copy of the GNU {0}General Public License along with this program.
If not, see https://www.gnu.org/licenses/."""
MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""

# The words by which licences are declared, by SPDX name: short forms, whole texts or notices, and of
# whole texts the lines that a header takes from them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http www.apache.org licenses"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("proprietary", "Copyright. All rights reserved."),
    ("MIT", MIT_TEXT),
    ("MIT", MIT_LINES),
    ("BSD-3-Clause", BSD_TEXT),
    ("BSD-3-Clause", BSD_LINES),
    ("BSD-2-Clause", BSD2_TEXT),
    ("BSD-2-Clause", BSD2_LINES),
    ("Apache-2.0", APACHE_NOTICE),
    ("GPL-3.0", GNU_NOTICE.format("", "3")),
    ("GPL-2.0", GNU_NOTICE.format("", "2")),
    ("LGPL-3.0", GNU_NOTICE.format("Lesser ", "3")),
    ("MPL-2.0", MPL_NOTICE),
]
HEADER_LINE = r"(?i)licen[cs]ed?\b|copyright|all rights reserved|redistribut|permission is hereby|spdx"
TERM = r"[a-z]+(?:-[a-z]+)*|[0-9]+(?:\.[0-9]+)*"
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)(\.[a-z]+)?$"


def header_terms(text: Column) -> Column:
    """Terms of a text's licence lines, in lower case, repeated as they occur."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(HEADER_LINE))
    return F.regexp_extract_all(F.lower(F.array_join(lines, "\n")), F.lit(TERM), F.lit(0))


def _template_terms(docs: DataFrame) -> DataFrame:
    """``template`` (its number), ``licence``, ``term``, ``tf``: a small fixed table."""
    counts = [(k, licence, term, text.count(term)) for k, (licence, words) in enumerate(TEMPLATES)
              for text in [re.findall(TERM, words.lower())] for term in sorted(set(text))]
    return docs.sparkSession.createDataFrame(counts, "template int, licence string, term string, tf bigint")


def _idf(n: int, df: Column) -> Column:
    return F.log((F.lit(float(n)) + 1) / (df + 1)) + 1


def own_licences(files: DataFrame) -> DataFrame:
    """``uid, own, score`` of the files (``uid, _text``) whose header is close enough to a template."""
    headed = files.where(F.col("_text").rlike(HEADER_LINE))
    terms = written(headed.select("uid", F.explode(header_terms(F.col("_text"))).alias("term")).groupBy(
        "uid", "term").agg(F.count(F.lit(1)).alias("tf")), "op8-terms")
    templates = _template_terms(files)
    vocabulary = F.broadcast(templates.select("term").distinct())  # the templates' words: a fixed table
    n = terms.select("uid").distinct().count()
    idf = written(terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select("term", _idf(n, F.col("df")).alias("idf")),
                  "op8-idf")  # of all header terms: as many rows as the headers have different words
    known = written(idf.join(vocabulary, "term"), "op8-known")  # at most one row per template word
    of_template = templates.join(known, "term", "left").withColumn("idf", F.coalesce("idf", _idf(n, F.lit(0)))).select(
        "template", "licence", "term", "idf", (F.col("tf") * F.col("idf")).alias("y"))
    template_norm = of_template.groupBy("template").agg(F.sqrt(F.sum(F.col("y") * F.col("y"))).alias("ny"))
    weighted = of_template.join(template_norm, "template").select(
        "template", "licence", "term", (F.col("idf") * F.col("y") / F.col("ny")).alias("y"))
    # a header's length counts all of its words, those of no template too
    norm = terms.join(idf, "term").groupBy("uid").agg(F.sqrt(F.sum(F.pow(F.col("tf") * F.col("idf"), 2))).alias("nx"))
    dots = terms.join(F.broadcast(weighted), "term").groupBy("uid", "template", "licence").agg(F.sum(F.col("tf") * F.col("y")).alias("dot"))
    scored = dots.join(norm, "uid").select("uid", "licence", F.round(F.col("dot") / F.col("nx"), 9).alias("score"))
    best = scored.groupBy("uid").agg(F.min(F.struct((-F.col("score")).alias("minus"), "licence")).alias("best"))
    return best.select("uid", F.col("best.licence").alias("own"), (-F.col("best.minus")).alias("score")).where(
        F.col("score") >= ACCEPT)


def scan_licences(files: DataFrame, path_col: str = "path", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, path, licence, score, inherited_from`` of every file.

    ``inherited_from`` is the directory that gave the licence, null for a file's own; ``licence`` is null
    if neither the file nor a directory above it has one.
    """
    rows = row_numbered(files.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{path_col}`").alias("path"),
                                     F.col(f"`{text_col}`").cast("string").alias("_text")), "uid")
    own = written(own_licences(rows), "op8-own")
    # directory of a/b/c is a/b, of c it is the root, ""
    parts = F.split("path", "/")
    named = rows.select("uid", "doc_id", "path", F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/").alias("dir"),
                        F.element_at(parts, -1).alias("name"))
    known = written(named.join(own, "uid", "left"), "op8-named")
    speaking = written(known.where(F.col("own").isNotNull() & F.col("name").rlike(LICENCE_FILE)).groupBy("dir").agg(
        F.min(F.struct("path", "own")).alias("first")).select("dir", F.col("first.own").alias("given")), "op8-speaking")
    steps = F.split("dir", "/")
    above = known.where(F.col("own").isNull() & F.col("dir").isNotNull()).select("dir").distinct().select(
        "dir", F.posexplode(F.transform(F.sequence(F.lit(0), F.size(steps)), lambda up: F.array_join(
            F.slice(steps, F.lit(1), F.size(steps) - up), "/"))).alias("up", "above"))
    nearest = above.join(speaking.withColumnRenamed("dir", "above"), "above").groupBy("dir").agg(
        F.min(F.struct("up", "above", "given")).alias("near"))
    nearest = written(nearest.select("dir", F.col("near.above").alias("inherited_from"), F.col("near.given").alias("given")),
                      "op8-nearest")
    return known.join(nearest, "dir", "left").select(
        "doc_id", "path", F.coalesce("own", "given").alias("licence"), "score",
        F.when(F.col("own").isNull(), F.col("inherited_from")).alias("inherited_from"))


def with_paths(docs: DataFrame) -> DataFrame:
    """Documents as files of source trees: the table has no paths, so they are derived from its columns.

    A document lies under its source, three levels deep by its number; every fourth one is a LICENSE file,
    of its directory or of one above it.
    """
    n = F.col("doc_id")
    digits = [F.expr("doc_id div 1000"), F.expr("doc_id div 100 % 10"), F.expr("doc_id div 10 % 10")]
    deep = F.concat_ws("/", F.coalesce(F.col("source"), F.lit("unknown")), *[d.cast("string") for d in digits])
    up = F.expr("doc_id div 4 % 3").cast("int")
    kept = F.slice(F.split(deep, "/"), F.lit(1), F.lit(4) - up)
    path = F.when(n % 4 == 0, F.concat(F.array_join(kept, "/"), F.lit("/LICENSE"))).otherwise(
        F.concat(deep, F.lit("/"), n.cast("string"), F.lit(".txt")))
    return docs.select("doc_id", path.alias("path"), "text")
