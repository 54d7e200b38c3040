"""License scans [DataFrame functions only].

A text is read in units: its lines, its blocks (lines joined, comment marks at their starts
taken off, cut at empty lines) and the sentences of its blocks. Units that speak of licensing
are compared with license templates by the cosine of sparse TF-IDF vectors; the best template
from ``HEADER`` on is the unit's license. A file's own license is the best of its units. A
file is a license file if its name says so or if nearly all of its text is one template
(``WHOLE``); its license holds for its directory. A file without a license of its own
inherits that of the nearest ancestor directory that has one, found by joining directory
paths.

Templates are the notices and permission texts of the licenses below, the SPDX tags of their
identifiers, and the short forms in which projects name them.

Edge cases: a null text has no license of its own; a null path is a file named "" at the
root; rows of equal path share the best license found in them; among equal scores the
first license by name wins; an empty table gives an empty result; other columns are
ignored. Texts are read whole, whatever their length, each in one task.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import pick, written

HEADER = 0.6
WHOLE = 0.8
# --- fixed values: notices and permission texts, public identifiers and names ----------------
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files (the \"Software\"), to deal in the Software without "
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions:",
    "The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software.")
_MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
    "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:")
_BSD_1 = ("Redistributions of source code must retain the above copyright notice, this list of "
          "conditions and the following disclaimer.")
_BSD_2 = ("Redistributions in binary form must reproduce the above copyright notice, this list of "
          "conditions and the following disclaimer in the documentation and/or other materials "
          "provided with the distribution.")
_BSD_3 = ("Neither the name of the copyright holder nor the names of its contributors may be used to "
          "endorse or promote products derived from this software without specific prior written "
          "permission.")
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
    "except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0",
    "Unless required by applicable law or agreed to in writing, software distributed under the "
    "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
    "either express or implied. See the License for the specific language governing permissions "
    "and limitations under the License.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.")
_UNLICENSE = ("This is free and unencumbered software released into the public domain.",
              "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
              "software, either in source code form or as a compiled binary, for any purpose, "
              "commercial or non-commercial, and by any means.")
_MPL = ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.")
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License."),
    ("Apache-2.0", _APACHE[0]), ("Apache-2.0", _APACHE[1]), ("Apache-2.0", " ".join(_APACHE)),
    ("BSD-2-Clause", " ".join((_BSD, _BSD_1, _BSD_2))),
    ("BSD-3-Clause", "Released under the BSD License."), ("BSD-3-Clause", _BSD),
    ("BSD-3-Clause", _BSD_3), ("BSD-3-Clause", " ".join((_BSD, _BSD_1, _BSD_2, _BSD_3))),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("ISC", _ISC), ("MIT", _MIT[0]), ("MIT", _MIT[1]), ("MIT", " ".join(_MIT)),
    ("MIT", " ".join((*_MIT, _MIT_WARRANTY))),
    ("MPL-2.0", _MPL[0]), ("MPL-2.0", _MPL[1]), ("MPL-2.0", " ".join(_MPL)),
    ("Unlicense", _UNLICENSE[0]), ("Unlicense", _UNLICENSE[1]), ("Unlicense", " ".join(_UNLICENSE)),
)
GNU = (("GPL", "GNU General Public License", ("2.0", "3.0")),
       ("LGPL", "GNU Lesser General Public License", ("2.1", "3.0")),
       ("AGPL", "GNU Affero General Public License", ("3.0",)))
CREATIVE = (("BY", "Attribution"), ("BY-NC", "Attribution-NonCommercial"),
            ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"))
NAMES = (("MIT", "MIT"), ("Apache-2.0", "Apache"), ("Apache-2.0", "Apache 2.0"),
         ("BSD-3-Clause", "BSD"), ("BSD-2-Clause", "BSD 2-Clause"), ("BSD-3-Clause", "BSD 3-Clause"),
         ("ISC", "ISC"), ("MPL-2.0", "MPL 2.0"), ("Unlicense", "Unlicense"), ("CC0-1.0", "CC0"))
SHORT_FORMS = ("Released under the {} License.", "Licensed under the {} license.",
               "This file is {} licensed.",
               "This project is licensed under the terms of the {} license.")
FILE_NAMES = r"(?i)^(?:licen[cs]e|copying|unlicense|notice)(?:[.-][a-z0-9.-]*)?$"
# -------------------------------------------------------------------------------------------
# a word that every template holds, so a unit without any has no license
SPEAKS = r"(?i)licen[cs]e|permission|redistribut|public domain|\bcopy\b|\bCC[ 0]"
TERM = "[a-z0-9]+"
# marks of comments at the start and the end of a line
COMMENT = r'(?m)^[ \t]*(?:/\*+|\*+/?|//+|#+|--+|;+|<!--|%+|""")[ \t]?|[ \t]*(?:\*+/|-->)[ \t]*$'


def templates() -> list[tuple[str, str]]:
    """``(license, text)`` of all templates."""
    out = list(NOTICES)
    tags = {name for name, _ in NOTICES}
    for short, name, versions in GNU:
        for v in versions:
            number = v.removesuffix(".0")
            out += [(f"{short}-{v}", f"This work is licensed under the {name}, version {number}."),
                    (f"{short}-{v}", f"Licensed under the {short}v{number} license."),
                    (f"{short}-{v}", f"This program is free software: you can redistribute it and/or "
                     f"modify it under the terms of the {name} as published by the Free Software "
                     f"Foundation, either version {number} of the License, or (at your option) any "
                     "later version.")]
            out += [(f"{short}-{v}", f"SPDX-License-Identifier: {short}-{v}{x}")
                    for x in ("", "-only", "-or-later")]
    for short, name in CREATIVE:
        out += [(f"CC-{short}-4.0", f"Licensed under CC {short} 4.0."),
                (f"CC-{short}-4.0", f"This work is licensed under a Creative Commons {name} 4.0 "
                 "International License.")]
        tags.add(f"CC-{short}-4.0")
    out += [(tag, f"SPDX-License-Identifier: {tag}") for tag in sorted(tags)]
    return out + [(tag, form.format(name)) for tag, name in NAMES for form in SHORT_FORMS]


def _terms(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def template_weights() -> tuple[list[tuple[int, str, str, float]], dict[str, float], float]:
    """``(template, license, term, weight)`` with weights of unit length; the idf of every
    term; the idf of a term that no template has."""
    every = templates()
    n = len(every)
    df = Counter(t for _, text in every for t in set(_terms(text)))
    idf = {t: math.log((1 + n) / (1 + k)) + 1 for t, k in df.items()}
    rows = []
    for i, (name, text) in enumerate(every):
        tf = Counter(_terms(text))
        norm = math.sqrt(sum((k * idf[t]) ** 2 for t, k in sorted(tf.items())))
        rows.extend((i, name, t, k * idf[t] / norm) for t, k in sorted(tf.items()))
    return rows, idf, math.log(1 + n) + 1


def best_template(spark: SparkSession, parts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, license, score`` of every part (``keys, part`` rows) with its nearest template."""
    rows, idf, rare = template_weights()
    # both are tables of the templates, a few hundred rows whatever is scanned
    weights = F.broadcast(spark.sql("SELECT * FROM VALUES " + ", ".join(
        f"({i}, '{name}', '{t}', {w!r}D)" for i, name, t, w in rows)
        + " AS t(template, license, term, weight)"))
    known = F.broadcast(spark.sql("SELECT * FROM VALUES " + ", ".join(
        f"('{t}', {x!r}D)" for t, x in sorted(idf.items())) + " AS t(term, idf)"))
    terms = parts.select(*keys, F.explode(F.regexp_extract_all(
        F.lower("part"), F.lit(TERM), F.lit(0))).alias("term"))
    tf = terms.groupBy(*keys, "term").agg(F.count("*").alias("tf")).join(known, "term", "left").select(
        *keys, "term", (F.col("tf") * F.coalesce("idf", F.lit(rare))).alias("x"))
    norm = tf.groupBy(*keys).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dot = tf.join(weights, "term").groupBy(*keys, "template", "license").agg(
        F.sum(F.col("x") * F.col("weight")).alias("dot"))
    score = F.round(F.col("dot") / F.col("norm"), 6)
    near = dot.join(norm, keys).select(*keys, "license", score.alias("score"))
    best = F.max(F.struct(F.col("score"), F.col("rev"))).alias("b")
    # the first by name among equal scores: the largest of the places counted from the end
    names = sorted({r[1] for r in rows}, reverse=True)
    place = F.array_position(F.array(*[F.lit(x) for x in names]), F.col("license"))
    return near.withColumn("rev", place).groupBy(*keys).agg(best).select(
        *keys, F.element_at(F.array(*[F.lit(x) for x in names]), F.col("b.rev").cast("int")).alias(
            "license"), F.col("b.score").alias("score"))


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan(files: DataFrame, header: float = HEADER, whole: float = WHOLE) -> DataFrame:
    """Per row of ``files`` (``doc_id, path, text``): ``doc_id, path, license, found, score``.

    ``found`` is ``file``, ``header``, ``inherited`` or null. Only texts that speak of
    licensing are taken apart; directories are combined before anything is joined, so a
    directory with very many files is one row of the path join.
    """
    spark = files.sparkSession
    rows = pick(files, "doc_id", "path", "text").withColumn("path", F.coalesce("path", F.lit("")))
    speaking = rows.filter(F.rlike("text", F.lit(SPEAKS)))
    plain = F.regexp_replace("text", COMMENT, "")
    blocks = F.transform(F.split(plain, r"\n(?:[ \t\r\f]*\n)+"),
                         lambda b: F.regexp_replace(b, r"\s+", " "))
    sentences = F.flatten(F.transform(blocks, lambda b: F.split(b, r"(?<=[.!?]) ")))
    units = F.concat(F.split(plain, "\n"), blocks, sentences)
    parts = written(speaking.select("path", F.explode(F.array_distinct(F.filter(
        units, lambda u: F.rlike(u, F.lit(SPEAKS))))).alias("part")).withColumn(
        "part_id", F.md5(F.col("part").cast("binary"))), "license-parts")
    # equal units are compared once
    scored = written(best_template(spark, parts.select("part_id", "part").distinct(), ["part_id"])
                     .filter(F.col("score") >= header), "license-units")
    best = parts.join(scored, "part_id").groupBy("path").agg(F.min(F.struct(
        (-F.col("score")).alias("s"), F.col("license").alias("license"))).alias("b"))
    own = written(best.select("path", F.col("b.license").alias("license"),
                              (-F.col("b.s")).alias("score")), "license-own")
    # whole texts are only compared where a sentence has a license
    texts = speaking.join(own.select("path"), "path", "left_semi").select(
        "path", F.col("text").alias("part")).distinct().withColumn("row", F.md5(
            F.concat_ws("\n", "path", "part").cast("binary")))
    alone = best_template(spark, texts.select("path", "row", "part"), ["path", "row"]).filter(
        F.col("score") >= whole).select("path").distinct().withColumn("alone", F.lit(True))
    own = written(own.join(alone, "path", "left").withColumn("is_file", F.coalesce(
        "alone", F.lit(False)) | F.rlike(F.element_at(F.split("path", "/"), -1), F.lit(FILE_NAMES))
    ).drop("alone"), "license-files")
    of_dir = own.filter("is_file").groupBy(_directory(F.col("path")).alias("dir")).agg(
        F.min(F.struct((-F.col("score")).alias("s"), F.col("license").alias("license"))).alias("b")
    ).select(F.col("dir").alias("above"), F.col("b.license").alias("inherited"))
    dirs = rows.groupBy(_directory(F.col("path")).alias("dir")).agg(F.lit(1).alias("one"))
    steps = F.split("dir", "/")
    above = F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(F.transform(
        F.sequence(F.lit(0), F.size(steps)), lambda k: F.array_join(F.slice(steps, 1, k), "/")))
    nearest = written(dirs.select("dir", F.explode(F.array_distinct(above)).alias("above")).join(
        of_dir, "above").groupBy("dir").agg(F.max(F.struct(
            F.length("above").alias("n"), F.col("inherited").alias("inherited"))).alias("b")).select(
        "dir", F.col("b.inherited").alias("inherited")), "license-dirs")
    out = rows.select("doc_id", "path", _directory(F.col("path")).alias("dir")).join(
        own, "path", "left").join(nearest, "dir", "left")
    found = F.when(F.col("is_file"), "file").when(F.col("license").isNotNull(), "header").when(
        F.col("inherited").isNotNull(), "inherited")
    return out.select("doc_id", "path", F.coalesce("license", "inherited").alias("license"),
                      found.alias("found"), "score")


def document_paths(docs: DataFrame) -> DataFrame:
    """``documents`` as a file tree: ``source/lang/doc_id``."""
    rows = pick(docs, "doc_id", "text", "lang", "source")
    return rows.select("doc_id", "text", F.concat_ws(
        "/", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("source", "lang", "doc_id")]
    ).alias("path"))
