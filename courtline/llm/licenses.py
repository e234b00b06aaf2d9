"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

DataFrame functions only. A file's passages (its lines, as many successive
words as a template has, wherever lines break, and the whole of a licence file)
are compared with each template (licence texts, file headers and one-line
notices) on words weighted by inverse document frequency over all files. Files without a licence of their own take that of the nearest
directory above that holds a licence file.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtline.llm import common, licence_texts

# Short notices of common licences.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
}
# Notices that differ from those in a word or two, so that the nearest one decides.
NEIGHBOURS = {
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-1.1": "Licensed under the Apache License, Version 1.1.",
    "MPL-1.1": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC0-1.0": "Licensed under CC0 1.0.",
}
#: All that passages are compared with; what follows a slash tells a licence's templates apart.
NOTICES = TEMPLATES | NEIGHBOURS | licence_texts.TEXTS
#: A licence that a file names by its identifier.
IDENTIFIER = r"SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9][A-Za-z0-9.+-]*)"
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice)(\.[a-z]+)?$"


def _terms(text: Column) -> Column:
    """Distinct lower-case words of letters and digits."""
    return F.array_distinct(F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != ""))


def _sequence(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def _words(text: str) -> set[str]:
    return set(_sequence(text))


def passages(files: DataFrame, anchors: Mapping[str, set[str]], lengths: Mapping[str, int], passage: str = "\n") -> DataFrame:
    """(file_id, _w): the distinct words of each passage of ``files`` that holds an anchor, a template's weightier word.

    Runs of ``lengths[name]`` words are taken around the anchors of that
    template, so that their number grows with the anchors in the text.
    """
    known = sorted(set().union(*anchors.values()))
    low = F.lower(F.col("text"))
    some = F.lit(False)
    for a in known:
        some = some | low.contains(a)
    any_of = F.array(*[F.lit(a) for a in known]).cast("array<string>")
    whole = F.filter(F.split(low, "[^a-z0-9]+"), lambda w: w != "")
    path = F.col("path") if "path" in files.columns else F.lit(None).cast("string")
    # stored, so that the words of a text are split once, not for each run
    held = common.stored(
        files.filter(some & F.arrays_overlap(whole, any_of)).select(
            "file_id", F.coalesce(path.rlike(LICENSE_FILE), F.lit(False)).alias("_file"), F.split("text", passage).alias("_lines"), whole.alias("_all")
        ),
        "licence_words",
    )
    out = held.select("file_id", F.explode("_lines").alias("_p")).select("file_id", _terms(F.col("_p")).alias("_w"))
    out = out.union(held.filter("_file").select("file_id", F.array_distinct("_all").alias("_w")))
    runs: dict[int, set[str]] = {}
    for name, k in lengths.items():
        runs.setdefault(k, set()).update(anchors[name])
    count = F.size("_all")
    for k, words in sorted(runs.items()):
        mine = F.array(*[F.lit(w) for w in sorted(words)]).cast("array<string>")
        at = F.filter(F.transform("_all", lambda w, i: F.when(F.array_contains(mine, w), i + 1)), lambda i: i.isNotNull())
        last = F.greatest(count - k + 1, F.lit(1))  # a text of fewer words is one run
        starts = F.array_distinct(F.flatten(F.transform(at, lambda i: F.sequence(F.least(F.greatest(i - k + 1, F.lit(1)), last), F.least(i, last)))))
        out = out.union(held.select("file_id", F.explode(F.transform(starts, lambda i: F.array_distinct(F.slice("_all", i, F.lit(k))))).alias("_w")))
    return out.filter(F.arrays_overlap("_w", any_of))


def frequencies(files: DataFrame, terms: set[str]) -> tuple[int, dict[str, int]]:
    """Number of files and, for each template term, how many hold it: one row for each term reaches the driver."""
    known = F.array(*[F.lit(t) for t in sorted(terms)])
    row = files.agg(F.count(F.lit(1)).alias("n")).first()
    held = files.select(F.explode(F.array_intersect(_terms(F.col("text")), known)).alias("t")).groupBy("t").count().collect()
    return row["n"], {r["t"]: r["count"] for r in held}


def own_licenses(files: DataFrame, templates: Mapping[str, str] = NOTICES, least: float = 0.75, passage: str = "\n") -> DataFrame:
    """(file_id, license, score) for files with a passage whose cosine to a template is at least ``least``.

    Presence TF-IDF: a word weighs log((1 + files) / (1 + files with it)) + 1,
    counted for every word of a passage that may reach ``least`` (where its
    words of no template weigh 1, the least there is). Passages without the
    template's weightier words can't reach ``least`` (by Cauchy-Schwarz on the
    rest), so only files with such words are cut into passages: lines, runs of
    as many words as the template has, and the whole text where ``path`` is
    that of a licence file. A licence stated by its SPDX identifier counts as a
    passage of score 1. The best passage counts; ties go to an identifier, then
    to a text or header (a notice may be a part of it), then to the licence last
    by name.
    """
    vocabulary = {name: _words(text) for name, text in templates.items()}
    terms = set().union(*vocabulary.values())
    n, held = frequencies(files, terms)
    weight = {t: math.log((1 + n) / (1 + held.get(t, 0))) + 1 for t in terms}
    anchors: dict[str, set[str]] = {}
    for name, words in vocabulary.items():
        order = sorted(words, key=lambda w: (-weight[w], w))
        norm = sum(weight[w] ** 2 for w in words)
        rest = norm
        anchors[name] = set()
        for w in order:
            if rest < (least**2) * norm * (1 - 1e-9):
                break
            anchors[name].add(w)
            rest -= weight[w] ** 2
    weights = F.create_map(*[x for t in sorted(terms) for x in (F.lit(t), F.lit(weight[t]))])
    parts = passages(files, anchors, {name: len(_sequence(text)) for name, text in templates.items()}, passage)

    def square(words: Column) -> Column:
        return F.aggregate(words, F.lit(0.0), lambda a, w: a + F.pow(F.try_element_at(weights, w), 2))

    known = F.array(*[F.lit(t) for t in sorted(terms)])
    scored = []
    for name in sorted(vocabulary):
        mine = F.array(*[F.lit(w) for w in sorted(vocabulary[name])])
        norm = math.sqrt(sum(weight[w] ** 2 for w in vocabulary[name]))
        # both vectors have the same weight at a common word: the product is the sum of squares
        scored.append(F.struct((square(F.array_intersect("_w", mine)) / norm).alias("dot"), F.lit(name).alias("license")))
    parts = parts.select("file_id", square(F.array_intersect("_w", known)).alias("_n"), F.array_except("_w", known).alias("_other"), F.array(*scored).alias("_s"))
    near = parts.withColumn("_s", F.explode("_s")).filter(F.col("_s.dot") >= (least - 1e-9) * F.sqrt(F.col("_n") + F.size("_other")))
    near = common.numbered(near.select("file_id", "_n", "_other", "_s.dot", "_s.license"), "licence_passages")
    one = near.select("_row", F.explode("_other").alias("t"))
    # a stored list of words: of a size the planner knows
    asked = common.stored(one.select("t").distinct(), "licence_terms")
    held = files.select(F.explode(_terms(F.col("text"))).alias("t")).join(asked, "t").groupBy("t").agg(F.count(F.lit(1)).alias("held"))
    rest = one.join(held, "t").groupBy("_row").agg(F.sum(F.pow(F.log((1 + n) / (1 + F.col("held"))) + 1, 2)).alias("_rest"))
    score = F.col("dot") / F.sqrt(F.col("_n") + F.coalesce("_rest", F.lit(0.0)))
    best = near.join(rest, "_row", "left").withColumn("score", score)
    best = best.filter(F.col("score") >= least).select(
        "file_id", F.round("score", 9).alias("score"), F.col("license").contains("/").cast("int").alias("_told"), F.substring_index("license", "/", 1).alias("license")
    )
    stated = files.select("file_id", F.explode(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(1))).alias("license"))
    best = best.unionByName(stated.select("file_id", F.lit(1.0).alias("score"), F.lit(2).alias("_told"), "license"))
    return best.groupBy("file_id").agg(F.max("score").alias("score"), F.max_by("license", F.struct("score", "_told", "license")).alias("license"))


def scan(files: DataFrame, templates: Mapping[str, str] = NOTICES, least: float = 0.75) -> DataFrame:
    """file_id, path, own_license, own_score, from_dir, inherited, license of every row of ``files`` (file_id, path, text).

    A licence file (LICENSE, COPYING or NOTICE) with a licence gives it to its
    directory; a file without a licence of its own takes that of the nearest
    directory at or above its own. Of several licence files in one directory
    the highest score counts, ties to the first by name. Null and empty texts
    have no licence of their own and may inherit one; rows without a path
    inherit nothing. Repeated rows get equal rows; rows of one file_id share
    what any of them states. An empty table gives no rows; only file_id, path
    and text are read.

    Ancestors are joined for distinct directories, not for files.
    """
    files = files.select("file_id", "path", "text")
    own = own_licenses(files, templates, least)
    named = files.select("file_id", "path").join(own, "file_id", "left")
    folder = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), F.lit(""))
    named = named.withColumn("_dir", folder)
    given = (
        named.filter(F.col("license").isNotNull() & F.col("path").rlike(LICENSE_FILE))
        .groupBy(F.col("_dir").alias("from_dir"))
        .agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("license").alias("license")))["license"].alias("inherited"))
    )
    dirs = named.filter("_dir IS NOT NULL").select("_dir").distinct()
    steps = F.split("_dir", "/")
    above = dirs.withColumn(
        "_depth", F.explode(F.when(F.col("_dir") == "", F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.size(steps))))
    ).withColumn("from_dir", F.when(F.col("_depth") == 0, F.lit("")).otherwise(F.array_join(F.slice(steps, F.lit(1), F.col("_depth")), "/")))
    nearest = (
        above.join(given, "from_dir")
        .groupBy("_dir")
        .agg(F.max(F.struct("_depth", "from_dir", "inherited")).alias("_i"))
        .select("_dir", "_i.from_dir", "_i.inherited")
    )
    out = named.join(nearest, "_dir", "left")
    return out.select(
        "file_id",
        "path",
        F.col("license").alias("own_license"),
        F.col("score").alias("own_score"),
        F.when(F.col("license").isNull(), F.col("from_dir")).alias("from_dir"),
        F.when(F.col("license").isNull(), F.col("inherited")).alias("inherited"),
        F.coalesce("license", "inherited").alias("license"),
    )


def as_files(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: ``<source>/<doc_id / 1024>/<doc_id / 64>/<doc_id>.txt``, the first of a folder being its LICENSE."""
    unit = F.col("doc_id")
    inner = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.floor(unit / 1024).cast("string"), F.floor(unit / 64).cast("string"))
    name = F.when(F.pmod(unit, F.lit(64)) < 8, F.lit("/LICENSE")).otherwise(F.concat(F.lit("/"), unit.cast("string"), F.lit(".txt")))
    return docs.select(unit.alias("file_id"), F.when(unit.isNotNull(), F.concat(inner, name)).alias("path"), "text")
