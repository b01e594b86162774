"""Licence scan with DataFrame functions only.

Lines that speak of licences are headers; the whole text of a file called LICENSE or COPYING is one unit.
Both become sparse TF-IDF vectors over word tokens; a word's weight comes from the number of units of the
whole corpus, and of templates, that hold it. Vectors are compared with every template by cosine (a join on words, so
only shared words cost anything), each distinct unit once. A file without a licence of its own takes that of
the nearest ancestor directory that has a licence file: ancestors are exploded and joined by path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: fixed short forms of public licence statements
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "proprietary": ["All rights reserved."],
}
CUE = r"(?i)licen[sc]e|copyright|all rights reserved|spdx|redistribution and use|permission is hereby"


def _tokens(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), r"[^a-z0-9.-]+|\.(?=\s|$)"), lambda x: x != "")


#: tasks among which the files of one folder are dealt
SPREAD = 32
NAMED = r"(^|/)(LICEN[SC]E|COPYING)(\.[a-z]+)?$"


def template_words(spark: SparkSession) -> DataFrame:
    """template, licence, word, tf: a table of fixed size."""
    rows = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate((k, t) for k, ts in TEMPLATES.items() for t in ts)], "template int, licence string, line string")
    return rows.select("template", "licence", F.explode(_tokens(F.col("line"))).alias("word")).groupBy("template", "licence", "word").agg(F.count(F.lit(1)).alias("tf"))


def best_licences(units: DataFrame, least: float) -> DataFrame:
    """line, licence, cosine of every distinct unit that is near enough to a template; units: line."""
    lined = units.groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    words = lined.select("line", "n", F.explode(_tokens(F.col("line"))).alias("word")).groupBy("line", "word").agg(F.count(F.lit(1)).alias("tf"), F.max("n").alias("n"))
    words = common.save(words, "licence-words")
    fixed = template_words(units.sparkSession)
    held = words.select("word", "n").union(fixed.select("word", F.lit(1).cast("long").alias("n"))).groupBy("word").agg(F.sum("n").alias("df"))
    size = lined.agg((F.coalesce(F.sum("n"), F.lit(0)) + sum(map(len, TEMPLATES.values()))).alias("size"))  # one row
    idf = held.crossJoin(F.broadcast(size)).select("word", (F.log((1.0 + F.col("size")) / (1 + F.col("df"))) + 1).alias("idf"))
    idf = common.save(idf, "licence-idf")
    weigh = lambda df, key: df.join(idf, "word").withColumn("w", F.col("tf") * F.col("idf")).select(*key, "word", "w")
    norms = lambda df, key: df.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    known, sample = weigh(words, ["line"]), weigh(fixed, ["template", "licence"])
    sample = sample.join(norms(sample, "template"), "template").select("template", "licence", "word", (F.col("w") / F.col("norm")).alias("weight"))
    dots = known.join(F.broadcast(sample), "word").groupBy("line", "template", "licence").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dots.join(norms(known, "line"), "line").withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("cosine") >= least)
    out = common.save(scored.groupBy("line").agg(F.min_by("licence", F.struct(-F.col("cosine"), F.col("licence"))).alias("licence"), F.max("cosine").alias("cosine")), "licence-lines")
    common.forget(words, idf)
    return out


def license_scan(files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text", least: float = 0.6) -> DataFrame:
    """One row per input row: id_col, path, licence, cosine, origin (header, inherited or null), n_headers.

    Ties of cosine go to the alphabetically first licence. Null or empty texts have no headers; a null path
    inherits nothing. Repeated rows repeat with the headers of one, rows that share an id (null included) only where id,
    path and text agree; an empty table gives an empty result; other columns are ignored.
    """
    path, text = F.col(path_col), common.text_of(text_col)
    key = F.xxhash64(F.col(id_col), path, F.xxhash64(text))
    rows = files.select(F.col(id_col).alias("id"), path.alias("path"), text.alias("t"), key.alias("row"))
    cued = F.filter(F.when(F.col("t").rlike(CUE), F.split("t", "\n")).otherwise(F.array().cast("array<string>")), lambda x: x.rlike(CUE))
    # a long line is cut to the sentences that carry a cue
    sentences = F.filter(F.flatten(F.transform(cued, lambda x: F.split(x, r"(?<=[.!?])\s+(?=[A-Z])"))), lambda x: x.rlike(CUE))
    named_file = F.coalesce(F.col("path").rlike(NAMED), F.lit(False))
    whole = F.array_compact(F.array(F.nullif(F.trim(F.regexp_replace("t", r"\s+", " ")), F.lit(""))))
    seen = common.save(rows.select("id", "path", "row", F.when(named_file, whole).otherwise(sentences).alias("units")), "licence-units")
    units = seen.where(F.size("units") > 0).dropDuplicates(["row"]).select("row", F.explode("units").alias("line"))
    best = best_licences(units.select("line"), least)
    own = units.join(best, "line").groupBy("row").agg(F.min_by("licence", F.struct(-F.col("cosine"), F.col("licence"))).alias("licence"), F.max("cosine").alias("cosine"), F.count(F.lit(1)).alias("n_headers"))
    full = seen.select("id", "path", "row").join(own, "row", "left")
    home = F.regexp_replace("path", r"/?[^/]*$", "")
    by_dir = full.where(F.col("path").rlike(NAMED) & F.col("licence").isNotNull()).groupBy(home.alias("dir")).agg(F.min_by("licence", F.struct(-F.col("cosine"), F.col("licence"))).alias("dir_licence"), F.max("cosine").alias("dir_cosine"))
    bare = full.where("licence IS NULL AND path IS NOT NULL").select(home.alias("home")).distinct()
    parts = F.split("home", "/")
    ups = bare.select("home", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))).alias("dir"))
    near = ups.join(by_dir, "dir").groupBy("home").agg(F.max_by("dir_licence", F.length("dir")).alias("dir_licence"), F.max_by("dir_cosine", F.length("dir")).alias("dir_cosine"))
    near = near.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
    out = full.withColumn("home", home).withColumn("part", F.pmod("row", F.lit(SPREAD).cast("long"))).join(near, ["home", "part"], "left")
    return out.select(
        F.col("id").alias(id_col), "path", F.coalesce("licence", "dir_licence").alias("licence"), F.coalesce("cosine", "dir_cosine").alias("cosine"),
        F.when(F.col("licence").isNotNull(), "header").when(F.col("dir_licence").isNotNull(), "inherited").alias("origin"), F.coalesce("n_headers", F.lit(0)).cast("long").alias("n_headers"),
    )
