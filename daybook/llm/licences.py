"""Licence scan: sparse TF-IDF cosine to templates, then nearest-ancestor inheritance.

Lines that may state a licence, and whole licence files, become sparse vectors
over the words of the templates, weighted by how rare a word is among all these
passages, and are matched to templates by cosine. A licence that stands in a
licence file holds for the directory of the file and for everything below it, up
to a directory with a licence of its own. Ancestors are found by joining paths,
one row for each directory above a file.

Defined results: a passage without a word of any template has no licence; of
templates equally near the first by name wins; a null text has no header; a null
path inherits nothing; a file's own header goes before what it inherits;
directories with several licence files take the nearest match of them, the first
by name if equally near; repeated rows are rows like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import written

#: One or more statements of each licence, by SPDX name.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met.",
    ),
)
#: Words one of which a line must hold to be scanned.
CUES = r"(?i)licen[cs]e|copyright|redistribut|permission is hereby|spdx"
#: Names of licence files.
LICENCE_FILE = r"(?i)^(?:licen[cs]e|copying|unlicense|notice)(?:[._-].*)?$"
#: Least cosine of a match.
LEAST_COSINE = 0.7
_TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0))


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    return spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "template int, licence string, statement string")


def matched(passages: DataFrame, templates: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """(passage, licence, cosine) of the nearest template of every distinct passage near enough.

    ``passages`` has the column passage, ``templates`` template, licence and
    statement. Inverse document frequencies count the distinct passages and the
    templates. Words that no template has only lengthen a vector.
    """
    # A whole licence file is a passage: its words carry its number, not its text.
    distinct = passages.select("passage").where("passage is not null").distinct()
    kinds = written(distinct.withColumn("number", F.monotonically_increasing_id()), "passages")
    texts = kinds.select(F.col("passage").alias("text")).unionByName(templates.select(F.col("statement").alias("text")))
    weights = written(
        texts.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n")),
        "frequencies",
    )
    total = texts.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    idf = F.log((F.lit(total) + 1) / (F.col("n") + 1)) + 1

    def vectors(rows: DataFrame, key: str, text: str) -> DataFrame:
        """(key, term, weight) of vectors of length one."""
        counted = rows.select(key, F.explode(terms(F.col(text))).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("times"))
        weighted = counted.join(weights, "term").select(key, "term", (F.col("times") * idf).alias("weight"))
        norms = weighted.groupBy(key).agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
        return weighted.join(norms, key).select(key, "term", (F.col("weight") / F.col("norm")).alias("weight"))

    known = vectors(templates, "template", "statement").withColumnRenamed("weight", "known")
    near = (
        vectors(kinds, "number", "passage")
        .join(known, "term")
        .groupBy("number", "template")
        .agg(F.sum(F.col("weight") * F.col("known")).alias("cosine"))
        .where(F.col("cosine") >= least)
        .join(templates.select("template", "licence"), "template")
    )
    # Rounded, so that the order of a sum decides no tie.
    best = F.min(F.struct((-F.round("cosine", 9)).alias("far"), "licence")).alias("best")
    return near.groupBy("number").agg(best).join(kinds, "number").select(
        "passage", F.col("best.licence").alias("licence"), (-F.col("best.far")).alias("cosine")
    )


def passages(text: Column, is_file: Column) -> Column:
    """The lines of a whole text that may state a licence, and all of it where it is a licence file.

    White space is one space and ends are trimmed, so that equal statements are one passage.
    """
    one_space = lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))
    lines = F.transform(F.filter(F.split(text, "\n"), lambda x: x.rlike(CUES)), one_space)
    none = F.array().cast("array<string>")
    return F.concat(
        F.when(text.rlike(CUES), lines).otherwise(none), F.when(is_file & text.isNotNull(), F.array(one_space(text))).otherwise(none)
    )


def ancestors(path: Column) -> Column:
    """The directories above a path with their depth, the root first."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), "/").alias("directory")),
    )


def scanned(files: DataFrame, templates: DataFrame | None = None, path: str = "path", text: str = "text") -> DataFrame:
    """``files`` without ``text``, with licence, cosine, found (header, inherited or null) and licence_dir.

    Columns of these names give way.
    """
    spark = files.sparkSession
    templates = template_table(spark) if templates is None else templates
    kept = [c for c in files.columns if c not in (text, "licence", "cosine", "found", "licence_dir")]
    is_file = lambda p: F.coalesce(F.element_at(F.split(p, "/"), -1).rlike(LICENCE_FILE), F.lit(False))
    place, body = F.col(f"`{path}`"), F.col(f"`{text}`")
    # Written with its numbers, so that every use sees the same row under a number; the caller's
    # columns travel in a struct, where their names are no matter.
    narrow = written(
        files.select(
            F.struct(*[F.col(f"`{c}`") for c in kept]).alias("kept"),
            place.alias("path"),
            F.monotonically_increasing_id().alias("row"),
            passages(body, is_file(place)).alias("passages"),
        ),
        "files",
    )
    lines = narrow.select("row", F.explode("passages").alias("passage"))
    best = written(matched(lines, templates), "matched")
    order = F.min(F.struct((-F.col("cosine")).alias("far"), "licence")).alias("own")
    own = written(lines.join(best, "passage").groupBy("row").agg(order), "own")

    directory = F.expr("substring(path, 1, greatest(0, length(path) - length(element_at(split(path, '/'), -1)) - 1))")
    named = narrow.drop("passages").join(own, "row", "left").withColumn("place", directory)
    # One row for each directory that has a licence of its own.
    owners = (
        named.where(is_file(F.col("path")) & F.col("own").isNotNull())
        .groupBy(F.col("place").alias("directory"))
        .agg(F.min("own").alias("given"))
    )
    # Directories, not files, are met with their ancestors: a directory of very many files is one row.
    places = narrow.select(directory.alias("place")).where("place is not null").distinct()
    above = places.select("place", F.explode(ancestors(F.concat(F.col("place"), F.lit("/x")))).alias("up"))
    near = (
        above.select("place", "up.depth", "up.directory")
        .join(owners, "directory")
        .groupBy("place")
        .agg(F.max(F.struct("depth", "directory", "given")).alias("near"))
    )
    out = named.join(near, "place", "left")
    mine = F.col("own").isNotNull()
    given = F.col("near.given")
    return out.select(
        *[F.col(f"kept.`{c}`") for c in kept],
        F.when(mine, F.col("own.licence")).otherwise(given["licence"]).alias("licence"),
        (-F.when(mine, F.col("own.far")).otherwise(given["far"])).alias("cosine"),
        F.when(mine, F.lit("header")).when(given.isNotNull(), F.lit("inherited")).alias("found"),
        F.when(~mine, F.col("near.directory")).alias("licence_dir"),
    )
