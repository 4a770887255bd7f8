"""License scan: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a line; a run of lines without a blank one is a paragraph too, where it holds most of a template and none of
its lines does, so wrapped notices are found. A run is judged by its words and pairs that occur in templates, has the number
of its first line, and is returned only if confirmed. A paragraph's features are the words and word pairs that the templates have,
all of them, common or rare: a few hundred, as many as the templates need. A multinomial
logistic regression with an L1 penalty, one class per family and one for everything else, is trained on
the templates and on every paragraph of every document; of those, the ones that hold
a template are labelled with its family, all others are unknown, and classes weigh the same. A paragraph gets
the likeliest family if its probability passes a threshold that nearly all unknown training paragraphs
stay below. A prediction is confirmed if the paragraph holds most of a template of that family.

The features of all lines are worked out once and stored, as hashes. Paragraphs with the same features are one training row that weighs as
many, which is the same fit. The threshold is taken to six decimals, so that its quantile keeps a million counts at most.

Training and scoring stay in DataFrame operations; the driver holds weights only, one for each feature and family.

Defined results: null and empty texts have no paragraph and give no row, nor have empty tables. Ties between families go
to the first in alphabetic order. Repeated rows, also with null ids, give the rows of each.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrytally.llm.common import let, stored, table, upto

# The usual wording of common licences.
TEMPLATES = {
    "agpl-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
    ],
    "all-rights-reserved": [
        "All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without prior permission.",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    ],
    "bsd-3-clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met.",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc0-1.0": [
        "Released into the public domain under CC0 1.0.",
        "This is free and unencumbered software released into the public domain.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    ],
    "lgpl-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction.",
    ],
    "mpl-2.0": [
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
}
UNKNOWN = "unknown"


@dataclass(frozen=True)
class Settings:
    parts: int = 4  # of the training set, at least: every iteration visits all of them
    part_rows: int = 20_000  # of a part of the training set
    penalty: float = 0.0005
    holds: float = 0.9  # of a template's features, to label a training paragraph
    confirms: float = 0.75  # of a template's features, to confirm a prediction
    unknown_quantile: float = 0.999
    least_probability: float = 0.5


def paragraphs(numbered: DataFrame) -> DataFrame:
    """doc_id, __row, number and text of every line with a word."""
    lines = numbered.select("doc_id", "__row", F.posexplode(F.split(F.col("text").cast("string"), "\n", -1)).alias("paragraph", "line"))
    return lines.filter(F.col("line").rlike("[\\p{L}\\p{N}]"))


def _line_breaks(text: Column) -> Column:
    return F.size(F.split(text, "\n", -1)) - 1


def runs(numbered: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, __row, paragraph and hits of every run of lines that holds a template which none of its lines holds."""
    kept = [hashes for _, hashes in template_hashes(numbered.sparkSession)]
    every = sorted({h for hashes in kept for h in hashes})
    templates = [F.array(*[F.lit(h) for h in hashes]) for hashes in kept]

    def held(hits: Column) -> Column:
        return F.array(*[F.size(F.array_intersect(hits, t)) / F.size(t) >= settings.confirms for t in templates])

    def hits(text: Column) -> Column:
        return F.array_distinct(F.filter(hashed_grams(text), lambda h: h.isin(every)))

    # A piece is a run of lines after at most one blank line.
    pieces = F.split(F.col("text").cast("string"), "(?<=\n)(?=[^\\S\n]*\n)", -1)
    long = F.filter(
        F.transform(pieces, lambda p, i: F.struct(i.alias("at"), p.alias("line"))),
        lambda x: F.trim(F.regexp_replace(x["line"], "^\\s+|\\s+$", "")).contains("\n"),
    )
    least = min(len(h) for h in kept) * settings.confirms
    some = F.filter(
        F.transform(long, lambda x: F.struct(x["at"].alias("at"), x["line"].alias("line"), hits(x["line"]).alias("hits"))),
        lambda x: F.size(x["hits"]) >= least,
    )
    # Lines are looked at only where the whole run holds a template.
    some = F.filter(some, lambda x: F.exists(held(x["hits"]), lambda b: b))
    holding = F.filter(some, lambda x: F.exists(
        F.zip_with(
            held(x["hits"]), F.aggregate(
                F.transform(F.split(x["line"], "\n", -1), lambda l: held(hits(l))),
                F.array(*[F.lit(False)] * len(kept)), lambda a, b: F.zip_with(a, b, lambda p, q: p | q),
            ), lambda whole, own: whole & ~own,
        ), lambda b: b,
    ))
    found = numbered.select("doc_id", "__row", "text", F.explode(holding).alias("x"))
    before = F.array_join(F.slice(pieces, 1, F.col("x.at")), "")
    blank = F.when(F.col("x.line").rlike("^[^\\S\n]*\n"), 1).otherwise(0)
    return found.select(
        "doc_id", "__row", (_line_breaks(before) + blank).alias("paragraph"), F.col("x.hits").alias("hits")
    )


def grams(line: Column) -> Column:
    """The words and word pairs of a paragraph, once each."""
    w = F.array_remove(F.split(F.lower(line), "[^\\p{L}\\p{N}]+", -1), "")
    return let(w, lambda a: F.array_distinct(F.concat(
        a, F.transform(upto(F.size(a) - 1), lambda i: F.concat_ws(" ", F.get(a, i), F.get(a, i + 1)))
    )))


def hashed_grams(line: Column) -> Column:
    """``grams`` as 64-bit hashes, without building the pairs."""
    w = F.array_remove(F.split(F.lower(line), "[^\\p{L}\\p{N}]+", -1), "")
    return let(w, lambda a: F.concat(
        F.transform(a, lambda x: F.xxhash64(x)),
        F.transform(upto(F.size(a) - 1), lambda i: F.xxhash64(F.get(a, i), F.lit(" "), F.get(a, i + 1))),
    ))


def _gram_hash(gram: Column) -> Column:
    parts = F.split(gram, " ")
    return F.when(F.size(parts) == 1, F.xxhash64(gram)).otherwise(F.xxhash64(F.get(parts, F.lit(0)), F.lit(" "), F.get(parts, F.lit(1))))


def template_table(spark: SparkSession) -> DataFrame:
    """family and features of every template."""
    rows = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    return spark.createDataFrame(rows, "family string, line string").select("family", grams(F.col("line")).alias("template"))


def template_hashes(spark: SparkSession) -> list[tuple[str, list[int]]]:
    """Family and feature hashes of every template."""
    rows = template_table(spark).select("family", F.transform("template", _gram_hash).alias("hashes")).collect()
    return [(r["family"], sorted(set(r["hashes"]))) for r in rows]


def _held(features: Column, template: Column) -> Column:
    """The share of a template's features that a paragraph has."""
    return F.size(F.array_intersect(features, template)) / F.size(template)


@dataclass(frozen=True)
class Model:
    weights: DataFrame  # (gram, w): a feature that counts, and its weight in each class
    features: list[int]  # the hashes of those features
    classes: list[str]
    intercepts: list[float]
    threshold: float

    def logits(self, sums: Column) -> Column:
        return F.zip_with(F.array(*[F.lit(x) for x in self.intercepts]), sums, lambda a, b: a + b)


def hit_lines(numbered: DataFrame) -> DataFrame:
    """doc_id, __row, paragraph and hits of every paragraph: the hashes of its features, sorted; often there are none."""
    every = sorted({h for _, hashes in template_hashes(numbered.sparkSession) for h in hashes})
    hits = F.array_distinct(F.filter(hashed_grams(F.col("line")), lambda h: h.isin(every)))
    return paragraphs(numbered).select("doc_id", "__row", "paragraph", F.sort_array(hits).alias("hits"))


def training_rows(lines: DataFrame, settings: Settings) -> DataFrame:
    """family, hits and number of the templates and of all paragraphs, those with the same hits as one row."""
    known = template_hashes(lines.sparkSession)
    templates = lines.sparkSession.createDataFrame(known, "family string, hits array<bigint>").withColumn("n", F.lit(1).cast("bigint"))
    best = F.array_max(F.array(*[
        F.struct(_held(F.col("hits"), F.array(*[F.lit(h) for h in hashes])).alias("held"), F.lit(len(hashes)).alias("size"), F.lit(family).alias("family"))
        for family, hashes in known
    ]))
    labelled = lines.groupBy("hits").agg(F.count(F.lit(1)).alias("n")).withColumn("best", best).select(
        F.when(F.col("best.held") >= settings.holds, F.col("best.family")).otherwise(UNKNOWN).alias("family"), "hits", "n"
    )
    return templates.unionByName(labelled)


def vocabulary(spark: SparkSession) -> list[int]:
    """The hashes of the grams of all templates: what else is in a paragraph says nothing about its licence."""
    every = template_table(spark).select(F.explode("template").alias("gram")).distinct()
    return [r["hash"] for r in every.select("gram", _gram_hash(F.col("gram")).alias("hash")).orderBy("gram").collect()]


def train(lines: DataFrame, settings: Settings = Settings()) -> Model:
    """The model of the ``hit_lines`` of all documents."""
    spark = lines.sparkSession
    classes = [UNKNOWN, *sorted(TEMPLATES)]
    rows = stored(training_rows(lines, settings).withColumn(
        "label", F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("family")).cast("double") - 1
    ))
    counts = {r["label"]: r for r in rows.groupBy("label").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("sets")).collect()}
    total, sets = (sum(r[c] for r in counts.values()) for c in ("n", "sets"))
    weight = F.lit(1.0)
    for label, r in counts.items():
        weight = F.when(F.col("label") == label, F.lit(total / len(counts) / r["n"])).otherwise(weight)
    rows = rows.repartition(max(settings.parts, -(-sets // settings.part_rows))).persist()
    # The hashes are the words of the vocabulary.
    hashes = vocabulary(spark)
    vector = CountVectorizerModel.from_vocabulary([str(h) for h in hashes], "terms", "features").setBinary(True)
    fit = LogisticRegression(
        family="multinomial", regParam=settings.penalty, elasticNetParam=1.0, weightCol="weight", maxIter=25, standardization=False,
    ).fit(vector.transform(rows.select("label", F.col("hits").cast("array<string>").alias("terms"), (weight * F.col("n")).alias("weight"))))
    matrix = fit.coefficientMatrix.toArray()
    size = matrix.shape[0]
    kept = [i for i in range(matrix.shape[1]) if abs(matrix[:, i]).max() > 1e-6]
    features = [hashes[i] for i in kept]
    weights = spark.createDataFrame([(hashes[i], [float(x) for x in matrix[:, i]]) for i in kept], "gram bigint, w array<double>")
    model = Model(weights, features, classes[:size], [float(x) for x in fit.interceptVector], 0.0)
    unknown = rows.filter(F.col("label") == 0).select("n", F.monotonically_increasing_id().alias("paragraph"), F.col("hits").alias("found"))
    likely = F.floor(F.col("probability") * 1e6) / 1e6
    limit = _probabilities(unknown, model).agg(F.percentile(likely, settings.unknown_quantile, F.col("n"))).first()[0]
    rows.unpersist()
    return Model(weights, features, model.classes, model.intercepts, max(settings.least_probability, limit or 0.0))


def _probabilities(known: DataFrame, model: Model, least: float = 0.0) -> DataFrame:
    """The likeliest family of each paragraph (doc_id, paragraph, ... found) with a feature that counts.

    Paragraphs that cannot reach the probability ``least`` fall out before probabilities are worked out: the likeliest family must
    be so much likelier than none. Features are looked up in the one broadcast table of weights, which the templates bound; paragraphs without any fall out there.
    """
    keys = [c for c in known.columns if c != "found"]
    size = len(model.classes)
    each = known.select(*keys, F.explode(F.array_distinct("found")).alias("gram")).join(F.broadcast(model.weights), "gram")
    sums = each.groupBy(*keys).agg(*[F.sum(F.get("w", F.lit(k))).alias(f"s{k}") for k in range(size)])
    if least > 0 and size > 1:
        families = [F.col(f"s{k}") + model.intercepts[k] for k in range(1, size)]
        best = F.greatest(*families) if len(families) > 1 else families[0]
        sums = sums.filter(best - F.col("s0") - model.intercepts[0] >= math.log(least / (1 - min(least, 1 - 1e-12))) - 1e-6)
    logits = F.array(*[F.round(F.col(f"s{k}") + model.intercepts[k], 9) for k in range(size)])
    odds = sums.select(*keys, logits.alias("z")).withColumn(
        "e", F.transform("z", lambda x: F.exp(x - F.array_max("z")))
    ).withColumn("total", F.aggregate("e", F.lit(0.0), lambda a, x: a + x))
    families = F.slice("e", 2, size - 1)
    return odds.select(*keys, F.array_max(families).alias("top"), families.alias("families"), "total").select(
        *keys, F.get(F.array(*[F.lit(c) for c in model.classes[1:]]), (F.array_position("families", F.col("top")) - 1).cast("int")).alias("family"),
        (F.col("top") / F.col("total")).alias("probability"),
    )


def scan(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per paragraph that is predicted to be a licence notice."""
    # The row number tells repeated rows apart.
    numbered = docs.select("doc_id", "text").withColumn("__row", F.monotonically_increasing_id())
    lines = stored(hit_lines(numbered))
    model = train(lines, settings)
    found = F.filter("hits", lambda h: h.isin(model.features))
    known = lines.select("doc_id", "__row", "paragraph", "hits", found.alias("found"), F.lit(False).alias("run"))
    wrapped = runs(numbered, settings).select(
        "doc_id", "__row", "paragraph", "hits", F.col("hits").alias("found"), F.lit(True).alias("run")
    )
    predicted = _probabilities(known.unionByName(wrapped).filter(F.size("found") > 0), model, model.threshold).filter(F.col("probability") >= model.threshold)
    templates = docs.sparkSession.createDataFrame(template_hashes(docs.sparkSession), "family string, template array<bigint>")
    compared = predicted.join(F.broadcast(templates), "family")
    best = compared.groupBy("doc_id", "__row", "paragraph", "run", "family", "probability").agg(
        F.max(_held(F.col("hits"), F.col("template"))).alias("similarity")
    )
    return best.filter(~F.col("run") | (F.col("similarity") >= settings.confirms)).select(
        "doc_id", "paragraph", "family", "probability", "similarity", (F.col("similarity") >= settings.confirms).alias("confirmed")
    )


def query(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
