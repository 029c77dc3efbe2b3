"""Licence scan: a trained paragraph classifier, confirmed by templates.

Paragraphs (lines with a word) are represented by the words and word pairs of a bounded
vocabulary. A sparse multinomial logistic regression tells licence families from other text. It
is trained on public licence sentences, each in ``VARIANTS`` versions with some words left out,
against a bounded sample of paragraphs of the corpus (about ``NEGATIVES``) that resemble no
template. Half of the labelled rows train; the other half calibrates the unknown class: a
paragraph is unknown if no family reaches the probability that at most ``FALSE_SHARE`` of the
held-out other paragraphs reach. A prediction is confirmed if the paragraph holds at least
``CONFIRM`` of the word triples of one of the family's templates.

Notices that are wrapped over several lines are found in blocks, runs of lines with a word: a
block names every family of which it holds ``CONFIRM`` of a template's triples, unless one of its
lines is confirmed for that family already. A family goes if all triples that speak for it also speak,
with more, for another one. Its row has the number of the block's first line and the probability of
that family.

Defined results: null and empty texts have no paragraph and no row. Repeated rows give repeated
results. Very long paragraphs are whole. The corpus sample is chosen by a hash of id and
paragraph, so it does not depend on partitioning.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettersieve.llm.common import let
from lettersieve.sources.shared import stored

VARIANTS = 24
DROP_PERCENT = 12
NEGATIVES = 4000
VOCABULARY = 1 << 13
FALSE_SHARE = 0.001
CONFIRM = 0.5
OTHER = "unknown"

# Sentences of public licences by family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "This software is distributed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "reserved": ("All rights reserved.", "Copyright, all rights reserved."),
}
# Sentences that use the words of licences without granting one.
HARD_NEGATIVES = (
    "The driving license of the applicant was renewed by the office.",
    "The general public is invited to the free concert.",
    "The software version of the device is shown on the second page.",
    "Common people created the work of art under difficult conditions.",
    "A person without a license may not drive a car in this country.",
)


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def pairs(words: Column) -> Column:
    return F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )


def terms(text: Column) -> Column:
    return let(tokens(text), lambda words: F.concat(words, pairs(words)))


def triples(text: Column) -> Column:
    """Distinct word triples; the whole paragraph if it is shorter."""

    def picked(words: Column) -> Column:
        # By position: a slice would copy the whole array for every triple.
        at = F.sequence(F.lit(0), F.greatest(F.size(words) - 3, F.lit(0)))
        return F.transform(at, lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(3)]))

    return F.array_distinct(let(tokens(text), picked))


def template_triples(template: str) -> list[str]:
    words = re.findall("[a-z0-9]+", template.lower())
    return sorted({" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))})


def paragraphs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, paragraph, body): the lines of each text that hold a word, numbered from 0."""
    return (
        docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("paragraph", "body"))
        .filter(F.col("body").rlike("[A-Za-z0-9]"))
    )


def blocks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, paragraph, body): runs of two or more lines with a word, numbered by their first line."""

    def edges(has: Column, beyond: int) -> Column:
        """The lines with a word whose neighbour ``beyond`` has none."""
        at = F.sequence(F.lit(0), F.size(has) - 1)
        return F.filter(at, lambda i: F.get(has, i) & ~F.coalesce(F.get(has, i + beyond), F.lit(False)))

    def runs(lines: Column) -> Column:
        def cut(first: Column, last: Column) -> Column:
            body = F.array_join(F.slice(lines, first + 1, last - first + 1), "\n")
            return F.struct(first.alias("paragraph"), last.alias("last"), body.alias("body"))

        return let(
            F.transform(lines, lambda line: line.rlike("[A-Za-z0-9]")),
            lambda has: F.zip_with(edges(has, -1), edges(has, 1), cut),
        )

    found = let(F.split(text, "\n"), runs)
    return (
        docs.filter(F.col(text).isNotNull())
        .select(F.col(doc_id).alias("doc_id"), F.inline(found))
        .filter("last > paragraph")
        .drop("last")
    )


def _held(body: Column) -> Column:
    """The distinct word triples of a text that some template has."""
    known = sorted({t for texts in TEMPLATES.values() for text in texts for t in template_triples(text)})
    return F.filter(triples(body), lambda t: t.isin(known))


def _alike(body: Column) -> Column:
    """Array of (known, similarity, own): templates of which a text has enough, by family and common triples."""
    templates = F.array(
        *[
            F.struct(F.lit(family).alias("known"), F.array(*map(F.lit, template_triples(text))).alias("all"))
            for family, texts in TEMPLATES.items()
            for text in texts
        ]
    )

    def matched(t: Column, held: Column) -> Column:
        own = F.array_intersect(t["all"], held)
        return F.struct(t["known"].alias("known"), (F.size(own) / F.size(t["all"])).alias("similarity"), own.alias("own"))

    found = let(_held(body), lambda held: F.transform(templates, lambda t: matched(t, held)))
    return F.filter(found, lambda m: m["similarity"] >= CONFIRM)


def wrapped(bodies: DataFrame) -> DataFrame:
    """``bodies`` of several lines with known, similarity and lines: a row per family that a block confirms.

    ``lines`` are those that hold enough of a template of the family alone.
    """

    def explained(m: Column, found: Column) -> Column:
        return F.exists(
            found,
            lambda o: (o["known"] != m["known"])
            & (F.size(o["own"]) > F.size(m["own"]))
            & (F.size(F.array_except(m["own"], o["own"])) == 0),
        )

    def families(found: Column) -> Column:
        return F.array_distinct(F.transform(found, lambda m: m["known"]))

    def best(found: Column, known: Column) -> Column:
        return F.array_max(F.transform(F.filter(found, lambda m: m["known"] == known), lambda m: m["similarity"]))

    def alone(known: Column) -> Column:
        return F.filter(F.split("body", "\n"), lambda line: F.array_contains(families(_alike(line)), known))

    def together(found: Column) -> Column:
        left = F.filter(found, lambda m: ~explained(m, found))
        return F.transform(
            families(left),
            lambda known: F.struct(
                known.alias("known"), best(found, known).alias("similarity"), alone(known).alias("lines")
            ),
        )

    # Few blocks hold any triple of a template: the rest is done for those only.
    some = bodies.filter(F.size(_held(F.col("body"))) > 0)
    return some.select(*bodies.columns, F.inline(let(_alike(F.col("body")), together)))


def similarity(body: Column, family: str) -> Column:
    """The largest share of a template's word triples that a paragraph holds."""

    def share(own: Column, template: str) -> Column:
        known = template_triples(template)
        return F.size(F.array_intersect(own, F.array(*map(F.lit, known)))) / len(known)

    return let(triples(body), lambda own: F.array_max(F.array(*[share(own, t) for t in TEMPLATES[family]])))


def labelled(bodies: DataFrame, negatives: int = NEGATIVES) -> DataFrame:
    """(label, family, body, train): variants of the templates and paragraphs of the corpus."""
    spark = bodies.sparkSession
    rows = [(i + 1, family, text) for i, (family, texts) in enumerate(TEMPLATES.items()) for text in texts]
    rows += [(0, OTHER, text) for text in HARD_NEGATIVES]
    variants = (
        spark.createDataFrame(rows, "label int, family string, whole string")
        .withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
        .withColumn("words", F.split("whole", " "))
        .withColumn(
            "body",
            F.array_join(
                F.filter(
                    "words",
                    lambda w, i: (F.col("variant") == 0)
                    | (F.pmod(F.xxhash64("whole", "variant", w, i), F.lit(100)) >= DROP_PERCENT),
                ),
                " ",
            ),
        )
        .select("label", "family", "body", ((F.col("variant") % 2) == 0).alias("train"))
    )
    total = bodies.count()
    place = F.pmod(F.xxhash64("doc_id", "paragraph", F.lit("sample")), F.lit(1 << 30))
    share = min(1.0, negatives / max(total, 1))
    alike = reduce(or_, [similarity(F.col("body"), f) >= CONFIRM for f in TEMPLATES])
    others = (
        stored(bodies.filter(place < int(share * (1 << 30))), "licence-sample")
        .filter(~alike)
        .select(F.lit(0).alias("label"), F.lit(OTHER).alias("family"), "body", (place % 2 == 0).alias("train"))
    )
    return variants.union(others)


class Model:
    """A fitted vocabulary, regression and calibrated probability."""

    def __init__(self, vocabulary: CountVectorizerModel, regression: LogisticRegressionModel) -> None:
        self.vocabulary = vocabulary
        self.regression = regression
        self.least = 0.5

    def scored(self, bodies: DataFrame) -> DataFrame:
        """``bodies`` with label (the most probable class) and probability (of the best family)."""
        vectors = self.vocabulary.transform(bodies.withColumn("terms", terms(F.col("body"))))
        found = self.regression.transform(vectors)
        chances = vector_to_array("probability")
        families = F.slice(chances, 2, len(TEMPLATES))
        best = F.array_max(families)
        return found.withColumn("chance", best).withColumn(
            "family",
            F.when(
                best >= self.least,
                F.element_at(
                    F.array(*[F.lit(f) for f in TEMPLATES]), F.array_position(families, best).cast("int")
                ),
            ).otherwise(OTHER),
        ).withColumn("chances", families).drop("terms", "vector", "rawPrediction", "probability", "prediction")


def fit(spark: SparkSession, bodies: DataFrame) -> Model:
    rows = stored(labelled(bodies).select("label", "body", "train", terms(F.col("body")).alias("terms")), "licence-rows")
    vocabulary = CountVectorizer(inputCol="terms", outputCol="vector", vocabSize=VOCABULARY, minDF=2.0).fit(
        rows.filter("train")
    )
    train = vocabulary.transform(rows.filter("train"))
    regression = LogisticRegression(
        featuresCol="vector", labelCol="label", family="multinomial", regParam=1e-4, elasticNetParam=0.5, maxIter=60
    ).fit(train)
    model = Model(vocabulary, regression)
    # Bins of a thousandth: a bounded number of counts.
    bins = (
        model.scored(rows.filter("not train and label = 0").select("body"))
        .groupBy(F.floor(F.col("chance") * 1000).alias("bin"))
        .agg(F.count("*").alias("n"))
        .collect()
    )
    allowed, above = FALSE_SHARE * sum(b["n"] for b in bins), 0
    for b in sorted(bins, key=lambda b: -b["bin"]):
        above += b["n"]
        if above > allowed:
            model.least = min(0.99, max(0.5, (b["bin"] + 1) / 1000))
            break
    return model


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, paragraph, family, probability, similarity, confirmed) of paragraphs that name a family."""
    bodies = paragraphs(docs, doc_id, text)
    model = fit(docs.sparkSession, bodies)
    found = model.scored(bodies).filter(F.col("family") != OTHER)
    alike = F.lit(0.0)
    for family in TEMPLATES:
        alike = F.when(F.col("family") == family, similarity(F.col("body"), family)).otherwise(alike)
    columns = ["doc_id", "paragraph", "family", "probability", "similarity", "confirmed"]
    lines = stored(
        found.withColumn("similarity", F.round(alike, 4)).select(
            "doc_id",
            "paragraph",
            "family",
            F.round("chance", 4).alias("probability"),
            "similarity",
            (F.col("similarity") >= CONFIRM).alias("confirmed"),
            "body",
        ),
        "licence-lines",
    )
    names = F.array(*[F.lit(f) for f in TEMPLATES])
    of_blocks = stored(
        model.scored(wrapped(blocks(docs, doc_id, text))).select(
            "doc_id",
            "paragraph",
            F.col("known").alias("family"),
            F.round(F.element_at("chances", F.array_position(names, F.col("known")).cast("int")), 4).alias("probability"),
            F.round("similarity", 4).alias("similarity"),
            F.lit(True).alias("confirmed"),
            "lines",
        ),
        "licence-blocks",
    )
    # A line's class depends on its words alone, so an equal line of the same id stands for the block's own.
    said = (
        F.col("b.doc_id").eqNullSafe(F.col("l.doc_id"))
        & (F.col("b.family") == F.col("l.family"))
        & F.array_contains("b.lines", F.col("l.body"))
    )
    only_together = of_blocks.alias("b").join(lines.filter("confirmed").alias("l"), said, "left_anti")
    return lines.select(*columns).union(only_together.select(*columns))


def digest(docs: DataFrame) -> DataFrame:
    return scan(docs)
