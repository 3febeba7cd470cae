"""Licence notices in documents, by a trained paragraph classifier.

A paragraph is a line with a word. Paragraphs that name a licence, a permission or the like are described by hashed
one- and two-word sequences and classified by logistic regression: a licence family, a licence of no known family, or no
licence. The classifier is trained on windows of words of the notices below and on lines of the corpus; its
probabilities are calibrated on windows held back, and what is less sure than the threshold found there is unknown.
A family is confirmed if the paragraph has its name and a word pair that only this family's notices have, or half of the
word pairs of a long notice, which needs no name. The trained weights are a constant of
fixed size in one expression over the text, so that documents are read once and nothing is shuffled.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pageflow.llm.common import prepared, sampled, saved, table

# Notices of the families, of licences of no family, and sentences near to the subject without a licence.
NOTICES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
        "This project is licensed under the terms of the Apache 2.0 license",
        "SPDX-License-Identifier: Apache-2.0", "Distributed under the terms of Apache 2.0", "Released under Apache 2.0",
        "License: Apache 2.0"),
    "bsd": (
        "Released under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
        "This software is licensed under the BSD license", "Distributed under the terms of BSD 2-Clause", "Released under BSD 3-Clause",
        "SPDX-License-Identifier: BSD-3-Clause", "License: BSD"),
    "cc": (
        "Licensed under CC BY-NC 4.0", "Licensed under CC BY-SA 4.0", "Licensed under CC BY 4.0", "Available under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "This article is available under the Creative Commons Attribution-NonCommercial licence",
        "SPDX-License-Identifier: CC-BY-4.0"),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program",
        "Released under the GNU GPL version 2 or later", "Released under the GPL 3", "Released under GPL 3", "Distributed under the GPL 2 or later",
        "SPDX-License-Identifier: GPL-2.0-or-later", "SPDX-License-Identifier: LGPL-2.1-or-later", "License: GPL 2",
        "Distributed under the LGPL 2.1 or later", "Available under the AGPL 3.0",
        "Licensed under the GNU Lesser General Public License, LGPL 3", "Licensed under the GNU Affero General Public License, AGPL 3.0"),
    "mit": (
        "Released under the MIT License", "This project is licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT", "Distributed under the terms of MIT", "Released under MIT",
        "The MIT License (MIT)"),
    "mozilla": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License 2.0", "Released under the MPL 2.0", "Available under MPL 2", "Released under MPL 2",
        "SPDX-License-Identifier: MPL-2.0"),
    "reserved": (
        "Copyright 2020 Example Corporation. All rights reserved", "Copyright 2011 Smith. All rights reserved", "All rights reserved", "All rights reserved. No part of this publication may be reproduced",
        "Reproduction or redistribution in whole or in part without written permission of the publisher is prohibited"),
    "unknown": (
        "Licensed under the Example Software License Agreement", "Released under the terms of the Orchard Community Licence, version 1.1",
        "Use of this data set is subject to the licence agreement of the institute", "This font is licensed under the terms given by its foundry",
        "The licence fee is due every year", "A licence is required for any commercial use of these recordings"),
    "none": (
        "The driver lost his license after the accident", "She asked for permission to leave the room",
        "The warranty covers parts and labour for two years", "Fishing without a license is not allowed here",
        "He was granted permission to build a house", "The council released its report under pressure",
        "Taxi drivers need a licence from the city", "They copied the recipe without asking",
        "She studied physics at MIT", "The Apache lived in the south west", "Firefox is a browser made by Mozilla",
        "A gnu grazed beside the river", "The server runs Apache on a BSD system",
        "The GNU compiler is written in C", "The GNU tools were ported to other machines in 1991", "The BSD kernel boots in seconds",
        "A BSD machine served the pages", "The Apache foundation hosts many projects", "The MIT campus lies on the river",
        "Mozilla was founded in 1998", "The creative commons of the village was a meadow"),
}
LABELS = tuple(sorted(NOTICES))
FAMILIES = tuple(x for x in LABELS if x not in ("unknown", "none"))
# The families' short names, also before a version or a dash. MIT counts in capitals alone, as "mit" is a word of German.
NAMES = {
    "apache": r"apache", "bsd": r"\bbsd", "cc": r"\bcc[-\s]+by(?![a-z])|creative\s+commons|\bcc0", "gpl": r"\b[al]?gpl|\bgnu\b",
    "mit": r"(?-i:\bMIT(?![A-Za-z]))", "mozilla": r"mozilla|\bmpl(?![a-z&&[^v]])", "reserved": r"rights\s+reserved|copyright"}
# Lines with neither a name nor one of these stems are no licence notices.
STEMS = "(?i)" + "|".join((r"licen[cs]|redistribut|permission|spdx|public\s+domain", *NAMES.values()))
# Lines of the corpus that train the classifier at most, hashed features, and words of a training window at least.
SAMPLE, FEATURES, FEWEST = 400, 1 << 11, 4
# They are from texts of under so many characters, and have at least and at most so many themselves.
SAMPLE_CHARS, SAMPLE_LINE = 20_000, (10, 400)
# Share of right answers asked of what is not called unknown, and of the word pairs of a notice with so many at least that
# confirm a family without its name.
SURE, SHARED, LONG = 0.95, 0.5, 8


def tokens(text: Column) -> Column:
    """Lower-case words of letters, digits, dots and dashes, without dots at their ends; names stand apart from versions."""
    apart = F.regexp_replace(F.lower(text), r"\b([al]?gpl|mpl|apache|bsd|cc[-\s]+by(?:-(?:nc|sa|nd))*)[-\s]?v?[.]?(?=[0-9])", "$1 ")
    apart = F.regexp_replace(apart, r"\bcc-by(?![a-z])", "cc by")
    return F.filter(F.split(F.regexp_replace(apart, r"[.]+(?=\s|$)|[^\p{L}\p{N}.\-\s]+", " "), r"\s+"), lambda w: w != "")


def pairs(words: Column) -> Column:
    return F.when(F.size(words) > 1, F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(
        " ", F.get(words, i), F.get(words, i + 1)))).otherwise(F.array().cast("array<string>"))


def features(words: Column) -> Column:
    """Places of the words and word pairs among the hashed features."""
    return F.array_distinct(F.transform(F.concat(words, pairs(words)), lambda g: F.pmod(F.xxhash64(g), F.lit(FEATURES)).cast("int")))


def notices(spark: SparkSession) -> DataFrame:
    """label, words of the fixed notices."""
    rows = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(text).alias("text")) for label in LABELS for text in NOTICES[label]])
    return spark.range(1).select(F.inline(rows)).select("label", tokens(F.col("text")).alias("words"))


@dataclass
class Classifier:
    """Weights by label and feature, a bias by label, the temperature that calibrates them, the probability below which a
    family is unknown, the word pairs of the families' long notices, and of each family those that no other label has."""

    weights: list[float]
    biases: list[float]
    temperature: float
    threshold: float
    notices: list[tuple[str, list[str]]]
    particular: dict[str, list[str]]

    def judged(self, lines: Column) -> Column:
        """label, probability and confirmed of each line of an array."""
        weights, biases = F.lit(self.weights), F.lit(self.biases)
        known = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(own).alias("pairs")) for label, own in self.notices])

        def kept(x):
            return x["line"].alias("line"), x["pairs"].alias("pairs")

        def raw(on):
            return F.transform(F.sequence(F.lit(0), F.lit(len(LABELS) - 1)), lambda k: F.aggregate(
                on, F.element_at(biases, k + 1), lambda total, i: total + F.element_at(weights, k * FEATURES + i + 1)))

        def named(x):
            best = F.element_at(F.lit(list(LABELS)), F.array_position(x["p"], F.array_max(x["p"])).cast("int"))
            sure = (F.array_max(x["p"]) >= self.threshold) | (best == "none")
            return F.struct(F.when(sure, best).otherwise("unknown").alias("label"), F.array_max(x["p"]).alias("p"), *kept(x))

        def confirmed(x):
            def shared(notice):
                return (notice["label"] == x["label"]) & (
                    F.size(F.array_intersect(notice["pairs"], x["pairs"])) >= F.size(notice["pairs"]) * SHARED)

            def called(label):
                return (x["label"] == label) & x["line"].rlike(f"(?i){NAMES[label]}") & F.arrays_overlap(x["pairs"], F.lit(self.particular[label]))

            names = reduce(lambda a, b: a | b, map(called, FAMILIES))
            return F.struct(x["label"].alias("label"), F.round(x["p"], 3).alias("probability"),
                            (names | F.exists(known, shared)).alias("confirmed"))

        each = F.transform(lines, lambda t: F.struct(t.alias("line"), tokens(t).alias("words")))
        each = F.transform(each, lambda x: F.struct(
            x["line"].alias("line"), F.array_distinct(pairs(x["words"])).alias("pairs"), features(x["words"]).alias("on")))
        each = F.transform(each, lambda x: F.struct(*kept(x), raw(x["on"]).alias("raw")))
        each = F.transform(each, lambda x: F.struct(*kept(x), _probabilities(x["raw"], F.lit(self.temperature)).alias("p")))
        return F.transform(F.transform(each, named), confirmed)


def _training(spark: SparkSession, plain: DataFrame) -> DataFrame:
    """label, words, held: windows of the notices' words, whole notices, and plain lines. Every fifth window is held back."""
    base = notices(spark)
    sizes = F.filter(F.sequence(F.lit(FEWEST), F.greatest(F.size("words"), F.lit(FEWEST))), lambda k: k <= F.size("words"))
    sized = base.select("label", "words", F.explode(sizes).alias("k"))
    step = F.greatest(F.lit(1), F.floor(F.col("k") / 3).cast("int"))
    starts = sized.select("label", "k", "words", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("k") + 1, step)).alias("i"))
    cut = starts.select("label", F.expr("slice(words, i, k)").alias("words"))
    # A fragment that several families share teaches nothing.
    own = cut.groupBy("words").agg(F.count_distinct("label").alias("n"), F.first("label").alias("label")).where("n = 1")
    lines = plain.select(F.lit("none").alias("label"), tokens(F.col("text")).alias("words")).where("size(words) > 0")
    held = F.pmod(F.xxhash64("words"), F.lit(5)) == 0
    rows = own.select("label", "words", held.alias("held")).union(base.select("label", "words", F.lit(False)))
    return rows.union(lines.select("label", "words", held))


def plain_lines(docs: DataFrame) -> DataFrame:
    """At most `SAMPLE` different lines of the corpus without a stem: those with the smallest hashes."""
    lines = docs.where(F.length("text") < SAMPLE_CHARS).select(F.explode(F.split("text", "\n")).alias("text")).where(
        F.length("text").between(*SAMPLE_LINE) & ~F.col("text").rlike(STEMS))
    return sampled(lines, SAMPLE)


def fit(docs: DataFrame) -> Classifier:
    """Trained on the notices and on plain lines of the corpus."""
    spark = docs.sparkSession
    number = (F.array_position(F.lit(list(LABELS)), F.col("label")) - 1).cast("double")
    on = _training(spark, plain_lines(docs)).select("held", number.alias("label"), features(F.col("words")).alias("on"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(FEATURES - 1)), lambda i: F.array_contains("on", i).cast("double"))
    data = saved(on.select("held", "label", dense.alias("dense")), "training").select(
        "held", "label", array_to_vector("dense").alias("features"))
    model = LogisticRegression(maxIter=60, regParam=0.002, family="multinomial").fit(data.where("not held"))
    judged = saved(model.transform(data.where("held")).select("label", vector_to_array("rawPrediction").alias("raw")), "held-back")
    choices = [0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0]
    each = judged.select("label", "raw", F.explode(F.lit(choices)).alias("t"))
    right = F.element_at(_probabilities(F.col("raw"), F.col("t")), F.col("label").cast("int") + 1)
    losses = each.groupBy("t").agg(F.avg(-F.ln(F.greatest(right, F.lit(1e-9)))).alias("loss")).collect()
    temperature = min(((r["loss"], r["t"]) for r in losses), default=(0.0, 1.0))[1]
    best = F.array_max(_probabilities(F.col("raw"), F.lit(temperature)))
    guess = F.array_position("raw", F.array_max("raw")) - 1
    sure = judged.select(best.alias("p"), (guess == F.col("label")).cast("double").alias("ok"), F.explode(
        F.lit([x / 20 for x in range(6, 20)])).alias("x")).where("p >= x")
    shares = sure.groupBy("x").agg(F.avg("ok").alias("right")).collect()
    threshold = min((r["x"] for r in shares if r["right"] >= SURE), default=0.95)
    own = [(r["label"], r["p"]) for r in notices(spark).select("label", F.array_distinct(pairs(F.col("words"))).alias("p")).collect()]
    held_by: dict[str, set[str]] = {}
    for label, some in own:
        for pair in some:
            held_by.setdefault(pair, set()).add(label)
    particular = {label: sorted(p for p, labels in held_by.items() if labels == {label}) for label in FAMILIES}
    weights = model.coefficientMatrix.toArray().round(6).ravel().tolist()
    return Classifier(weights, model.interceptVector.toArray().round(6).tolist(), float(temperature), float(threshold),
                      [(label, some) for label, some in own if label in FAMILIES and len(some) >= LONG], particular)


def _probabilities(raw: Column, temperature: Column) -> Column:
    """Softmax of the scores over the temperature."""
    powers = lambda: F.transform(raw, lambda x: F.exp((x - F.array_max(raw)) / temperature))
    total = F.aggregate(powers(), F.lit(0.0), lambda a, b: a + b)
    return F.transform(powers(), lambda p: p / total)


def licenses(docs: DataFrame, classifier: Classifier | None = None) -> DataFrame:
    """doc_id, n_notices, license, families, probability and confirmed of every document.

    `license` is the family of the surest confirmed notice, else 'unknown' if there is a notice of any kind, else null, and
    `probability` that notice's; `families` are all confirmed families by name, joined by commas. One row per row of `docs`,
    whatever its doc_id; null and empty texts have no notices, no rows give none, and texts of any length are read whole. Of
    equally sure notices the label last by name counts. Other columns are ignored. Lines without a name or stem of `STEMS` are
    not scored.
    """
    model = classifier or fit(docs)
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda line: line.rlike(STEMS))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lines.alias("lines")).select("doc_id", F.filter(
        model.judged(F.col("lines")), lambda x: x["label"] != "none").alias("found"))
    ranked = found.select("doc_id", F.inline(F.array(F.struct("found", F.array_max(F.transform("found", lambda x: F.struct(
        (x["confirmed"] & (x["label"] != "unknown")).alias("known"), x["probability"].alias("probability"), x["label"].alias("label")))).alias("best")))))
    families = F.transform(F.filter("found", lambda x: x["confirmed"]), lambda x: x["label"])
    return ranked.select(
        "doc_id", F.size("found").cast("long").alias("n_notices"),
        F.when(F.col("best.known"), F.col("best.label")).when(F.col("best").isNotNull(), "unknown").alias("license"),
        F.array_join(F.sort_array(F.array_distinct(families)), ",").alias("families"),
        F.col("best.probability").alias("probability"), F.coalesce("best.known", F.lit(False)).alias("confirmed"))


def op1_licenses(spark, sf_dir: str) -> DataFrame:
    return licenses(table(prepared(spark), sf_dir, "documents"))
