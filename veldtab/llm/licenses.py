"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

Looked at are single lines and, for notices that are wrapped, stretches of lines of a paragraph (a run of lines between lines without
letters and digits): where ``CONFIRM`` of a template's word pairs stand in the joined paragraph, the whole of it and every stretch of up to
``SPAN`` lines is taken like a line. Their words and word pairs are hashed to a sparse vector of unit length, and an elastic-net multinomial
logistic regression gives a family or ``unknown``. It is fitted on the templates (whole, and with each word left out in turn) and, as the unknown
class, on notices of other families and on the paragraphs of a bounded sample of documents (``FIT_DOCS`` expected, chosen by a hash) that share
few word pairs with any template. A text that holds ``CONFIRM`` of a template's pairs has one of the words ``TELLING``, so lines and paragraphs without any are not looked at. A fifth of those rows is held back to fit the temperature that calibrates the probabilities. A paragraph counts as
a licence where the family is the likeliest class, its calibrated probability is at least ``LEAST``, and ``CONFIRM`` of the word
pairs of one of the family's templates stand in it; of the stretches of a paragraph
the one with the greatest share counts for a family, unless it overlaps that of another family with a greater share.

Everything runs as DataFrame expressions and ``pyspark.ml`` transformers in the JVM. The model has ``FEATURES`` weights per family.

``n_paragraphs`` counts the lines that are not blank, ``n_licence`` the lines at which a licence stands or begins.

Null and empty texts have no paragraphs. Long paragraphs are taken whole. Repeated rows get equal results; a table without rows gives
an empty result, and with no row to fit on only the templates are learned. Extra columns are dropped.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, NGram, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veldtab.llm.common import table
from veldtab.sources.storage import write_through

UNKNOWN = "unknown"
#: Opening sentences of public licences and usual notices.
TEMPLATES = {
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later"],
    "apache": [
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "bsd": [
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "cc": [
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0.",
        "Licensed under the Eclipse Public License, version 2.0.",
        "SPDX-License-Identifier: EPL-2.0"],
    "gpl": [
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC"],
    "lgpl": [
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 2.1."],
    "mit": [
        "SPDX-License-Identifier: MIT",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction."],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0"],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense"],
}
#: Notices of families that are not told apart, learned as unknown.
OTHERS = [
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "Licensed under the Boost Software License, Version 1.0.",
    "Licensed under the Artistic License 2.0.",
    "Licensed under the EUPL, Version 1.2 or later.",
    "Licensed under the Open Software License version 3.0.",
    "Released under the zlib License.",
    "Licensed under the Common Development and Distribution License, version 1.0.",
    "SPDX-License-Identifier: Zlib",
    "SPDX-License-Identifier: BSL-1.0",
    "SPDX-License-Identifier: Artistic-2.0",
    "SPDX-License-Identifier: EUPL-1.2",
    "SPDX-License-Identifier: OFL-1.1",
    "SPDX-License-Identifier: CDDL-1.0",
    "SPDX-License-Identifier: LicenseRef-Proprietary",
    "All rights reserved. This software is proprietary and may not be copied, modified or distributed without written permission.",
]
#: Words too common in any text to look for.
COMMON = set("a and any are as at be by can code copy file for found form free from in into is it may means of on option or other out permitted "
             "program public source terms that the this to under use version with without work you your".split())
FAMILIES = sorted(TEMPLATES)
FEATURES = 1 << 14
FIT_DOCS = 3_000
LEAST, CONFIRM, FAR = 0.5, 0.6, 0.2
SPLIT = r"[^\p{L}\p{N}]+"
BREAK = r"\n[^\p{L}\p{N}]*\n"
SPAN = 8
TEMPERATURES = [0.1, 0.2, 0.35, 0.5, 0.7, 0.85, 1.0, 1.2, 1.5, 2.0, 3.0, 5.0]


def _words(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def _pairs(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _telling() -> list[str]:
    """Words of which every text with ``CONFIRM`` of a template's word pairs has at least one, common words last."""
    needed = []
    for template in sorted({t for family in TEMPLATES.values() for t in family}):
        words = _words(template)
        left = _pairs(words)
        spare = len(left) - math.ceil(CONFIRM * len(left) - 1e-9)
        # as long as enough pairs for the share have none of the words, another word is needed
        choice = sorted(set(words), key=lambda w: (w in COMMON or w.isdigit(), w not in needed, -len(w), w))
        while len(left) >= len(_pairs(words)) - spare:
            word = choice.pop(0)
            rest = [p for p in left if word not in p.split()]
            if len(rest) < len(left):
                needed += [word] if word not in needed else []
                left = rest
    return needed


TELLING = r"(?<![\p{L}\p{N}])(?:" + "|".join(_telling()) + r")(?![\p{L}\p{N}])"


def with_terms(df: DataFrame) -> DataFrame:
    """Add ``words`` and ``pairs`` to rows with a ``paragraph``."""
    worded = df.withColumn("words", F.filter(F.split(F.lower("paragraph"), SPLIT), lambda w: w != ""))
    return NGram(n=2, inputCol="words", outputCol="pairs").transform(worded)


def with_vectors(df: DataFrame) -> DataFrame:
    """Add ``features`` to rows with ``words`` and ``pairs``."""
    termed = df.withColumn("terms", F.concat("words", "pairs"))
    hashed = HashingTF(numFeatures=FEATURES, binary=True, inputCol="terms", outputCol="hashed").transform(termed)
    return Normalizer(inputCol="hashed", outputCol="features").transform(hashed)


def covered(family: Column | None = None) -> Column:
    """The largest share of a template's word pairs that ``pairs`` holds, over the templates of the family (of all without one)."""
    listed = [(name, ", ".join(f"'{p}'" for p in _pairs(_words(t)))) for name in FAMILIES for t in TEMPLATES[name]]
    known = F.expr("array(" + ", ".join(f"named_struct('family', '{name}', 'pairs', array({pairs}))" for name, pairs in listed) + ")")
    own = known if family is None else F.filter(known, lambda t: t["family"] == family)
    every = F.expr("array(" + ", ".join(f"'{p}'" for p in sorted({p for name in FAMILIES for t in TEMPLATES[name] for p in _pairs(_words(t))})) + ")")
    # the templates are compared with the few pairs that any of them has; the array of one keeps those from being looked up for each template
    share = lambda held: F.array_max(F.transform(own, lambda t: F.size(F.array_intersect(held, t["pairs"])) / F.size(t["pairs"])))
    return F.coalesce(F.get(F.transform(F.array(F.array_intersect("pairs", every)), share), F.lit(0)), F.lit(0.0))


class LicenceModel:
    def __init__(self, regression: LogisticRegressionModel, temperature: float):
        self.regression, self.temperature = regression, temperature


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, place, paragraph): the lines of every text that are not blank."""
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"), F.posexplode(F.split(text_col, "\n")).alias("place", "paragraph"))
    return source.where(F.trim("paragraph") != "")


def _spread(raw: str, temperature: float) -> Column:
    """Sum of the exponentials of an array of numbers up to 0, at a temperature."""
    return F.aggregate(raw, F.lit(0.0), lambda total, x: total + F.exp(x / temperature))


def fit_licences(docs: DataFrame, text_col: str = "text", fit_docs: int = FIT_DOCS) -> LicenceModel:
    spark = docs.sparkSession
    rows = []
    for label, family in enumerate(FAMILIES):
        for template in TEMPLATES[family]:
            words = template.split()
            variants = [template] * 5 + [" ".join(words[:i] + words[i + 1:]) for i in range(len(words))]
            rows += [(float(label), v) for v in variants]
    rows += [(float(len(FAMILIES)), text) for text in OTHERS for _ in range(5)]
    known = spark.createDataFrame(rows, "label double, paragraph string")
    share = min(1.0, fit_docs / max(1, docs.count()))
    some = docs.where(F.pmod(F.xxhash64(F.col(text_col)), F.lit(1_000_000)) < int(share * 1_000_000))
    ordinary = with_terms(paragraphs(some.withColumn("__none", F.lit(0)), "__none", text_col).select("paragraph").distinct()).where(covered() < FAR)
    ordinary = ordinary.select(F.lit(float(len(FAMILIES))).alias("label"), "paragraph")
    labelled = with_vectors(with_terms(known.unionByName(ordinary))).select("label", "features", (F.pmod(F.xxhash64("paragraph"), F.lit(5)) == 0).alias("held"))
    labelled = write_through(labelled.repartition(4), "licence-sample")
    # both halves of the evidence weigh alike: each class has the same total weight
    sizes = {r["label"]: r["n"] for r in labelled.where("NOT held").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = F.lit(1.0)
    for label, n in sizes.items():
        weight = F.when(F.col("label") == label, sum(sizes.values()) / (len(sizes) * n)).otherwise(weight)
    fit = LogisticRegression(family="multinomial", regParam=1e-4, elasticNetParam=0.5, maxIter=25, weightCol="weight", standardization=False)
    regression = fit.fit(labelled.where("NOT held").withColumn("weight", weight))
    held = regression.transform(labelled.where("held")).select(vector_to_array("rawPrediction").alias("raw"), F.col("label").cast("int").alias("label"))
    held = held.withColumn("top", F.array_max("raw")).withColumn("raw", F.transform("raw", lambda x: x - F.col("top")))
    log_loss = [F.sum(F.log(_spread("raw", t)) - F.get("raw", F.col("label")) / t).alias(f"t{i}") for i, t in enumerate(TEMPERATURES)]
    losses = held.where(F.col("label") < F.size("raw")).agg(*log_loss).first()
    best = min(range(len(TEMPERATURES)), key=lambda i: losses[i] if losses[i] is not None else 0.0)
    return LicenceModel(regression, TEMPERATURES[best] if losses[0] is not None else 1.0)


def wrapped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, place, paragraph, first, last): stretches of lines, from place to last, of the paragraphs in which a template's word pairs stand; first is the paragraph's."""
    text = F.col(text_col)
    source = docs.where(F.lower(text).rlike(TELLING)).select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("key"), F.explode(F.split(text, BREAK)).alias("paragraph"), text.alias("whole"))
    blocks = source.where(F.col("paragraph").contains("\n") & F.lower("paragraph").rlike(TELLING))
    blocks = with_terms(blocks).where(covered() >= CONFIRM).select("id", "key", "whole", "paragraph").distinct()
    # equal paragraphs of a text stand at the first of their places
    before = F.expr("substring(whole, 1, locate(paragraph, whole) - 1)")
    lines = blocks.select("id", "key", (F.size(F.split(before, "\n")) - 1).alias("first"), F.split("paragraph", "\n").alias("lines")).withColumn("n", F.size("lines"))
    told = lines.withColumn("told", F.transform("lines", lambda line: F.lower(line).rlike(TELLING)))
    starts = told.select("id", "key", "first", "lines", "n", "told", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("start"))
    # a stretch without a telling line cannot be confirmed
    starts = starts.withColumn("ahead", F.array_position(F.expr("slice(told, start, n)"), F.lit(True))).where(F.col("ahead") > 0)
    sizes = F.array_distinct(F.when(F.col("start") == 1, F.array(F.col("n"))).otherwise(F.array().cast("array<int>")))
    some = F.filter(F.array(*[F.lit(k) for k in range(2, SPAN + 1)]), lambda k: (F.col("start") + k - 1 <= F.col("n")) & (k >= F.col("ahead")))
    return starts.select("id", "key", "first", (F.col("first") + F.col("start") - 1).alias("place"), "lines", "start", F.explode(F.array_union(sizes, some)).alias("size")).select(
        "id", "key", "place", F.array_join(F.slice("lines", F.col("start"), F.col("size")), "\n").alias("paragraph"), "first", (F.col("place") + F.col("size") - 1).alias("last"))


def _licences(parts: DataFrame, model: LicenceModel) -> DataFrame:
    """The (id, key, place, paragraph, ...) that are licences, with ``pairs``, family and probability and without the paragraph."""
    scored = model.regression.transform(with_vectors(with_terms(parts)))
    likely = scored.where(F.col("prediction") < len(FAMILIES)).withColumn("raw", vector_to_array("rawPrediction"))
    family = F.get(F.array(*map(F.lit, FAMILIES)), F.col("prediction").cast("int"))
    likely = likely.withColumn("top", F.array_max("raw")).withColumn("raw", F.transform("raw", lambda x: x - F.col("top")))
    chance = 1 / _spread("raw", model.temperature)
    likely = likely.select(*[c for c in parts.columns if c != "paragraph"], "pairs", family.alias("family"), chance.alias("probability"))
    return likely.where((F.col("probability") >= LEAST) & (covered(F.col("family")) >= CONFIRM))


def _begins(stretches: DataFrame) -> DataFrame:
    """(id, key, place, family, probability): one stretch for each licence of a paragraph."""
    shared = stretches.withColumn("share", covered(F.col("family")))
    best = F.max_by(F.struct("family", "place", "last", "probability", "share"), F.struct("share", "probability", -F.col("place"), -F.col("last"))).alias("best")
    found = shared.groupBy("id", "key", "first", "family").agg(best).groupBy("id", "key", "first").agg(F.collect_list("best").alias("all"))
    beaten = lambda x: F.exists("all", lambda y: (y["share"] > x["share"]) & (y["place"] <= x["last"]) & (y["last"] >= x["place"]))
    kept = found.select("id", "key", F.explode(F.filter("all", lambda x: ~beaten(x))).alias("x"))
    return kept.select("id", "key", "x.place", "x.family", "x.probability")


def licence_paragraphs(docs: DataFrame, model: LicenceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, place, family, probability) of the lines that are licences or at which a wrapped one begins."""
    # read twice below, so written: every line is hashed and scored once
    told = paragraphs(docs.where(F.lower(F.col(text_col)).rlike(TELLING)), id_col, text_col).where(F.lower("paragraph").rlike(TELLING))
    single = write_through(_licences(told, model).drop("pairs"), "licence-lines")
    extra = _begins(_licences(wrapped(docs, id_col, text_col), model))
    # a family that a line of the text holds by itself is known
    known = single.select("id", "key", "family").distinct()
    same = extra["id"].eqNullSafe(known["id"]) & (extra["key"] == known["key"]) & (extra["family"] == known["family"])
    return single.unionByName(extra.join(known, same, "left_anti"))


def scan_licences(docs: DataFrame, model: LicenceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_paragraphs, n_licence, families, score) of every row; families are sorted and comma-joined, score is the highest probability or 0."""
    found = licence_paragraphs(docs, model, id_col, text_col)
    found = found.groupBy("id", "key").agg(F.countDistinct("place").alias("n"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("names"), F.max("probability").alias("best"))
    lines = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), lambda p: F.trim(p) != "")
    every = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("of"), F.size(lines).cast("long").alias("n_paragraphs"))
    joined = every.join(found, every["doc_id"].eqNullSafe(found["id"]) & (every["of"] == found["key"]), "left")
    return joined.select("doc_id", "n_paragraphs", F.coalesce("n", F.lit(0)).alias("n_licence"), F.coalesce("names", F.lit("")).alias("families"), F.coalesce("best", F.lit(0.0)).alias("score"))


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan_licences(docs, fit_licences(docs))
