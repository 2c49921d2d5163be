"""Licence scan: a trained paragraph classifier with a calibrated unknown class, confirmed by templates.

Native operator: DataFrame functions and Spark's own logistic regression only.

1. A paragraph is a line with a word; its features are hashed counts of its words and word pairs.  A paragraph without any
   word triple of any template cannot be confirmed (step 4), so it is left out before it is classified.
2. Multinomial logistic regression is trained on ``TEMPLATES`` (whole, and notices cut at a half and at three quarters), on
   ``DECOYS`` and on the paragraphs of at most ``SAMPLE_DOCS`` documents of all languages and sources as class unknown.  Sampled
   paragraphs that a template confirms are left out.
3. A first fit is made without the second template of every family, with all its cuts, and without a quarter of the unknown
   paragraphs (by hash): the temperature of ``TEMPERATURES`` with the least log loss on those calibrates the class probabilities of
   the fit to all rows; known and unknown rows have equal weight in this loss.  A paragraph is taken for a family when its calibrated
   probability is at least ``LEAST_PROBABILITY``, else it is unknown; of families with equal probability the one that comes
   first in ``TEMPLATES`` counts.
4. A prediction stands when the paragraph holds at least ``CONFIRM_PERCENT`` of the distinct word triples of one of the
   family's templates, or two thirds of its own triples come from one (a cut notice).

Every paragraph of every document is looked at.  Defined cases: null and blank texts have no paragraphs; texts of any length
are read whole; repeated rows with the same doc_id add up; null doc_ids form one group; empty tables give an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.tables import small, stored

FEATURES = 1 << 13
ITERATIONS = 40
#: Documents whose paragraphs stand for what is no licence: so many of each language and source, those with the least hashes of
#: doc_id, and so many in all.
SAMPLE_EACH, SAMPLE_DOCS = 20, 1000
TEMPERATURES = (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)
LEAST_PROBABILITY = 0.5
CONFIRM_PERCENT = 60
UNKNOWN = "unknown"
# Notices that these licences are known by.
NOTICES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the MIT License - see the LICENSE file for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GPL version 2 or later.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "CC-BY": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Dedicated to the public domain under CC0 1.0 Universal."),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "Released under the ISC License."),
    "AGPL": (
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "Released under the AGPL-3.0 license.",
    ),
    "EPL": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "Licensed under the Eclipse Public License, version 1.0.",
    ),
    "CDDL": ("The contents of this file are subject to the terms of the Common Development and Distribution License", "Licensed under the CDDL 1.0."),
    "EUPL": ("Licensed under the EUPL, Version 1.2 or as soon they will be approved by the European Commission", "This work is licensed under the European Union Public Licence v. 1.2."),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Licensed under the zlib License.",
    ),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0.", "Licensed under the Boost Software License."),
    "Artistic-2.0": ("This package is licensed under the Artistic License 2.0.", "you can redistribute it and/or modify it under the terms of the Artistic License"),
    "WTFPL": ("Everyone is permitted to copy and distribute verbatim or modified copies of this license document", "Licensed under the WTFPL, Do What The Fuck You Want To Public License."),
    "0BSD": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is granted under the Zero-Clause BSD license", "Licensed under the BSD Zero Clause License."),
    "OFL-1.1": ("This Font Software is licensed under the SIL Open Font License, Version 1.1.", "Licensed under the SIL OFL 1.1."),
    "PSF": ("Licensed under the Python Software Foundation License, version 2.", "PSF hereby grants Licensee a nonexclusive, royalty-free, world-wide license to reproduce"),
    "MS-PL": ("This code is released under the Microsoft Public License (Ms-PL).", "Licensed under the Microsoft Public License."),
    "SSPL": ("Licensed under the Server Side Public License, version 1.", "it under the terms of the Server Side Public License, as published by MongoDB"),
    "BUSL-1.1": ("Use of this software is governed by the Business Source License included in the LICENSE file", "Licensed under the Business Source License 1.1."),
    "CC-BY-ND": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "CC-BY-NC-SA": ("Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    "CC-BY-NC-ND": ("Licensed under CC BY-NC-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    "GFDL": ("Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License", "Licensed under the GNU Free Documentation License, version 1.3."),
    "ODbL": ("This database is made available under the Open Database License.", "Licensed under the ODbL 1.0."),
    "Unlicense": ("This is free and unencumbered software released into the public domain.", "Released under the Unlicense."),
}
# Identifiers of the families in one-line marks; the bare name stands for all versions.
IDENTIFIERS: dict[str, tuple[str, ...]] = {
    "MIT": ("MIT",), "Apache-2.0": ("Apache-2.0",), "GPL": ("GPL", "GPL-2.0-only", "GPL-3.0-or-later"), "LGPL": ("LGPL", "LGPL-2.1-or-later"),
    "BSD": ("BSD", "BSD-2-Clause", "BSD-3-Clause"), "MPL-2.0": ("MPL-2.0",), "CC-BY": ("CC-BY-4.0",), "CC-BY-SA": ("CC-BY-SA-4.0",),
    "CC-BY-NC": ("CC-BY-NC-4.0",), "CC0": ("CC0-1.0",), "ISC": ("ISC",), "AGPL": ("AGPL", "AGPL-3.0-or-later"), "EPL": ("EPL", "EPL-2.0"),
    "CDDL": ("CDDL", "CDDL-1.0"), "EUPL": ("EUPL", "EUPL-1.2"), "Zlib": ("Zlib",), "BSL-1.0": ("BSL-1.0",), "Artistic-2.0": ("Artistic-2.0",),
    "WTFPL": ("WTFPL",), "0BSD": ("0BSD",), "OFL-1.1": ("OFL-1.1",), "PSF": ("PSF-2.0",), "MS-PL": ("MS-PL",), "SSPL": ("SSPL-1.0",),
    "BUSL-1.1": ("BUSL-1.1",), "CC-BY-ND": ("CC-BY-ND-4.0",), "CC-BY-NC-SA": ("CC-BY-NC-SA-4.0",), "CC-BY-NC-ND": ("CC-BY-NC-ND-4.0",),
    "GFDL": ("GFDL", "GFDL-1.3-or-later"), "ODbL": ("ODbL-1.0",), "Unlicense": ("Unlicense",),
}
MARK = "SPDX-License-Identifier: "
TEMPLATES = {family: (*notices, *(MARK + i for i in IDENTIFIERS[family])) for family, notices in NOTICES.items()}
#: Sentences of this library that speak of like things and name no licence.
DECOYS = (
    "The driver showed his license to the officer.", "You need a license to fish in this lake.", "Permission was granted by the city council.",
    "The software is free of charge for students.", "All rights reserved.", "The work was released under pressure from the public.",
    "The general public is invited to the opening.", "She studied at MIT in Boston.", "The apache helicopter landed at noon.",
    "Version 2.0 of the program was released in May.", "The terms of the contract were modified by the parties.", "Copyright 2020 by the authors.",
    "Source code and binary files are stored on the server.", "This file is subject to review.",
)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _runs(tokens: Column, n: int) -> Column:
    """Runs of n tokens; of fewer tokens the whole as one."""
    whole = F.array(F.array_join(tokens, " "))
    return F.when(F.size(tokens) <= n, whole).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)), lambda i: F.array_join(F.slice(tokens, i, n), " "))
    )


def featured(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``tokens``) with ``features``."""
    pairs = F.when(F.size("tokens") > 1, F.zip_with(F.slice("tokens", 1, F.size("tokens") - 1), F.slice("tokens", 2, F.size("tokens")), lambda a, b: F.concat_ws(" ", a, b)))
    terms = rows.withColumn("_terms", F.concat("tokens", F.coalesce(pairs, F.array().cast("array<string>"))))
    return HashingTF(numFeatures=FEATURES, inputCol="_terms", outputCol="features").transform(terms).drop("_terms")


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph and tokens of every line that has a word."""
    lines = docs.select(F.col("doc_id").cast("long"), F.explode(F.split("text", "[\r\n]+")).alias("paragraph"))
    return lines.withColumn("tokens", words(F.col("paragraph"))).filter(F.size("tokens") > 0)


def templates(spark: SparkSession) -> DataFrame:
    """family, template (a number), nth (in its family, from 0), tokens."""
    rows = [(family, i, nth, text) for i, (family, nth, text) in enumerate((f, n, t) for f, ts in TEMPLATES.items() for n, t in enumerate(ts))]
    return spark.createDataFrame(rows, "family string, template int, nth int, text string").select("family", "template", "nth", words(F.col("text")).alias("tokens"))


def _triples(tokens: Column) -> Column:
    """A hash of each run of three words; of fewer words one of them all."""
    codes = F.transform(tokens, lambda t: F.xxhash64(t))
    whole = F.array(F.xxhash64(F.array_join(tokens, " ")))
    of = lambda c: F.transform(F.sequence(F.lit(0), F.size(c) - 3), lambda i: F.xxhash64(c[i], c[i + 1], c[i + 2]))
    return F.when(F.size(tokens) < 3, whole).otherwise(F.transform(F.array(codes), of)[0])


def within_reach(rows: DataFrame) -> DataFrame:
    """The paragraphs that have a word triple of a template: all that ``confirmed`` can confirm, and a few by hash."""
    known = templates(rows.sparkSession).select(F.explode(_triples(F.col("tokens"))).alias("triple")).distinct()
    triples = sorted(r.triple for r in known.collect())  # some 1,000 of the fixed TEMPLATES
    return rows.filter(F.arrays_overlap(_triples(F.col("tokens")), F.lit(triples)))


def confirmed(rows: DataFrame) -> DataFrame:
    """(id, family) of the ``rows`` (id, tokens) that a template confirms."""
    spark = rows.sparkSession
    known = templates(spark).select("family", "template", F.array_distinct(_runs(F.col("tokens"), 3)).alias("runs"))
    known = known.select("family", "template", F.size("runs").alias("size"), F.explode("runs").alias("run"))
    own = rows.select("id", F.array_distinct(_runs(F.col("tokens"), 3)).alias("runs")).select("id", F.size("runs").alias("own"), F.explode("runs").alias("run"))
    both = own.join(F.broadcast(known), "run").groupBy("id", "family", "template", "size", "own").count()
    enough = (100 * F.col("count") >= CONFIRM_PERCENT * F.col("size")) | ((3 * F.col("count") >= 2 * F.col("own")) & (F.col("own") >= 3))
    return both.filter(enough).select("id", "family").distinct()


def _least(known: DataFrame) -> DataFrame:
    """The rows that can be among the SAMPLE_EACH least hashes of doc_id of their language and source: those within four times
    that share of the hashes; all rows of a small group."""
    sizes = known.groupBy(F.col("lang").alias("_l"), F.col("source").alias("_s")).agg(F.count("*").alias("_n"))
    both = known.join(small(stored(sizes, "licence-groups")), F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")))
    near = (F.shiftright(F.xxhash64("doc_id"), 11).cast("double") + float(1 << 52)) / float(1 << 53)  # the hash as a share of all
    return both.filter((F.col("_n") <= 4 * SAMPLE_EACH) | (near * F.col("_n") <= 4 * SAMPLE_EACH)).drop("_l", "_s", "_n")


def training_rows(docs: DataFrame) -> DataFrame:
    """label, tokens, held (not for the first fit) of the training paragraphs."""
    spark, families = docs.sparkSession, [UNKNOWN, *TEMPLATES]
    cut = lambda q: F.expr(f"slice(tokens, 1, greatest(cast(size(tokens) * {q} div 4 as int), 3))")
    cuts = F.when(F.col("tokens")[0] == "spdx", F.array("tokens")).otherwise(F.array(F.col("tokens"), cut(2), cut(3)))
    good = templates(spark).select("family", (F.col("nth") == 1).alias("held"), F.explode(cuts).alias("tokens"))
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    good = good.select(label.cast("double").alias("label"), "tokens", "held")
    quarter = (F.pmod(F.xxhash64("tokens"), F.lit(4)) == 0).alias("held")
    decoys = spark.createDataFrame([(t,) for t in DECOYS], "text string").select(F.lit(0.0).alias("label"), words(F.col("text")).alias("tokens")).select("*", quarter)
    # The least hashes of each language and source come first, so that all are in the sample.
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.xxhash64("doc_id"), "doc_id"))
    known = docs.select("doc_id", *[F.col(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in ("lang", "source")]).filter("doc_id is not null")
    # A hash below the share of SAMPLE_EACH in its group is enough to be among its least ones; only such rows are ranked.
    ids = _least(known).withColumn("place", place).filter(F.col("place") <= SAMPLE_EACH)
    ids = ids.orderBy("place", F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS).select(F.col("doc_id").alias("_id")).distinct()
    sample = paragraphs(docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id"), "left_semi"))
    sample = stored(sample.select(F.xxhash64("tokens").alias("id"), "tokens").distinct(), "licence-sample")
    sample = sample.join(confirmed(sample).select("id").distinct(), "id", "left_anti").select(F.lit(0.0).alias("label"), "tokens", quarter)
    # Few template rows stand against many others: each is repeated, plain and with the first word of each of four sampled paragraphs.
    fronts = sample.orderBy(F.xxhash64("tokens"), "tokens").limit(4).select(F.slice("tokens", 1, 1).alias("front"))
    fronts = fronts.unionByName(spark.range(4).select(F.array().cast("array<string>").alias("front")))
    many = good.crossJoin(F.broadcast(fronts)).select("label", F.concat("front", "tokens").alias("tokens"), "held")
    return many.unionByName(decoys).unionByName(decoys).unionByName(sample)


def centred() -> Column:
    """The classes' raw scores, the greatest as 0."""
    raw = vector_to_array("rawPrediction")
    return F.transform(raw, lambda z: z - F.array_max(raw))


def train(docs: DataFrame) -> tuple[LogisticRegressionModel, float]:
    """The fitted model and its temperature."""
    rows = stored(featured(training_rows(docs)).select("label", "features", "held"), "licence-training").coalesce(1)
    fitting = LogisticRegression(maxIter=ITERATIONS, regParam=1e-3, family="multinomial")
    trial = fitting.fit(rows.filter("not held"))
    scored = trial.transform(rows.filter("held")).select("label", centred().alias("z"))
    total = lambda t: F.aggregate("z", F.lit(0.0), lambda a, z: a + F.exp(z / t))
    losses = [F.avg(F.log(total(t)) - F.element_at("z", F.col("label").cast("int") + 1) / t).alias(f"t{i}") for i, t in enumerate(TEMPERATURES)]
    sides = scored.groupBy((F.col("label") > 0).alias("known")).agg(*losses)
    values = sides.agg(*[F.sum(f"t{i}") for i in range(len(TEMPERATURES))]).first()
    return fitting.fit(rows), min(zip((v if v is not None else 0.0 for v in values), TEMPERATURES, strict=True))[1]


def found(docs: DataFrame, fitted: tuple[LogisticRegressionModel, float] | None = None) -> DataFrame:
    """doc_id, paragraph, tokens, family, probability of each paragraph taken for a family and confirmed; by a model of ``train``, of
    these documents if none is given."""
    model, temperature = fitted or train(docs)
    near = stored(within_reach(paragraphs(docs)), "licence-near")
    rows = model.copy().setProbabilityCol("").setPredictionCol("").transform(featured(near))
    scores = rows.select("doc_id", "paragraph", "tokens", centred().alias("z"), F.monotonically_increasing_id().alias("row"))
    # The row number is a barrier: without it the filters below would bring the classifier along several times.
    named = F.element_at(F.array(*map(F.lit, [UNKNOWN, *TEMPLATES])), F.array_position("z", 0.0).cast("int"))
    likely = scores.withColumn("family", named).filter((F.col("family") != UNKNOWN) & (F.col("row") >= 0))
    # The best class's score is 0, so its share is 1 over the sum.
    share = 1 / F.aggregate(F.transform("z", lambda z: F.exp(z / temperature)), F.lit(0.0), lambda a, x: a + x)
    taken = likely.withColumn("probability", share).filter(F.col("probability") >= LEAST_PROBABILITY).drop("z", "row")
    taken = stored(taken.withColumn("id", F.xxhash64("tokens")), "licence-taken")
    sure = confirmed(taken.select("id", "tokens").distinct()).withColumnsRenamed({"id": "_id", "family": "_family"})
    return taken.join(sure, (F.col("id") == F.col("_id")) & (F.col("family") == F.col("_family")), "left_semi").drop("id")


def families(docs: DataFrame, fitted: tuple[LogisticRegressionModel, float] | None = None) -> DataFrame:
    """doc_id, family, n_paragraphs and least_probability of each licence family that a document names."""
    return found(docs, fitted).groupBy("doc_id", "family").agg(F.count("*").alias("n_paragraphs"), F.min("probability").alias("least_probability"))
