"""Licence scan: a trained paragraph classifier over word n-grams, confirmed by templates.

A paragraph is a run of consecutive non-blank lines.  It is judged by its lines and, as
notices are often wrapped, by each run of neighbouring lines that hold words which speak
for a family, joined.  Features are distinct longer words and word pairs.  A
multinomial logistic regression with sparse weights, trained here on the notices
below and on a bounded sample of ordinary lines, gives a probability per licence
family and for ``unknown``.  The least probability that counts is calibrated for each
family on ordinary lines left out of the training.  A prediction stands only if
enough word triples of one of the family's notices occur, among them the notice's own
mark: the triple that names the licence and its version.  So a notice that is like a
known one but for the name or the version stays unknown.

Everything is DataFrame work.  A line that holds none of the features that speak for
a family cannot be anything but unknown, so only the others are exploded and joined
with the weights (bounded by the features of the notices).

Defined results: null and empty texts have no paragraphs and no licence;
repeated ids count together; equal probabilities go to the smaller family name; a
paragraph may name several families, each counts once; lines of any length are one
line; input columns that are not named are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, StringIndexer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadworks.llm.components import stored

UNKNOWN = "unknown"
SAMPLE = 4000          # ordinary paragraphs of the training, about
CONTAINED = 0.6        # share of a notice's word triples that confirms a prediction
VOCABULARY = 1 << 12   # features that are weighed, at most: those of most examples
LEAST = 0.5            # lowest probability that may count, before calibration
WEIGHT = 40.0          # weight of a notice's example against an ordinary paragraph

# Notices by which works name their licence, each with its mark (see ``words``).
NOTICES = [
    ("MIT", "Released under the MIT License.", "the mit license"),
    ("MIT", "This project is licensed under the terms of the MIT license.", "the mit license"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
     "permission is hereby"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software.", "this permission notice"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "license version 2.0"),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
     "at http //www.apache.org/licenses/license-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", "license version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version.", "version 3 of"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", "license version 2"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation; either version 2 of the "
                "License, or (at your option) any later version.", "version 2 of"),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License.", "gnu lesser general"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3.", "gnu affero general"),
    ("BSD", "Use of this source code is governed by a BSD-style license.", "a bsd-style license"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted",
     "source and binary"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
     "mozilla public license"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "cc by-nc 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                     "International License.", "commons attribution-noncommercial 4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0.", "cc by 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
     "commons attribution 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "cc by-sa 4.0"),
    ("CC0-1.0", "This work has been dedicated to the public domain under CC0 1.0 Universal.", "under cc0 1.0"),
]
# Ordinary sentences with words of licences.
ORDINARY = [
    "He was granted a license to drive in the general area.",
    "The public is free to use the software in the library under supervision.",
    "Permission was granted to build the house under the terms of the contract.",
    "The version released in spring was subject to modification.",
    "A copy of the work may be obtained from the foundation.",
]


_MARKS = ",;:!?()[]{}<>\"'|*#$%&_=~`\t\r"


def words(paragraph: Column) -> Column:
    """Lower-case words of a paragraph without marks around them; version numbers stay whole."""
    plain = F.translate(F.lower(paragraph), _MARKS, " " * len(_MARKS))
    plain = F.replace(F.concat(plain, F.lit(" ")), F.lit(". "), F.lit(" "))
    found = F.filter(F.split(plain, " "), lambda w: w != "")
    return F.coalesce(found, F.array().cast("array<string>"))


def grams(tokens: Column, n: int) -> Column:
    """Word n-grams of an array of words, from n shifted slices of it."""
    count = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
    out = F.slice(tokens, 1, count)
    for k in range(1, n):
        out = F.zip_with(out, F.slice(tokens, k + 1, count), lambda x, y: F.concat(x, F.lit(" "), y))
    return out


def features(tokens: Column) -> Column:
    """Distinct words of four letters or more, and distinct word pairs."""
    return F.array_distinct(F.concat(F.filter(tokens, lambda t: F.length(t) > 3), grams(tokens, 2)))


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """(id, more, part, paragraph) of every line that holds an ASCII letter; ``part`` is its number."""
    return (docs.select(F.col(id_col).alias("id"), *more, F.posexplode(F.split(F.col(text_col), "\n")).alias("part", "paragraph"))
            .where(F.col("paragraph").rlike("[A-Za-z]")))


def _notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f, t, m, k) for k, (f, t, m) in enumerate(NOTICES)],
                                 "family string, text string, mark string, notice int")


class Model:
    """Feature weights by family, the calibrated thresholds, and the notices' word triples."""

    def __init__(self, weights: DataFrame, intercepts: dict[str, float], speaking: list[str],
                 thresholds: dict[str, float], triples: DataFrame):
        self.weights, self.intercepts, self.speaking = weights, intercepts, speaking
        self.thresholds, self.triples = thresholds, triples


def _contained(rows: DataFrame, keys: list[str], triples: DataFrame) -> DataFrame:
    """(keys, family, contained): families of which rows with ``tokens`` hold enough of a notice."""
    return (rows.select(*keys, F.explode(F.array_distinct(grams(F.col("tokens"), 3))).alias("triple"))
            .join(F.broadcast(triples), "triple").groupBy(*keys, "family", "notice")
            .agg((F.countDistinct("triple") / F.max("size")).alias("share"), F.max("is_mark").alias("marked"))
            .where("marked").groupBy(*keys, "family").agg(F.max("share").alias("contained"))
            .where(F.col("contained") >= CONTAINED))


def _scored(rows: DataFrame, keys: list[str], weights: DataFrame, intercepts: dict[str, float]) -> DataFrame:
    """(keys, family, probability): the likeliest family of rows with a ``features`` column."""
    families = sorted(intercepts)
    logits = [F.coalesce(F.sum(F.col("w")[i]), F.lit(0.0)).alias(f"z{i}") for i in range(len(families))]
    summed = (rows.select(*keys, F.explode("features").alias("feature"))
              .join(F.broadcast(weights), "feature", "left").groupBy(*keys).agg(*logits))
    values = F.array(*[F.struct((-(F.col(f"z{i}") + F.lit(intercepts[f]))).alias("z"), F.lit(f).alias("family"))
                       for i, f in enumerate(families)])
    best = F.array_min(values)  # least negated logit, then smaller name
    total = F.aggregate(values, F.lit(0.0), lambda s, v: s + F.exp(best["z"] - v["z"]))
    return summed.select(*keys, best["family"].alias("family"), (1 / total).alias("probability"))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Train on the notices and about ``sample`` ordinary paragraphs of the corpus.

    Ordinary are paragraphs without a word that begins with licen, copyright
    or copyleft and without enough word triples of a notice.  Half of them
    train, the other half calibrate each family's threshold.
    """
    spark = docs.sparkSession
    notices = _notices(spark).withColumn("tokens", words(F.col("text")))
    triples = notices.select("family", "notice", "mark", F.explode(F.array_distinct(grams(F.col("tokens"), 3))).alias("triple"))
    triples = triples.withColumn("is_mark", F.col("triple") == F.col("mark"))
    triples = triples.withColumn("size", F.count("*").over(Window.partitionBy("notice")))
    # examples of a notice: the whole of it, and its parts of three quarters of its words
    size = F.size("tokens")
    part = F.greatest(F.lit(3), F.ceil(size * 0.75).cast("int"))
    known = notices.withColumn("tokens", F.explode(F.array(
        F.col("tokens"), F.col("tokens"), F.slice("tokens", 1, part),
        F.slice("tokens", F.greatest(F.lit(1), size - part + 1), part)))).select("family", "tokens")
    known = known.unionByName(spark.createDataFrame([(t,) for t in ORDINARY], "text string").select(
        F.lit(UNKNOWN).alias("family"), words(F.col("text")).alias("tokens"))).withColumn("weight", F.lit(WEIGHT))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    count = rows.count()
    share = min(1.0, sample / 4 / max(1, count))  # a few paragraphs a document: read few documents
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    plain = (lines(chosen, "id", "text").where(~F.lower("paragraph").rlike(r"\b(licen|copyright|copyleft)"))
             .select(F.lit(UNKNOWN).alias("family"), F.xxhash64("id", "part").alias("key"),
                     words(F.col("paragraph")).alias("tokens")))
    plain = plain.join(_contained(plain, ["key"], triples), "key", "left_anti").orderBy("key").limit(sample).persist()
    train = (known.unionByName(plain.where("key % 2 = 0").select("family", "tokens", F.lit(1.0).alias("weight")))
             .withColumn("features", features(F.col("tokens"))).coalesce(4).persist())
    vectors = CountVectorizer(inputCol="features", outputCol="vector", binary=True, vocabSize=VOCABULARY, minDF=2.0).fit(train)
    labels = StringIndexer(inputCol="family", outputCol="label", stringOrderType="alphabetAsc").fit(train)
    fitted = LogisticRegression(featuresCol="vector", labelCol="label", weightCol="weight", family="multinomial",
                                maxIter=25, regParam=0.001, elasticNetParam=0.5, standardization=False).fit(
        labels.transform(vectors.transform(train)))
    matrix = fitted.coefficientMatrix.toArray()
    families, unknown = labels.labels, labels.labels.index(UNKNOWN)
    relative = matrix - matrix[unknown]
    used = [i for i in range(matrix.shape[1]) if abs(matrix[:, i]).max() > 1e-9]
    weights = spark.createDataFrame([(vectors.vocabulary[i], matrix[:, i].tolist()) for i in used],
                                    "feature string, w array<double>")
    intercepts = dict(zip(families, fitted.interceptVector.toArray().tolist()))
    # Without a strong feature no family can overtake unknown: all weak features together
    # weigh less than the lead that unknown has from its intercept.
    lead = [intercepts[UNKNOWN] - intercepts[f] for f in families]
    room, speaking = list(lead), []
    for i in sorted(used, key=lambda i: relative[:, i].max()):
        gain = relative[:, i].clip(min=0)
        if not speaking and all(gain[k] < room[k] for k, f in enumerate(families) if f != UNKNOWN):
            room = [r - g for r, g in zip(room, gain)]
        else:
            speaking.append(vectors.vocabulary[i])
    held = (plain.where("key % 2 <> 0").select("key", features(F.col("tokens")).alias("features")))
    worst = (_scored(held, ["key"], weights, intercepts).where(F.col("family") != UNKNOWN)
             .groupBy("family").agg(F.max("probability").alias("probability")).collect())  # a row a family
    plain.unpersist()
    train.unpersist()
    thresholds = {f: LEAST for f in families} | {r["family"]: max(LEAST, r["probability"]) for r in worst}
    return Model(weights, intercepts, speaking, thresholds, triples)


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, part, family, probability, contained) of every paragraph that names a licence.

    ``part`` is the first line that shows it (by itself, or as the first of joined ones).
    """
    marks = sorted({mark for _, _, mark in NOTICES})  # without one of them no prediction stands
    ends = sorted({m.split(" ")[-1] for m in marks})  # a line may begin with the end of a mark
    spoken = sorted({*model.speaking, *(" ".join(m.split(" ")[i:i + 2]) for m in marks for i in (0, 1))})
    speaking = sorted({*(f.split(" ")[0] for f in spoken), *ends})
    rows = (lines(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row")),
                  "id", "text", "row").withColumn("tokens", words(F.col("paragraph")))
            .where(F.arrays_overlap("tokens", F.array(*map(F.lit, speaking))))
            .where(F.arrays_overlap(features(F.col("tokens")), F.array(*map(F.lit, spoken)))
                   | F.get("tokens", F.lit(0)).isin(ends))
            .select("id", "row", "part", "tokens"))
    rows = stored(rows, "licence-lines")  # few lines pass: the texts are read once
    # neighbouring lines: their number less their rank in the document is the same
    line = Window.partitionBy("row").orderBy("part")
    runs = (rows.withColumn("run", F.col("part") - F.row_number().over(line)).groupBy("row", "run")
            .agg(F.first("id").alias("id"), F.array_sort(F.collect_list(F.struct("part", "tokens"))).alias("x")))
    runs = runs.select("id", "row", F.col("x")[0]["part"].alias("first"), "x")
    alone = F.transform("x", lambda y: F.struct(y["part"].alias("part"), F.lit(False).alias("whole"), y["tokens"].alias("tokens")))
    joined = F.struct(F.col("first").alias("part"), F.lit(True).alias("whole"), F.flatten("x.tokens").alias("tokens"))
    units = runs.select("id", "row", "first", F.inline(F.concat(alone, F.when(F.size("x") > 1, F.array(joined))
                                                               .otherwise(F.slice(F.array(joined), 1, 0)))))
    units = stored(units.where(F.arrays_overlap(grams(F.col("tokens"), 3), F.array(*map(F.lit, marks))))
                   .withColumn("features", features(F.col("tokens"))), "licence-paragraphs")
    keys = ["id", "row", "first", "part", "whole"]
    least = F.create_map(*[F.lit(x) for pair in sorted(model.thresholds.items()) for x in pair])
    predicted = (_scored(units, keys, model.weights, model.intercepts)
                 .where((F.col("family") != UNKNOWN) & (F.col("probability") >= least[F.col("family")])))
    shared = _contained(units, keys, model.triples)
    same = [predicted[k].eqNullSafe(shared[k]) for k in keys] + [predicted["family"] == shared["family"]]
    found = predicted.join(shared, same).select(*[predicted[k] for k in keys], predicted["family"], "probability", "contained")
    # a family that a line shows by itself is not reported again for the lines joined
    own = Window.partitionBy("row", "first", "family")
    found = found.withColumn("lone", F.min("whole").over(own)).where(~F.col("whole") | F.col("lone"))
    return found.select("id", "part", "family", "probability", "contained")
