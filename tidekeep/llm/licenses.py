"""Licence families of paragraphs, with DataFrame functions and Spark ML's JVM-side regression only.

A multinomial logistic regression over words and word pairs is trained on notices of each family, alone, in phrases around
them and within paragraphs of the corpus, and on paragraphs that hold none (the unknown class). Part of the examples is kept
back to fit a temperature, so that the probabilities are calibrated. A paragraph is a line; lines of at most `WRAPPED` signs that
follow each other are one, as wrapped text stands in files, until a sentence ends with its line or a line is blank or of signs only. Paragraphs of more than `RUN` words are scored in runs that
overlap by more than the longest template, so a notice is found wherever it is in one. Every line of every text is scored.

A run that is likelier a notice than not is compared with the templates: a family fits if one of its templates shares `SHARED`
of its word pairs with the run. Of those that fit the likeliest is confirmed if it reaches `LEAST` beside the unknown class and
the families that do not fit. The words before and after its template are then scored again as runs of their own, until no
further notice is confirmed. What touches the cut end of a run is left to the neighbouring run, which has it whole. A paragraph
counts once for each of its families.

Training uses the paragraphs of the `FIT_DOCS` documents with the smallest hashes of id and text; those that hold a template are
left out of the unknown class. Null and empty texts have no paragraphs. A document of one long line is one paragraph. Repeated
rows each get a row; on an empty table the result is empty. Other columns are not looked at.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, NGram, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

FIT_DOCS = 500
CONTEXTS = 12
# Signs of a line, at most, that may be part of a wrapped paragraph.
WRAPPED = 100
# Runs of which each notice gets CONTEXTS: many different ones, so that common words speak for no class.
POOL = 96
# Words of a run, and how many of them the next run has too: the longest template and EDGE words on either side of it.
RUN = 96
OVERLAP = 32
EDGE = 4
LEAST = 0.5
SHARED = 0.6
UNKNOWN = "unknown"
_GAP = r"[^\p{L}\p{N}]+"
# Wordings by which each family of licences is usually given.
TEMPLATES = {
    "agpl": [
        "licensed under the GNU Affero General Public License, version 3",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org",
        "distributed under the Apache License",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Released under the BSD 3-Clause License",
        "licensed under the BSD License",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0",
        "licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0",
        "Licensed under CC BY-NC-SA 4.0",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "cc0": [
        "Dedicated to the public domain under CC0 1.0 Universal",
        "To the extent possible under law, the author has waived all copyright and related rights",
    ],
    "gpl": [
        "licensed under the GNU General Public License, version 3",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Released under the GPL version 2",
    ],
    "lgpl": [
        "licensed under the GNU Lesser General Public License, version 3",
        "modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "licensed under the MIT License",
    ],
    "mpl": [
        "subject to the terms of the Mozilla Public License, v. 2.0",
        "licensed under the Mozilla Public License 2.0",
    ],
    "reserved": [
        "All rights reserved",
        "No part of this publication may be reproduced without the prior written permission of the publisher",
    ],
}
FRAMES = ["{}", "{}.", "This work is {}.", "The code in this repository is {}", "Copyright 2020 the authors. {}.", "{}, see LICENSE."]
STRANGERS = [
    "He lost his driving license last year.", "The license fee was raised again.", "A public version of the report is free of charge.",
    "The general public was not permitted to enter.", "Under the bridge, version 2 of the plan was discussed.",
    "They released the prisoners under law.", "Software and files are in the source folder.", "The rights of the reader",
]


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text that hold more than blanks: its lines, wrapped ones joined."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    short = rf"[^\n\r]{{1,{WRAPPED}}}"
    # A line with a letter or digit that ends here, not with a sentence, before another such line.
    joined = F.regexp_replace(
        whole, rf"(?m)^(?=[^\n\r]*[\p{{L}}\p{{N}}])({short})(?<![.!?:;])(?:\r\n|\n|\r)(?=[^\n\r]*[\p{{L}}\p{{N}}])(?={short}$)", "$1 "
    )
    lines = F.split(joined, "[\\n\\r]+")
    return F.filter(lines, lambda x: F.trim(x) != "")


def runs(line: Column) -> Column:
    """A line as runs of words: text, and whether words of the line were cut off before and after it."""
    whole = F.array(F.struct(line.alias("text"), F.lit(False).alias("before"), F.lit(False).alias("after")))
    step = RUN - OVERLAP

    def cut(words: Column) -> Column:
        last = F.ceil((F.size(words) - RUN) / step).cast("int")
        several = F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(
                F.array_join(F.slice(words, i * step + 1, RUN), " ").alias("text"), (i > 0).alias("before"), (i < last).alias("after")
            ),
        )
        return F.when(F.size(words) <= RUN, whole).otherwise(several)

    words = F.filter(F.split(line, _GAP), lambda w: w != "")
    # Short lines are not split at all; the words of others are bound once.
    return F.when(F.length(line) < 2 * RUN, whole).otherwise(F.transform(F.array(words), cut)[0])


def _terms(rows: DataFrame) -> DataFrame:
    """rows with words and the terms of `text`: words and word pairs."""
    rows = RegexTokenizer(inputCol="text", outputCol="words", pattern=_GAP).transform(rows)
    rows = NGram(n=2, inputCol="words", outputCol="pairs").transform(rows)
    return rows.withColumn("terms", F.concat("words", "pairs"))


def _pairs(template: str) -> list[str]:
    """The distinct word pairs of a template."""
    words = re.findall("[a-z0-9]+", template.lower())
    return sorted({" ".join(p) for p in zip(words, words[1:], strict=False)})


def _likeness(pairs: Column, family: str) -> Column:
    """The largest share of a template's word pairs, over the family's templates, that are among the pairs."""
    shares = []
    for template in TEMPLATES[family]:
        own = _pairs(template)
        shares.append(F.size(F.array_intersect(F.lit(own), pairs)) / len(own))
    return F.greatest(*shares) if len(shares) > 1 else shares[0]


def _place(pairs: Column, family: str) -> Column:
    """Where the family's template lies that fits best, as the share of its pairs, less its extent, less its first place."""
    def at_hits(template: str) -> Column:
        own = _pairs(template)
        length = len(re.findall("[a-z0-9]+", template.lower())) - 1
        hits = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda i: F.array_contains(F.lit(own), pairs[i]))

        def from_hit(at: Column) -> Column:
            inside = F.filter(hits, lambda i: (i >= at) & (i < at + length))
            return F.struct((F.size(inside) / len(own)).alias("share"), (at - F.array_max(inside)).alias("extent"), (-at).alias("at"))

        return F.transform(hits, from_hit)

    return F.array_max(F.concat(*[at_hits(t) for t in TEMPLATES[family]]))


class Classifier:
    """Calibrated probabilities of licence families for a paragraph."""

    def __init__(self, docs: DataFrame):
        spark = docs.sparkSession
        self.families = [UNKNOWN, *TEMPLATES]
        hashed = docs.select(F.xxhash64("doc_id", "text").alias("h"), "text")
        chosen = F.broadcast(hashed.select("h").distinct().orderBy("h").limit(FIT_DOCS))
        few = hashed.join(chosen, "h").groupBy("h").agg(F.first("text").alias("text"))
        lines = few.select(F.explode(paragraphs(F.col("text"))).alias("line"))
        own = _terms(lines.select(F.explode(runs(F.col("line"))).alias("run")).select("run.text"))
        best = reduce(F.greatest, [_likeness(F.col("pairs"), f) for f in TEMPLATES])
        own = own.where(best < SHARED / 2).select("text", F.xxhash64("text").alias("h"))
        own = stored(own.distinct(), "strangers")
        notices = [(k, fr.format(t)) for k, f in enumerate(TEMPLATES, 1) for t in TEMPLATES[f] for fr in FRAMES]
        notices = spark.createDataFrame(notices, "label int, notice string")
        # At most POOL runs, dealt to a few dozen notices.
        pool = [r["text"] for r in own.orderBy("h").limit(POOL).select("text").collect()]
        turn = F.pmod(F.xxhash64("notice"), F.lit(max(1, len(pool)))).cast("int")
        dealt = F.slice(F.array(*[F.lit(t) for t in pool + pool[:CONTEXTS]]), turn + 1, CONTEXTS) if pool else F.array().cast("array<string>")
        around = F.concat(dealt, F.array_repeat(F.lit(""), 3))
        rows = notices.select("label", "notice", F.explode(around).alias("around"))
        first = F.concat_ws(" ", "notice", "around")
        rows = rows.select(
            "label", F.when(F.xxhash64("notice", "around") % 2 == 0, first).otherwise(F.concat_ws(" ", "around", "notice")).alias("text")
        )
        others = own.select("text").unionByName(spark.createDataFrame([(t,) for t in STRANGERS], "text string"))
        rows = rows.unionByName(others.select(F.lit(0).alias("label"), "text"))
        rows = stored(_terms(rows).select(F.col("label").cast("double"), "text", "terms").coalesce(2), "examples")
        back = F.pmod(F.xxhash64("text"), F.lit(5)) == 0
        self.vector = CountVectorizer(inputCol="terms", outputCol="x", vocabSize=1 << 15, binary=True).fit(rows.where(~back))
        regression = LogisticRegression(
            featuresCol="x", family="multinomial", regParam=0.0003, maxIter=40, standardization=False
        )
        self.model = regression.fit(self.vector.transform(rows.where(~back)))
        self.temperature = 1.0
        self.temperature = self._calibrate(rows.where(back))

    def _calibrate(self, rows: DataFrame) -> float:
        """The temperature under which the examples kept back are likeliest."""
        raw = self.model.transform(self.vector.transform(rows)).select("label", vector_to_array("rawPrediction").alias("raw"))
        grid = [0.1, 0.15, 0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]
        own = F.element_at("raw", F.col("label").cast("int") + 1)
        losses = [F.avg(F.log(self._total(F.col("raw"), t)) - own / t).alias(f"t{k}") for k, t in enumerate(grid)]
        found = raw.agg(*losses).first()
        known = [(loss, t) for loss, t in zip(found, grid, strict=True) if loss is not None]
        return min(known)[1] if known else 1.0

    @staticmethod
    def _total(raw: Column, t: float) -> Column:
        return F.aggregate(raw, F.lit(0.0), lambda s, x: s + F.exp(x / t))

    def classify(self, rows: DataFrame) -> DataFrame:
        """rows, of which `text` is a paragraph, with family, probability, likeness and confirmed."""
        kept = rows.columns
        out = self.model.transform(self.vector.transform(_terms(rows)))
        out = out.select(*kept, "pairs", vector_to_array("rawPrediction").alias("raw"))
        top = F.array_max("raw")
        first = F.array_position("raw", top).cast("int")
        # Only where unknown is not the likeliest can a family reach LEAST.
        alike = F.array(F.lit(0.0), *[_likeness(F.col("pairs"), f) for f in TEMPLATES])
        alike = F.when(first == 1, F.array_repeat(F.lit(0.0), len(self.families))).otherwise(alike)
        out = out.withColumn("alike", alike)
        weights = F.transform("raw", lambda x: F.exp((x - top) / self.temperature))
        out = out.withColumn("each", F.arrays_zip(weights.alias("w"), F.col("alike").alias("like")))
        fits = F.array_max(F.transform("each", lambda x: F.when(x["like"] >= SHARED, x["w"])))
        out = out.withColumn("w", F.coalesce(fits, F.lit(1.0)))
        rest = F.aggregate("each", F.lit(0.0), lambda s, x: s + F.when(x["like"] >= SHARED, 0.0).otherwise(x["w"]))
        probability = F.when(fits.isNull(), 1 / rest).otherwise(F.col("w") / (F.col("w") + rest))
        chosen = F.array_position(
            F.transform("each", lambda x: (x["w"] == F.col("w")) & (fits.isNull() | (x["like"] >= SHARED))), F.lit(True)
        ).cast("int")
        names = F.array(*[F.lit(f) for f in self.families])
        out = out.withColumn("chosen", chosen).withColumn("probability", probability)
        out = out.select(
            *kept, F.element_at(names, F.col("chosen")).alias("family"), "probability", F.element_at("alike", F.col("chosen")).alias("likeness")
        )
        return out.withColumn("confirmed", (F.col("likeness") >= SHARED) & (F.col("probability") >= LEAST))


_RUN = ["row", "paragraph", "text", "before", "after"]


def _placed(found: DataFrame) -> DataFrame:
    """Confirmed runs with their words, the template's place among them (start, end), and whether it is clear of a cut end."""
    place = F.lit(None)
    for f in TEMPLATES:
        place = F.when(F.col("family") == f, _place(F.col("pairs"), f)).otherwise(place)
    out = _terms(found).withColumn("place", place)
    out = out.withColumn("start", -F.col("place.at")).withColumn("end", F.col("start") - F.col("place.extent") + 2)
    clear = (~F.col("before") | (F.col("start") >= EDGE)) & (~F.col("after") | (F.col("end") <= F.size("words") - EDGE))
    return out.select("row", "paragraph", "family", "probability", "before", "after", "words", "start", "end", clear.alias("clear"))


def _beside(placed: DataFrame) -> DataFrame:
    """The runs before and after the places."""
    no, words = F.lit(False), F.col("words")
    first = F.struct(F.slice(words, F.lit(1), F.col("start")).alias("w"), F.col("before").alias("before"), no.alias("after"))
    second = F.struct(F.slice(words, F.col("end") + 1, F.size(words)).alias("w"), no.alias("before"), F.col("after").alias("after"))
    out = placed.select("row", "paragraph", F.explode(F.array(first, second)).alias("run")).where(F.size("run.w") > 1)
    return out.select("row", "paragraph", F.array_join("run.w", " ").alias("text"), "run.before", "run.after")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs, n_licences, families (in order, comma-joined) and probability (the highest), a row per document.

    n_licences counts the families of each paragraph.
    """
    model = Classifier(docs)
    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumn("row", F.monotonically_increasing_id())
    rows = rows.select("doc_id", "row", F.posexplode_outer(paragraphs(F.col("text"))).alias("paragraph", "line"))
    rows = rows.withColumn("run", F.explode(runs(F.coalesce("line", F.lit("")))))
    found = model.classify(rows.select("doc_id", "row", "paragraph", "run.*"))
    sure = F.struct("text", "before", "after", "family", "probability")
    first = stored(found.select("doc_id", "row", "paragraph", F.when(F.col("confirmed"), sure).alias("sure")), "runs")
    left, notices = first.where("sure is not null").select("row", "paragraph", "sure.*"), None
    while True:
        placed = stored(_placed(left), "licences")
        clear = placed.where("clear").select("row", "paragraph", "family", "probability")
        notices = clear if notices is None else notices.unionByName(clear)
        left = model.classify(_beside(placed)).where("confirmed")
        left = stored(left.select(*_RUN, "family", "probability"), "left")
        if left.isEmpty():
            break
    bit = F.lit(0)
    for k, f in enumerate(TEMPLATES):
        bit = F.when(F.col("family") == f, 1 << k).otherwise(bit)
    by_paragraph = notices.groupBy("row", "paragraph").agg(F.bit_or(bit).alias("mask"), F.max("probability").alias("probability"))
    by_row = by_paragraph.groupBy("row").agg(
        F.sum(F.bit_count("mask")).alias("n_licences"), F.bit_or("mask").alias("mask"), F.max("probability").alias("probability")
    )
    by_doc = first.groupBy("row", "doc_id").agg((F.coalesce(F.max("paragraph"), F.lit(-1)) + 1).cast("long").alias("n_paragraphs"))
    by_doc = by_doc.join(by_row, "row", "left").withColumn("mask", F.coalesce("mask", F.lit(0)))
    names = [F.when(F.col("mask").bitwiseAND(F.lit(1 << k)) != 0, F.lit(f)) for k, f in enumerate(TEMPLATES)]
    n = F.coalesce("n_licences", F.lit(0)).cast("long").alias("n_licences")
    return by_doc.select("doc_id", "n_paragraphs", n, F.concat_ws(",", *names).alias("families"), "probability")
