"""Licence scans: a trained paragraph classifier with a calibrated unknown class, confirmed by templates.

Native: DataFrame and Spark ML on the JVM.  Every line is read, and every run of lines between blank lines as one
paragraph, so hard-wrapped notices are read whole; what has more than ``PIECE`` words is read in overlapping pieces.
The word 1-, 2- and 3-grams of the notices below are the features of a sparse vector; a multinomial logistic
regression with an L1 share gives the family, ``unknown`` (reads like a licence of no known family) or ``none``.  It is
trained on the templates and made-up notices, each with words dropped and set into ordinary pieces of the corpus, on
sentences that mention licences without being notices, and on every distinct ordinary piece of every document; a piece that
holds ``confirm`` of a template is not ordinary.  Pieces that hold the same grams are one row with their number, and all of
them together weigh as much as ``ordinary`` notices at most, so the balance of the classes does not depend on the size of
the corpus.  Only the surroundings of the made-up variants, one piece each, are picked: from ``max_pieces`` pieces out of
``max_documents`` documents, least in hashes of piece and id.  On set-aside variants the least family probability is chosen
at which unknown notices pass as a family at most ``max_false`` of the time; below it a finding counts as unknown.  In the
same way the least probability of being a notice at all keeps ordinary pieces out, judged on a third of all of them.  A family also has to be confirmed: enough of one of its templates' word pairs stand in the
piece, else it is unknown.  A paragraph piece adds nothing where one of its lines shows the same, and a line that is a
fragment of a family's template, inside a paragraph piece of that family, is no unknown notice.  ``n_pieces`` counts the
pieces of lines.

Most pieces are never scored, without loss: a gram helps if it weighs more for some notice class than for ``none``.  Frequent
words whose helping grams, all taken together, leave a piece below the threshold are set aside; each other helping gram
has its least frequent word as a trigger, and texts and pieces without a trigger are passed over.  Should an empty
piece reach the threshold, all pieces are scored.

Edge cases: null and empty texts have no paragraphs and no findings; very long texts are read whole, in pieces; repeated rows
with one doc_id show the findings of all of them; rows without doc_id share one row of findings; of classes that tie the
first one is taken; other columns are left behind; an empty table gives an empty result (the model is then fitted on
notices alone).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowlens.runtime import materialise

PIECE, STRIDE = 60, 30
PIECES = "array<struct<words:array<string>,run:int,first:int,last:int,joined:boolean>>"
NONE, UNKNOWN = "none", "unknown"

# fixed values: short notices of well-known licences
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "This project is licensed under the MIT License.", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
            "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY"],
    "Apache": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
               "you may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org/licenses"],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
            "Released under the GNU GPL version 2"],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-2.1-only"],
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only"],
    "BSD": ["Released under the BSD 3-Clause License.", "Licensed under the BSD license", "SPDX-License-Identifier: BSD-3-Clause",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0"],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "EPL": ["Eclipse Public License - v 2.0", "made available under the terms of the Eclipse Public License 2.0", "SPDX-License-Identifier: EPL-2.0"],
    "EUPL": ["Licensed under the EUPL, Version 1.2", "Licensed under the European Union Public Licence", "SPDX-License-Identifier: EUPL-1.2"],
    "ISC": ["Released under the ISC License.", "SPDX-License-Identifier: ISC",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
    "CC0": ["Released under CC0 1.0 Universal, public domain dedication.", "To the extent possible under law the author has waived all copyright"],
}
#: notices that read like licences of no family above
OTHERS = [
    "Licensed under the Example Community License, version 1.", "All rights reserved. No part may be reproduced without permission.",
    "This software is proprietary and confidential.", "Released under a custom licence, see the file LICENSE.", "Free for personal use only.",
    "Licensed under the Open Widget License 3.1", "Used with permission of the publisher.", "Copyright by the author, redistribution prohibited.",
    "This work is licensed under the terms of our agreement, version 5.", "Released under the Northern Data Licence.",
    "License: commercial, contact sales for terms.", "Licensed to the customer under the Master Agreement.",
]
#: sentences that speak of licences, rights or permission and are no notices
MENTIONS = [
    "She lost her driving licence and had to apply for a new one.", "The restaurant was granted a licence to sell wine last year.",
    "Ask your parents for permission before you go to the lake.", "The course explains what a software license is and how to choose one.",
    "The committee discussed copyright law and the rights of authors for two hours.", "The terms of the agreement were never published.",
    "A public hearing on the general plan will be held on Monday.", "Version 2.0 of the report includes the following conditions of the study.",
    "The software is used by thousands of people free of charge.", "He read the notice on the door and went home without a copy.",
    "The book describes the history of the Apache people and the MIT campus.", "Redistribution of income was the subject of the debate.",
    "The license plate of the car was covered with mud.", "Der Angler braucht einen Schein und die Erlaubnis des Besitzers.",
    "Le permis de conduire est valable dans toute l'Union.", "El permiso de obra fue concedido por el ayuntamiento.",
    "Many projects on the site are released under different licenses.", "The fishing license costs more for visitors than for residents.",
]
CLASSES = [NONE, UNKNOWN, *TEMPLATES]


@dataclass(frozen=True)
class Scan:
    max_documents: int = 1500  # documents that give surroundings of variants
    max_pieces: int = 6000  # pieces that variants are set into
    ordinary: int = 6000  # notices that all ordinary pieces weigh as much as, at most
    variants: int = 24
    max_false: float = 0.05  # unknown notices that may pass as a family
    max_noise: float = 0.0005  # ordinary pieces that may pass as unknown
    confirm: float = 0.6
    seed: int = 5


def tokens(text: Column) -> Column:
    """Lower-case words without edge punctuation."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}](?:[^\x20\x09-\x0D]*[\p{L}\p{N}])?"), F.lit(0))
    return found


def _cut(words: Column) -> Column:
    """Where the overlapping pieces of an array begin, from 0."""
    last = F.greatest(F.ceil((F.size(words) - PIECE) / STRIDE).cast("int"), F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: i * STRIDE)


def pieces(text: Column) -> Column:
    """array of arrays of words: the lines of a text, long ones in overlapping pieces."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), tokens)
    return F.flatten(F.transform(F.filter(lines, lambda w: F.size(w) > 0), lambda words: F.transform(
        _cut(words), lambda i: F.slice(words, i + 1, F.lit(PIECE)))))


def all_pieces(text: Column) -> Column:
    """array of (words, run, first, last, joined): the pieces of lines, and those of runs of lines that reach over several lines."""
    runs = F.transform(F.split(F.coalesce(text, F.lit("")), r"\n(?:[\x20\x09\x0B-\x0D]*\n)+", -1),
                       lambda run: F.transform(F.split(run, "\n", -1), tokens))

    def of_lines(run: Column, r: Column) -> Column:
        return F.flatten(F.transform(run, lambda words, k: F.when(F.size(words) > 0, F.transform(
            _cut(words), lambda i: piece(F.slice(words, i + 1, F.lit(PIECE)), r, k, k, False))).otherwise(F.array().cast(PIECES))))

    def piece(words: Column, r: Column, first: Column, last: Column, joined: bool) -> Column:
        return F.struct(words.alias("words"), r.alias("run"), first.alias("first"), last.alias("last"), F.lit(joined).alias("joined"))

    def of_run(run: Column, r: Column) -> Column:
        both = F.array(F.struct(  # one entry, so that it is made once
            F.flatten(run).alias("words"), F.flatten(F.transform(run, lambda words, k: F.array_repeat(k, F.size(words)))).alias("line")))
        made = F.flatten(F.transform(both, lambda x: F.transform(_cut(x.words), lambda i: piece(
            F.slice(x.words, i + 1, F.lit(PIECE)), r, F.get(x.line, i), F.get(x.line, F.least(i + PIECE, F.size(x.line)) - 1), True))))
        return F.when(F.size(run) > 1, F.filter(made, lambda x: x["first"] < x["last"])).otherwise(F.array().cast(PIECES))

    return F.flatten(F.transform(runs, lambda run, r: F.concat(of_lines(run, r), of_run(run, r))))


def grams(words: Column) -> Column:
    """Word 1-, 2- and 3-grams."""
    def of(n: int) -> Column:
        last = F.size(words) - n
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.concat_ws(
            " ", *[F.get(words, i + k) for k in range(n)]))).otherwise(F.array().cast("array<string>"))
    return F.concat(words, of(2), of(3))


def known_grams(words: Column, vocabulary: list[str]) -> Column:
    """The distinct grams of the vocabulary in an array of words, sorted; only those that begin with a known word are made."""
    last = F.size(words) - 1
    known = [g for g in vocabulary if " " not in g]  # every word of a gram is a gram itself
    at = F.filter(F.sequence(F.lit(0), last), lambda i: F.get(words, i).isin(known))
    # a gram that would reach beyond the end is null and no gram of the vocabulary
    made = F.flatten(F.transform(at, lambda i: F.array(
        F.get(words, i), F.concat(F.get(words, i), F.lit(" "), F.get(words, i + 1)),
        F.concat(F.get(words, i), F.lit(" "), F.get(words, i + 1), F.lit(" "), F.get(words, i + 2)))))
    found = F.sort_array(F.array_distinct(F.filter(made, lambda g: g.isin(vocabulary))))
    return F.when(last >= 0, found).otherwise(F.array().cast("array<string>"))


def _counted(vocabulary: list[str]) -> CountVectorizerModel:
    return CountVectorizerModel.from_vocabulary(vocabulary, inputCol="_grams", outputCol="_x").setBinary(True).setMinTF(1.0)


def _vectors(rows: DataFrame, vocabulary: list[str]) -> DataFrame:
    return _counted(vocabulary).transform(rows.withColumn("_grams", grams(F.col("words")))).drop("_grams")


def _notices(spark: SparkSession) -> DataFrame:
    """family, number of the notice, its words."""
    rows = [(family, text) for family, texts in {**TEMPLATES, UNKNOWN: OTHERS, NONE: MENTIONS}.items() for text in texts]
    literal = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(k).alias("k"), F.lit(t).alias("text")) for k, (f, t) in enumerate(rows)])
    return spark.range(1).select(F.inline(literal)).select("family", "k", tokens(F.col("text")).alias("words"))


def _vocabulary(spark: SparkSession) -> list[str]:
    """The grams of the notices and mentions, as many as these fixed texts have."""
    return [r.gram for r in _notices(spark).select(F.explode(grams(F.col("words"))).alias("gram")).distinct().orderBy("gram").collect()]


def ordinary_pieces(docs: DataFrame, scan: Scan) -> DataFrame:
    """words and row, from 1: pieces of the corpus that hold no template, ``max_pieces`` at most, for variants to be set into."""
    # ids alone are sorted and broadcast, max_documents of them at most
    chosen = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(scan.max_documents)
    some = docs.join(F.broadcast(chosen.distinct()), "doc_id")
    known = _template_pairs(docs.sparkSession)
    meets = F.arrays_overlap("words", F.lit(sorted({pair.split(" ")[0] for _, pairs in known for pair in pairs})))
    held = F.exists(F.transform(F.array(_pairs(F.col("words"))), lambda mine: F.exists(  # one entry, so that it is made once
        _literal(known), lambda t: F.size(F.array_intersect(mine, t.pairs)) >= scan.confirm * F.size(t.pairs))), lambda x: x)
    few = some.select(F.explode(pieces(F.col("text"))).alias("words")).filter(~(meets & held)).distinct().orderBy(
        F.xxhash64("words"), F.to_json("words")).limit(scan.max_pieces)
    ordered = Window.orderBy(F.xxhash64("words"), F.to_json("words"))  # over max_pieces rows at most
    return materialise(few.withColumn("row", F.row_number().over(ordered)), "pieces")


def ordinary_grams(docs: DataFrame, vocabulary: list[str], scan: Scan) -> DataFrame:
    """_grams, aside, n: how many distinct pieces of all documents hold these grams of the vocabulary, without those that hold a template."""
    read = docs.filter("text IS NOT NULL").select(F.explode(pieces(F.col("text"))).alias("words"))
    each = read.select(known_grams(F.col("words"), vocabulary).alias("_grams"), F.xxhash64("words").alias("piece"))
    # written, because the filter below would otherwise be taken to every piece
    counted = materialise(each.groupBy("_grams", (F.pmod("piece", F.lit(3)) == 2).alias("aside")).agg(
        F.count_distinct("piece").alias("n")), "all-grams")
    known = _template_pairs(docs.sparkSession)  # their pairs are grams of the vocabulary
    # what holds enough of a template holds one of any pairs that are too many to miss; long ones are rare in ordinary text
    some = F.arrays_overlap("_grams", F.lit(sorted({pair for _, pairs in known for pair in sorted(pairs, key=lambda p: (-len(p), p))[
        :max(1, len(pairs) - math.ceil(scan.confirm * len(pairs)) + 1)]})))
    held = F.exists(_literal(known), lambda t: F.size(F.array_intersect("_grams", t.pairs)) >= scan.confirm * F.size(t.pairs))
    return materialise(counted.filter(~(some & held)), "ordinary-grams")


def training_rows(plain: DataFrame, ordinary: DataFrame, vocabulary: list[str], scan: Scan) -> DataFrame:
    """_grams, class number, weight, number of pieces, and whether the row is set aside for the threshold."""
    spark = plain.sparkSession
    notices = _notices(spark).withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(scan.variants - 1))))
    key = lambda *x: F.pmod(F.xxhash64(*x, F.lit(scan.seed)), F.lit(1000))
    thinned = notices.withColumn("words", F.filter("words", lambda w, i: (F.col("v") % 4 == 0) | (
        F.pmod(F.xxhash64(w, i, F.col("v"), F.col("k")), F.lit(12)) > 0)))
    place = (F.pmod(F.xxhash64("k", "v"), F.lit(max(plain.count(), 1))) + 1).cast("int")
    placed = thinned.withColumn("row", F.when(F.col("v") % 4 < 2, F.lit(None).cast("int")).otherwise(place))
    around = plain.select("row", F.col("words").alias("context"))
    placed = placed.join(around, "row", "left").withColumn("lead", key("k", "v") % 30).withColumn("words", F.coalesce(F.concat(
        F.slice("context", F.lit(1), F.col("lead").cast("int")), "words",
        F.slice("context", (F.col("lead") + 1).cast("int"), F.lit(20))), "words"))
    number = F.array_position(F.lit(CLASSES), F.col("family")).cast("double") - 1
    total = ordinary.agg(F.sum("n")).first()[0] or 0
    share = min(1.0, scan.ordinary / max(total, 1))
    return materialise(
        placed.select(known_grams(F.col("words"), vocabulary).alias("_grams"), number.alias("label"), F.lit(1.0).alias("weight"),
                      F.lit(1).cast("long").alias("n"), (F.col("v") % 3 == 2).alias("aside"))
        .unionByName(ordinary.select("_grams", F.lit(0.0).alias("label"), (F.col("n") * share).alias("weight"), "n", "aside")),
        "licence-rows")


@dataclass(frozen=True)
class Model:
    regression: LogisticRegressionModel
    threshold: float  # least probability of a family
    unknown: float  # least probability of being no ordinary text
    vocabulary: list[str]
    triggers: list[str] | None  # a piece without any of these words is no notice; None: every piece is scored


def _best(rows: DataFrame) -> DataFrame:
    """``notice``, the probability of being no ordinary text, and the likeliest class that is a notice."""
    p = vector_to_array("_p")
    of_notice = F.slice(p, F.lit(2), F.lit(len(CLASSES) - 1))
    top = F.array_max(of_notice)
    return rows.withColumns({
        "probability": top, "notice": 1.0 - F.element_at(p, 1),
        "family": F.element_at(F.lit(CLASSES[1:]), F.array_position(of_notice, top).cast("int"))})


def _triggers(regression: LogisticRegressionModel, vocabulary: list[str], ordinary: DataFrame, least: float) -> list[str] | None:
    """Words without which a piece stays below ``least``, whatever else it holds.

    Frequent words are set aside as long as all grams of them together, each with its whole weight for each class, stay below;
    each other gram that helps gives its least frequent word.
    """
    weights, start = regression.coefficientMatrix.toArray(), regression.interceptVector.toArray()
    gains = {g: [max(float(y - x[0]), 0.0) for y in x[1:]] for g, x in zip(vocabulary, weights.T) if (x[1:] > x[0]).any()}
    enough = math.log(least / (1 - least)) - 1e-6  # of the odds

    def bound(words: set[str]) -> float:
        total = [x - start[0] for x in start[1:]]
        for gram, gain in gains.items():
            if words.issuperset(gram.split(" ")):
                total = [t + g for t, g in zip(total, gain)]
        return math.log(sum(map(math.exp, total)))

    if bound(set()) >= enough:
        return None
    known = sorted({w for g in gains for w in g.split(" ")})
    often = {r.word: r.n for r in ordinary.select(F.explode("_grams").alias("word"), "n").filter(F.col("word").isin(known)).groupBy("word").agg(
        F.sum("n").alias("n")).collect()}  # words of the vocabulary only
    weak: set[str] = set()
    for word in sorted(known, key=lambda w: (-often.get(w, 0), w)):
        if bound(weak | {word}) < enough:
            weak.add(word)
    open_grams = [[w for w in g.split(" ") if w not in weak] for g in gains]
    return sorted({min(g, key=lambda w: (often.get(w, 0), w)) for g in open_grams if g})


LEAST_NOTICE, MOST_NOTICE = 0.7, 0.95


def fit(docs: DataFrame, scan: Scan = Scan()) -> Model:
    vocabulary = _vocabulary(docs.sparkSession)
    ordinary = ordinary_grams(docs, vocabulary, scan)
    rows = _counted(vocabulary).transform(training_rows(ordinary_pieces(docs, scan), ordinary, vocabulary, scan))
    regression = LogisticRegression(
        featuresCol="_x", labelCol="label", weightCol="weight", probabilityCol="_p", rawPredictionCol="_r", predictionCol="_y",
        family="multinomial", regParam=0.003, elasticNetParam=0.9, maxIter=40).fit(rows.filter("NOT aside"))
    aside = materialise(_best(regression.transform(rows.filter("aside"))).select("label", "family", "probability", "notice", "n"), "aside")
    as_family = F.when(F.col("family") == UNKNOWN, 0.0).otherwise(F.col("probability"))
    # what lies outside the limits counts as the limit, so only the few values between them are kept apart
    as_notice = F.greatest(F.lit(LEAST_NOTICE), F.least(F.lit(MOST_NOTICE), F.col("notice")))
    at = lambda label, value, share: aside.filter(F.col("label") == label).agg(F.percentile(value, F.lit(share), F.col("n"))).first()[0]
    threshold = min(0.9, max(0.4, at(1.0, as_family, 1 - scan.max_false) or 0.0))
    unknown = at(0.0, as_notice, 1 - scan.max_noise) or LEAST_NOTICE
    return Model(regression, threshold, unknown, vocabulary, _triggers(regression, vocabulary, ordinary, unknown))


def _pairs(words: Column) -> Column:
    last = F.size(words) - 2
    return F.array_distinct(F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.concat_ws(
        " ", F.get(words, i), F.get(words, i + 1)))).otherwise(words))


def find_licences(docs: DataFrame, model: Model, scan: Scan = Scan()) -> DataFrame:
    """One row per piece that is no ordinary text: doc_id, piece, family (or unknown), probability, match, paragraph."""
    found = F.transform(all_pieces(F.col("text")), lambda x, i: F.struct(i.alias("piece"), x.alias("of")))
    if model.triggers is not None:
        triggers = F.lit(model.triggers) if model.triggers else F.array().cast("array<string>")
        docs = docs.filter(F.arrays_overlap(tokens(F.coalesce("text", F.lit(""))), triggers))
        found = F.filter(found, lambda x: F.arrays_overlap(x.of.words, triggers))
    read = docs.select("doc_id", F.xxhash64("text").alias("_text"), F.explode(found).alias("_piece")).select(
        "doc_id", "_text", "_piece.piece", "_piece.of.*")
    judged = _best(model.regression.transform(_vectors(read, model.vocabulary))).filter(F.col("notice") >= model.unknown)
    known = _literal(_template_pairs(docs.sparkSession))
    mine = _pairs(F.col("words"))
    match = F.array_max(F.transform(F.filter(known, lambda t: t.family == F.col("family")), lambda t: F.size(
        F.array_intersect(mine, t.pairs)) / F.size(t.pairs)))
    part_of = F.transform(F.filter(known, lambda t: F.size(F.array_intersect(mine, t.pairs)) >= scan.confirm * F.size(mine)), lambda t: t.family)
    named = judged.withColumn("match", F.coalesce(match, F.lit(0.0))).select(
        "doc_id", "_text", "piece", F.when((F.col("probability") >= model.threshold) & (F.col("match") >= scan.confirm), F.col("family"))
        .otherwise(UNKNOWN).alias("family"), "probability", "match", F.array_join("words", " ").alias("paragraph"),
        "run", "first", "last", "joined", part_of.alias("part_of"))

    def holds(x: Column, line: Column) -> Column:
        return x.joined & ~line.joined & (x.run == line.run) & (line["first"] >= x["first"]) & (line["last"] <= x["last"])

    def adds(x: Column) -> Column:
        """Whether no other finding of the text says the same."""
        again = F.exists("_all", lambda y: holds(x, y) & x.family.isin(UNKNOWN, y.family))
        fragment = (x.family == UNKNOWN) & F.exists("_all", lambda y: holds(y, x) & F.array_contains(x.part_of, y.family))
        return ~again & ~fragment

    fields = ["piece", "family", "probability", "match", "paragraph", "run", "first", "last", "joined", "part_of"]
    return named.groupBy("doc_id", "_text").agg(F.collect_list(F.struct(*fields)).alias("_all")).select(
        "doc_id", F.inline(F.filter("_all", adds))).select("doc_id", *fields[:5])


def _template_pairs(spark: SparkSession) -> list[tuple[str, list[str]]]:
    """family and word pairs of each template."""
    rows = _notices(spark).filter(~F.col("family").isin(UNKNOWN, NONE)).orderBy("k").select("family", _pairs(F.col("words")).alias("pairs"))
    return [(r.family, r.pairs) for r in rows.collect()]


def _literal(known: list[tuple[str, list[str]]]) -> Column:
    return F.array(*[F.struct(F.lit(family).alias("family"), F.lit(pairs).alias("pairs")) for family, pairs in known])


def licences_by_document(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, n_pieces, families (distinct, sorted), n_known and n_unknown: one row per row of ``docs``."""
    per = found.groupBy(F.col("doc_id").alias("_id")).agg(
        F.array_sort(F.collect_set("family")).alias("families"),  # at most as many entries as there are families
        F.count(F.when(F.col("family") != UNKNOWN, 1)).alias("n_known"), F.count(F.when(F.col("family") == UNKNOWN, 1)).alias("n_unknown"))
    counted = docs.select("doc_id", F.size(pieces(F.col("text"))).cast("long").alias("n_pieces"))
    return counted.join(per, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select(
        "doc_id", "n_pieces", F.coalesce("families", F.array().cast("array<string>")).alias("families"),
        F.coalesce("n_known", F.lit(0)).alias("n_known"), F.coalesce("n_unknown", F.lit(0)).alias("n_unknown"))
