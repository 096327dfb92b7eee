"""Licence scans: planted notices, notices not trained on, ordinary text, odd rows."""

import dataclasses
import re

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from flowlens.llm import licences as li
from flowlens.llm.queries import LLM

# how the notices of the test tables begin
PLANTED = {"MIT": r"MIT License", "Apache": r"Apache License", "GPL": r"GNU General Public License", "CC-BY-NC": r"CC BY-NC"}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def model(docs):
    return li.fit(docs)


def test_query_finds_planted_notices_only(spark, docs):
    got = {r.doc_id: set(filter(None, r.families.split(","))) for r in LLM.queries["op6_licence_scan"](spark, "/root/testdata/sf0.01").collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert sorted(got) == sorted(texts)
    want = {i: {f for f, p in PLANTED.items() if re.search(p, t)} for i, t in texts.items()}
    assert sum(bool(x) for x in want.values()) > 20
    assert {i: x - {"unknown"} for i, x in got.items()} == want
    assert sum("unknown" in x for x in got.values()) <= 0.005 * len(got)


def families(spark, model, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: (r.families, r.n_pieces) for r in li.licences_by_document(rows, li.find_licences(rows, model)).collect()}


def test_new_notices(spark, model):
    filler = " ".join(f"word{i}" for i in range(500))
    got = families(spark, model, [
        "The code is licensed under the Apache License, Version 2.0 (the License).", f"{filler} Released under the MIT License. {filler}",
        "Licensed under the Southern Gadget License, version 9.", "ordinary words about gardens and rain", None, "", "\n \n",
        "Redistribution and use in source and binary forms, with or without modification, are permitted", "a\n" * 3000])
    assert got[0][0] == ["Apache"] and got[1][0] == ["MIT"] and got[2][0] == ["unknown"]
    assert got[3][0] == [] and got[4] == ([], 0) and got[5] == ([], 0) and got[6] == ([], 0)
    assert got[7][0] == ["BSD"] and got[8] == ([], 3000)


def test_edge_rows(spark, model):
    rows = spark.createDataFrame([(None, "Released under the MIT License.", "x"), (1, "x", "x"), (1, "Licensed under CC BY-NC 4.0.", "x")],
                                 "doc_id long, text string, families string")
    out = li.licences_by_document(rows, li.find_licences(rows, model)).collect()
    assert sorted((r.doc_id or 0, r.families) for r in out) == [(0, ["MIT"]), (1, ["CC-BY-NC"]), (1, ["CC-BY-NC"])]
    none = rows.limit(0)
    assert li.licences_by_document(none, li.find_licences(none, model)).count() == 0
    assert 0.4 <= li.fit(none).threshold <= 0.9


def test_wrapped_notices(spark, model):
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License"
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met"
    mit = "Permission is hereby granted, free of charge, to any\nperson obtaining a copy of this software and\nassociated documentation files"
    commented = "# " + gpl.replace("\n", "\n# ")
    rows = [gpl, bsd, mit, commented, f"garden words\n \n{bsd}\n\nmore rain", "Released under the MIT License.\nordinary words about rain",
            gpl.replace("\n", "\n\n")]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: (r.families, r.n_known, r.n_unknown) for r in li.licences_by_document(docs, li.find_licences(docs, model)).collect()}
    want = [["GPL"], ["BSD"], ["MIT"], ["GPL"], ["BSD"], ["MIT"]]
    assert [got[i] for i in range(6)] == [(f, 1, 0) for f in want]
    assert "GPL" not in got[6][0]  # a blank line ends a paragraph


def test_notices_of_more_families(spark, model):
    got = families(spark, model, [
        "Eclipse Public License - v 2.0", "Licensed under the EUPL, Version 1.2", li.TEMPLATES["MIT"][-1],
        "The driver showed her driving licence and was free to go.", "He wrote a book on copyright."])
    assert [got[i][0] for i in range(5)] == [["EPL"], ["EUPL"], ["MIT"], [], []]


def test_passing_over_pieces_loses_nothing(docs, model):
    fields = lambda found: sorted((r.doc_id, r.piece, r.family, round(r.probability, 9), r.match) for r in found.collect())
    assert model.triggers is not None and "the" not in model.triggers
    everything = fields(li.find_licences(docs, dataclasses.replace(model, triggers=None)))
    assert fields(li.find_licences(docs, model)) == everything and len(everything) > 20


def test_probabilities_against_plain_python(docs, model):
    """Every piece of every document, read and judged without Spark."""
    weights, start = model.regression.coefficientMatrix.toArray(), model.regression.interceptVector.toArray()
    column = {g: k for k, g in enumerate(model.vocabulary)}
    want = {}
    for row in docs.collect():
        lines = [regex.findall(r"[\p{L}\p{N}](?:[^\x20\x09-\x0D]*[\p{L}\p{N}])?", x) for x in (row.text or "").lower().split("\n")]
        for words in lines:
            for at in range(0, max(len(words) - li.PIECE + li.STRIDE - 1, 0) // li.STRIDE * li.STRIDE + 1, li.STRIDE):
                piece = words[at: at + li.PIECE]
                found = {" ".join(piece[i: i + n]) for n in (1, 2, 3) for i in range(len(piece) - n + 1)} & column.keys()
                scores = start + weights[:, sorted(column[g] for g in found)].sum(axis=1)
                odds = np.exp(scores - scores.max())
                chance = odds / odds.sum()
                if 1 - chance[0] >= model.unknown:
                    want[row.doc_id, " ".join(piece)] = float(chance[1:].max())
    got = {(r.doc_id, r.paragraph): r.probability for r in li.find_licences(docs, model).collect()}
    assert want and got.keys() >= want.keys() and all(abs(got[k] - p) < 1e-9 for k, p in want.items())


def test_fitting_reads_a_bounded_sample(docs):
    scan = li.Scan(max_documents=20, max_pieces=30)
    assert li.ordinary_pieces(docs, scan).count() == 30
    assert li.ordinary_pieces(docs.limit(0), scan).count() == 0


def test_ordinary_pieces_of_every_document_are_learned_from(spark):
    """Against plain Python, copies counted once; a document outside the picked surroundings changes the model."""
    texts = [f"song number {i} of the book is about the public and the general terms of version {i % 7}" for i in range(60)]
    texts += [texts[3], "Released under the MIT License.", "", None, "rain " * 100]
    vocabulary, scan = li._vocabulary(spark), li.Scan(max_documents=5, max_pieces=5)
    want = {}
    for piece in {p for t in texts if t and "MIT" not in t for w in [t.lower().split()]
                  for p in {tuple(w[i: i + li.PIECE]) for i in range(0, max(len(w) - li.PIECE + li.STRIDE - 1, 0) // li.STRIDE * li.STRIDE + 1, li.STRIDE)}}:
        grams = {" ".join(piece[i: i + n]) for n in (1, 2, 3) for i in range(len(piece) - n + 1)} & set(vocabulary)
        want[tuple(sorted(grams))] = want.get(tuple(sorted(grams)), 0) + 1
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in li.ordinary_grams(docs, vocabulary, scan).collect():
        got[tuple(r._grams)] = got.get(tuple(r._grams), 0) + r.n
    assert got == want and sum(want.values()) > 60

    picked = {r.doc_id for r in docs.join(li.ordinary_pieces(docs, scan).select(F.array_join("words", " ").alias("text")), "text").collect()}
    other = docs.withColumn("text", F.when(F.col("doc_id").isin(*picked) | (F.col("doc_id") > 59), F.col("text")).otherwise(
        F.concat(F.lit("the software is provided by author "), F.col("doc_id"))))
    assert li.ordinary_pieces(other, scan).select("words").collect() == li.ordinary_pieces(docs, scan).select("words").collect()
    one, two = (li.fit(x, scan).regression.coefficientMatrix.toArray() for x in (docs, other))
    assert not np.allclose(one, two)
