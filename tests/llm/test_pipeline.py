"""The pipeline against its stages in plain Python."""

import base64
import hashlib
import re

import public_tokenizers
import tiktoken
from test_neardup import brute as near_groups
from test_outliers import brute as quality
from test_secrets import brute as base_findings

import corpus_pipeline
from flowlens.llm import outliers

WORD = re.compile("[^\x20\x09-\x0D]+")


def tokens(text):
    return [w for x in WORD.findall(text or "") if (w := re.sub(r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$", "", x).translate({c: c + 32 for c in range(65, 91)}))]


def covers(doc, item, width=10):
    """Whether windows of the item's words (its whole if shorter) that stand in the document cover half of it."""
    width = min(width, len(item))
    there = {tuple(doc[i: i + width]) for i in range(len(doc) - width + 1)}
    hit = {i + k for i in range(len(item) - width + 1) if tuple(item[i: i + width]) in there for k in range(width)}
    return len(item) >= 5 and 2 * len(hit) >= len(item)


def redacted(text):
    out, at, end = [], 0, -1
    for s, _, e in base_findings(text):
        if s >= end:
            out += [text[at:s], corpus_pipeline.MARK]
        at = end = max(e, end)
    return "".join([*out, text[at:]])


def test_run(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = [tokens(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = quality(rows, outliers.Rules())
    left = [(r.doc_id, r.text) for r in rows if kept[r.doc_id]]
    groups = near_groups(left, percent=80)
    left = [(i, t) for i, t in left if groups[i][1] == i]
    left = [(i, redacted(t)) for i, t in left if not any(covers(tokens(t), x) for x in items)]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {i: hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in own.encode_ordinary(t))).hexdigest() for i, t in left}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert {i: r.ids_sha256 for i, r in got.items()} == want
    assert all(r.n_tokens * 4 == len(r.ids) and hashlib.sha256(r.ids).hexdigest() == r.ids_sha256 for r in got.values())
    assert {i: r.decoded_sha256 for i, r in got.items()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in left}


def test_stages_on_empty_and_odd_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0
    odd = spark.createDataFrame([(None, None, None, None, None), (-5, "", "en", None, 0), (3, "a b", None, "s", 3)], docs.schema)
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, odd, sf).count() == 3, name
    assert corpus_pipeline.STAGES[0][1](spark, odd, sf).count() == 0


def test_duplicates_are_decided_per_row(spark, sf):
    text = " ".join(f"word{i}" for i in range(80))
    other = " ".join(f"other{i}" for i in range(80))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(10, text, "en", "a", 1), (10, text, "en", "a", 1), (11, text, "en", "a", 1), (11, other, "en", "a", 1),
            (None, other, None, None, None), (None, None, "en", "a", 0), (None, None, "en", "a", 0), (12, "", "en", "a", 0)]
    got = corpus_pipeline.keep_one_of_each(spark, spark.createDataFrame(rows, docs.schema), sf).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in got) == [(-1, ""), (-1, ""), (10, text), (11, other), (12, "")]


def test_long_texts_and_clashing_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    long = " ".join(f"w{i % 5000}x{i // 5000}" for i in range(120_000))
    odd = spark.createDataFrame([(1, long, "en", "s", 1, 0, "x", "y"), (2, "a b", "en", "s", 3, 1, None, "y")],
                                docs.schema.add("kept", "integer").add("spans", "string").add("ids", "string"))
    for name, stage in corpus_pipeline.STAGES[1:]:
        got = stage(spark, odd, sf).collect()
        assert sorted(r.doc_id for r in got) == [1, 2], name
    assert [r.n_tokens > 120_000 for r in corpus_pipeline.encode(spark, odd, sf).orderBy("doc_id").collect()] == [True, False]
