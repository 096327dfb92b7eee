"""Merge replay against the public library, and exact round trips."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from flowlens.llm import bpe
from flowlens.llm.queries import LLM

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(texts, ranks):
    encoder, decoder = bpe.Encoder(ranks, public_tokenizers.PATTERN), bpe.Decoder(ranks)
    found = encoder.encode(texts)
    assert [decoder.decode(x) for x in found] == [t.encode() for t in texts]
    return [[int.from_bytes(x[i: i + 4], "little") for i in range(0, len(x), 4)] for x in found]


def test_hard_texts(ranks, library):
    texts = ["", " ", "a", "aaaaaaaaaaa", "a" * 5000, "ab" * 999, "<|endoftext|>", "don't  stop\n\n x", "é😀漢字ß",
             "\x00\x01�", "   lead", "0123456789" * 30, "=" * 77, "\t\t\n" * 9]
    assert ids_of(texts, ranks) == [library.encode_ordinary(t) for t in texts]


def test_random_texts(ranks, library):
    rng = random.Random(5)
    for letters in ("ab", "etaoin shr", "abcdefghijklmnopqrstuvwxyz", "éèß漢 \n'sT1."):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 300))) for _ in range(300)]
        assert ids_of(texts, ranks) == [library.encode_ordinary(t) for t in texts]


def test_merge_that_makes_a_lower_rank():
    """After b+c the pair a+bc has a lower rank than b+c; the next b+c of the same piece must wait."""
    ranks = {bytes([i]): 100 + i for i in range(256)} | {b"bc": 5, b"abc": 1, b"bcb": 2, b"abcb": 0}
    own = tiktoken.Encoding("x", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    texts = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 30))) for _ in range(500)]
    encoder = bpe.Encoder(ranks, r"\S+")
    for text, got in zip(texts, encoder.encode(texts)):
        assert [int.from_bytes(got[i: i + 4], "little") for i in range(0, len(got), 4)] == own.encode_ordinary(text)


def test_query(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in LLM.queries["op7_byte_bpe"](spark, sf).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d.text or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        row = got[d.doc_id]
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, "a b", "x"), (1, "a b", "x"), (None, "", None)], "doc_id long, text string, ids string")
    out = bpe.encode_texts(docs, PATH, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    assert sorted(bytes(r.decoded) for r in out.collect()) == [b"", b"", b"a b", b"a b"]
    assert bpe.encode_texts(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
