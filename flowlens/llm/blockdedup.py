"""Substring dedup of word windows with fixed-block anchors.

Words are runs of bytes other than space and 0x09-0x0D.  Every word covered by a window of ``window`` words whose word
sequence also starts elsewhere goes; windows are judged on the input.

1. Index.  Each document is cut into non-overlapping blocks of ``(window + 1) // 2`` words.  Whatever its offset, a window
   holds a whole block, so of two equal windows each meets a block of the other with one of its rolling probes.
2. Probe.  All rolling probes of block length are asked against the index of all shards, as sorted 32-bit keys within a bucket.
   A probe that is itself a block must meet another one.  A false meeting of two short keys costs work, not results.
3. Extend.  Every window that holds a meeting is a candidate.  Candidates meet again by two hashes of the whole
   window (64 bits and the bucket); the windows found twice, joined where they overlap, are the maximal exact repeats, for
   groups of thousands of copies too, and without a pair of occurrences being written down.

Documents without a candidate are finished after step 2; only the others travel on.  Buckets and shards grow in number with the
input, not in size.

Edge cases: null and empty texts have no words; fewer words than a window are kept; repeated rows are repeats of each other; a
document without id is judged like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.arrowtext import Texts, Words, roller, whole_windows, word_hashes, words_of
from flowlens.llm.shards import answers, expand, make_shards, rows_of, slices, squeeze, store, texts_in, unpack
from flowlens.runtime import materialise

BUCKET_KEYS = 2_500_000  # probes in a bucket, about
DONE, TEXTS, KEYS = range(3)
SPLIT = "kind int, shard long, bucket int, ids array<long>, numbers array<long>, hashes array<string>, blob binary, mask binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:long,end:long>>"


@dataclass
class Probes:
    """The rolling probes of a shard: where they start, their key among the sorted distinct ones, which are blocks."""

    start: np.ndarray
    entry: np.ndarray
    is_block: np.ndarray
    bucket: np.ndarray
    key: np.ndarray
    lengths: dict[int, tuple[int, int]]


def probes_of(hashes: np.ndarray, words: Words, block: int, n_buckets: int) -> Probes:
    found = roller(41).windows(hashes, block)
    start = np.flatnonzero(whole_windows(words.first, block)[: len(found)])
    found = found[start]
    place = start - np.repeat(words.first[:-1], np.diff(words.first))[start]
    whole = ((found >> np.uint64(32)) % np.uint64(n_buckets) << np.uint64(32)) | (found & np.uint64(0xFFFFFFFF))
    distinct, entry = np.unique(whole, return_inverse=True)
    bucket = (distinct >> np.uint64(32)).astype(np.int64)
    return Probes(start, entry, place % block == 0, bucket, distinct.astype(np.uint32), {b: (i, j) for b, i, j in slices(bucket, n_buckets)})


def _digest(texts: Texts, words: Words, keep: np.ndarray) -> list[str]:
    """Of each text: SHA-256 of its kept words, joined by one space."""
    take = np.zeros(len(texts.data) + 1, np.int32)
    np.add.at(take, words.start[keep], 1)
    np.add.at(take, words.end[keep], -1)
    mask = np.cumsum(take[:-1]) > 0
    owner = np.repeat(np.arange(len(texts)), words.counts())[keep]
    follows = np.zeros(len(owner), bool)
    follows[:-1] = owner[:-1] == owner[1:]
    gaps = words.end[keep][follows]
    data = texts.data.copy()
    data[gaps] = 32
    mask[gaps] = True
    size = np.concatenate([[0], np.cumsum(mask)])[texts.offsets]
    out = data[mask].tobytes()
    return [hashlib.sha256(out[a:b]).hexdigest() for a, b in zip(size.tolist(), size[1:].tolist())]


def _hashes(texts: Texts) -> tuple[Words, np.ndarray]:
    words = words_of(texts)
    return words, word_hashes(texts, words, roller(40))


def ask_probes(shards: DataFrame, block: int, n_buckets: int) -> DataFrame:
    """Rows (bucket, shard, probes, blocks, many): the sorted keys of a shard in a bucket."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            words, hashes = _hashes(texts_in(row))
            p = probes_of(hashes, words, block, n_buckets)
            blocks = np.bincount(p.entry[p.is_block], minlength=len(p.key))
            out = []
            for b, (i, j) in p.lengths.items():
                own = np.flatnonzero(blocks[i:j])
                out.append((b, row["shard"], p.key[i:j].tobytes(), p.key[i:j][own].tobytes(), np.packbits(blocks[i:j][own] > 1).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 5, (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                names=["bucket", "shard", "probes", "blocks", "many"])

    return shards.mapInArrow(work, "bucket int, shard long, probes binary, blocks binary, many binary")


def _meet_blocks(asked: pa.Table) -> pa.Table:
    """Two bits per probe: some block has its key; at least two blocks have."""
    keys, counts = [], []
    for k, many in zip(asked.column("blocks").to_pylist(), asked.column("many").to_pylist()):
        keys.append(np.frombuffer(k, np.uint32))
        counts.append(1 + np.unpackbits(np.frombuffer(many, np.uint8), count=len(keys[-1])).astype(np.int64))
    index, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(where, np.concatenate(counts), len(index)) if len(index) else np.empty(0)
    bits = []
    for k in asked.column("probes").to_pylist():
        probe = np.frombuffer(k, np.uint32)
        if len(index):
            at = np.minimum(np.searchsorted(index, probe), len(index) - 1)
            n = np.where(index[at] == probe, total[at], 0)
        else:
            n = np.zeros(len(probe))
        bits.append(np.packbits(np.column_stack([n > 0, n > 1]).ravel()).tobytes())
    return pa.table({"shard": asked.column("shard"), "bucket": asked.column("bucket"), "bits": pa.array(bits, pa.binary())})


def _window_keys(hashes: np.ndarray, window: int, at: np.ndarray, n_buckets: int) -> tuple[np.ndarray, ...]:
    """Sorted distinct (bucket, key) of the windows at ``at``; the entry of each; how often each occurs."""
    key = roller(42).windows(hashes, window)[at]
    bucket = roller(43).windows(hashes, window)[at] % np.uint64(n_buckets)
    order = np.lexsort((key, bucket))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(key[order]) != 0) | (np.diff(bucket[order]) != 0)
    entry = np.empty(len(order), np.int64)
    entry[order] = np.cumsum(new) - 1
    first = order[new]
    return bucket[first].astype(np.int64), key[first], entry, np.bincount(entry, minlength=len(first))


def split_candidates(shards: DataFrame, flags: DataFrame, window: int, block: int, n_buckets: int) -> DataFrame:
    """Finished documents, texts with candidates (``mask``: their candidate windows), and candidate keys."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            texts = texts_in(row)
            words, hashes = _hashes(texts)
            p = probes_of(hashes, words, block, n_buckets)
            bits = unpack(row, {b: j - i for b, (i, j) in p.lengths.items()}, 2).reshape(-1, 2)
            met = np.where(p.is_block, bits[p.entry, 1], bits[p.entry, 0])
            n = int(words.first[-1])
            hits = np.zeros(n + 1, np.int64)
            hits[p.start[met] + 1] = 1
            hits = np.cumsum(hits)  # meetings before each word
            last = np.minimum(np.arange(n) + window - block + 1, n)
            candidate = whole_windows(words.first, window) & (hits[last] > hits[:-1])
            owner = np.repeat(np.arange(len(texts)), words.counts())
            some = np.zeros(len(texts), bool)
            some[owner[candidate]] = True
            ids, counts = row["ids"], words.counts()
            done = np.flatnonzero(~some)
            digests = _digest(texts, words, np.arange(n))
            out = [(DONE, row["shard"], 0, [ids[i] for i in done], counts[done].tolist(), [digests[i] for i in done], b"", b"")]
            if some.any():
                bytes_ = np.repeat(some, np.diff(texts.offsets))
                offsets = np.concatenate([[0], np.cumsum(np.diff(texts.offsets)[some])])
                out.append((TEXTS, row["shard"], 0, [ids[i] for i in np.flatnonzero(some)], offsets.tolist(), [],
                            squeeze(texts.data[bytes_]), np.packbits(candidate[some[owner]]).tobytes()))
                bucket, key, _, often = _window_keys(hashes, window, np.flatnonzero(candidate), n_buckets)
                out += [(KEYS, row["shard"], b, [], [], [], key[i:j].tobytes(), np.packbits(often[i:j] > 1).tobytes())
                        for b, i, j in slices(bucket, n_buckets)]
            types = (pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=[c.split()[0] for c in SPLIT.split(", ")])

    return store(shards.join(answers(flags), "shard", "left").mapInArrow(work, SPLIT), "candidates", "kind")


def _meet_windows(asked: pa.Table) -> pa.Table:
    """A bit per candidate key: it occurs at least twice in all."""
    keys = [np.frombuffer(k, np.uint64) for k in asked.column("blob").to_pylist()]
    counts = [1 + np.unpackbits(np.frombuffer(m, np.uint8), count=len(k)) for k, m in zip(keys, asked.column("mask").to_pylist())]
    _, where = np.unique(np.concatenate(keys), return_inverse=True)
    twice = np.bincount(where, np.concatenate(counts))[where] > 1
    ends = np.cumsum([len(k) for k in keys])
    bits = [np.packbits(x).tobytes() for x in np.split(twice, ends[:-1])]
    return pa.table({"shard": asked.column("shard"), "bucket": asked.column("bucket"), "bits": pa.array(bits, pa.binary())})


def _remove(texts: DataFrame, flags: DataFrame, window: int, n_buckets: int) -> DataFrame:
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            text = Texts(expand(row["blob"]), np.array(row["numbers"], np.int64))
            words, hashes = _hashes(text)
            n = int(words.first[-1])
            at = np.flatnonzero(np.unpackbits(np.frombuffer(row["mask"], np.uint8), count=n))
            bucket, _, entry, _ = _window_keys(hashes, window, at, n_buckets)
            again = at[unpack(row, {b: j - i for b, i, j in slices(bucket, n_buckets)})[entry]]
            change = np.zeros(n + 1, np.int64)
            change[again] += 1
            change[again + window] -= 1
            gone = np.cumsum(change[:-1]) > 0
            edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
            inner = words.first[1:-1][(words.first[1:-1] > 0) & (words.first[1:-1] < n)]
            both = np.unique(inner[gone[inner] & gone[inner - 1]])  # a run never crosses documents
            begins, ends = np.sort(np.concatenate([np.flatnonzero(edge == 1), both])), np.sort(np.concatenate([np.flatnonzero(edge == -1), both]))
            owner = np.repeat(np.arange(len(text)), words.counts())
            removed: list[list[dict]] = [[] for _ in range(len(text))]
            for a, b in zip(begins.tolist(), ends.tolist()):
                base = int(words.first[owner[a]])
                removed[owner[a]].append({"start": a - base, "end": b - base})
            counts = words.counts()
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(counts, pa.int64()), pa.array(np.bincount(owner[gone], minlength=len(text)), pa.int64()),
                 pa.array(_digest(text, words, np.flatnonzero(~gone)), pa.string()),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "removed"])

    return texts.join(answers(flags), "shard", "left").mapInArrow(work, RESULT)


def remove_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and ``removed``, the word ranges that go: a row per row of ``docs``."""
    block = (window + 1) // 2
    shards = make_shards(docs)
    size = shards.agg(F.sum(F.element_at("offsets", -1))).first()[0] or 0
    n_buckets = 1 + int(size) // (6 * BUCKET_KEYS)  # a word and its space take about six bytes
    bits = "shard long, bucket int, bits binary"
    met = materialise(ask_probes(shards, block, n_buckets).groupBy("bucket").applyInArrow(_meet_blocks, bits), "met")
    split = split_candidates(shards, met, window, block, n_buckets)
    again = materialise(split.filter(F.col("kind") == KEYS).select("bucket", "shard", "blob", "mask")
                        .groupBy("bucket").applyInArrow(_meet_windows, bits), "met")
    done = split.filter(F.col("kind") == DONE).select(F.explode(F.arrays_zip("ids", "numbers", "hashes")).alias("d")).select(
        F.col("d.ids").alias("doc_id"), F.col("d.numbers").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
        F.col("d.hashes").alias("kept_sha256"), F.array().cast("array<struct<start:long,end:long>>").alias("removed"))
    return done.unionByName(_remove(split.filter(F.col("kind") == TEXTS).select("shard", "ids", "numbers", "blob", "mask"), again, window, n_buckets))
