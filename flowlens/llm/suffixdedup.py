"""Dedup of byte strings with suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts earlier (smaller doc_id, or same document, earlier
start) goes; strings are judged on the input and never cross documents.

1. Anchors.  The least hash among the 36-byte strings of a window picks the same spot in equal windows.  Each shard sorts
   its distinct anchors; the sorted lists of all shards are merged by binary search within a bucket, and an anchor found at
   one place only can not belong to a repeat.  Documents without a repeated anchor are finished here.
2. Segments.  A run of consecutive windows with one repeated anchor, as text, goes to the shard of that anchor, so
   equal windows meet whatever document they are in.  Of equal segments of a document shard only the first travels.
3. Suffix arrays.  Each anchor shard sorts all its suffixes by prefix doubling in the manner of Larsson and Sadakane:
   start from eight bytes, then sort only groups that are not yet single, by the rank ``h`` bytes on.  Kasai's
   rule gives the common prefixes, run in step over all segments at once.  Neighbours that share ``length`` bytes are
   one string; all but its earliest start are removed.
4. An anchor shard of more than ``UNIT_BYTES`` is split by document shard and every pair of splits is one unit, so
   that a passage found in a third of all documents is spread over tasks.

Edge cases: null and empty texts have no bytes; documents without id come first; rows with the same doc_id follow the order of shards;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.arrowtext import Texts, roller, whole_windows
from flowlens.llm.shards import answers, expand, make_shards, rows_of, slices, squeeze, store, texts_in, unpack
from flowlens.runtime import materialise

SHARD_BYTES = 2 << 20  # text in a document shard; every byte of it is a window, so shards are smaller than for words
UNIT_BYTES = 3 << 20  # segment text in a unit, about
ANCHOR = 36
LONGEST = 256  # windows in a segment
BUCKET_BYTES = 64 << 20  # text whose anchors share a bucket
DONE, TEXTS, SEGMENTS = range(3)
SPLIT = "kind int, shard long, bucket int, ids array<long>, numbers array<long>, hashes array<string>, blob binary, mask binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:long,end:long>>"


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over values[i:i + width] for every i, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = pick(values[: len(values) - step], values[step:])
        have += step
    return values


class Anchors:
    """Per window of a shard its anchor value; the distinct anchors, sorted by bucket, and how often each is placed."""

    def __init__(self, texts: Texts, length: int, n_buckets: int):
        n = len(texts.data)
        self.inside = whole_windows(texts.offsets, length)  # per byte: whether a window starts here
        self.value = np.zeros(n, np.uint64)
        if n >= length:
            spots = roller(51).windows(roller(51).letters[texts.data], ANCHOR)
            least = sliding(spots, length - ANCHOR + 1, np.minimum)
            self.value[: len(least)] = np.where(self.inside[: len(least)], least, 0)
            around = np.concatenate([np.zeros(length - ANCHOR, np.uint64), self.value[: len(spots)]])
            chosen = spots[spots == sliding(around, length - ANCHOR + 1, np.maximum)]
        else:
            chosen = np.empty(0, np.uint64)
        whole = self.whole(chosen, n_buckets)
        self.distinct, count = np.unique(whole, return_counts=True)
        self.many = count > 1
        self.lengths = {b: (i, j) for b, i, j in slices((self.distinct >> np.uint64(32)).astype(np.int64), n_buckets)}

    @staticmethod
    def whole(value: np.ndarray, n_buckets: int) -> np.ndarray:
        """Bucket and 32-bit key of an anchor."""
        return ((value >> np.uint64(32)) % np.uint64(n_buckets) << np.uint64(32)) | (value & np.uint64(0xFFFFFFFF))


def ask_anchors(shards: DataFrame, length: int, n_buckets: int) -> DataFrame:
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            a = Anchors(texts_in(row), length, n_buckets)
            out = [(b, row["shard"], a.distinct[i:j].astype(np.uint32).tobytes(), np.packbits(a.many[i:j]).tobytes()) for b, (i, j) in a.lengths.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 4, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                names=["bucket", "shard", "anchors", "many"])

    return shards.mapInArrow(work, "bucket int, shard long, anchors binary, many binary")


def _meet_anchors(asked: pa.Table) -> pa.Table:
    """A bit per anchor: it is placed at least twice in all.  Shards are merged by binary search."""
    lists = [np.frombuffer(k, np.uint32) for k in asked.column("anchors").to_pylist()]
    many = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(k)).astype(bool) for k, m in zip(lists, asked.column("many").to_pylist())]
    merged = np.sort(np.concatenate(lists))
    bits = [np.packbits(m | (np.searchsorted(merged, k, "right") - np.searchsorted(merged, k, "left") > 1)).tobytes() for k, m in zip(lists, many)]
    return pa.table({"shard": asked.column("shard"), "bucket": asked.column("bucket"), "bits": pa.array(bits, pa.binary())})


def _order(ids: list[int | None]) -> np.ndarray:
    return np.array([np.iinfo(np.int64).min if i is None else i for i in ids], np.int64)


def split_segments(shards: DataFrame, flags: DataFrame, length: int, n_buckets: int, n_units: int) -> DataFrame:
    """Finished documents, texts with repeated anchors (``mask``: windows known to be removed), and their segments."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            texts = texts_in(row)
            a = Anchors(texts, length, n_buckets)
            repeated = a.distinct[unpack(row, {b: j - i for b, (i, j) in a.lengths.items()})]
            n, ids, size = len(texts.data), row["ids"], np.diff(texts.offsets)
            new = np.zeros(n, bool)  # a run of windows with one anchor begins
            new[:1] = True
            new[1:] = a.value[1:] != a.value[:-1]
            new[texts.offsets[:-1][size > 0]] = True
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], n)
            windows = np.concatenate([[0], np.cumsum(a.inside)])
            count = windows[end] - windows[begin]  # windows of a run come first
            key = Anchors.whole(a.value[begin], n_buckets)
            hit = (count > 0) & (np.isin(key, repeated) if len(repeated) else False)
            begin, count = begin[hit], count[hit]
            parts = -(-count // LONGEST)
            step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            start = np.repeat(begin, parts) + step * LONGEST
            count = np.minimum(np.repeat(count, parts) - step * LONGEST, LONGEST)
            owner = np.searchsorted(texts.offsets, start, "right") - 1
            some = np.zeros(len(texts), bool)
            some[owner] = True
            done = np.flatnonzero(~some)
            out = [(DONE, row["shard"], 0, [ids[i] for i in done], size[done].tolist(), [hashlib.sha256(texts.of(i)).hexdigest() for i in done], b"", b"")]
            if some.any():
                age = _order(ids)
                text_hash = roller(52).spans(roller(52).letters[texts.data], start, start + count + length - 1)
                order = np.lexsort((start, owner, age[owner], text_hash))
                first = np.ones(len(order), bool)
                first[1:] = np.diff(text_hash[order]) != 0
                known = np.zeros(n + 1, np.int64)  # windows of segments that stand earlier in this shard
                np.add.at(known, start[order[~first]], 1)
                np.add.at(known, start[order[~first]] + count[order[~first]], -1)
                kept_bytes = np.repeat(some, size)
                offsets = np.concatenate([[0], np.cumsum(size[some])])
                out.append((TEXTS, row["shard"], 0, [ids[i] for i in np.flatnonzero(some)], offsets.tolist(), [], squeeze(texts.data[kept_bytes]),
                            squeeze(np.packbits((np.cumsum(known[:-1]) > 0)[kept_bytes]))))
                rank = np.cumsum(some) - 1  # place among the documents that travel on
                unit = (roller(53).spans(a.value, start, start + 1) % np.uint64(n_units)).astype(np.int64)
                go = order[first]
                go = go[np.lexsort((start[go], unit[go]))]
                for u, i, j in slices(unit[go], n_units):
                    own = go[i:j]
                    wide = count[own] + length - 1
                    at = np.repeat(start[own] - np.cumsum(wide) + wide, wide) + np.arange(wide.sum())
                    head = b"".join(x.tobytes() for x in (age[owner[own]], rank[owner[own]].astype(np.uint32), (start[own] - texts.offsets[owner[own]]).astype(np.uint32), count[own].astype(np.uint16)))
                    out.append((SEGMENTS, row["shard"], u, [], [len(own), int(wide.sum())], [], squeeze(texts.data[at]), squeeze(head)))
            types = (pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=[c.split()[0] for c in SPLIT.split(", ")])

    return store(shards.join(answers(flags), "shard", "left").mapInArrow(work, SPLIT), "segments", "kind")


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes of ``data`` in the order of their first bytes, at least ``depth`` of them.

    Also the packed eight bytes at every place, and for every suffix of the order whether those first bytes differ
    from the ones of the suffix before it.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.zeros(n, np.uint64)
    for k in range(8):
        eight = (eight << np.uint64(8)) | padded[k: k + n]
    order = np.argsort(eight)
    head = np.ones(n, bool)
    head[1:] = eight[order[1:]] != eight[order[:-1]]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    h = 8
    while h < depth:
        single = head & np.append(head[1:], True)
        at = np.flatnonzero(~single)  # only groups that are not yet single
        if not len(at):
            break
        own = order[at]
        group, beyond = rank[own], rank[np.minimum(own + h, n)] + 1
        again = np.argsort((group.astype(np.uint64) << np.uint64(32)) | beyond.astype(np.uint64))
        own, group, beyond = own[again], group[again], beyond[again]
        order[at] = own
        fresh = np.ones(len(at), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (beyond[1:] != beyond[:-1])
        head[at] = fresh
        rank[own] = np.maximum.accumulate(np.where(fresh, at, 0))
        h *= 2
    return order, eight, head


def common_prefixes(data: np.ndarray, order: np.ndarray, eight: np.ndarray, head: np.ndarray, begin: np.ndarray, wide: np.ndarray, most: int) -> np.ndarray:
    """Of every place: the bytes shared with the suffix before it in ``order``, up to ``most``.

    Kasai: moving one byte on loses at most one shared byte.  All segments move together, one byte a step.  A
    suffix that is still tied with the one before it shares ``most`` without a look.  Kasai's rule holds behind a
    suffix that is not tied, because its order was decided within the sorted bytes; behind a tied one counting starts anew.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([data, np.zeros(most + 8, np.uint8)])
    shared = np.zeros(n, np.int64)
    tied = np.empty(n, bool)
    tied[order] = ~head
    by_width = np.argsort(-wide, kind="stable")
    begin, wide = begin[by_width], wide[by_width]
    now = np.zeros(len(begin), np.int64)  # shared by the place before, none if that one was tied
    for step in range(int(wide[0]) if len(wide) else 0):
        lanes = int(np.searchsorted(-wide, -step, "left"))  # segments longer than step
        i = begin[:lanes] + step
        j = before[i]
        alike = tied[i]
        h = np.where(alike, most, np.where(j >= 0, np.maximum(now[:lanes] - 1, 0), 0))
        for jump, words in ((8, eight), (1, data)):
            go = np.flatnonzero((j >= 0) & (h < most))
            while len(go):
                x, y = i[go] + h[go], j[go] + h[go]
                ok = (x + jump <= n) & (y + jump <= n)
                ok[ok] = words[x[ok]] == words[y[ok]]
                go = go[ok]
                h[go] += jump
                go = go[h[go] < most]
        shared[i] = h
        now[:lanes] = np.where(alike, 0, h)
    return shared


def later_windows(data: np.ndarray, begin: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
    """Which windows (``count`` from each segment's begin; segments in order of age) also start earlier."""
    order, eight, head = suffix_array(data, length)
    shared = common_prefixes(data, order, eight, head, begin, count + length - 1, length)
    group = np.cumsum(shared[order] < length)  # suffixes that share ``length`` bytes stand together
    start = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
    group_at = np.empty(len(data), np.int64)
    group_at[order] = group
    _, first = np.unique(group_at[start], return_index=True)
    later = np.ones(len(start), bool)
    later[first] = False
    return later


def resolve(length: int):
    def work(unit: pa.Table) -> pa.Table:
        rows = unit.to_pylist()
        heads, shard_of, text, text_of = [], [], [], 0
        for k, row in enumerate(rows):
            n = row["numbers"][0]
            raw = expand(row["mask"]).tobytes()
            age, rank, start, count = (np.frombuffer(raw[a * n: b * n], t) for a, b, t in ((0, 8, np.int64), (8, 12, np.uint32), (12, 16, np.uint32), (16, 18, np.uint16)))
            wide = count.astype(np.int64) + length - 1
            heads.append((age, rank, start, count.astype(np.int64), np.cumsum(wide) - wide + text_of))
            shard_of.append(np.full(n, k))
            text.append(expand(row["blob"]))
            text_of += len(text[-1])
        age, rank, start, count, at = (np.concatenate(x) for x in zip(*heads))
        shard_of = np.concatenate(shard_of)
        shards = np.array([row["shard"] for row in rows])
        order = np.lexsort((start, rank, shards[shard_of], age))
        age, rank, start, count, at, shard_of = (x[order] for x in (age, rank, start, count, at, shard_of))
        wide = count + length - 1
        begin = np.cumsum(wide) - wide
        data = np.concatenate(text)[np.repeat(at - begin, wide) + np.arange(wide.sum())]
        later = later_windows(data, begin, count, length)
        edge = np.cumsum(count) - count
        rise = later.copy()
        rise[1:] &= ~later[:-1]
        rise[edge] = later[edge]
        fall = later.copy()
        fall[:-1] &= ~later[1:]
        fall[edge + count - 1] = later[edge + count - 1]
        a, b = np.flatnonzero(rise), np.flatnonzero(fall) + 1
        seg = np.searchsorted(edge, a, "right") - 1
        found = []
        for k in np.unique(shard_of[seg]):
            own = shard_of[seg] == k
            s = seg[own]
            found.append((int(shards[k]), squeeze(b"".join(x.astype(np.uint32).tobytes() for x in (rank[s], start[s] + a[own] - edge[s], b[own] - a[own])))))
        return pa.table([pa.array(x, t) for x, t in zip(zip(*found) if found else [[]] * 2, (pa.int64(), pa.binary()))], names=["shard", "bits"])

    return work


def _remove(texts: DataFrame, found: DataFrame, length: int) -> DataFrame:
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            text = Texts(expand(row["blob"]), np.array(row["numbers"], np.int64))
            n = len(text.data)
            change = np.zeros(n + 1, np.int64)
            for answer in row["answers"] or []:
                rank, start, count = np.frombuffer(expand(answer["bits"]), np.uint32).astype(np.int64).reshape(3, -1)
                np.add.at(change, text.offsets[rank] + start, 1)
                np.add.at(change, text.offsets[rank] + start + count, -1)
            again = np.flatnonzero((np.cumsum(change[:-1]) > 0) | np.unpackbits(expand(row["mask"]), count=n).astype(bool))
            change = np.zeros(n + 1, np.int64)
            change[again] += 1
            change[again + length] -= 1
            gone = np.cumsum(change[:-1]) > 0
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            first[text.offsets[:-1]] = gone[text.offsets[:-1]]  # texts that travel on are not empty
            last = gone.copy()
            last[:-1] &= ~gone[1:]
            last[text.offsets[1:] - 1] = gone[text.offsets[1:] - 1]
            a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
            owner = np.searchsorted(text.offsets, a, "right") - 1
            removed: list[list[dict]] = [[] for _ in range(len(text))]
            for o, x, y in zip(owner.tolist(), (a - text.offsets[owner]).tolist(), (b - text.offsets[owner]).tolist()):
                removed[o].append({"start": x, "end": y})
            kept, size = text.data[~gone].tobytes(), np.concatenate([[0], np.cumsum(~gone)])[text.offsets]
            before = np.concatenate([[0], np.cumsum(gone)])[text.offsets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(np.diff(text.offsets)), pa.array(np.diff(before)), pa.array([len(x) for x in removed], pa.int64()),
                 pa.array([hashlib.sha256(kept[x:y]).hexdigest() for x, y in zip(size.tolist(), size[1:].tolist())], pa.string()),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    return texts.join(answers(found.withColumn("bucket", F.lit(0))), "shard", "left").mapInArrow(work, RESULT)


def remove_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``removed``, the byte ranges that go: a row per row of ``docs``."""
    if length <= ANCHOR:
        raise ValueError(f"length must be above {ANCHOR}")
    shards = make_shards(docs, SHARD_BYTES)
    size = int(shards.agg(F.sum(F.element_at("offsets", -1))).first()[0] or 0)
    n_buckets, n_units = 1 + size // BUCKET_BYTES, 1 + size // UNIT_BYTES
    met = materialise(ask_anchors(shards, length, n_buckets).groupBy("bucket").applyInArrow(_meet_anchors, "shard long, bucket int, bits binary"), "met")
    split = split_segments(shards, met, length, n_buckets, n_units)
    segments = split.filter(F.col("kind") == SEGMENTS).select("bucket", "shard", "numbers", "blob", "mask")
    splits = materialise(segments.groupBy("bucket").agg(F.ceil(F.sum(F.element_at("numbers", 2)) / (2 * UNIT_BYTES)).cast("int").alias("splits")), "splits")
    placed = segments.join(splits, "bucket").withColumn("split", F.pmod(F.xxhash64("shard"), "splits").cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("splits") - 1))).withColumns({"low": F.least("split", "other"), "high": F.greatest("split", "other")})
    found = materialise(placed.select("bucket", "low", "high", "shard", "numbers", "blob", "mask").groupBy("bucket", "low", "high")
                        .applyInArrow(resolve(length), "shard long, bits binary"), "found")
    done = split.filter(F.col("kind") == DONE).select(F.explode(F.arrays_zip("ids", "numbers", "hashes")).alias("d")).select(
        F.col("d.ids").alias("doc_id"), F.col("d.numbers").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.col("d.hashes").alias("kept_sha256"), F.array().cast("array<struct<start:long,end:long>>").alias("removed"))
    return done.unionByName(_remove(split.filter(F.col("kind") == TEXTS).select("shard", "ids", "numbers", "blob", "mask"), found, length))
