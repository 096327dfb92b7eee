"""Shards: a few MB of whole texts as one row of a written table, and packed exchanges between them.

Work on substrings needs the same texts several times.  Texts are packed once into shards (zstd, about ``SHARD_BYTES`` of
text each; a longer text is a shard of its own) and written, so that every later pass sees the same shards, after
lost executors too.  Questions about all shards ("does this key occur elsewhere?") travel as sorted arrays of keys, one
row per shard and bucket; answers come back as one bit per key.  Keys are distinct within a shard, so a key that stands
everywhere costs one entry per shard.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.arrowtext import Texts, parts_of
from flowlens.runtime import materialise, scratch_path

SHARD_BYTES = 4 << 20
SHARD = "shard long, ids array<long>, offsets array<long>, blob binary"


def squeeze(data: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data.tobytes() if isinstance(data, np.ndarray) else data)


def expand(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)


def make_shards(docs: DataFrame, size: int | None = None) -> DataFrame:
    """The written shards of (doc_id, text), with about ``size`` bytes of text each."""
    size = size or SHARD_BYTES

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId()) << 32
        for batch in batches:
            for part, texts in parts_of(batch, 1, size):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                     pa.array([texts.offsets], pa.list_(pa.int64())), pa.array([squeeze(texts.data)], pa.binary())],
                    names=["shard", "ids", "offsets", "blob"])
                number += 1

    return materialise(docs.select("doc_id", "text").mapInArrow(work, SHARD), "shards")


def texts_in(row: dict) -> Texts:
    return Texts(expand(row["blob"]), np.array(row["offsets"], np.int64))


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time, so that one shard is unpacked at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def slices(bucket: np.ndarray, n: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, begin, end) of the non-empty runs of a sorted bucket column."""
    cuts = np.searchsorted(bucket, np.arange(n + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        yield b, int(cuts[b]), int(cuts[b + 1])


def answers(flags: DataFrame) -> DataFrame:
    """Rows (shard, bucket, bits) as one row per shard."""
    return flags.groupBy("shard").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers"))


def unpack(row: dict, lengths: dict[int, int], per_key: int = 1) -> np.ndarray:
    """The answers of a shard in bucket order: ``per_key`` bits for each key, whose counts per bucket are given."""
    found = {a["bucket"]: a["bits"] for a in row["answers"] or []}
    parts = [np.unpackbits(np.frombuffer(found[b], np.uint8), count=n * per_key) for b, n in lengths.items()]
    return np.concatenate(parts).astype(bool) if parts else np.empty(0, bool)


def store(df: DataFrame, name: str, by: str) -> DataFrame:
    """Write ``df`` with a folder per value of ``by`` and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
