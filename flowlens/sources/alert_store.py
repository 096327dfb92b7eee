"""A table of alerts that can be appended to, updated, followed and compacted while others read it.

Alerts lie in Parquet folders, one per day and write, that never change once written.  A version of the table is a small
document naming the folders that count; a write puts its folders down first and then adds the next version with
one rename, so a reader sees all of a write or nothing of it, and each alert once, also while days are rewritten.  The document has
one entry per live folder: with closed days compacted, one per day.

Every alert keeps the number of the version it arrived with (``arrival``).  Versions rise, and an entry knows the least and
greatest arrival in its folder, so "what came after the last alert I saw" opens only folders that can hold something new,
after any restart and after rewrites.

Writes are named: appends by ``batch``, updates by ``sequence``.  A write that was done before changes nothing.  Writers that
meet at the same version are refused and may try again (``Conflict``); on a store whose rename replaces files without notice
there should be one writer.  A row without a time lies in the day ``none``.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.operators.alerts import _last_per_alert, check_updates
from flowlens.runtime import materialise
from flowlens.schema import UPDATE_STATUSES, alert_schema

NO_DAY = "none"
LEDGER = 10_000  # names of past appends that are remembered


class Conflict(RuntimeError):
    """Another writer added the same version first."""


@dataclass(frozen=True)
class Entry:
    """A live folder: its day, and the least and greatest arrival in it."""

    day: str
    folder: str
    first: int
    last: int


@dataclass(frozen=True)
class Version:
    number: int
    entries: tuple[Entry, ...] = ()
    batches: tuple[str, ...] = ()
    sequence: int = -1


class AlertStore:
    def __init__(self, spark: SparkSession, path: str, zone_free: bool = False):
        """``zone_free`` stores times without a zone, as the test tables have them."""
        self.spark, self.path = spark, path.rstrip("/")
        time = T.TimestampNTZType() if zone_free else T.TimestampType()
        fields = [T.StructField(f.name, time if isinstance(f.dataType, T.TimestampType) else f.dataType) for f in alert_schema().fields]
        self.schema = T.StructType([*fields, T.StructField("arrival", T.LongType()), T.StructField("day", T.StringType())])

    # ---- versions ---------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _names(self, folder: str) -> list[str]:
        fs, at = self._fs(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def version(self) -> Version:
        """The newest version; number 0 is the empty table."""
        names = [n for n in self._names("versions") if n.endswith(".json")]
        if not names:
            return Version(0)
        fs, at = self._fs(f"{self.path}/versions/{names[-1]}")
        stream = fs.open(at)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        d = json.loads(text)
        return Version(d["number"], tuple(Entry(*e) for e in d["entries"]), tuple(d["batches"]), d["sequence"])

    def _commit(self, v: Version) -> Version:
        """Add version ``v``; the rename is what makes the write visible."""
        text = json.dumps({"number": v.number, "entries": [[e.day, e.folder, e.first, e.last] for e in v.entries],
                           "batches": list(v.batches[-LEDGER:]), "sequence": v.sequence})
        fs, draft = self._fs(f"{self.path}/versions/draft-{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        _, final = self._fs(f"{self.path}/versions/{v.number:020d}.json")
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise Conflict(f"version {v.number} of {self.path} exists already")
        return v

    def _write(self, rows: DataFrame, kind: str) -> list[tuple[str, str]]:
        """Put rows down below a new folder and return (day, folder) of what was written."""
        folder = f"{kind}-{uuid.uuid4().hex}"
        rows.write.partitionBy("day").parquet(f"{self.path}/data/{folder}")
        return [(n.split("=", 1)[1], f"data/{folder}/{n}") for n in self._names(f"data/{folder}") if n.startswith("day=")]

    # ---- reading -------------------------------------------------------------

    def _open(self, entries: list[Entry]) -> DataFrame:
        if not entries:
            return self.spark.createDataFrame([], self.schema)
        stored = T.StructType(self.schema.fields[:-1])
        parts: dict[str, list[str]] = {}
        for e in entries:
            parts.setdefault(e.day, []).append(f"{self.path}/{e.folder}")
        # the day is in the folder's name; base paths differ, so it is read from the file's own
        files = self.spark.read.schema(stored).parquet(*[f for group in parts.values() for f in group])
        return files.withColumn("day", F.regexp_extract(F.col("_metadata.file_path"), "/day=([^/]*)/", 1))

    def read(self, days: tuple[str, str] | None = None) -> DataFrame:
        """All alerts, or those of the days from the first to the last of ``days``."""
        return self._open([e for e in self.version().entries if days is None or days[0] <= e.day <= days[1]])

    def since(self, arrival: int = 0, last_id: str | None = None, limit: int | None = None) -> DataFrame:
        """Alerts behind the last one seen, in order of (arrival, id); only folders that can hold them are opened.

        (arrival, id) of the last row is where the next call goes on.  An alert that is updated keeps its place.
        """
        rows = self._open([e for e in self.version().entries if e.last >= arrival])
        behind = F.col("arrival") > arrival
        if last_id is not None:
            behind = behind | ((F.col("arrival") == arrival) & (F.col("id") > last_id))
        found = rows.filter(behind).orderBy("arrival", "id")
        return found.limit(limit) if limit is not None else found

    # ---- writing ----------------------------------------------------------------

    def append(self, alerts: DataFrame, batch: str, known_days: int | None = None) -> Version:
        """Add alerts in alert layout; the same ``batch`` again changes nothing.

        With ``known_days``, alerts whose id is stored already in one of the newest so many days, or repeated in the batch,
        are left out: a message delivered again hours later adds nothing, and no state has to be held for it.
        """
        now = self.version()
        if batch in now.batches:
            return now
        number = now.number + 1
        day = F.coalesce(F.date_format("timestamp", "yyyy-MM-dd"), F.lit(NO_DAY))
        rows = alerts.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields[:-2]]).withColumns(
            {"arrival": F.lit(number).cast("long"), "day": day})
        if known_days is not None:
            days = sorted({e.day for e in now.entries})[-known_days:] if known_days else []
            stored = self._open([e for e in now.entries if e.day in days]).select("id")
            first = rows.groupBy("id").agg(F.min(F.struct(*[c for c in rows.columns if c != "id"])).alias("r"))
            rows = first.select("id", "r.*").join(stored, "id", "left_anti").select(*[f.name for f in self.schema.fields])
        written = [Entry(d, f, number, number) for d, f in self._write(rows, "append")]
        return self._commit(Version(number, (*now.entries, *written), (*now.batches, batch), now.sequence))

    def update(self, updates: DataFrame, sequence: int, allowed: list[str] = UPDATE_STATUSES) -> Version:
        """Set status and resolver of alerts (id, status, resolved_by, resolved_at); rewrites the days of these alerts only.

        Update batches are numbered from 0 and applied in order.  A number up to the last one is a replay and changes
        nothing.  Bad updates and those of unknown alerts have no effect (``check_updates`` tells the bad ones).
        """
        now = self.version()
        if sequence <= now.sequence:
            return now
        last = materialise(_last_per_alert(check_updates(updates, allowed).accepted), "last-updates")
        # only ids are read to find the days; as many rows come back as there are days
        days = {r[0] for r in self._open(list(now.entries)).join(last.select("id"), "id", "left_semi").select("day").distinct().collect()}
        touched = [e for e in now.entries if e.day in days]
        kept = [e for e in now.entries if e.day not in days]
        written = []
        if touched:
            u = F.col("u")
            changed = self._open(touched).join(last, "id", "left").withColumns({
                c: F.when(u.isNotNull(), F.col(f"u.{c}").cast(self.schema[c].dataType)).otherwise(F.col(c))
                for c in ("status", "resolved_by", "resolved_at")})
            written = self._rewrite(changed.select(*self.schema.fieldNames()), touched, "update")
        return self._commit(Version(now.number + 1, (*kept, *written), now.batches, sequence))

    def _rewrite(self, rows: DataFrame, replaced: list[Entry], kind: str) -> list[Entry]:
        """Entries of ``rows`` that stand for all rows of the days of ``replaced``."""
        first, last = {}, {}
        for e in replaced:
            first[e.day] = min(e.first, first.get(e.day, e.first))
            last[e.day] = max(e.last, last.get(e.day, e.last))
        return [Entry(d, f, first[d], last[d]) for d, f in self._write(rows, kind)]

    def _bytes(self, folder: str) -> int:
        fs, at = self._fs(f"{self.path}/{folder}")
        return fs.getContentSummary(at).getLength()

    def _files(self, folder: str) -> int:
        return sum(n.endswith(".parquet") for n in self._names(folder))

    def compact(self, before: str, file_bytes: int = 128 << 20) -> Version:
        """Rewrite days before ``before`` that have several folders or small files into one folder of files of about
        ``file_bytes`` each, sorted by arrival and id.  Readers go on seeing the same alerts throughout."""
        now = self.version()
        by_day: dict[str, list[Entry]] = {}
        for e in now.entries:
            if e.day < before:  # "none" lies behind every date
                by_day.setdefault(e.day, []).append(e)
        size = {d: sum(self._bytes(e.folder) for e in es) for d, es in by_day.items()}
        files = {d: max(1, -(-size[d] // file_bytes)) for d in by_day}
        loose = {d for d, es in by_day.items() if len(es) > 1 or sum(self._files(e.folder) for e in es) > files[d]}
        if not loose:
            return now
        replaced = [e for e in now.entries if e.day in loose]
        # every file is one bin of its day; ids spread the rows of a day evenly over its bins
        wanted = F.create_map(*[x for d in sorted(loose) for x in (F.lit(d), F.lit(files[d]))])
        bin_ = F.pmod(F.xxhash64("id"), wanted[F.col("day")]).cast("int")
        total = sum(files[d] for d in loose)
        rows = (self._open(replaced).withColumn("_bin", bin_).repartition(total, "day", "_bin")
                .sortWithinPartitions("day", "_bin", "arrival", "id").drop("_bin"))
        written = self._rewrite(rows, replaced, "compact")
        kept = [e for e in now.entries if e.day not in loose]
        return self._commit(Version(now.number + 1, (*kept, *written), now.batches, now.sequence))

    def expire(self) -> int:
        """Delete data folders that the newest version does not name; readers of older versions are cut off."""
        live = {e.folder for e in self.version().entries}
        gone = 0
        for top in self._names("data"):
            for day in self._names(f"data/{top}"):
                if day.startswith("day=") and f"data/{top}/{day}" not in live:
                    fs, at = self._fs(f"{self.path}/data/{top}/{day}")
                    gone += bool(fs.delete(at, True))
        return gone


def pending_by_day(alerts: DataFrame) -> DataFrame:
    """Alerts and pending alerts per day."""
    pending: Column = F.count_if(F.col("status") == "pending")
    return alerts.groupBy("day").agg(F.count("*").alias("n"), pending.alias("pending"))
