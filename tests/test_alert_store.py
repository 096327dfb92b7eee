"""The alert store: replays, untouched days, cursors, compaction, conflicts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowlens.operators import alerts as ops
from flowlens.sources.alert_store import AlertStore, Conflict, Version

DAY = dt.datetime(2024, 1, 1)


def incoming(spark, *rows):
    """(id, day number or None) as alerts."""
    df = spark.createDataFrame([(i, None if d is None else DAY + dt.timedelta(days=d, hours=1)) for i, d in rows],
                               "id string, timestamp timestamp")
    return ops.normalise_alerts(df, F.lit(None).cast("timestamp"))


def said(spark, *rows):
    return spark.createDataFrame([(i, s, "ann", DAY + dt.timedelta(days=9, minutes=m)) for i, s, m in rows],
                                 "id string, status string, resolved_by string, resolved_at timestamp")


@pytest.fixture
def store(spark, tmp_path):
    s = AlertStore(spark, str(tmp_path / "store"))
    s.append(incoming(spark, ("a", 0), ("b", 0), ("c", 1)), "one")
    s.append(incoming(spark, ("d", 1), ("e", 2), ("f", None)), "two")
    return s


def ids(df):
    return sorted(r.id for r in df.collect())


def folders(store):
    return {e.day: {x.folder for x in store.version().entries if x.day == e.day} for e in store.version().entries}


def test_empty_store(spark, tmp_path):
    s = AlertStore(spark, str(tmp_path / "none"))
    assert s.version() == Version(0) and s.read().collect() == [] and s.since().collect() == []
    assert s.update(said(spark, ("a", "handled", 0)), 0).number == 1 and s.compact("9999").number == 1


def test_append_is_replay_safe(spark, store):
    before = store.version()
    assert store.append(incoming(spark, ("z", 0)), "two") == before
    assert ids(store.read()) == list("abcdef") and {r.day for r in store.read().collect()} == {"2024-01-01", "2024-01-02", "2024-01-03", "none"}
    assert ids(store.read(days=("2024-01-02", "2024-01-02"))) == ["c", "d"]


def test_updates_rewrite_their_days_only(spark, store):
    old = folders(store)
    store.update(said(spark, ("c", "handled", 1), ("c", "pending", 0), ("x", "handled", 0), ("a", "closed", 0)), 0)
    new = folders(store)
    assert {d for d in old if old[d] != new[d]} == {"2024-01-02"} and len(new["2024-01-02"]) == 1
    got = {r.id: (r.status, r.resolved_by) for r in store.read().collect()}
    assert got["c"] == ("handled", "ann") and got["a"] == ("pending", None) and len(got) == 6
    version = store.version()
    assert store.update(said(spark, ("a", "handled", 0)), 0) == version  # a replay
    store.update(said(spark, ("a", "handled", 0)), 1)
    assert store.read().filter("status = 'handled'").count() == 2


def test_cursor_opens_newer_folders_only(spark, store):
    assert [r.id for r in store.since().collect()] == ["a", "b", "c", "d", "e", "f"]
    assert [r.id for r in store.since(1, "b", limit=2).collect()] == ["c", "d"]
    store.append(incoming(spark, ("0", 0)), "three")
    again = AlertStore(spark, store.path)  # after a restart
    newer = again.since(2, "f")
    assert [(r.id, r.arrival) for r in newer.collect()] == [("0", 3)]
    arrived_before = {e.folder for e in again.version().entries if e.last < 2}
    assert arrived_before and not any(folder in f for f in newer.inputFiles() for folder in arrived_before)
    store.update(said(spark, ("0", "handled", 0)), 0)  # rewrites the day with a, b and 0
    assert [r.id for r in store.since(2, "f").collect()] == ["0"]


def test_compaction_keeps_every_reader_right(spark, store):
    before = store.read()
    store.append(incoming(spark, *((f"n{i}", 0) for i in range(50))), "three")
    during, entries = store.read(), len(store.version().entries)
    store.compact("2024-01-03")
    after = store.read()
    assert len(store.version().entries) < entries and len(folders(store)["2024-01-01"]) == 1
    assert ids(before) == list("abcdef") and ids(during) == ids(after) and len(ids(after)) == 56
    assert store.compact("2024-01-03") == store.version()  # nothing left to do
    tops = {f.rsplit("/", 1)[0] for f in after.inputFiles()}
    assert store.expire() > 0 and {f.rsplit("/", 1)[0] for f in after.inputFiles()} == tops and len(ids(store.read())) == 56


def test_compaction_fills_files(spark, store):
    store.append(incoming(spark, *((f"n{i}", 0) for i in range(3000))), "three")
    store.compact("2024-01-03", file_bytes=20_000)
    (folder,) = folders(store)["2024-01-01"]
    assert 1 < store._files(folder) < 20 and store.read().filter("day = '2024-01-01'").count() == 3002


def test_writers_that_meet(spark, store, monkeypatch):
    stale = store.version()
    store.append(incoming(spark, ("g", 3)), "three")
    monkeypatch.setattr(store, "version", lambda: stale)
    with pytest.raises(Conflict):
        store.append(incoming(spark, ("h", 3)), "four")
    monkeypatch.undo()
    assert ids(store.read()) == list("abcdefg")


def test_late_redelivery(spark, store):
    store.append(incoming(spark, ("a", 5), ("g", 5), ("g", 6)), "late", known_days=30)
    assert ids(store.read()) == list("abcdefg")
    store.append(incoming(spark, ("a", 5)), "later", known_days=1)  # a lies in an older day than that
    assert ids(store.read()).count("a") == 2
