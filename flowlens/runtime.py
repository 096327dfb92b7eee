"""Session helpers and the shared scratch space that operators write to.

Operators that need an intermediate result twice, or that must cut a growing
lineage, write it as a Parquet table below the folder named by
``spark.checkpoint.dir`` and read it back.  A written table survives the loss
of executors, and its file size is what Catalyst uses to decide whether it may
be broadcast: a table under ``spark.sql.autoBroadcastJoinThreshold`` is
broadcast, a larger one is joined by shuffle.  That is why no operator here
forces a broadcast of learned or user-supplied tables.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}
_scope: ContextVar[str] = ContextVar("scratch_scope", default="")


def get_spark(app_name: str = "flowlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and times in UTC."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    ``spark.checkpoint.dir`` decides.  Only a local session may go without it,
    because there the driver and all tasks see the same disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="flowlens-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_home(spark)}{_scope.get()}/{name}-{uuid.uuid4().hex}"


def scratch_home(spark: SparkSession) -> str:
    """Where all intermediate tables of this application lie."""
    app = spark.conf.get("spark.app.id", "")
    return f"{scratch_dir(spark)}/flowlens" + (f"/{app}" if app else "")


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder and all below it, if it is there."""
    fs, at = _at(spark, path)
    fs.delete(at, True)


def path_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, in order; none if it is not there."""
    fs, at = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def release_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; results that still read them are lost."""
    delete_path(spark, scratch_home(spark))


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end, for work that repeats in a long-running application.

    Results must be written to a place of their own before the scope ends.  Scopes may be nested and are kept per thread.
    """
    token = _scope.set(f"{_scope.get()}/scope-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        path = f"{scratch_home(spark)}{_scope.get()}"
        _scope.reset(token)
        delete_path(spark, path)


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once to the scratch folder, with ``options`` of the Parquet writer, and return the table read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scalar_value(df: DataFrame):
    """The value of a one-row, one-column frame (NULL if there is no row)."""
    row = df.first()
    return None if row is None else row[0]
