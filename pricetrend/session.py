"""Session construction and the tables written to the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "pricetrend", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library relies on.

    UTC session time zone (bar boundaries are UTC), ANSI mode left on (all
    divisions go through ``try_divide``), AQE with partition coalescing and
    skew-join handling, UI off.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = os.environ.get("PRICETREND_DRIVER_MEMORY", "8g")
        conf["spark.driver.host"] = "127.0.0.1"
        conf["spark.driver.bindAddress"] = "127.0.0.1"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read
    here. When it is unset (local tests) a private scratch folder is created
    and registered.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="pricetrend-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


# Tables written and not yet released, oldest first.
_WRITTEN: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder, deleted by ``release_tables`` like a table."""
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _WRITTEN.append(path)
    return path


def cut_lineage(df: DataFrame, name: str = "table", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and read it back.

    One job computes the input once; every later branch reads the columns it
    needs from durable storage, so a lost executor costs a re-read, not a
    recomputation of the upstream plan. ``partition_by`` lays the table out by
    a column, so that a filter on it reads only its own files. The table stays
    until ``release_tables`` (or the end of a ``scratch_tables`` block), because
    results are lazy and may read it at any later time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    if partition_by:
        # Column types and order as they were: partition values are read back as text.
        back = spark.read.schema(df.schema).parquet(path)
        return back.select(*df.columns)
    return spark.read.parquet(path)


def last_written() -> str:
    """The path of the table written last."""
    return _WRITTEN[-1]


def is_written(path: str) -> bool:
    """Whether a table of this path was written and not yet released."""
    return path in _WRITTEN


def release_tables(spark: SparkSession, since: int = 0) -> int:
    """Delete the tables that ``cut_lineage`` wrote (after the first ``since``); call it
    when the results that read them have been consumed. Returns their number."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths, _WRITTEN[since:] = _WRITTEN[since:], []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


def release_table(spark: SparkSession, path: str) -> None:
    """Delete one written table whose readers are done (a step of a loop, say)."""
    if path in _WRITTEN:
        _WRITTEN.remove(path)
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Tables written inside the block are deleted at its end; consume results within it."""
    since = len(_WRITTEN)
    try:
        yield
    finally:
        release_tables(spark, since)
