"""Session construction and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "quire", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that every plan in this package assumes.

    Only the time zone and adaptive execution matter for results; sizes such as the number of
    shuffle partitions belong to the cluster and are left to it unless given in ``conf``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in {**settings, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a folder of its own only where that is
    unset and everything runs on this machine."""
    sc = spark.sparkContext
    have = sc._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="quire-")
    sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_scratch: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for a table that is written once and read more than once."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _scratch.add(path)
    return path


def hub(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read from there: for tables that several steps read."""
    path = scratch_path(df.sparkSession, "hub")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table written under :func:`scratch_path` that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    _scratch.discard(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what is written under :func:`scratch_path` within, once all results that read it have been stored."""
    before = set(_scratch)
    try:
        yield
    finally:
        for path in _scratch - before:
            drop_path(spark, path)
