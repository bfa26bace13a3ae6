"""Session helpers: a UTC session for local use, shared working folders, scoped settings."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Rows a side may have to be broadcast.
BROADCAST_ROWS = 200_000


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session set up like a cluster job: UTC, AQE on, colons allowed in file names."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("transitlake")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Recording the call site of every column expression makes long plans slow to build.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Snapshot names hold colons, which the checksum layer of the local file system rejects.
        .config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables.

    It lies in the shared folder that the cluster names in ``spark.checkpoint.dir``. A temporary
    folder is made only where that is unset and driver and executors are one process, as in tests; a
    cluster without the setting is an error, as its machines would not see each other's files.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.mkdtemp(prefix=f"transitlake-{name}-")


def hadoop(spark: SparkSession, path: str) -> tuple:
    """The file system that holds ``path``, and the function that makes one of its paths from text."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def keyed_state(spark: SparkSession) -> dict[str, str]:
    """Settings under which a stream with keyed state and timers has to be started: the state store that it needs.

    That store copies files by way of the checksum layer of the local file system, which ``local_session`` turns off.
    """
    conf = {"spark__sql__streaming__stateStore__providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
    if "RawLocal" in (spark.sparkContext._jsc.hadoopConfiguration().get("fs.file.impl") or ""):
        conf |= {"fs__file__impl": "org.apache.hadoop.fs.LocalFileSystem", "fs__file__impl__disable__cache": "true"}
    return conf


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Set SQL options for the jobs started inside the block, then put the old values back.

    Keys are written with ``__`` for the dots.
    """
    conf = {key.replace("__", "."): value for key, value in conf.items()}
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` may be broadcast. The check reads no more than ``max_rows + 1`` rows."""
    return df.limit(max_rows + 1).count() <= max_rows
