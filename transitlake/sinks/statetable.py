"""A table of newest rows, kept as one base folder and the delta folders after it.

Every change is a delta with a name that sorts behind those before, such as the number of a micro-batch; a change that is
repeated after a failure is left out where it is complete, and written again where it is not. When ``MERGE_EVERY`` deltas have come
together they are merged with the base into the next one, and what went into that is dropped one merge later, so that
readers that have just begun find their files. A folder counts once its write is complete.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from transitlake.session import hadoop

MERGE_EVERY = 10
_BASE, _DELTA = "base-", "delta-"


def batch_name(batch_id: int) -> str:
    """Name of a micro-batch that sorts like its number."""
    return f"{batch_id:020d}"


def _folders(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Names of complete bases and deltas, in order. Only names are listed, of which there are few."""
    files, at = hadoop(spark, path)
    if not files.exists(at(path)):
        return [], []
    names = [status.getPath().getName() for status in files.listStatus(at(path)) if status.isDirectory()]
    whole = sorted(name for name in names if files.exists(at(f"{path}/{name}/_SUCCESS")))
    return [n for n in whole if n.startswith(_BASE)], [n for n in whole if n.startswith(_DELTA)]


def live_folders(spark: SparkSession, path: str) -> list[str]:
    """The newest base and the deltas behind it: what the table consists of."""
    bases, deltas = _folders(spark, path)
    base = bases[-1:]
    return base + [d for d in deltas if not base or d.removeprefix(_DELTA) > base[0].removeprefix(_BASE)]


def holds(spark: SparkSession, path: str, name: str) -> bool:
    """Whether the change ``name``, or one behind it, is in the table."""
    live = live_folders(spark, path.rstrip("/"))
    return bool(live) and name <= live[-1].split("-", 1)[1]


def newest_rows(rows: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Of each key the row of the newest change (column ``_change``)."""
    keys = list(keys)
    rest = [name for name in rows.columns if name not in (*keys, "_change")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct("_change", *rest), "_change").alias("row"))
    return newest.select(*keys, "row.*").select(*rows.columns)


def _rows(spark: SparkSession, path: str, folders: list[str], schema: str) -> DataFrame:
    declared = spark.createDataFrame([], f"{schema}, _change STRING")
    if not folders:
        return declared
    return spark.read.schema(declared.schema).parquet(*[f"{path}/{name}" for name in folders])


def read_state(spark: SparkSession, path: str, keys: Iterable[str], schema: str) -> DataFrame:
    """The newest row of each key. ``schema`` declares the columns, so that an empty table can be read as well."""
    return newest_rows(_rows(spark, path, live_folders(spark, path), schema), keys).drop("_change")


def write_change(rows: DataFrame, path: str, name: str, keys: Iterable[str], schema: str, merge_every: int = MERGE_EVERY) -> None:
    """Store ``rows``, one for each key they change, as the change ``name``; merge when it is time. ``rows`` may depend on
    what the table held before."""
    spark, path = rows.sparkSession, path.rstrip("/")
    if holds(spark, path, name):
        return
    rows.withColumn("_change", F.lit(name)).write.mode("overwrite").parquet(f"{path}/{_DELTA}{name}")
    live = live_folders(spark, path)
    if sum(folder.startswith(_DELTA) for folder in live) >= merge_every:
        _merge(spark, path, live, list(keys), schema)


def _merge(spark: SparkSession, path: str, live: list[str], keys: list[str], schema: str) -> None:
    before = [folder for group in _folders(spark, path) for folder in group if folder not in live]
    newest_rows(_rows(spark, path, live, schema), keys).write.mode("overwrite").parquet(
        f"{path}/{_BASE}{live[-1].removeprefix(_DELTA)}"
    )
    files, at = hadoop(spark, path)
    for folder in before:
        files.delete(at(f"{path}/{folder}"), True)
