"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import AbstractContextManager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from transitlake.operators.batches import pieces
from transitlake.session import settings, work_folder

# White space of the word rules: space, tab to carriage return.
WHITE = "\\x20\\x09-\\x0D"
# Rows of whole texts that a Python task turns into objects at a time, and those of an Arrow batch in jobs that are started here.
PIECE_ROWS = 256
BATCH_ROWS = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hold(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: later steps neither repeat its work nor
    depend on the executors that did it."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """Arrow batches of at most ``BATCH_ROWS`` rows in the jobs started inside: both JVM and Python worker hold a batch as a whole."""
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    return settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS))


def text_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``PIECE_ROWS`` rows. A worker stays as large as its largest batch made it, for all later stages."""
    return pieces(batches, PIECE_ROWS)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns named like one of ``names``, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def extended(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns`` at its end; columns of such names are replaced, whatever their case."""
    taken = {n.lower() for n in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[c.alias(n) for n, c in columns.items()])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once although ``body`` may use it inside lambdas."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def by_batch(
    make: Callable[[pa.RecordBatch], pa.RecordBatch],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that turns each piece of a batch into one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_pieces(batches):
            yield make(batch)

    return run
