"""Repeated runs of lines, by winnowing over line hashes.

Units are the lines that hold words, known by the hash of their text without outer white space. A window is
the shortest stretch of lines from some line on that has ``WORDS`` words; a longer line is a window of its own. The
fingerprint of a window is its smallest line hash, so a run of ``WORDS`` words that two places share has a window, and a fingerprint, in common
for certain. Places are joined on the fingerprint and the hash of the whole window with the first place only
(smallest ``doc_id``, text hash, line), never with each other; the match is extended both ways over the lines
around the two windows, and the lines of the later place are deleted.

What extension can reach beyond the windows of a run is less than a window, so every place carries the hashes of that many lines
before and after it, and no document has to be looked up.

Defined cases: null and empty texts have no lines; texts without a window stay as they are; a null ``doc_id`` comes after
all others; rows that repeat ``doc_id`` and text are one document and are treated alike; an empty table gives an empty result; input
columns other than the text stay as they are, but for ``n_chars`` of a changed text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from transitlake.llm.common import hold, table

WORDS = 50


def lines_of(text: bytes | None) -> tuple[list[int], list[int], list[int]]:
    """Line numbers, hashes and words of the lines that hold words."""
    numbers, hashes, words = [], [], []
    for number, line in enumerate((text or b"").split(b"\n")):
        count = len(line.split())
        if count:
            numbers.append(number)
            hashes.append(xxhash.xxh64_intdigest(line.strip()) - (1 << 63))
            words.append(count)
    return numbers, hashes, words


def windows(hashes: list[int], words: list[int], least: int = WORDS) -> list[dict]:
    """Windows with their fingerprint and the hashes of the lines around them, nearest first."""
    out = []
    end, total = 0, 0
    for start in range(len(hashes)):
        while end < len(hashes) and total < least:
            total += words[end]
            end += 1
        if total < least:
            break
        inside = hashes[start:end]

        def around(step: int, at: int) -> list[int]:
            found, seen = [], 0
            while 0 <= at < len(hashes) and seen + words[at] < least:
                seen += words[at]
                found.append(hashes[at])
                at += step
            return found

        out.append(
            {
                "print": min(inside),
                "whole": xxhash.xxh64_intdigest(b"".join(h.to_bytes(8, "little", signed=True) for h in inside)) - (1 << 63),
                "start": start,
                "end": end,
                "before": around(-1, start - 1),
                "after": around(1, end),
            }
        )
        total -= words[start]
    return out


_WINDOW = pa.struct(
    [
        ("print", pa.int64()),
        ("whole", pa.int64()),
        ("start", pa.int32()),
        ("end", pa.int32()),
        ("before", pa.list_(pa.int64())),
        ("after", pa.list_(pa.int64())),
    ]
)
_DDL = "array<struct<print:long,whole:long,start:int,end:int,before:array<long>,after:array<long>>>"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, found = [], []
        for text in batch.column("text").to_pylist():
            _, hashes, words = lines_of(text)
            counts.append(len(hashes))
            found.append(windows(hashes, words))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(counts, pa.int64()), pa.array(found, pa.list_(_WINDOW))],
            ["doc_id", "text_hash", "n_lines", "windows"],
        )


def _shared(a: Column, b: Column) -> Column:
    """Length of the common beginning of two arrays."""
    pairs = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(pairs, False)
    return F.when(first > 0, first - 1).otherwise(F.size(pairs)).cast("int")


def read_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_lines, windows) of each row."""
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    slim = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return slim.mapInArrow(_read, f"doc_id {kind}, text_hash long, n_lines long, windows {_DDL}")


def repeated(read: DataFrame) -> DataFrame:
    """(id, text_hash, runs): stretches (first line, line after the last) of lines to delete, lines counted among
    those that hold words; a row for each document that has some."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "w.start")
    rows = read.select("doc_id", "text_hash", F.explode("windows").alias("w"))
    keyed = rows.select(F.col("w.print").alias("print"), F.col("w.whole").alias("whole"), place.alias("place"), "w")
    first = (
        keyed.groupBy("print", "whole")
        .agg(F.min(F.struct("place", "w.before", "w.after")).alias("f"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("print", "whole", "f")
    )
    later = keyed.join(first, ["print", "whole"]).where(~F.col("place").eqNullSafe(F.col("f.place")))
    run = F.struct(
        (F.col("w.start") - _shared(F.col("w.before"), F.col("f.before"))).alias("first"),
        (F.col("w.end") + _shared(F.col("w.after"), F.col("f.after"))).alias("end"),
    )
    return (
        later.select(
            F.coalesce(F.col("place.doc_id").cast("string"), F.lit("")).alias("id"), F.col("place.text_hash").alias("text_hash"), run.alias("run")
        )
        .groupBy("id", "text_hash")
        .agg(F.array_sort(F.collect_set("run")).alias("runs"))
    )


def merged(runs: Column) -> Column:
    """Sorted stretches with those that touch made one."""
    empty = F.array().cast("array<struct<first:int,end:int>>")

    def add(done: Column, run: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["first"].alias("first"), F.greatest(last["end"], run["end"]).alias("end"))
        return F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= run["first"]),
            F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined)),
        ).otherwise(F.concat(done, F.array(run)))

    return F.aggregate(F.coalesce(runs, empty), empty, add)


def _rebuilt(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("__runs").to_pylist()):
                if runs:
                    lines = text.split("\n")
                    numbers = lines_of(text.encode())[0]
                    gone = {n for r in runs for n in numbers[r["first"] : r["end"]]}
                    text = "\n".join(line for n, line in enumerate(lines) if n not in gone)
                texts.append(text)
                counts.append(len(text) if runs else None)
            columns = []
            for name in names:
                column = batch.column(name)
                if name == "text":
                    column = pa.array(texts, column.type)
                elif name == "n_chars":
                    column = pa.array([o if c is None else c for o, c in zip(column.to_pylist(), counts)], column.type)
                columns.append(column)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines of later repeated runs."""
    runs = repeated(hold(read_lines(docs), "line-windows")).select("id", F.col("text_hash").alias("__hash"), F.col("runs").alias("__runs"))
    keyed = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"),
        F.xxhash64("text").alias("__hash"),
    )
    joined = keyed.join(runs.withColumnRenamed("id", "__id"), ["__id", "__hash"], "left")
    return joined.select(*docs.columns, "__runs").mapInArrow(_rebuilt(docs.columns), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op4_winnowed_lines``: lines with words, deleted ones, and the deleted stretches of each document."""
    read = hold(read_lines(table(spark, sf_dir, "documents")), "line-windows")
    runs = repeated(read).select("id", F.col("text_hash").alias("hash"), merged(F.col("runs")).alias("runs"))
    rows = read.select("doc_id", "n_lines", "text_hash", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("row_id"))
    joined = rows.join(runs, (rows.row_id == runs.id) & (rows.text_hash == runs.hash), "left")
    deleted = F.aggregate(
        F.coalesce("runs", F.array().cast("array<struct<first:int,end:int>>")), F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["first"]
    )
    written = F.array_join(F.transform("runs", lambda r: F.concat_ws("-", r["first"].cast("string"), r["end"].cast("string"))), ",")
    return joined.select("doc_id", "n_lines", deleted.alias("n_deleted"), F.coalesce(written, F.lit("")).alias("deleted_runs"))
