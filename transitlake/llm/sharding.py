"""Sharding by histogram sort: splitters of equal bytes, found by exact counts, then one exchange.

Every row gets a 128-bit key: the hash of its text, then the hash of its ``doc_id``, as 32 hex digits.
Rows of one text stand together in key order, and a splitter cuts such a run only where no edge
between texts meets the tolerance. Each round counts the bytes of all rows below the probes of every
open splitter, two more digits a round, until each splitter meets the tolerance or single keys are left.

Defined cases: a null text has no bytes and the checksum of nothing; an empty table gives an empty
result; repeated rows (same ``doc_id``, same text) share a key and so a shard, each with a slot of its
own; input columns named like an added one are replaced.
"""

from __future__ import annotations

import os.path

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from transitlake.llm.common import extended, hold, table

SHARDS = 24
# Share of a shard's bytes that a splitter may be off.
TOLERANCE = 0.001
# Further hex digits of a probe in each round: at most 256 counts for each open splitter.
DIGITS = 2
KEY_DIGITS = 32
# Rows that one task numbers, about.
ROWS_PER_RUN = 10_000
LEAST_RUNS = 8


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def key_of(text: Column, doc_id: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(F.xxhash64(text)), 16, "0"), F.lpad(F.hex(F.xxhash64(doc_id)), 16, "0")))


def splitters(keyed: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[str]:
    """Splitters of ``keyed`` (key, size): a row belongs above splitter ``s`` when ``key > s``.

    The driver holds at most 256 counts for each splitter, whatever the input.
    """
    total = keyed.agg(F.sum("size")).first()[0] or 0
    slack = tolerance * total / shards
    goals = {i: total * i / shards for i in range(1, shards)}
    done: dict[int, str] = {}
    # The open prefixes, each with the bytes below it and the splitters that fall into it.
    spans = {"": (0, list(goals))}
    if not total:
        return []
    while spans:
        depths: dict[int, list[str]] = {}
        for prefix in spans:
            depths.setdefault(len(prefix), []).append(prefix)
        # Prefixes differ in length once a run of one text was passed over.
        owner = F.coalesce(
            *[
                F.when(F.substring("key", 1, depth).isin(prefixes), F.substring("key", 1, depth))
                for depth, prefixes in sorted(depths.items())
            ],
        )
        counted = (
            keyed.withColumn("owner", owner)
            .where(F.col("owner").isNotNull())
            .withColumn("probe", F.expr(f"substring(key, 1, length(owner) + {DIGITS})"))
            .groupBy("owner", "probe")
            .agg(F.sum("size").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high"))
            .collect()
        )
        found: dict[str, list] = {}
        for row in counted:
            found.setdefault(row.owner, []).append(row)
        following: dict[str, tuple[int, list[int]]] = {}
        for prefix, (start, open_goals) in spans.items():
            below = start
            for row in sorted(found[prefix], key=lambda r: r.probe):
                above = below + row.bytes
                for i in [i for i in open_goals if below < goals[i] <= above]:
                    near_low, near_high = goals[i] - below, above - goals[i]
                    if min(near_low, near_high) <= slack or row.low == row.high:
                        # A shorter text sorts below all that it begins: such a splitter has the probe above it.
                        done[i] = row.probe[: KEY_DIGITS - 1] if near_low < near_high else row.high
                    else:
                        shared = os.path.commonprefix([row.low, row.high])
                        following.setdefault(shared, (below, []))[1].append(i)
                below = above
        spans = following
    return [done[i] for i in sorted(done)]


def shard_documents(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``shard`` and ``slot`` (0, 1, ... within each shard).

    Rows move once, to the run of their shard that numbers them. Runs are cut by hash and their number
    follows the row count, so no task holds a shard or a group of copies; a run's first slot comes
    from the counts of the runs before it.
    """
    text, doc_id = F.col("text"), F.col("doc_id")
    keyed = hold(docs.select(key_of(text, doc_id).alias("key"), size_of(text).alias("size")), "shard-keys")
    bounds = splitters(keyed, shards, tolerance)
    runs = max(LEAST_RUNS, keyed.count() // (shards * ROWS_PER_RUN) + 1)

    def shard(key: Column) -> Column:
        return sum(((key > s).cast("int") for s in bounds), F.lit(0))

    def run(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(runs)).cast("int")

    key = F.col("key")
    first = (
        keyed.groupBy(shard(key).alias("shard"), run(key).alias("run_no"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "shard",
            "run_no",
            (F.sum("n").over(W.partitionBy("shard").orderBy("run_no")) - F.col("n")).alias("first_slot"),
        )
    )
    placed = extended(docs, size=size_of(text), text_crc32=F.crc32(F.coalesce(text, F.lit(""))), key=key_of(text, doc_id))
    placed = extended(placed, shard=shard(key), run_no=run(key))
    numbered = placed.withColumn("slot_in_run", F.row_number().over(W.partitionBy("shard", "run_no").orderBy("key")) - 1)
    return (
        numbered.join(first, ["shard", "run_no"])
        .select(
            *[F.col(f"`{c}`") for c in placed.columns if c not in ("shard", "run_no", "key", "slot", "first_slot", "slot_in_run")],
            "shard",
            (F.col("first_slot") + F.col("slot_in_run")).alias("slot"),
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of ``op3_histogram_shards``: law ``bytes``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_documents(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
