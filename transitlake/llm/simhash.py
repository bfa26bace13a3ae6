"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has one bit for each bit of the hashes of the document's shingles, set where over half
of the hashes have it. Documents link at ``RADIUS`` or fewer differing bits. Fingerprints are cut into
``BLOCKS`` blocks; with two differing bits in four blocks two whole blocks agree, so fingerprints are
joined on every pair of blocks and verified by their Hamming distance. Equal fingerprints are one
row in all of this; copies never multiply.

A bucket (fingerprints that share a pair of blocks) of more than ``BUCKET`` members is not joined with itself.
There every member sends itself to itself and to all fingerprints one bit away outside the shared blocks:
two members differ by at most two bits exactly if they meet at such a midpoint. That is 33 rows for each member instead
of all pairs, finds the same classes, and drops nothing.

Defined cases: a null text is one without words; without words the fingerprint is zero, linked like
any other; fewer words than a shingle count as one shingle; a null ``doc_id`` takes part and counts after
all others when the smallest is sought (a class of null ids only has a null component); an empty table gives an empty
result; repeated rows are copies. Other columns of the input are not looked at.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from transitlake.llm.common import by_batch, hold, table
from transitlake.llm.components import components

SHINGLE = 3
SEED = 42
RADIUS = 2
BITS = 64
BLOCKS = 4
BUCKET = 24
# Shingles that are summed at once, which bounds the memory of a very long text.
CHUNK = 1 << 16

BLOCK_BITS = BITS // BLOCKS
PAIRS = list(combinations(range(BLOCKS), 2))


def fingerprint(text: bytes | None) -> int:
    """Signed 64-bit fingerprint of UTF-8 text. ``bytes`` lower-cases A-Z alone and splits at the six
    ASCII white-space characters."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        shingles = iter([b" ".join(words)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
        n = len(words) - SHINGLE + 1
    counts = np.zeros(BITS, np.int64)
    for start in range(0, n, CHUNK):
        size = min(CHUNK, n - start)
        hashes = np.fromiter((digest(next(shingles), SEED) for _ in range(size)), np.uint64, size)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    ones = np.packbits(counts * 2 > n, bitorder="little")
    return int(ones.view("<i8")[0])


def _fingerprints(batch: pa.RecordBatch) -> pa.RecordBatch:
    prints = pa.array([fingerprint(t) for t in batch.column("text").to_pylist()], pa.int64())
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("text_hash"), prints], ["doc_id", "text_hash", "fp"]
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp) for each row."""
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    slim = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return slim.mapInArrow(by_batch(_fingerprints), f"doc_id {kind}, text_hash long, fp long")


def _block(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, i * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def links(prints: DataFrame) -> DataFrame:
    """(a, b) between distinct fingerprints of ``prints`` (fp): each pair within the radius is linked
    directly or over others within the radius."""
    fp = F.col("fp")
    keys = F.array(
        *[
            F.struct(F.lit(n).alias("pair"), (_block(fp, i) * (1 << BLOCK_BITS) + _block(fp, j)).alias("value"))
            for n, (i, j) in enumerate(PAIRS)
        ]
    )
    rows = hold(prints.select("fp", F.explode(keys).alias("key")).select("fp", "key.pair", "key.value"), "simhash-keys")
    sizes = rows.groupBy("pair", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = hold(rows.join(sizes, ["pair", "value"]), "simhash-buckets")

    few = shared.where(F.col("n") <= BUCKET)
    left = few.select("pair", "value", fp.alias("a"))
    right = few.select("pair", "value", fp.alias("b"))
    near = left.join(right, ["pair", "value"]).where(
        (F.col("a") > F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)
    )

    def flips(i: int, j: int) -> Column:
        outside = [b for b in range(BITS) if b // BLOCK_BITS not in (i, j)]
        return F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << b)).cast("long") for b in outside])

    flip = F.coalesce(*[F.when(F.col("pair") == n, flips(i, j)) for n, (i, j) in enumerate(PAIRS)])
    met = (
        shared.where(F.col("n") > BUCKET)
        .select("pair", "value", "fp", F.explode(flip).alias("flip"))
        .select("pair", "value", "fp", fp.bitwiseXOR(F.col("flip")).alias("midpoint"))
    )
    meeting = ["pair", "value", "midpoint"]
    first = met.groupBy(*meeting).agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    many = met.join(first, meeting).where("fp > b").select(fp.alias("a"), "b")
    return near.select("a", "b").union(many).distinct()


def classes(rows: DataFrame, linked: DataFrame | None = None) -> DataFrame:
    """``rows`` (doc_id, text_hash, fp) with ``component_id`` and ``keeper``, the row that stands for the
    component: its smallest (doc_id, text_hash). ``linked`` (a, b) are the links, without it those of ``links``."""
    # A null id comes after all others.
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    per_print = hold(rows.groupBy("fp").agg(F.min(rank).alias("first")), "simhash-prints")
    roots = hold(components(links(per_print.select("fp")) if linked is None else linked, "simhash-links"), "simhash-roots")
    joined = per_print.join(roots, per_print.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    best = joined.groupBy("root").agg(F.min("first").alias("keeper"))
    per_class = joined.join(best, "root").select("fp", "keeper")
    return rows.join(per_class, "fp").select(
        "doc_id", "text_hash", "fp", F.col("keeper.doc_id").alias("component_id"), "keeper"
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id, …) for every row of ``docs`` (doc_id, text)."""
    return classes(hold(fingerprints(docs), "simhash-docs"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest ``doc_id``, of several such rows the
    one with the smallest text hash. All columns stay as they are."""
    return kept(docs, near_duplicates(docs))


def kept(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their component in ``found`` (of ``classes``), each once."""
    keepers = (
        found
        .where(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash").eqNullSafe(F.col("keeper")))
        .select(F.struct("doc_id", "text_hash").alias("kept_row"))
        .distinct()
    )
    keyed = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"),
        F.xxhash64("text").alias("__hash"),
    )
    wanted = keepers.select(
        F.coalesce(F.col("kept_row.doc_id").cast("string"), F.lit("")).alias("__id"),
        F.col("kept_row.text_hash").alias("__hash"),
    )
    survivors = keyed.join(wanted, ["__id", "__hash"], "left_semi")
    one = survivors.withColumn("__n", F.row_number().over(W.partitionBy("__id", "__hash").orderBy("__hash")))
    return one.where("__n = 1").select(*[F.col(f"`{c}`") for c in docs.columns])


def united(first: DataFrame, second: DataFrame) -> DataFrame:
    """Classes of rows that are linked by either of two groupings of the same rows, as (doc_id, text_hash, component_id, keeper)."""
    none = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    row = F.concat_ws(":", none, F.col("text_hash").cast("string"))

    def node(keeper: str) -> Column:
        held = F.col(keeper)
        return F.concat_ws(":", F.coalesce(held["doc_id"].cast("string"), F.lit("")), held["text_hash"].cast("string"))

    def of(found: DataFrame, name: str) -> DataFrame:
        return found.select(row.alias("row"), "doc_id", "text_hash", F.col("keeper").alias(name)).dropDuplicates(["row"])

    rows = of(first, "one").join(of(second, "two").select("row", "two"), "row")
    rows = hold(rows.select("doc_id", "text_hash", node("one").alias("node"), node("two").alias("other")), "united-rows")
    roots = hold(components(rows.select(F.col("node").alias("a"), F.col("other").alias("b")), "united-links"), "united-roots")
    placed = rows.join(roots, "node", "left").select("doc_id", "text_hash", F.coalesce("root", "node").alias("root"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = placed.groupBy("root").agg(F.min(rank).alias("keeper"))
    return placed.join(best, "root").select("doc_id", "text_hash", F.col("keeper.doc_id").alias("component_id"), "keeper")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of ``op7_simhash_blocks``."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
