"""Mixing of sources to target weights by systematic sampling.

Within a source every document expects ``target / source_size`` copies. Documents stand in order of size;
the running sum of expected copies gets one random offset, and a document is emitted once for each
whole number that the sum crosses at it. Ordered by size, the words taken are off by the size of a document or so.

The running sum of equal parts is a rank. It is worked out from cells (source, class of size, salt):
counts of cells are added up in order, and ranks inside a cell come from one window. Cells follow the row count, so
no task holds a source or a group of copies.

Defined cases: a null text or one without words has size 0 and may be emitted, taking no words; a null
source is a source, the last in order; a source without words has target 0 and emits nothing; an empty table gives an empty result; repeated rows count
each for themselves; input columns named like an added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from transitlake.llm.common import WHITE, extended, hold, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
SEED = "mix-1"
ROWS_PER_SALT = 25_000


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{WHITE}]+")), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Never null, so that joins and windows use it as it is."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """Targets from ``sizes`` (skey, source_size), a row per source: sources in order weigh ``weights``,
    repeating; none gets more than ``most`` times its size, and what is above goes to the others by weight.

    Sources ordered by limit per weight reach their limit one after the other. The level (words per unit of
    weight) is that at the first source that stays below its limit.
    """
    # The key of a null source is the empty text and sorts first: it is put last.
    by_name = W.orderBy(F.col("skey") == "", "skey")
    weighed = sizes.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    ).withColumn("limit", F.col("source_size") * most)
    everything = W.partitionBy()
    before = W.orderBy(F.col("limit") / F.col("weight"), "skey").rowsBetween(W.unboundedPreceding, -1)
    level = (
        F.sum("source_size").over(everything) * share - F.coalesce(F.sum("limit").over(before), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    place = F.row_number().over(W.orderBy(F.col("limit") / F.col("weight"), "skey"))
    reached = weighed.withColumn("level", level).withColumn("place", place)
    below = F.when(F.col("level") * F.col("weight") < F.col("limit"), F.struct("place", "level"))
    return reached.withColumn("final", F.min(below).over(everything)["level"]).select(
        "skey",
        "source_size",
        F.least(
            F.col("limit").cast("double"), F.coalesce(F.col("final") * F.col("weight"), F.col("limit").cast("double"))
        ).alias("target"),
    )


def size_class(size: Column) -> Column:
    """Grows with the size; sizes of one class differ by a sixteenth at most."""
    bits = F.length(F.bin(size))
    return (bits * 64 + F.expr("shiftright(size_, greatest(length(bin(size_)) - 5, 0))")).cast("int")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``, the times the mix has the row."""
    text, doc_id, source = F.col("text"), F.col("doc_id"), F.col("source")
    # Rows without an id are told apart by their text, so that they do not all meet in one cell.
    name = F.coalesce(doc_id.cast("string"), F.xxhash64(text).cast("string"))
    number = F.md5(F.concat(F.lit(seed), name))

    def keyed(df: DataFrame, salts: int) -> DataFrame:
        out = extended(df, size_=words_in(text), skey=source_key(source), order_=number)
        return extended(
            out,
            class_=size_class(F.col("size_")),
            salt_=F.pmod(F.conv(F.substring("order_", 1, 8), 16, 10).cast("long"), F.lit(salts)).cast("int"),
        )

    slim = docs.select("doc_id", "text", "source")
    held = hold(keyed(slim, 1).select("size_", "skey", "order_", "class_"), "mix-sizes")
    salts = held.count() // ROWS_PER_SALT + 1
    salted = held.withColumn("salt_", F.pmod(F.conv(F.substring("order_", 1, 8), 16, 10).cast("long"), F.lit(salts)).cast("int"))
    cells = salted.groupBy("skey", "class_", "salt_").agg(
        F.count(F.lit(1)).alias("n_"), F.sum("size_").alias("words_")
    )
    per_source = targets(cells.groupBy("skey").agg(F.sum("words_").alias("source_size")), weights, share, most)
    # Two short sums instead of a long one: over the classes of a source, over the salts of a class.
    classes = cells.groupBy("skey", "class_").agg(F.sum("n_").alias("of_class_"))
    below = F.sum("of_class_").over(W.partitionBy("skey").orderBy("class_")) - F.col("of_class_")
    before = F.sum("n_").over(W.partitionBy("skey", "class_").orderBy("salt_")) - F.col("n_")
    starts = (
        cells.withColumn("before_", before)
        .join(classes.withColumn("below_", below), ["skey", "class_"])
        .withColumn("start_", F.col("below_") + F.col("before_"))
        .join(per_source, "skey")
        .select("skey", "class_", "salt_", "start_", "source_size", "target")
    )
    inside = W.partitionBy("skey", "class_", "salt_").orderBy("size_", "order_", F.xxhash64("text"))
    ranked = keyed(docs, salts).withColumn("rank_", F.row_number().over(inside) - 1)
    ranked = ranked.drop("source_size", "target", "start_").join(starts, ["skey", "class_", "salt_"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # 20 bits, so that whole rates stay exact for any rank.
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("skey"))), 1, 5), 16, 10).cast("double") / (1 << 20)
    rank = F.col("start_") + F.col("rank_")
    copies = F.floor((rank + 1) * rate + offset) - F.floor(rank * rate + offset)
    added = ("size", "source_size", "target", "copies")
    inner = {"size_", "skey", "order_", "class_", "salt_", "rank_", "start_", *added}
    return ranked.select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in inner],
        F.col("size_").alias("size"),
        "source_size",
        "target",
        F.least(copies, F.lit(most)).cast("long").alias("copies"),
    )


def emitted(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of the mix: each as often as ``copies`` says."""
    return mixed.where("copies > 0").select(
        *[F.col(f"`{c}`") for c in columns], F.explode(F.expr("sequence(1, copies)")).alias("copy_no_")
    ).drop("copy_no_")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of ``op9_systematic_mix``."""
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )
