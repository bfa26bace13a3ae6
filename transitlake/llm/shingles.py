"""Near-duplicates by the exact similarity of shingle sets.

A document is the set of its shingles of ``SHINGLE`` words; two documents link where the Jaccard similarity of their sets
is ``SIMILARITY`` or more. Nothing is estimated: sets are put in one global order, and two sets that similar share a
shingle among the first ``n - ceil(similarity * n) + 1`` of each (prefix filter). Shingles that are common in a sample come
last in the order, which any order may do, so that common passages bring nobody together. Candidates are filtered by
length and by position of the shared shingle, and then compared on their whole sets.

Equal sets are one row in all of this. Of the sets that share a shingle all are first compared with the smallest only; what then
is one component is not compared again, and the others are compared with all members outside their component. A large group of near
copies thus costs a comparison for each member; sets that share a rare shingle and are not similar are compared in pairs.

Defined cases: a null text is one without words; documents without words are equal; fewer words than a shingle count as one
shingle; ids and repeated rows as in ``simhash``. Shingles are 64-bit hashes, and so are the names of sets.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from transitlake.llm import simhash
from transitlake.llm.common import by_batch, hold
from transitlake.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
SEED = 42
# Documents (about) in which common shingles are sought, and how many of these come last in the order.
SAMPLE = 20_000
LATE = 50_000
# Rows of a set that many others are compared with.
SALTS = 64


def shingle_set(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the different shingles of UTF-8 text, ascending. Words as in ``simhash``."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    return np.unique(np.fromiter((digest(s, SEED) for s in shingles), np.uint64, len(words) - shingle + 1))


def _name(shingles: np.ndarray) -> int:
    return simhash._signed(xxhash.xxh64_intdigest(shingles.astype("<u8").tobytes()))


def _prefix(shingles: np.ndarray, late: np.ndarray, ranks: np.ndarray, share: Fraction) -> np.ndarray:
    """The shingles of which a similar set holds one at least, in the global order; ``late`` ascends."""
    n = len(shingles)
    if not n:
        return shingles
    size = n - -(-share.numerator * n // share.denominator) + 1
    place = np.zeros(n, np.int64)
    if len(late):
        at = np.minimum(np.searchsorted(late, shingles), len(late) - 1)
        place = np.where(late[at] == shingles, ranks[at] + 1, 0)
    return shingles[np.lexsort((shingles, place))[:size]]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(fp, shingles) of ``texts``, one row for each different set."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, shingle) for t in batch.column("text").to_pylist()]
        names = pa.array([_name(s) for s in sets], pa.int64())
        return pa.RecordBatch.from_arrays([names, pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["fp", "shingles"])

    return texts.select("text").mapInArrow(by_batch(make), "fp long, shingles array<long>").dropDuplicates(["fp"])


def common_shingles(docs: DataFrame, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingles common in a sample of ``docs``, ascending, and their place among the common ones, rarest first."""
    every = max(1, docs.count() // SAMPLE)
    some = _texts(docs).where(F.pmod("text_hash", F.lit(every)) == 0)
    counts = _sets(some, shingle).select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.where("n > 2").orderBy(F.col("n").desc(), "s").limit(LATE).toPandas()
    late = rows["s"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(late)
    return late[order], (len(late) - 1 - np.arange(len(late)))[order]


def prefixes(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_hash, fp, n, prefix) for each row: name, size and prefix of its shingle set."""
    late, ranks = common_shingles(docs, shingle)
    share = Fraction(str(similarity))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, shingle) for t in batch.column("text").to_pylist()]
        found = [
            pa.array([_name(s) for s in sets], pa.int64()),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([_prefix(s, late, ranks, share).view(np.int64) for s in sets], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), *found], ["doc_id", "text_hash", "fp", "n", "prefix"]
        )

    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    return _texts(docs).mapInArrow(by_batch(make), f"doc_id {kind}, text_hash long, fp long, n long, prefix array<long>")


def _possible(a: str, b: str, share: Fraction) -> Column:
    """Whether sets that share the shingle at ``at`` as the first in the order can be similar. ``at`` counts from 0."""
    p, q = share.numerator, share.denominator
    total = F.col(f"{a}.n") + F.col(f"{b}.n")
    overlap = F.least(*[F.col(f"{s}.n") - F.col(f"{s}.at") for s in (a, b)])
    # Overlap o is needed with o / (total - o) >= p / q; it is at most the smaller set.
    return overlap * (p + q) >= total * p


def _verified(pairs: DataFrame, docs: DataFrame, rows: DataFrame, shingle: int, share: Fraction) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar."""
    p, q = share.numerator, share.denominator
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    texts = rows.join(wanted, "fp", "left_semi").groupBy("fp").agg(F.min("text_hash").alias("text_hash")).select("text_hash").distinct()
    sets = hold(_sets(_texts(docs).join(texts, "text_hash", "left_semi"), shingle), "shingle-sets")
    # A set that very many are compared with is dealt to salts, only as many as there are.
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    left = salted.select("a", "salt").distinct().join(sets.select(F.col("fp").alias("a"), F.col("shingles").alias("left")), "a")
    both = salted.join(sets.select(F.col("fp").alias("b"), F.col("shingles").alias("right")), "b").join(left, ["a", "salt"])

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column("left"), batch.column("right")):
            x, y = (v.values.to_numpy(zero_copy_only=False) for v in (x, y))
            o = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(o * q >= p * (len(x) + len(y) - o))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "left", "right").mapInArrow(by_batch(compare), "a long, b long")


def links(docs: DataFrame, rows: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b) between sets of ``rows`` (of ``prefixes``): similar sets are linked directly or over similar ones."""
    share = Fraction(str(similarity))
    tokens = rows.dropDuplicates(["fp"]).select("fp", "n", F.posexplode("prefix").alias("at", "token"))
    # The window reads the sets of a shingle one after the other.
    of_token = W.partitionBy("token")
    me = F.struct("fp", "n", "at")
    shared = tokens.select("token", me.alias("me"), F.count(F.lit(1)).over(of_token).alias("size"), F.min(me).over(of_token).alias("first"))
    shared = hold(shared.where("size > 1"), "shingle-tokens")
    stars = shared.where((F.col("me.fp") > F.col("first.fp")) & _possible("me", "first", share))
    stars = hold(stars.select(F.col("first.fp").alias("a"), F.col("me.fp").alias("b")).distinct(), "shingle-stars")
    near = hold(_verified(stars, docs, rows, shingle, share), "shingle-near")

    # What the smallest of a shingle has not brought into one component is compared across components.
    roots = hold(components(near, "shingle-links"), "shingle-roots")
    rest = shared.where("size > 2").select("token", "me", F.col("me.fp").alias("node")).join(roots, "node", "left")
    rest = hold(rest.select("token", "me", F.coalesce("root", "node").alias("root")), "shingle-rest")
    groups = rest.groupBy("token", "root").agg(F.count(F.lit(1)).alias("n"))
    bases = groups.groupBy("token").agg(F.max(F.struct("n", "root")).alias("most"), F.count(F.lit(1)).alias("groups"))
    parted = hold(rest.join(bases.where("groups > 1").select("token", F.col("most.root").alias("base")), "token"), "shingle-parted")
    outside = parted.where("root <> base").select("token", F.col("me").alias("x"), F.col("root").alias("x_root"))
    across = (
        outside.join(parted, "token")
        .where((F.col("x_root") != F.col("root")) & ((F.col("root") == F.col("base")) | (F.col("x.fp") > F.col("me.fp"))) & _possible("x", "me", share))
        .select(F.least("x.fp", "me.fp").alias("a"), F.greatest("x.fp", "me.fp").alias("b"))
        .distinct()
    )
    across = hold(across.join(stars, ["a", "b"], "left_anti"), "shingle-across")
    if across.isEmpty():
        return near
    return near.union(_verified(across, docs, rows, shingle, share))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, keeper) for every row of ``docs`` (doc_id, text)."""
    rows = hold(prefixes(docs, shingle, similarity), "shingle-docs")
    return simhash.classes(rows.select("doc_id", "text_hash", "fp"), links(docs, rows, shingle, similarity))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each component, chosen as in ``simhash.keep_one``."""
    return simhash.kept(docs, near_duplicates(docs, shingle, similarity))
