"""Nearest neighbours by learned partitions.

Training, on a bounded sample of different vectors: their exact neighbour graph is cut into balanced partitions by
repeated bisection with exchange of border vectors, and a small classifier (one linear layer on the vector and its products with
anchors) learns the partition of a vector. Index: every vector goes to its most probable partition. Search: every query goes
to its most probable partitions and is compared there with all vectors, in double precision.

Equal vectors are one entry, with their smallest ids (as many as a result needs) and no more; equal queries are one
query. A partition is dealt to blocks of about ``BLOCK_ROWS`` vectors and ``BLOCK_QUERIES`` queries, so no task grows with the data.
Every block returns its best, and the best of all blocks are the result. What a query would find in the fitted sample alone
is a floor: entries below it cannot be in the result, so blocks leave them out.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do vectors of another
length than the most frequent one (of several the longest); a null ``vec_id`` takes no part; with fewer candidates than asked for, all are returned
when all partitions are probed; equal scores go to the smaller id; rows that repeat a ``vec_id`` are candidates of their own for others
and one query, which takes the best of what its different vectors find, no row of its own id among them;
an empty table gives an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from transitlake.llm.common import hold, table

TOP = 20
QUERY_STEP = 20
# The sample that graph, partitions and classifier are fitted on.
SAMPLE = 6_000
ROWS_PER_PARTITION = 400
MOST_PARTITIONS = 64
NEIGHBOURS = 12
# A query goes to so many partitions that queries outside the fitted sample find this share of their neighbours.
RECALL = 0.95
LEAST_PROBES = 4
TRIED_QUERIES = 600
BLOCK_ROWS = 4_000
BLOCK_QUERIES = 1_000
ANCHORS = 256


@dataclass
class Router:
    anchors: np.ndarray
    weights: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _features(x, self.anchors) @ self.weights


def _features(x: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    near = np.maximum(x @ anchors.T, 0.0)
    return np.hstack([np.ones((len(x), 1)), x, near])


def neighbour_graph(x: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """Indexes of the ``k`` nearest others of each row by inner product, computed in blocks."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for start in range(0, len(x), 1000):
        near = x[start : start + 1000] @ x.T
        near[np.arange(len(near)), np.arange(start, start + len(near))] = -np.inf
        out[start : start + 1000] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def partition_graph(x: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Balanced partitions: the rows are halved along their main direction, then rows with more neighbours on the other
    side are exchanged in equal numbers, and each half is cut further."""
    part = np.zeros(len(x), np.int64)
    work = [(np.arange(len(x)), parts, 0)]
    while work:
        rows, count, first = work.pop()
        if count <= 1 or len(rows) < 2:
            part[rows] = first
            continue
        left_count = count // 2
        centred = x[rows] - x[rows].mean(0)
        direction = rng.normal(size=x.shape[1])
        for _ in range(12):
            direction = centred.T @ (centred @ direction)
            direction /= np.linalg.norm(direction) + 1e-12
        cut = max(1, min(len(rows) - 1, len(rows) * left_count // count))
        left = np.zeros(len(x), np.int64)
        order = rows[np.argsort(centred @ direction, kind="stable")]
        left[order[:cut]], left[order[cut:]] = 1, -1
        for _ in range(8):
            # Neighbours on the own side less those on the other; both directions of the graph count.
            pull = left[graph].sum(1)
            back = np.zeros(len(x))
            np.add.at(back, graph, left[:, None])
            gain = -left * (pull + back)
            a, b = rows[left[rows] == 1], rows[left[rows] == -1]
            a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
            n = min(len(a), len(b))
            move = int((gain[a[:n]] + gain[b[:n]] > 0).sum()) // 2
            if not move:
                break
            left[a[:move]], left[b[:move]] = -1, 1
        work.append((rows[left[rows] == 1], left_count, first))
        work.append((rows[left[rows] == -1], count - left_count, first + left_count))
    return part


def fit_router(x: np.ndarray, parts: int, seed: int = 7) -> Router:
    rng = np.random.default_rng(seed)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    graph = neighbour_graph(x)
    part = partition_graph(x, graph, parts, rng)
    anchors = x[rng.choice(len(x), min(ANCHORS, len(x)), replace=False)]
    inputs = _features(x, anchors)
    # Targets are shared with the neighbours, so that a query learns where its neighbours lie.
    target = np.zeros((len(x), parts))
    target[np.arange(len(x)), part] = 1.0
    target = (target + target[graph].mean(1)) / 2
    weights = np.zeros((inputs.shape[1], parts))
    mean, spread = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, 121):
        z = inputs @ weights
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        slope = inputs.T @ (p - target) / len(x) + 1e-5 * weights
        mean, spread = 0.9 * mean + 0.1 * slope, 0.99 * spread + 0.01 * slope * slope
        weights -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-9)
    return Router(anchors, weights)


def probes_for(router: Router, x: np.ndarray, tried: np.ndarray, recall: float, top: int) -> int:
    """Fewest partitions in which the queries ``tried`` find ``recall`` of their ``top`` nearest of ``x``."""

    def order(v: np.ndarray) -> np.ndarray:
        return np.argsort(-router.scores(v / np.linalg.norm(v, axis=1, keepdims=True)), axis=1, kind="stable")

    near = tried @ x.T
    k = min(top + 1, len(x))
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    home = order(x)[:, 0]
    place = np.argsort(order(tried), axis=1)
    ranks = np.take_along_axis(place, home[best], axis=1).ravel()
    return int(np.sort(ranks)[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))))]) + 1


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _routed(router: Router, probes: int, known: np.ndarray | None = None, need: int = 0):
    """The ``probes`` most probable partitions of each vector; with ``known`` also the floor of a query: the score of
    its ``need``-th best of these vectors in those partitions."""
    home = None if known is None else np.argmax(router.scores(known / np.linalg.norm(known, axis=1, keepdims=True)), axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("vector"))
            scores = router.scores(x / np.linalg.norm(x, axis=1, keepdims=True))
            order = np.argsort(-scores, axis=1, kind="stable")[:, :probes]
            parts = pa.array(order.tolist(), pa.list_(pa.int32()))
            added = {"parts": parts}
            if known is not None:
                floor = np.full(len(x), -np.inf)
                for start in range(0, len(x) if len(known) >= need else 0, 256):
                    near = x[start : start + 256] @ known.T
                    probed = np.zeros((len(near), scores.shape[1]), bool)
                    np.put_along_axis(probed, order[start : start + 256], True, axis=1)
                    near[~probed[:, home]] = -np.inf
                    floor[start : start + 256] = np.partition(near, near.shape[1] - need, axis=1)[:, -need]
                added["floor"] = pa.array(floor, pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added.values()], names=[*batch.schema.names, *added]
            )

    return run


def _compare(left: pa.Table, right: pa.Table, need: int) -> pa.Table:
    """Best ``need`` entries of a block of vectors (right) for each query of a block (left)."""
    out_q, out_v, out_l, out_s = [], [], [], []
    if left.num_rows and right.num_rows:
        queries, vectors = (_matrix(t.column("vector").combine_chunks()) for t in (left, right))
        names, entries = left.column("entry").to_numpy(), right.column("entry").to_numpy()
        least, floor = right.column("least").to_numpy(), left.column("floor").to_numpy()
        k = min(need, len(vectors))
        for start in range(0, len(queries), 256):
            near = queries[start : start + 256] @ vectors.T
            # All entries as near as the k-th stay, so that ties are settled by id below.
            limit = np.partition(near, near.shape[1] - k, axis=1)[:, -k]
            limit = np.maximum(limit, floor[start : start + 256])
            rows, columns = np.nonzero(near >= limit[:, None] - 1e-9)
            order = np.lexsort((least[columns], -near[rows, columns], rows))
            rows, columns = rows[order], columns[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, rows)
            kept = place < k
            out_q.append(names[start + rows[kept]])
            out_v.append(entries[columns[kept]])
            out_l.append(least[columns[kept]])
            out_s.append(near[rows[kept], columns[kept]])
    empty = np.zeros(0)
    return pa.table(
        {
            "query": pa.array(np.concatenate(out_q) if out_q else empty, pa.int64()),
            "entry": pa.array(np.concatenate(out_v) if out_v else empty, pa.int64()),
            "least": pa.array(np.concatenate(out_l) if out_l else empty, pa.int64()),
            "score": pa.array(np.concatenate(out_s) if out_s else empty, pa.float64()),
        }
    )


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the vectors that take part."""
    v = F.col("vector")
    finite = vectors.select("vec_id", F.col("embedding").alias("vector")).where(
        F.col("vec_id").isNotNull()
        & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    sizes = finite.groupBy(F.size(v).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    best = sizes.orderBy(F.col("n").desc(), F.col("size").desc()).first()
    # Adding zero turns the negative zero into zero, so that equal vectors look equal.
    return finite.where(F.size(v) == (best["size"] if best else 0)).select("vec_id", F.transform(v, lambda x: x + F.lit(0.0).cast("float")).alias("vector"))


def _leading(rows: DataFrame, group: list[str], order: list, need: int) -> DataFrame:
    """The first rows of each group, so many that ``need`` are left without the rows of any one id; ``n`` numbers the
    rows of an id."""
    by = W.partitionBy(*group).orderBy(*order)
    placed = rows.withColumn("__place", F.row_number().over(by)).withColumn("__most", F.max("n").over(by.rowsBetween(W.unboundedPreceding, 0)))
    return placed.where(F.col("__place") - F.col("__most") <= need).drop("__place", "__most")


def search(
    vectors: DataFrame, top: int = TOP, step: int = QUERY_STEP, recall: float = RECALL
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the nearest others found for every row whose id ``step`` divides."""
    spark = vectors.sparkSession
    need = top + 1
    rows = hold(usable(vectors).withColumn("entry", F.xxhash64("vector")), "ann-rows")
    # The smallest ids of each vector, in two steps: first within salts, so that a frequent vector is no one task's.
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(64)).cast("int")
    # Ids that repeat stay apart by their number, up to as many as a result needs.
    salted = rows.select("entry", "vec_id", salt.alias("salt"))
    salted = salted.withColumn("n", F.row_number().over(W.partitionBy("entry", "salt", "vec_id").orderBy("vec_id"))).where(f"n <= {need}")
    some = _leading(salted, ["entry", "salt"], [F.col("vec_id"), F.col("n")], need)
    ids = hold(_leading(some, ["entry"], [F.col("vec_id"), F.col("n")], need).select("entry", "vec_id", "n"), "ann-ids")
    entries = hold(rows.groupBy("entry").agg(F.first("vector").alias("vector"), F.min("vec_id").alias("least")), "ann-entries")
    total = entries.count()
    out = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], out)
    sample = entries.orderBy(F.xxhash64("entry", F.lit("sample"))).limit(SAMPLE).select("vector").toPandas()
    parts = max(1, min(MOST_PARTITIONS, total // ROWS_PER_PARTITION, len(sample) // 40))
    known = np.stack(sample["vector"].to_list()).astype(np.float64)
    outside = min(TRIED_QUERIES, len(known) // 8)
    router = fit_router(known[outside:], parts) if parts > 1 else Router(np.zeros((0, known.shape[1])), np.zeros((known.shape[1] + 1, 1)))
    probes = parts
    if outside:
        probes = min(parts, max(LEAST_PROBES, probes_for(router, known, known[:outside], recall, top)))

    kind = entries.schema.simpleString()[len("struct<") : -1]
    placed = hold(entries.mapInArrow(_routed(router, 1), f"{kind},parts array<int>"), "ann-placed")
    asked = rows.where(F.pmod(F.col("vec_id"), F.lit(step)) == 0).select("vec_id", "entry")
    queries = hold(entries.join(asked.select("entry").distinct(), "entry", "left_semi").mapInArrow(_routed(router, probes, known, need + 2), f"{kind},parts array<int>,floor double"), "ann-queries")

    # Blocks of each partition: one count for each of a bounded number of partitions.
    part = F.explode("parts").alias("part")
    blocks = {r.part: r.n // BLOCK_ROWS + 1 for r in placed.select(part).groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    rounds = {r.part: r.n // BLOCK_QUERIES + 1 for r in queries.select(part).groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}

    def per_part(numbers: dict[int, int]):
        return F.element_at(F.array(*[F.lit(numbers.get(p, 1)) for p in range(parts)]), F.col("part") + 1)

    right = placed.select("entry", "vector", "least", part)
    right = right.withColumn("block", F.pmod(F.xxhash64("entry"), per_part(blocks)).cast("int"))
    right = right.withColumn("round", F.explode(F.sequence(F.lit(0), per_part(rounds) - 1)))
    left = queries.select("entry", "vector", "floor", part)
    left = left.withColumn("round", F.pmod(F.xxhash64("entry"), per_part(rounds)).cast("int"))
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0), per_part(blocks) - 1)))
    keys = ["part", "block", "round"]
    near = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(lambda a, b: _compare(a, b, need), "query long, entry long, least long, score double")
    )
    # The best entries of each query, then their ids. Scores are worked out again on the vectors, the same way everywhere.
    best = near.withColumn("n", F.row_number().over(W.partitionBy("query").orderBy(F.col("score").desc(), "least", "entry")))
    best = hold(best.where(f"n <= {2 * need}").select("query", "entry"), "ann-best")
    pairs = (
        best.join(entries.select("entry", F.col("vector").alias("b")), "entry")
        .join(entries.select(F.col("entry").alias("query"), F.col("vector").alias("a")), "query")
        .select("query", "entry", F.expr("aggregate(zip_with(a, b, (x, y) -> double(x) * double(y)), 0D, (s, x) -> s + x)").alias("score"))
    )
    named = pairs.join(ids, "entry").select("query", "entry", "vec_id", "n", "score")
    # As many as a query needs beside any one id; then for each id that has that vector.
    by_score = [F.col("score").desc(), F.col("vec_id"), F.col("place")]
    order = W.partitionBy("query", "vec_id").orderBy(F.col("score").desc(), "n", "entry")
    numbered = named.withColumn("place", F.row_number().over(order)).where(f"place <= {need}")
    short = hold(_leading(numbered.withColumnRenamed("n", "copy").withColumn("n", F.col("place")), ["query"], by_score, need), "ann-short")
    queried = asked.distinct().select(F.col("vec_id").alias("query_id"), F.col("entry").alias("query"))
    found = queried.join(short, "query").where("vec_id <> query_id")
    # A row that several vectors of an id find counts once, with its best score.
    found = found.groupBy("query_id", "vec_id", "entry", F.col("copy").alias("n")).agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id", "entry", "n")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(f"rank <= {top}")
        .select("query_id", "rank", "vec_id", "score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of ``op5_learned_partitions``."""
    return search(table(spark, sf_dir, "embeddings"))
