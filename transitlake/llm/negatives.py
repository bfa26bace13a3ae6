"""Hard-negative mining by coordinate pruning in buckets of like length (after LEMP).

Rows are vectors of whole numbers. The score of a row for an anchor is their inner product, which is exact. Vectors go to
buckets of like length, each holding one sorted list of values for each coordinate it is asked for. An anchor
comes to a bucket with the least score that can still matter. From that and the longest vector of the bucket follows the least cosine, and
from the least cosine a range of feasible values for each coordinate of the vector scaled to length one. The ranges of the ``FOCUS``
coordinates where the anchor is largest are cut out of the sorted lists, the candidate sets are intersected, and what is in all of them
is scored exactly. Buckets whose longest vector is too short for the least score are not visited at all.

Two passes: the best ``POSITIVES`` rows of the anchor's label, then for each of them the best ``NEGATIVES`` rows of other labels
whose score lies between ``MARGIN`` of the positive's and the positive's. The least score of each pass starts from a sample of ``SAMPLE``
rows, which only tells where pruning may begin; all rows are indexed, every anchor is answered exactly.

A bucket is read by one task, which holds its vectors (at most about ``ROWS``) while the anchors stream by in small batches; vectors are
dealt once a pass, anchors once for each bucket they visit.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part; a row that repeats as a whole counts
once; other rows of an anchor are those with another id; rows that share an id and differ count each; a null id is no anchor and
comes after all others in ties; of vectors of different lengths the missing components count as zero; scores have to fit 64 bits; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from transitlake.llm.common import hold, table

POSITIVES = 5
NEGATIVES = 5
# A negative has at least this part of its positive's score, in hundredths.
MARGIN = 80
SCALE = 256
FOCUS = 4
# Rows that give the first least scores.
SAMPLE = 2000
# Vectors of a bucket, as many as a task holds; small tables are cut finer, into about ``PARTS``.
ROWS = 1 << 14
PARTS = 48
# Buckets hold vectors whose lengths differ by this factor at most.
STRETCH = 1.15
SLACK = 1e-9
# Whole numbers up to here are exact as double.
EXACT = float(1 << 53)
LAST = np.iinfo(np.int64).max


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, own) of the rows that take part, each different row once, components as whole numbers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    own = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    rows = vectors.select("vec_id", "label", "embedding").where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), own.alias("own")).distinct()


def relabelled(rows: DataFrame) -> DataFrame:
    """Labels as the query wants them: a tenth further round where 7 divides the id."""
    return rows.withColumn("label", F.when(F.pmod("vec_id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label")))


def bucketed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``bucket``, ``shortest`` and ``longest``: classes of like length, cut by hash to at most about ``ROWS``.
    There are a few hundred classes at most, as the length is that of a double."""
    length = F.sqrt(F.aggregate("own", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    kind = F.when(F.col("length") == 0, -1).otherwise(F.floor(F.log(F.col("length")) / float(np.log(STRETCH)))).cast("int")
    rows = rows.withColumn("length", length).withColumn("kind", kind)
    stats = rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.min("length").alias("shortest"), F.max("length").alias("longest"))
    total = W.partitionBy()
    size = F.least(F.lit(ROWS), F.greatest(F.lit(256), F.ceil(F.sum("n").over(total) / PARTS)))
    stats = stats.withColumn("cuts", F.ceil(F.col("n") / size).cast("int"))
    dealt = rows.join(F.broadcast(stats.drop("n")), "kind")
    return dealt.withColumn("bucket", F.concat_ws("/", "kind", F.pmod(F.xxhash64("vec_id", "own"), F.col("cuts"))))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of a matrix, filled up with zeros, cut to ``width`` (what an anchor lacks counts as zero)."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    inside = np.arange(int(sizes.max(initial=0)))[None, :] < sizes[:, None]
    rows, columns = np.nonzero(inside)
    keep = columns < width
    out[rows[keep], columns[keep]] = flat[keep]
    return out


def feasible(cosine: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Range of a coordinate of a vector of length one whose cosine with the anchor is ``least`` or more, where the anchor's own
    coordinate is ``cosine``."""
    rest = np.sqrt(np.maximum(0.0, (1 - least * least) * (1 - cosine * cosine)))
    low = np.where(-cosine >= least, -1.0, cosine * least - rest)
    high = np.where(cosine >= least, 1.0, cosine * least + rest)
    return low - SLACK, high + SLACK


class Bucket:
    """Vectors of like length with sorted lists of the coordinates asked for."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, own: np.ndarray) -> None:
        self.ids, self.labels, self.own = ids, labels, own
        wide = own.astype(np.float64)
        self.lengths = np.sqrt((wide * wide).sum(1))
        self.unit = wide / np.where(self.lengths > 0, self.lengths, 1.0)[:, None]
        self.most = float(np.abs(wide).max(initial=0.0))
        self.wide = wide
        self.order: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.shortest, self.longest = float(self.lengths.min()), float(self.lengths.max())

    def _sorted(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.order:
            order = np.argsort(self.unit[:, f])
            self.order[f] = order, self.unit[order, f]
        return self.order[f]

    def candidates(self, anchor: np.ndarray, least: float) -> np.ndarray:
        """Rows that may reach the score ``least``, by the ranges of the focus coordinates."""
        wide = anchor.astype(np.float64)
        length = float(np.sqrt((wide * wide).sum()))
        everything = np.arange(len(self.ids))
        if length == 0 or self.longest == 0 or least == -np.inf:
            return everything if least <= 0 else everything[:0]
        # A score of ``least`` needs the least cosine with the longest vector, or, below zero, with the shortest.
        bound = least / (length * (self.longest if least >= 0 else self.shortest)) if least >= 0 or self.shortest else -1.0
        if bound > 1 + SLACK:
            return everything[:0]
        bound = min(bound, 1.0)
        if bound <= -1:
            return everything
        focus = np.argsort(-np.abs(wide))[:FOCUS]
        low, high = feasible(wide[focus] / length, bound)
        hits = None
        for f, a, b in zip(focus.tolist(), low.tolist(), high.tolist()):
            if a <= -1 and b >= 1:
                continue
            order, values = self._sorted(f)
            inside = order[np.searchsorted(values, a, "left") : np.searchsorted(values, b, "right")]
            if hits is None:
                hits = inside
            else:
                marks = np.zeros(len(self.ids), bool)
                marks[inside] = True
                hits = hits[marks[hits]]
            if not len(hits):
                break
        return everything if hits is None else hits

    def scores(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact inner products."""
        if self.most * float(np.abs(anchor.astype(np.float64)).max(initial=0.0)) * max(1, self.own.shape[1]) < EXACT:
            return (self.wide[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.own[rows] @ anchor


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` greatest scores, ties by smaller id."""
    if len(scores) > 4 * k:
        # All that reach the k-th score.
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= edge)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def best_positives(bucket: Bucket, anchor: dict) -> list[tuple[int, int, int]]:
    """(slot, id, score) of the rows of the anchor's label that reach its least score."""
    rows = bucket.candidates(anchor["own"], anchor["least"])
    rows = rows[(bucket.labels[rows] == anchor["label"]) & (bucket.ids[rows] != anchor["id"])]
    scores = bucket.scores(anchor["own"], rows)
    top = _best(scores, bucket.ids[rows], POSITIVES)
    return [(0, i, s) for i, s in zip(bucket.ids[rows[top]].tolist(), scores[top].tolist()) if s >= anchor["least"]]


def best_negatives(bucket: Bucket, anchor: dict) -> list[tuple[int, int, int]]:
    """(slot, id, score) for each positive: the rows of other labels between the least score and that of the positive."""
    lows, highs = anchor["lows"], anchor["highs"]
    rows = bucket.candidates(anchor["own"], float(min(lows)))
    rows = rows[(bucket.labels[rows] != anchor["label"]) & (bucket.ids[rows] != anchor["id"])]
    scores = bucket.scores(anchor["own"], rows)
    ids, out = bucket.ids[rows], []
    for slot, (low, high) in enumerate(zip(lows, highs)):
        some = np.flatnonzero((scores >= low) & (scores <= high))
        top = some[_best(scores[some], ids[some], NEGATIVES)]
        out += [(slot, i, s) for i, s in zip(ids[top].tolist(), scores[top].tolist())]
    return out


def _margin(score: int) -> int:
    """Least negative score for a positive score."""
    return -(-MARGIN * score // 100)


def _visits(batch: pa.RecordBatch, width: int | None = None) -> Iterator[dict]:
    for row in batch.to_pylist():
        out = {"id": row["vec_id"], "label": row["label"], "own": np.array(row["own"], np.int64), "row": row}
        out["least"] = -np.inf if row["least"] is None else row["least"]
        if row["scores"]:
            out["highs"], out["lows"] = row["scores"], row["floors"]
        yield out


MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
ANCHOR = "anchor long, vec_id long, label long, own array<long>, length double, least long, scores array<long>, floors array<long>"


def sample_bucket(rows: DataFrame) -> Bucket:
    """``SAMPLE`` rows by the hash of the row: where pruning begins."""
    some = rows.orderBy(F.xxhash64("vec_id", "label", "own")).limit(SAMPLE).select("vec_id", "label", "own").toArrow()
    own = some.column("own").combine_chunks()
    return Bucket(*_ids(some), _matrix(own, int(own.value_lengths().to_numpy(zero_copy_only=False).max())))


def _ids(rows: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    ids = rows.column("vec_id").fill_null(LAST)
    return ids.to_numpy().astype(np.int64), rows.column("label").to_numpy().astype(np.int64)


def _fitted(anchor: dict, width: int) -> dict:
    """The anchor at the width of a bucket."""
    own = np.zeros(width, np.int64)
    own[: min(width, len(anchor["own"]))] = anchor["own"][:width]
    return anchor | {"own": own}


def first_floors(anchors: DataFrame, sample: Bucket) -> DataFrame:
    """``anchors`` with the scores that the sample shows to be reached: ``least`` before there are positives, ``floors`` after."""
    names = [c.split()[0] for c in ANCHOR.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row, anchor in zip(rows, _visits(batch)):
                fitted = _fitted(anchor, sample.own.shape[1])
                if row["scores"]:
                    lows = [_margin(s) for s in row["scores"]]
                    reached: dict[int, list[int]] = {}
                    for slot, _, score in best_negatives(sample, fitted | {"highs": row["scores"], "lows": lows}):
                        reached.setdefault(slot, []).append(score)
                    lows = [min(v) if len(v := reached.get(k, [])) == NEGATIVES else low for k, low in enumerate(lows)]
                    row["floors"], row["least"] = lows, min(lows)
                else:
                    scores = [s for _, _, s in best_positives(sample, fitted)]
                    row["least"] = min(scores) if len(scores) == POSITIVES else None
            kinds = {"own": pa.list_(pa.int64()), "scores": pa.list_(pa.int64()), "floors": pa.list_(pa.int64()), "length": pa.float64()}
            columns = [pa.array([r[n] for r in rows], kinds.get(n, pa.int64())) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return anchors.mapInArrow(run, ANCHOR)


def visit(rows: DataFrame, anchors: DataFrame, positives: bool) -> DataFrame:
    """(anchor, slot, vec_id, score): what every bucket has for every anchor that may find something there.

    The rows of a bucket come first, then its anchors; the task keeps the one and lets the other pass."""
    # One entry for each class of length, a few hundred at most.
    kinds = rows.groupBy("kind", "cuts", "longest").agg(F.lit(1)).collect()
    classes = F.array(*[F.struct(F.lit(k.kind).alias("kind"), F.lit(k.cuts).alias("cuts"), F.lit(k.longest).alias("longest")) for k in kinds])
    reached = F.filter(classes, lambda c: F.col("least").isNull() | (F.col("least") <= F.col("length") * c["longest"] * (1 + SLACK)))
    cuts = F.transform(reached, lambda c: F.transform(F.sequence(F.lit(0), c["cuts"] - 1), lambda k: F.concat_ws("/", c["kind"], k)))
    routed = anchors.select(F.explode(F.flatten(cuts)).alias("bucket"), *anchors.columns)
    own = rows.select("bucket", F.lit(None).cast("long").alias("anchor"), "vec_id", "label", "own", F.lit(None).cast("long").alias("least"))
    none = F.lit(None).cast("array<long>")
    own = own.withColumn("scores", none).withColumn("floors", none)
    both = own.union(routed.select(*own.columns))
    parted = both.repartition("bucket").sortWithinPartitions("bucket", F.col("anchor").asc_nulls_first())
    answer = best_positives if positives else best_negatives

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, bucket = None, [], None
        for batch in batches:
            names = batch.column("bucket").to_pylist()
            visitor = batch.column("anchor").is_valid().to_pylist()
            cuts = [k for k in range(1, len(names)) if names[k] != names[k - 1] or visitor[k] != visitor[k - 1]]
            found = []
            for start, end in zip([0, *cuts], [*cuts, len(names)] if names else []):
                part = batch.slice(start, end - start)
                if names[start] != name:
                    name, held, bucket = names[start], [], None
                if not visitor[start]:
                    held.append(part)
                    continue
                if bucket is None:
                    whole = pa.Table.from_batches(held)
                    lists = whole.column("own").combine_chunks()
                    bucket = Bucket(*_ids(whole), _matrix(lists, int(lists.value_lengths().to_numpy(zero_copy_only=False).max())))
                    held = []
                for row, anchor in zip(part.column("anchor").to_pylist(), _visits(part)):
                    found += [(row, *x) for x in answer(bucket, _fitted(anchor, bucket.own.shape[1]))]
            if found:
                columns = [pa.array(c, pa.int64()) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "slot", "vec_id", "score"])

    return parted.mapInArrow(run, "anchor long, slot long, vec_id long, score long")


def mine(vectors: DataFrame, anchors: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of ``anchors`` among ``vectors``
    (both of ``usable``)."""
    rows = hold(bucketed(vectors), "negatives-rows")
    if rows.isEmpty():
        return vectors.sparkSession.createDataFrame([], MINED)
    sample = sample_bucket(rows)
    length = F.sqrt(F.aggregate("own", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    none = F.lit(None).cast("array<long>")
    own = anchors.select(
        F.xxhash64("vec_id", "label", "own").alias("anchor"), "vec_id", "label", "own", length.alias("length"),
        F.lit(None).cast("long").alias("least"), none.alias("scores"), none.alias("floors"),
    )
    own = hold(first_floors(own, sample), "negatives-anchors")
    nearest = W.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "vec_id")
    positives = visit(rows, own, True).withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= POSITIVES)
    positives = hold(positives.drop("slot"), "negatives-positives")
    listed = positives.where("score >= 0").groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("own_positives"))
    asked = own.drop("scores", "floors", "least").join(listed, "anchor").select(
        "anchor", "vec_id", "label", "own", "length", F.lit(None).cast("long").alias("least"),
        F.col("own_positives.score").alias("scores"), none.alias("floors"),
    )
    asked = hold(first_floors(asked, sample), "negatives-asked")
    ranked = visit(rows, asked, False).withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= NEGATIVES)
    places = F.lit(LAST)
    known = lambda c: F.when(F.col(c) != places, F.col(c))
    pairs = positives.select("anchor", (F.col("place") - 1).cast("long").alias("slot"), known("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        ranked.select("anchor", "slot", "rank", known("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(pairs, ["anchor", "slot"])
        .join(own.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of ``op11_coordinate_pruning``."""
    rows = relabelled(usable(table(spark, sf_dir, "embeddings")))
    return mine(rows, rows.where(F.pmod("vec_id", F.lit(100)) == 0))


ORACLE = """
WITH rows AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS own
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_dot_product(a.own, b.own)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id AND a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""
