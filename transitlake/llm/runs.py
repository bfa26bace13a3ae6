"""Periodic run detection by descending-LCP Kruskal.

A run is a stretch of consecutive words with smallest period q, at least ``max(LEAST, 2 * q)`` words long, that no
neighbouring word extends. Two suffixes that start q words apart in a run share a common prefix (LCP) of ``length - q >= q``
words, so only positions matter whose next ``LEAST // 2`` words come again. Their suffixes are sorted, and the neighbours in
that order are united in order of falling LCP: union-find over classes that keep their positions sorted. A union moves the smaller
class into the larger one; the positions that thereby become neighbours have exactly the LCP of that union. Neighbours at a
distance d of at most that LCP seed a run of period d; the seed at the first word of the run, where the words before the two
differ, is the run itself with its whole length.

Why that is all of them: were there a third position of the class between the first word s of a run and s + q, the periods q
and a smaller one would both hold over more than their sum of words, and q were not the smallest (Fine and Wilf). By the same
argument a seed never has a multiple of the smallest period.

A text is worked on as a whole in one task, in time O(n log^2 n) and memory O(n log n) of its words; there is no shuffle.

Defined cases: a null text has no words; a null id leaves a text as it is in ``altered``; repeated rows are answered each; an
empty table gives an empty result; other columns of the input, whatever their names, pass ``collapse`` and are not looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from transitlake.llm.common import by_batch, table

LEAST = 12
# Positions in one piece of a sorted class.
PIECE = 512

RUN = "start:long,length:long,period:long"


class Positions:
    """A sorted set of positions in pieces, so that adding one costs no more than a piece."""

    __slots__ = ("heads", "pieces", "size")

    def __init__(self, position: int) -> None:
        self.pieces, self.heads, self.size = [[position]], [position], 1

    def add(self, position: int) -> tuple[int, int]:
        """Add ``position``; returns its neighbours, -1 where there is none."""
        pieces, heads = self.pieces, self.heads
        k = max(0, bisect_left(heads, position) - 1)
        piece = pieces[k]
        at = bisect_left(piece, position)
        before = piece[at - 1] if at else (pieces[k - 1][-1] if k else -1)
        after = piece[at] if at < len(piece) else (heads[k + 1] if k + 1 < len(heads) else -1)
        piece.insert(at, position)
        heads[k] = piece[0]
        self.size += 1
        if len(piece) > 2 * PIECE:
            pieces.insert(k + 1, piece[PIECE:])
            heads.insert(k + 1, piece[PIECE])
            del piece[PIECE:]
        return before, after

    def __iter__(self):
        for piece in self.pieces:
            yield from piece


def _ranks(words: np.ndarray, least: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Positions whose next ``least`` words come again, their order as suffixes, and for each neighbouring pair of that
    order the LCP: prefix doubling, with the ranks of each power of two kept to add the LCP up."""
    n = len(words)
    levels, size = [words.astype(np.int64)], 1

    def paired(first: np.ndarray, ahead: int, second: np.ndarray) -> np.ndarray:
        """Rank of ``first`` here and ``second`` ``ahead`` words on; behind the end counts as smallest."""
        behind = np.zeros(n, np.int64)
        behind[: n - ahead] = second[ahead:] + 1
        return np.unique(first * (n + 2) + behind, return_inverse=True)[1]

    while 2 * size <= least:
        levels.append(paired(levels[-1], size, levels[-1]))
        size *= 2
    # The next ``least`` words in two overlapping powers of two.
    window = paired(levels[-1], least - size, levels[-1]) if size < least else levels[-1]
    counts = np.bincount(window[: n - least + 1])
    at = np.flatnonzero(counts[window[: n - least + 1]] > 1)
    if not len(at):
        return at, levels, at
    while size < n and len(np.unique(levels[-1][at])) < len(at):
        levels.append(paired(levels[-1], size, levels[-1]))
        size *= 2
    order = at[np.argsort(levels[-1][at], kind="stable")]
    left, right = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(len(left), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = np.flatnonzero((left + (1 << k) <= n) & (right + (1 << k) <= n))
        same = inside[levels[k][left[inside]] == levels[k][right[inside]]]
        for x in (left, right, lcp):
            x[same] += 1 << k
    return order, levels, lcp


def find_runs(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words`` (numbers below their count), by start, then period."""
    half = -(-least // 2)
    if len(words) < least:
        return []
    order, _, lcp = _ranks(words, half)
    wanted = np.flatnonzero(lcp >= half)
    wanted = wanted[np.argsort(-lcp[wanted], kind="stable")]
    words = words.tolist()
    suffix = order.tolist()
    parent = list(range(len(suffix)))
    classes: list[Positions | None] = [None] * len(suffix)
    found = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def seed(i: int, j: int, common: int) -> None:
        """``i`` and ``j`` have become neighbours: a run, if the distance fits and ``i`` is its first word."""
        d = j - i
        if d <= common and d + common >= least and (not i or words[i - 1] != words[j - 1]):
            found.append((i, d + common, d))

    for edge, common in zip(wanted.tolist(), lcp[wanted].tolist()):
        a, b = root(edge), root(edge + 1)
        small, large = classes[a] or Positions(suffix[a]), classes[b] or Positions(suffix[b])
        if small.size > large.size:
            small, large, a, b = large, small, b, a
        parent[a], classes[a], classes[b] = b, None, large
        # Pairs of one position of each class with none between them.
        last = behind = -1
        for x in small:
            before, after = large.add(x)
            if -1 < behind < x:
                seed(last, behind, common)
            if -1 < before != last:
                seed(before, x, common)
            last, behind = x, after
        if behind > -1:
            seed(last, behind, common)
    return sorted(found, key=lambda run: (run[0], run[2]))


def numbered(words: list[bytes]) -> np.ndarray:
    """Each word as the number of its first place among the different words."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def altered(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """``words`` of one row in ten made periodic from some word on, as the contract of the query asks."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a : a + p]
    return words[:a] + (block * (-(-(n - a) // p)))[: n - a]


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each of ``n`` words stays: those of a run after its first period go."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:n]) == 0


def detect(docs: DataFrame, alter: bool = False, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs`` (doc_id, text): all runs by start, then period, and the
    kept words joined by one space. Words are what six ASCII white-space characters part."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, runs, collapsed = [], [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            words = (text or b"").split()
            if alter:
                words = altered(words, doc_id)
            own = find_runs(numbered(words), least)
            if own:
                words_left = [w for w, keep in zip(words, kept_words(len(words), own).tolist()) if keep]
            else:
                words_left = words
            sizes.append(len(words))
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
            collapsed.append(b" ".join(words_left))
        fields = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        columns = [pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(fields)), pa.array(collapsed, pa.binary())]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    slim = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    found = slim.mapInArrow(by_batch(make), f"doc_id {kind}, n_words long, runs array<struct<{RUN}>>, collapsed binary")
    return found.select("doc_id", "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def collapse(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` with every run of a text cut to its first period; texts without a run stay as they are, byte for byte."""
    schema = docs.select(*[F.col(f"`{c}`") for c in docs.columns]).schema

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index("text")
        texts = batch.column(at).to_pylist()
        for k, text in enumerate(texts):
            words = (text or "").encode().split()
            if own := find_runs(numbered(words), least):
                texts[k] = b" ".join(w for w, keep in zip(words, kept_words(len(words), own).tolist()) if keep).decode()
        columns = batch.columns
        columns[at] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(by_batch(cut), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of ``op12_descending_lcp``."""
    found = detect(table(spark, sf_dir, "documents"), alter=True)
    # Greatest length, then smallest start, then smallest period.
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    best = F.array_min(order)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), line.alias("lines"), "collapsed").select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.lit(-1000) * F.col("best.less") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat_ws("", "lines"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# Words that repeat at a distance q by equal stretches of six words, then islands of such places: every run, with each of its
# periods; the smallest counts. CRC-32 of the id byte by byte and bit by bit.
ORACLE = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM documents
), seeded AS (
  SELECT doc_id, coalesce(words, []) AS words, coalesce(len(words), 0) AS n,
    xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::UBIGINT),
      lambda crc, b: list_reduce([xor(crc, b)] || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0],
        lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))),
      4294967295::UBIGINT)::BIGINT AS h
  FROM split
), planned AS (
  SELECT *, (h // 10) % greatest(n, 1) AS a, 3 + (h // 10) % 8 AS parts FROM seeded
), texts AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
      THEN list_transform(range(n), lambda i: words[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END + 1])
      ELSE words END AS words
  FROM planned
), placed AS (
  SELECT doc_id, n, i, array_to_string(words[i + 1 : i + 6], ' ') AS six FROM texts, unnest(range(n - 5)) AS u(i)
), again AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, six) AS times FROM placed
), pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM again x JOIN again y ON x.doc_id = y.doc_id AND x.six = y.six AND x.i < y.i
  WHERE x.times > 1 AND y.times > 1
), islands AS (
  SELECT doc_id, q, min(i) AS start, count(*) + 5 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
  GROUP BY doc_id, q, island
), runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM islands WHERE length >= greatest(12, 2 * q) GROUP BY doc_id, start, length
), listed AS (
  SELECT doc_id, count(*) AS n_runs, min((-length, start, period)) AS best,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id
), dropped AS (
  SELECT DISTINCT doc_id, i FROM runs, unnest(range(start + period, start + length)) AS u(i)
), left_over AS (
  SELECT t.doc_id, string_agg(t.words[u.i + 1], ' ' ORDER BY u.i) AS collapsed
  FROM texts t CROSS JOIN LATERAL unnest(range(t.n)) AS u(i) LEFT JOIN dropped d ON d.doc_id = t.doc_id AND d.i = u.i
  WHERE d.i IS NULL GROUP BY t.doc_id
)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, best[2]::BIGINT AS start, (-best[1])::BIGINT AS length, best[3]::BIGINT AS period,
  ((-1000 * best[1]) // best[3])::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM texts t LEFT JOIN listed USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""
