"""Near-duplicates by bottom-k sketches from one hash function.

A document is the set of the hashes of its word shingles; its sketch are the ``SKETCH`` smallest of them. Documents link where the
Jaccard similarity of their sets is ``similarity`` or more. Three steps find the links:

1. *Inverted lists of retained values.* Of the ``SKETCH`` smallest hashes of the union of two similar sets, which is a random sample
   of it, ``shared_least()`` are in both sketches but for a chance below ``MISS`` (Chernoff); of sets of few shingles the number is
   exact. So each set is listed under all but that many of its values and ``TOGETHER`` more, in one order of all values: two
   similar sets are together in ``TOGETHER`` lists. Rare values come first in that order (any order may be taken), so common
   passages bring nobody together. A list is of sets of like size, as similar sets are. Lists of at most ``SMALL`` sets give pairs, which are
   counted; a pair that one of the larger lists holds is found there.
2. *Union sketches.* Sets that meet are compared by the share of both in the smallest hashes of their union; what
   misses ``shared_least()`` goes.
3. *Exact Jaccard similarity* on whole sets decides.

Nobody emits the pairs of a large list. The large lists that begin with the same set form a group; first the members are compared with
this first set alone. Groups that do not fall into one component by that are compared again: their members outside the largest component
against all others, in blocks of bounded size, which give back the members that have a possible partner (step 2), then as many links as bring
the members of a block together (step 3). Two sets that meet in several groups are compared in the first of them. A large group of near copies thus costs rows in proportion to its members.

Defined cases: a null text is one without words; a document without words has an empty set and links with nothing; fewer words than
a shingle count as one shingle; equal sets are one in all of this; a null ``doc_id`` takes part and counts after all others when
the smallest is sought; repeated rows are copies; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from transitlake.llm import simhash
from transitlake.llm.common import by_batch, hold, table
from transitlake.llm.components import components
from transitlake.session import is_small

SHINGLE = 2
SIMILARITY = 0.8
SKETCH = 64
# Chance that two sets of exactly the least similarity miss each other.
MISS = 1e-10
SEED = 42
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
# Lists in which similar sets are together, and the members of a list whose pairs are counted.
TOGETHER = 4
SMALL = 16
# Buckets in which values are counted for their order, a power of two.
BUCKETS = 1 << 22
# Members in one side of a block: sketches, whole sets, and shingles of the latter.
BLOCK = 1024
BLOCK_SETS = 256
BLOCK_SHINGLES = 1 << 20
# Texts that are picked by a broadcast of their hashes; more are picked by a shuffle.
PICKED = 1_000_000
# Columns of a block that are multiplied at once, and rows of it that are filtered at once.
SLAB = 2048
STRIP = 128
# Bytes of text that are hashed at once.
PIECE = 1 << 18


_POWER = 0x9E3779B97F4A7C15
_MIX = ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    tables = []
    for base in (_POWER, pow(_POWER, -1, 1 << 64)):
        table = np.full(size, base, np.uint64)
        table[0] = 1
        tables.append(np.multiply.accumulate(table))
    return tables[0], tables[1]


def _mixed(values: np.ndarray) -> np.ndarray:
    for shift, factor in _MIX:
        values ^= values >> np.uint64(shift)
        values *= np.uint64(factor)
    values ^= values >> np.uint64(33)
    return values


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of ``data``; words are what the six ASCII white-space characters part.

    A word is a polynomial of its bytes, read off running sums, so no word is looked at by itself."""
    text = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], (text != 32) & ((text < 9) | (text > 13)), [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    powers, inverses = _powers(1 << max(len(text), 1).bit_length())
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text + np.uint64(1)) * powers[: len(text)], out=sums[1:])
    values = (sums[ends] - sums[starts]) * inverses[starts]
    return _mixed(values + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), starts


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of about ``PIECE`` bytes, cut before white space."""
    start = 0
    while len(text) - start > PIECE:
        cut = _SPACE.search(text, start + PIECE)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def _joined(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes of texts and the number of words of each; short texts are worked on together."""
    group, size = [], 0
    for text in [*texts, None]:
        if group and (text is None or size + len(text) > PIECE):
            hashes, starts = word_hashes(b" ".join(group))
            bounds = np.cumsum([0, *(len(t) + 1 for t in group)])
            yield hashes, np.diff(np.searchsorted(starts, bounds))
            group, size = [], 0
        if text is not None and len(text) > PIECE:
            hashes = np.concatenate([word_hashes(piece)[0] for piece in _pieces(text)])
            yield hashes, np.array([len(hashes)])
        elif text is not None:
            group.append(text)
            size += len(text) + 1


def shingle_sets(texts: list[bytes | None], shingle: int) -> list[np.ndarray]:
    """For each UTF-8 text the hashes of its different shingles, ascending. ``bytes`` lower-cases A-Z alone."""
    out = []
    for words, counts in _joined([(t or b"").lower() for t in texts]):
        mixed = words.copy()
        for k in range(1, shingle):
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(_POWER)
            mixed[: max(0, len(words) - k)] += words[k:]
        mixed = _mixed(mixed)
        at = 0
        for n in counts.tolist():
            if n >= shingle:
                out.append(np.unique(mixed[at : at + n - shingle + 1]))
            else:
                # Fewer words than a shingle: the sequence as a whole, if there is any.
                out.append(np.array([xxhash.xxh64_intdigest(words[at : at + n].tobytes(), SEED)] if n else [], np.uint64))
            at += n
    return out


def shared_least(similarity: float = SIMILARITY, sketch: int = SKETCH) -> int:
    """Values of a union sketch that both sets have, but for a chance of ``MISS``, where their similarity is enough."""

    def tail(share: float) -> float:
        rest = share * math.log(share / similarity) if share else 0.0
        return math.exp(-sketch * (rest + (1 - share) * math.log((1 - share) / (1 - similarity)))) if similarity < 1 else 0.0

    return max((t for t in range(1, sketch + 1) if t < similarity * sketch and tail((t - 1) / sketch) <= MISS), default=1)


def _name(shingles: np.ndarray) -> int:
    return simhash._signed(xxhash.xxh64_intdigest(shingles.astype("<u8").tobytes()))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))


def sketches(docs: DataFrame, shingle: int = SHINGLE, sketch: int = SKETCH) -> DataFrame:
    """(doc_id, text_hash, fp, n, sketch) for every row: name, size and smallest hashes of its set."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text").to_pylist(), shingle)
        found = [
            pa.array([_name(s) for s in sets], pa.int64()),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([s[:sketch].view(np.int64) for s in sets], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), *found], ["doc_id", "text_hash", "fp", "n", "sketch"])

    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    return _texts(docs).mapInArrow(by_batch(make), f"doc_id {kind}, text_hash long, fp long, n long, sketch array<long>")


def frequencies(sets: DataFrame) -> np.ndarray:
    """How common the values of each bucket are among all ``sets``, on a scale of eighths of a power of two: the order of all
    values goes by it. ``BUCKETS`` bytes, whatever the size of the table."""
    counts = sets.select(F.explode("sketch").alias("v")).groupBy(F.col("v").bitwiseAND(F.lit(BUCKETS - 1)).cast("int").alias("bucket"))
    level = F.least(F.lit(255), F.round(8 * F.log2("n"))).cast("short")
    rows = counts.agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", level.alias("level")).toArrow()
    levels = np.zeros(BUCKETS, np.uint8)
    levels[rows.column("bucket").to_numpy()] = rows.column("level").to_numpy()
    return levels


def listed(sets: DataFrame, levels: np.ndarray, similarity: float, sketch: int) -> DataFrame:
    """(v, fp, n, kind): the values under which each set is listed, and the class of its size. Sizes of similar sets differ by the factor
    1 / similarity at most, so their classes by one at most."""
    share, least = Fraction(str(similarity)), shared_least(similarity, sketch)
    step = max(-math.log(float(share)), 1e-6) * (1 + 1e-9)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, sizes = batch.column("fp").to_numpy(), batch.column("n").to_numpy()
        values = [np.zeros(0, np.int64)]
        for n, own in zip(sizes.tolist(), batch.column("sketch")):
            own = own.values.to_numpy()
            # The union of a set with a similar one has at most n / share shingles: where these fit, nothing is left to chance.
            needed = -(-share.numerator * n // share.denominator) if n <= sketch * share else least
            values.append(own[np.lexsort((own, levels[own & (BUCKETS - 1)]))[: len(own) - needed + TOGETHER]])
        counts = [len(v) for v in values[1:]]
        # One bit of a long for each class; the last takes all sets beyond.
        kinds = np.minimum(np.floor(np.log(np.maximum(sizes, 1)) / step), 61).astype(np.int32)
        columns = [np.concatenate(values), np.repeat(names, counts), np.repeat(sizes, counts), np.repeat(kinds, counts)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["v", "fp", "n", "kind"])

    return sets.select("fp", "n", "sketch").mapInArrow(by_batch(make), "v long, fp long, n long, kind int")


def lists(values: DataFrame) -> DataFrame:
    """(v, kind, fp, n, home, size): the lists with more than one set. A list holds the sets of a value and of a class of sizes, and
    as guests those of the class below.

    Counts go ahead of the rows: a value that one set has, or sets of sizes far apart only, moves no further."""
    own = F.expr("shiftleft(1L, kind)")
    counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("all"), F.bit_or(own).alias("kinds"))
    # Two sets of one class, or of neighbouring ones.
    twice, near = F.col("all") > F.bit_count("kinds"), F.expr("kinds & shiftleft(kinds, 1)") != 0
    counts = counts.where((F.col("all") > 1) & (twice | near))
    met = values.join(counts, "v").where(twice | (F.expr("kinds & (shiftleft(1L, kind + 1) | shiftrightunsigned(shiftleft(1L, kind), 1))") != 0))
    places = F.array(F.struct("kind", F.lit(True).alias("home")), F.struct((F.col("kind") + 1).alias("kind"), F.lit(False).alias("home")))
    placed = met.select("v", "fp", "n", F.explode(places).alias("place")).select("v", "place.kind", "fp", "n", "place.home")
    stats = placed.groupBy("v", "kind").agg(F.count(F.lit(1)).alias("size"), F.bool_or("home").alias("used"))
    return placed.join(stats.where("size > 1 AND used").drop("used"), ["v", "kind"])


def _alike(a: Column, b: Column, share: Fraction) -> Column:
    """Whether sets of these sizes can be similar."""
    return F.least(a, b) * share.denominator >= F.greatest(a, b) * share.numerator


def counted_pairs(small: DataFrame, share: Fraction) -> DataFrame:
    """(f, fp): sets that are together in as many lists of at most ``SMALL`` members as similar sets are."""
    members = small.groupBy("v", "kind").agg(F.collect_list(F.struct("fp", "n", "home")).alias("m"))

    def beside(x: Column) -> Column:
        others = F.filter("m", lambda y: (y["fp"] > x["fp"]) & (x["home"] | y["home"]) & _alike(x["n"], y["n"], share))
        return F.transform(others, lambda y: F.struct(x["fp"].alias("f"), y["fp"].alias("fp"), F.greatest(x["n"], y["n"]).alias("n")))

    pairs = members.select(F.explode(F.flatten(F.transform("m", beside))).alias("p")).groupBy("p.f", "p.fp").agg(
        F.count(F.lit(1)).alias("together"), F.max("p.n").alias("n")
    )
    # Sets of few shingles have no more than those in common.
    needed = F.least(F.lit(TOGETHER), F.ceil(F.col("n") * float(share) * (1 - 1e-9)))
    return pairs.where(F.col("together") >= needed).select("f", "fp")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (f, i, j) of sorted batches."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy() for k in ("f", "i", "j")])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            key = tuple(keys[:, start].tolist())
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and ends of a column of lists."""
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False), np.cumsum(flat.value_lengths().to_numpy(zero_copy_only=False))


def overlaps(values: np.ndarray, owner: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common values of the sets of rows ``left`` with those of rows ``right``; ``owner`` is the row of each value."""
    _, place, counts = np.unique(values, return_inverse=True, return_counts=True)
    again = counts > 1
    place, owner = (np.cumsum(again) - 1)[place][again[place]], owner[again[place]]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    width, height = int(again.sum()), int(max(left.max(), right.max())) + 1
    total = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, width, SLAB):
        inside = slice(*np.searchsorted(place, (start, start + SLAB)))
        cells = np.zeros((height, min(SLAB, width - start)), np.float32)
        cells[owner[inside], place[inside] - start] = 1
        # Whole numbers up to SLAB, which are exact.
        np.add(total, cells[left] @ cells[right].T, out=total, casting="unsafe")
    return total


def union_share(a: np.ndarray, b: np.ndarray, sketch: int) -> tuple[int, int]:
    """Of the ``sketch`` smallest of the union of two sketches: how many are in both, and how many there are."""
    union = np.union1d(a, b)[:sketch]
    return int(np.isin(np.intersect1d(a, b), union).sum()), len(union)


def _blocks(groups: DataFrame, data: DataFrame, parts: Callable[[Column], Column]) -> DataFrame:
    """Members (f, fp, root, left, hubs) with their ``data`` (fp, n, own), dealt to blocks (f, i, j): side 0 are members to compare,
    side 1 all members. ``hubs`` are all groups of a member. ``parts`` tells from the members of a side, and ``n`` of each, into how many parts it goes."""
    rows = groups.join(data.select("fp", "n"), "fp")
    sizes = rows.groupBy("f").agg(parts(F.col("left")).alias("ni"), parts(F.lit(True)).alias("nj"))
    rows = groups.join(sizes, "f").withColumn("dealt", F.xxhash64("fp"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    compared = rows.where("left").select("f", F.pmod("dealt", "ni").alias("i"), every("nj").alias("j"), F.lit(0).alias("side"), "fp", "root", "hubs")
    others = rows.select("f", every("ni").alias("i"), F.pmod("dealt", "nj").alias("j"), F.lit(1).alias("side"), "fp", "root", "hubs")
    # The data come last: only the blocks are dealt with them.
    return compared.union(others).join(data, "fp").repartition("f", "i", "j").sortWithinPartitions("f", "i", "j", "side")


class _Sides:
    """A block: its rows, those to compare (``left``) and all members of the part (``right``)."""

    def __init__(self, group: pa.Table) -> None:
        self.fp, self.root, self.n, side = (group.column(c).to_numpy() for c in ("fp", "root", "n", "side"))
        self.left, self.right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        self.values, self.ends = _lists(group.column("own"))
        self.group = group.column("f")[0].as_py()
        self.hubs = group.column("hubs")

    def common(self) -> np.ndarray:
        """Values in common, of each row to compare with each member."""
        return overlaps(self.values, _owner(self.ends), self.left, self.right)

    def due(self) -> np.ndarray:
        """Pairs to be compared here: of two components, and not together in a group with a smaller name, which compares them."""
        other = self.root[self.left][:, None] != self.root[self.right][None, :]
        hubs, ends = _lists(self.hubs)
        before = hubs < self.group
        if before.any():
            other &= overlaps(hubs[before], _owner(ends)[before], self.left, self.right) == 0
        return other


def _owner(ends: np.ndarray) -> np.ndarray:
    """Row of each value of lists that end at ``ends``."""
    return np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))


def possible(groups: DataFrame, sets: DataFrame, similarity: float, sketch: int) -> DataFrame:
    """(f, fp) of the members that have a partner in another component by the union sketches. Of the values the upper
    half is looked at, which keeps their order."""
    share, least = Fraction(str(similarity)), shared_least(similarity, sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            block = _Sides(group)
            fp, n, right, values, ends = block.fp, block.n, block.right, block.values, block.ends
            if not len(block.left) or not (whole_due := block.due()).any():
                continue
            starts, lengths = np.concatenate([[0], ends[:-1]]), np.diff(ends, prepend=0)
            whole_common = block.common()
            found = np.zeros(len(fp), bool)
            for start in range(0, len(block.left), STRIP):
                left, due, common = (rows[start : start + STRIP] for rows in (block.left, whole_due, whole_common))
                low, high = np.minimum(n[left][:, None], n[right][None, :]), np.maximum(n[left][:, None], n[right][None, :])
                union = np.minimum(sketch, lengths[left][:, None] + lengths[right][None, :] - common)
                maybe = due & (low * share.denominator >= high * share.numerator) & (common * sketch >= least * union)
                for x in np.flatnonzero(maybe.any(1)).tolist():
                    a = left[x]
                    for y in np.flatnonzero(maybe[x]).tolist():
                        b = right[y]
                        if found[a] and found[b]:
                            continue
                        both, size = union_share(values[starts[a] : ends[a]], values[starts[b] : ends[b]], sketch)
                        if both * sketch >= least * size:
                            found[a] = found[b] = True
            if found.any():
                names = np.unique(fp[found])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(names), block.group, np.int64)), pa.array(names)], ["f", "fp"])

    # Shifted into the range of int.
    upper = F.transform("sketch", lambda v: (F.shiftrightunsigned(v, 32) - (1 << 31)).cast("int"))
    blocks = _blocks(groups, sets.select("fp", "n", upper.alias("own")), lambda use: F.greatest(F.lit(1), F.ceil(F.count(F.when(use, 1)) / BLOCK)).cast("long"))
    return blocks.mapInArrow(run, "f long, fp long").distinct()


def joining(fp: np.ndarray, root: np.ndarray, left: np.ndarray, right: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Of the links between rows ``left`` and ``right`` as many as bring the same components together: fewer than there are rows."""
    label = np.unique(root, return_inverse=True)[1]
    pairs = []
    for x in np.flatnonzero(linked.any(1)).tolist():
        a, ys = left[x], right[np.flatnonzero(linked[x])]
        for found, first in zip(*np.unique(label[ys], return_index=True)):
            if found != label[a]:
                pairs.append((fp[a], fp[ys[first]]))
                label[label == found] = label[a]
    return pairs


def similar(groups: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(a, b): members with similar whole sets, as many of a block as bring together what they connect. ``groups`` has ``text_hash``, which names a text of the set."""
    share = Fraction(str(similarity))
    p, q = share.numerator, share.denominator

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text").to_pylist(), shingle)
        columns = [pa.array([_name(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64())]
        return pa.RecordBatch.from_arrays([*columns, pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["fp", "n", "own"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            block = _Sides(group)
            fp, root, n, left, right = block.fp, block.root, block.n, block.left, block.right
            if not len(left) or not (due := block.due()).any():
                continue
            common = block.common()
            linked = due & (common * (p + q) >= p * (n[left][:, None] + n[right][None, :]))
            pairs = joining(fp, root, left, right, linked)
            if pairs:
                a, b = np.array(pairs, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    wanted = groups.select("text_hash").distinct()
    # One text names a set, so sets come out once.
    picked = F.broadcast(wanted) if is_small(wanted, PICKED) else wanted
    texts = _texts(docs).join(picked, "text_hash", "left_semi").dropDuplicates(["text_hash"])
    sets = hold(texts.select("text").mapInArrow(by_batch(make), "fp long, n long, own array<long>"), "minhash-sets")

    def parts(use: Column) -> Column:
        shingles = F.sum(F.when(use, F.col("n")).otherwise(0))
        return F.greatest(F.lit(1), F.ceil(F.count(F.when(use, 1)) / BLOCK_SETS), F.ceil(shingles / BLOCK_SHINGLES)).cast("long")

    return _blocks(groups.select("f", "fp", "root", "left", "hubs"), sets, parts).mapInArrow(run, "a long, b long")


def links(docs: DataFrame, rows: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, sketch: int = SKETCH) -> DataFrame:
    """(a, b) between sets of ``rows`` (of ``sketches``): similar sets are linked directly or over similar ones."""
    sets = rows.where("n > 0").groupBy("fp").agg(F.min("n").alias("n"), F.min("text_hash").alias("text_hash"), F.first("sketch").alias("sketch"))
    sets = hold(sets, "minhash-names")
    share = Fraction(str(similarity))
    found = hold(lists(listed(sets, frequencies(sets), similarity, sketch)), "minhash-lists")
    pairs = counted_pairs(found.where(F.col("size") <= SMALL), share)
    # A large list begins with the set that is in most of them: the one that a crowd of near copies is around.
    large = found.where(F.col("size") > SMALL)
    large = hold(large.join(large.groupBy("fp").agg(F.count(F.lit(1)).alias("weight")), "fp"), "minhash-large")
    first = F.max(F.struct("weight", "fp", "n")).alias("first")
    members = large.join(large.groupBy("v", "kind").agg(first), ["v", "kind"]).where(F.col("fp") != F.col("first.fp"))
    near = F.max(_alike(F.col("n"), F.col("first.n"), share)).alias("near")
    members = hold(members.groupBy(F.col("first.fp").alias("f"), "fp").agg(near, F.max("first.weight").alias("weight")), "minhash-groups")

    def compared(groups: DataFrame) -> DataFrame:
        maybe = possible(groups, sets, similarity, sketch)
        # A member without any possible partner is out; the first set of a group stays with those it may be similar to.
        chosen = groups.join(maybe, ["f", "fp"], "left_semi").join(sets.select("fp", "text_hash"), "fp")
        return similar(hold(chosen, "minhash-possible"), docs, shingle, similarity)

    def with_first(rows: DataFrame) -> DataFrame:
        return rows.union(rows.select("f", F.col("f").alias("fp")).distinct())

    # A member of several groups is compared with one first set: that is enough to bring a crowd together.
    with_one = members.where("near").groupBy("fp").agg(F.max_by("f", F.struct("weight", "f")).alias("f")).select("f", "fp")
    star = with_first(hold(pairs.union(with_one).distinct(), "minhash-pairs"))
    none = F.array().cast("array<long>").alias("hubs")
    star = star.select("f", "fp", F.col("fp").alias("root"), (F.col("fp") == F.col("f")).alias("left"), none)
    near_links = hold(compared(star).distinct(), "minhash-links")

    # Of the large lists, what the first sets have not brought together is compared across components.
    roots = hold(components(near_links, "minhash-stars"), "minhash-roots")
    rooted = with_first(members.select("f", "fp")).join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("f", "fp", F.coalesce("root", "fp").alias("root"))
    rooted = hold(rooted, "minhash-rooted")
    per_root = rooted.groupBy("f", "root").agg(F.count(F.lit(1)).alias("n"))
    per_group = per_root.groupBy("f").agg(F.max(F.struct("n", "root")).alias("base"), F.count(F.lit(1)).alias("roots"), F.sum("n").alias("size"))
    mixed = per_group.where("roots > 1 and size > 2").select("f", F.col("base.root").alias("base"))
    # No set is in more lists than its sketch has values, twice.
    hubs = rooted.groupBy("fp").agg(F.collect_set("f").alias("hubs"))
    parted = rooted.join(mixed, "f").join(hubs, "fp").select("f", "fp", "root", (F.col("root") != F.col("base")).alias("left"), "hubs")
    across = hold(compared(hold(parted, "minhash-parted")).distinct(), "minhash-across")
    return near_links.union(across)


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, sketch: int = SKETCH, empty_alike: bool = False
) -> DataFrame:
    """(doc_id, text_hash, fp, n, component_id, keeper) for every row of ``docs`` (doc_id, text). Texts without words are alone, or, with
    ``empty_alike``, copies of each other."""
    rows = hold(sketches(docs, shingle, sketch), "minhash-docs")
    some = rows if empty_alike else rows.where("n > 0")
    found = simhash.classes(some.select("doc_id", "text_hash", "fp"), links(docs, rows, shingle, similarity, sketch))
    sizes = rows.groupBy("fp").agg(F.min("n").alias("n"))
    found = found.join(sizes, "fp").select("doc_id", "text_hash", "fp", "n", "component_id", "keeper")
    if empty_alike:
        return found
    alone = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    empty = rows.where("n = 0").select("doc_id", "text_hash", "fp", "n", F.col("doc_id").alias("component_id"), alone.alias("keeper"))
    return found.union(empty)


def keep_one(docs: DataFrame, shingle: int = 5, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each component, chosen as in ``simhash.keep_one``; by default of five-word shingles. Of the texts without
    words one stays."""
    return simhash.kept(docs, near_duplicates(docs, shingle, similarity, empty_alike=True))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of ``op13_bottom_k``; a null id is kept where its component has null ids only."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


ORACLE = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) > 1 THEN list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))
    ELSE coalesce(words, []) END AS shingles
  FROM split
), items AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS s FROM sets
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM items x JOIN items y ON x.s = y.s AND x.doc_id <> y.doc_id AND 10 * x.n >= 8 * y.n AND 10 * y.n >= 8 * x.n
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT a, min(b) AS component_id FROM reached GROUP BY a) AS c ON c.a = doc_id
"""
