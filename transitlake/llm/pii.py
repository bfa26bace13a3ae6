"""Personal data: overlapping candidates of high recall, chosen by boosted trees. DataFrame functions only.

Generators propose spans. The four base kinds come with a check (octets, Luhn, number of digits); spans
that pass it are always redacted. Two further generators propose e-mail addresses in words and phone numbers
without a country code. Every candidate has format and context features of small range. All candidates of
all documents are counted by their features; a few boosted trees are fitted to the counts (weak labels: the
check for base kinds; brackets or a telling word before it for the others) and become one SQL expression. For each
generator the threshold is the lowest at which held-out candidates above it are right in ``PRECISION`` of all cases.

Positions are code points. They come from the gaps between matches, so the cost of a text is linear in its length.

Defined cases: null and empty texts have no spans; a text of one long run of letters or digits costs no more than another (patterns
never retry inside a run and never recurse); repeated rows count each for themselves; an empty table gives an empty result. Other columns
of the input are not looked at.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from transitlake.llm.common import let, table

KINDS = ("email", "ip", "card", "phone")
# Runs are taken whole (possessive) and start where a run or the search starts.
_LOCAL = "[A-Za-z0-9._%+-]"
GENERATORS = (
    ("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++", "@"),
    ("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)", "."),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", ""),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    (
        "email",
        r"(?<![A-Za-z0-9])[A-Za-z0-9._+-]{1,64}+ ?[\[( ](?:at|AT)[\]) ] ?[A-Za-z0-9-]{1,63}+ ?[\[( ](?:dot|DOT)[\]) ] ?[A-Za-z]{2,24}+",
        "",
    ),
    ("phone", r"(?<![0-9+.-])\(?[0-9]{2,5}\)?[ .-][0-9]{2,4}[ .-][0-9]{3,5}(?![0-9.-])", ""),
)
BASE = 4
CONTEXT = 24
# Telling words before a span, by kind.
TELLING = ("mail|contact|write", r"\bip\b|host|server|addr", "card|visa|credit|iban|account", "phone|tel|call|mobile|fax|whatsapp")
FEATURES = ("generator", "digits", "separators", "groups", "passes", "context", "left", "right", "size")
TREES = 24
RATE = 0.3
PRECISION = 0.95
LEAST_SUPPORT = 20.0
_CHUNK = 64


def _running_sum(values: Column) -> Column:
    """Sums of the first 1, 2, ... values, by chunks: about 64 steps for each value."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def within(v: Column) -> Column:
        chunks = F.transform(
            F.sequence(F.lit(0), ((F.size(v) - 1) / _CHUNK).cast("int")),
            lambda b: total(F.slice(v, b * _CHUNK + 1, F.lit(_CHUNK))),
        )

        def before(c: Column) -> Column:
            starts = F.transform(F.sequence(F.lit(0), F.size(c) - 1), lambda b: total(F.slice(c, F.lit(1), b)))
            return let(
                starts,
                lambda s: F.transform(
                    v,
                    lambda _, i: s[(i / _CHUNK).cast("int")]
                    + total(F.slice(v, (i / _CHUNK).cast("int") * _CHUNK + 1, i % _CHUNK + 1)),
                ),
            )

        return let(chunks, before)

    return let(values, within)


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substring(digits, F.length(digits) - i, F.lit(1))) - 48
        twice = digit * 2
        return total + F.when(i % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _count(text: Column, letters: str) -> Column:
    """Characters of ``text`` that are in the class ``letters``."""
    return F.length(F.regexp_replace(text, f"[^{letters}]", ""))


def _check(n: int, match: Column, digits: Column) -> Column:
    kind = GENERATORS[n][0]
    if n == 1:
        parts = F.split(match, r"\.")
        return F.forall(parts, lambda p: F.coalesce(p.try_cast("bigint") <= 255, F.lit(False)))
    if n == 2:
        return F.length(digits).between(12, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _candidate(n: int, match: Column, before: Column, after: Column, start: Column) -> Column:
    """Span, weak label and features, whose ranges are small."""
    kind = GENERATORS[n][0]
    near = F.lower(F.substring(before, F.greatest(F.length(before) - (CONTEXT - 1), F.lit(1)), F.lit(CONTEXT)))
    edge = lambda c: F.when(c == "", 0).when(c.rlike(r"\s"), 0).when(c.rlike(r"[\p{L}\p{N}]"), 1).otherwise(2)
    telling = F.coalesce(
        *[F.when(near.rlike(TELLING[k]), F.lit(k + 1)) for k in [KINDS.index(kind), *range(len(KINDS))]], F.lit(0)
    )

    def of(digits: Column) -> Column:
        passes = _check(n, match, digits)
        strong = match.rlike(r"[\[(](?:at|AT)[\])]") if kind == "email" else passes & (telling == KINDS.index(kind) + 1)
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            start.alias("start"),
            (start + F.length(match)).alias("end"),
            (passes if n < BASE else F.lit(False)).alias("base"),
            (passes if n < BASE else strong).alias("label"),
            F.lit(n).alias("generator"),
            F.least(F.length(digits), F.lit(20)).alias("digits"),
            F.least(_count(match, r"\x20().,-"), F.lit(6)).alias("separators"),
            F.least(F.size(F.split(match, r"[^0-9]+")), F.lit(7)).alias("groups"),
            passes.cast("int").alias("passes"),
            telling.alias("context"),
            edge(F.substring(before, -1, 1)).alias("left"),
            edge(F.substring(after, 1, 1)).alias("right"),
            F.least((F.length(match) / 4).cast("int"), F.lit(10)).alias("size"),
        )

    return let(F.regexp_replace(match, "[^0-9]", ""), of)


def candidates(text: Column) -> Column:
    """All candidates of ``text`` (not null), an array."""
    parts = []
    for n, (_, pattern, mark) in enumerate(GENERATORS):
        found = lambda p=pattern: F.regexp_extract_all(text, F.lit(p), 0)

        def with_gaps(matches: Column, n: int = n, pattern: str = pattern) -> Column:
            def spans(gaps: Column) -> Column:
                steps = F.transform(
                    matches, lambda m, i: F.length(gaps[i]) + F.when(i > 0, F.length(matches[i - 1])).otherwise(0)
                )
                return let(
                    _running_sum(steps),
                    lambda starts: F.transform(matches, lambda m, i: _candidate(n, m, gaps[i], gaps[i + 1], starts[i])),
                )

            return F.when(F.size(matches) > 0, let(F.split(text, pattern, -1), spans))

        likely = F.contains(text, F.lit(mark)) if mark else text.rlike("[0-9]") if n != 4 else text.rlike("(?:dot|DOT)[\\]) ]")
        parts.append(F.when(likely, let(found(), with_gaps)))
    kind = (
        "array<struct<kind:int,start:int,end:int,base:boolean,label:boolean,generator:int,digits:int,separators:int,"
        "groups:int,passes:int,context:int,left:int,right:int,size:int>>"
    )
    return F.concat(*[F.coalesce(p.cast(kind), F.array().cast(kind)) for p in parts])


@dataclass
class Model:
    """Trees as (feature, cut, feature, cut, four values), and a threshold for each generator."""

    start: float
    trees: list[tuple]
    thresholds: list[float]


def _best_split(bins: np.ndarray, slope: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> tuple:
    best = (0.0, 0, -1)
    whole = slope[rows].sum() ** 2 / (weight[rows].sum() + 1.0)
    for f in range(bins.shape[1]):
        for cut in np.unique(bins[rows, f])[:-1]:
            low = rows & (bins[:, f] <= cut)
            high = rows & ~low
            gain = sum(slope[s].sum() ** 2 / (weight[s].sum() + 1.0) for s in (low, high)) - whole
            if gain > best[0] + 1e-9:
                best = (gain, f, int(cut))
    return best[1:]


def boost(bins: np.ndarray, yes: np.ndarray, n: np.ndarray) -> tuple[float, list[tuple]]:
    """Trees of two levels for counted feature rows (``yes`` of ``n`` are right), by Newton steps."""
    start = math.log((yes.sum() + 1.0) / (n.sum() - yes.sum() + 1.0))
    score, trees = np.full(len(n), start), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        slope, weight = yes - n * p, n * p * (1 - p) + 1e-6
        f, cut = _best_split(bins, slope, weight, np.ones(len(n), bool))
        if cut < 0:
            break
        leaves, sides = [], []
        for side in (bins[:, f] <= cut, bins[:, f] > cut):
            g, inner = _best_split(bins, slope, weight, side)
            low = side & (bins[:, g] <= inner)
            for part in (low, side & ~low):
                value = RATE * float(slope[part].sum() / (weight[part].sum() + 1.0))
                leaves.append(value)
                score[part] += value
            sides.append((g, inner))
        trees.append((f, cut, *sides, *leaves))
    return start, trees


def _predict(bins: np.ndarray, start: float, trees: list[tuple]) -> np.ndarray:
    score = np.full(len(bins), start)
    for f, cut, (g, gc), (h, hc), a, b, c, d in trees:
        low = bins[:, f] <= cut
        score += np.where(low, np.where(bins[:, g] <= gc, a, b), np.where(bins[:, h] <= hc, c, d))
    return score


def fit(docs: DataFrame) -> Model:
    """The model from all candidates of ``docs``; the driver holds one row for each combination of feature
    values, which the ranges of the features bound."""
    counted = (
        docs.select(F.explode(candidates(F.coalesce(F.col("text"), F.lit("")))).alias("c"))
        .groupBy(*[F.col(f"c.{f}").alias(f) for f in FEATURES])
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("c.label").cast("long")).alias("yes"))
        .collect()
    )
    if not counted:
        return Model(0.0, [], [math.inf] * len(GENERATORS))
    rows = sorted(counted)
    bins = np.array([[r[f] for f in FEATURES] for r in rows])
    n, yes = (np.array([float(r[k]) for r in rows]) for k in ("n", "yes"))
    # Combinations are dealt by their values; a quarter is held out for the thresholds.
    held = np.array([zlib.crc32(repr(b.tolist()).encode()) % 4 == 0 for b in bins])
    train = ~held if (~held).any() else held
    start, trees = boost(bins[train], yes[train], n[train])
    score = _predict(bins, start, trees)
    thresholds = []
    for g in range(len(GENERATORS)):
        own = np.flatnonzero((bins[:, 0] == g) & held)
        order = own[np.argsort(-score[own], kind="stable")]
        hits, seen = np.cumsum(yes[order]), np.cumsum(n[order])
        good = np.flatnonzero((hits >= PRECISION * seen) & (seen >= LEAST_SUPPORT))
        thresholds.append(float(score[order[good[-1]]]) if len(good) else math.inf)
    return Model(start, trees, thresholds)


def _chosen(c: Column, model: Model) -> Column:
    """Whether the trees take candidate ``c``; a failed check of a base kind is never taken."""
    total = F.lit(model.start)
    for f, cut, (g, gc), (h, hc), a, b, x, y in model.trees:
        low = F.when(c[FEATURES[g]] <= gc, a).otherwise(b)
        high = F.when(c[FEATURES[h]] <= hc, x).otherwise(y)
        total = total + F.when(c[FEATURES[f]] <= cut, low).otherwise(high)
    limit = F.element_at(F.array(*[F.lit(min(t, 1e30)) for t in model.thresholds]), c["generator"] + 1)
    return (c["passes"] == 1) & (c["generator"] >= BASE) & (total >= limit)


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            F.array_sort(F.array_distinct(spans)),
            lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def _bare(spans: Column) -> Column:
    return F.transform(spans, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))


def find(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text, found): ``found`` has the base spans and all spans, as arrays."""

    def both(c: Column) -> Column:
        return F.struct(
            _bare(F.filter(c, lambda x: x["base"])).alias("base"),
            _bare(F.filter(c, lambda x: x["base"] | _chosen(x, model))).alias("all"),
        )

    return docs.select("doc_id", "text", let(candidates(F.coalesce(F.col("text"), F.lit(""))), both).alias("found"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of ``op6_boosted_pii``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, fit(docs))

    def digest(f: Column) -> Column:
        def of_kind(k: int) -> Column:
            return F.size(F.filter(f["base"], lambda s: s["kind"] == k)).cast("long")

        counts = [of_kind(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
        return F.struct(
            *counts, F.sha2(_written(f["base"]), 256).alias("base_sha256"), _written(f["all"]).alias("spans")
        )

    return found.select("doc_id", let(F.col("found"), digest).alias("d")).select("doc_id", "d.*")
