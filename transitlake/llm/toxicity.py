"""Toxicity by weak supervision.

1. Lexicons. From a bounded sample of labelled training rows: words and word beginnings that toxic rows
   use far more often. A short list of common insults stands beside them.
2. Voters. Lexicon, density and pattern voters each say toxic, clean or nothing for every document.
3. Label model. All documents are counted by their votes. A generative model (class, then every voter
   given the class and the voter it depends on most) is fitted to the counts by expectation maximisation: it has the
   accuracy of each voter and, through the tree of dependences, their correlations.
4. Classifier. Logistic regression on a bounded sample of documents with their posterior labels; its inputs
   are lexicon counts and hashed word beginnings of the text, nothing else. The threshold 0.5 is set on the labelled sample.

Labels are read only from rows whose CRC-32 of the id as text is no multiple of 5.

Defined cases: null and empty texts get the score of a text without words; a null ``doc_id`` is never in a sample, has
the remainder of the empty text and is scored like any other; without usable labels only the listed insults vote;
repeated rows are scored alike; an empty table gives an empty result; input columns named like an added one are replaced.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from transitlake.llm.common import small_batches, table, text_pieces

FOLDS = 5
# Bounds of the samples: labelled rows for lexicons and threshold, documents for the classifier.
LABELLED_ROWS = 20_000
TRAINING_ROWS = 6_000
# An entry of a lexicon: rows that must have it, and its log odds of toxic to clean.
LEAST_ROWS = 5
LEAST_ODDS = 2.5
# Entries kept of each lexicon, by log odds weighted with support: bounds the model that tasks hold.
LEXICON = 3_000
CUTS = (4, 5)
HASHED = 4096

# Common insults.
INSULTS = frozenset(
    b"idiot idiots moron morons stupid loser losers scum trash pathetic worthless disgusting clown dumb "
    b"imbecile cretin vermin filth retard bastard bitch whore fool fools garbage".split()
)
ADDRESS = re.compile(rb"\b(?:you|your|youre|they|these|such an?)\b[^.!?\n]{0,24}$")
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

VOTERS = ("word", "stem4", "stem5", "listed", "density", "spread", "addressed")
TOXIC, CLEAN, NOTHING = 2, 1, 0


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


@dataclass
class Lexicons:
    words: frozenset[bytes] = frozenset()
    stems: tuple[frozenset[bytes], ...] = tuple(frozenset() for _ in CUTS)


@dataclass
class Model:
    lexicons: Lexicons
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    # Sorted vote patterns and their posterior, of the label model.
    posterior: dict[int, float] = field(default_factory=dict)


def _counts(text: bytes | None) -> tuple[Counter, int]:
    words = WORD.findall((text or b"").lower())
    return Counter(words), len(words)


def _hits(text: bytes | None, lexicons: Lexicons) -> tuple[Counter, list[float]]:
    """Word counts and: hits of words, of each cut, of the list, words, different hit words, addressed hits."""
    counts, n = _counts(text)
    word = sum(c for w, c in counts.items() if w in lexicons.words)
    stems = [sum(c for w, c in counts.items() if w[:cut] in lex) for cut, lex in zip(CUTS, lexicons.stems)]
    listed = [w for w in counts if w in INSULTS]
    different = sum(1 for w in counts if w in lexicons.words or w[: CUTS[0]] in lexicons.stems[0])
    addressed = 0
    if listed:
        lowered = text.lower()
        addressed = sum(
            1 for w in listed for m in re.finditer(rb"\b" + w + rb"\b", lowered) if ADDRESS.search(lowered[max(0, m.start() - 40) : m.start()])
        )
    return counts, [word, *stems, sum(counts[w] for w in listed), n, different, addressed]


def _votes(hits: list[float]) -> tuple[int, ...]:
    word, stem4, stem5, listed, n, different, addressed = hits
    density = stem4 / n if n else 0.0
    return (
        TOXIC if word else NOTHING,
        TOXIC if stem4 >= 2 else CLEAN if not stem4 else NOTHING,
        TOXIC if stem5 >= 2 else CLEAN if not stem5 else NOTHING,
        TOXIC if listed else NOTHING,
        TOXIC if density >= 0.01 else CLEAN if density < 0.001 else NOTHING,
        TOXIC if different >= 2 else CLEAN if not different else NOTHING,
        TOXIC if addressed else NOTHING,
    )


def _pattern(votes: tuple[int, ...]) -> int:
    code = 0
    for v in votes:
        code = code * 3 + v
    return code


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of at most ``LABELLED_ROWS`` labelled training rows, those of the smallest hashes."""
    sample = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .select("doc_id", "toxic")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic")
        .limit(LABELLED_ROWS)
    )
    return docs.join(F.broadcast(sample), "doc_id").select(F.col("text").cast("binary").alias("text"), "toxic")


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that have each word and word beginning, by class, added up in each task's batches."""
    for batch in batches:
        rows: Counter = Counter()
        for piece in text_pieces([batch]):
            for text, toxic in zip(piece.column("text").to_pylist(), piece.column("toxic").to_pylist()):
                words = set(WORD.findall((text or b"").lower()))
                rows.update((0, w, toxic) for w in words)
                for cut in CUTS:
                    rows.update((cut, s, toxic) for s in {w[:cut] for w in words if len(w) >= cut})
                rows[(-1, b"", toxic)] += 1
        keys = list(rows)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.int32()),
                pa.array([k[1] for k in keys], pa.binary()),
                pa.array([k[2] for k in keys], pa.int32()),
                pa.array([rows[k] for k in keys], pa.int64()),
            ],
            ["kind", "entry", "toxic", "n"],
        )


def learn_lexicons(docs: DataFrame, labels: DataFrame) -> Lexicons:
    counted = (
        _labelled(docs, labels)
        .mapInArrow(_entries, "kind int, entry binary, toxic int, n long")
        .groupBy("kind", "entry")
        .agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("yes"),
            F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("no"),
        )
    )
    whole = counted.where("kind = -1").first()
    if whole is None or not whole.yes or not whole.no:
        return Lexicons()
    yes, no = F.col("yes"), F.col("no")
    odds = F.log((yes + 0.5) / (whole.yes + 1)) - F.log((no + 0.5) / (whole.no + 1))
    found: dict[int, set[bytes]] = {}
    for kind in (0, *CUTS):
        best = (
            counted.where((F.col("kind") == kind) & (yes >= LEAST_ROWS))
            .withColumn("odds", odds)
            .where(F.col("odds") >= LEAST_ODDS)
            .orderBy((F.col("odds") * F.sqrt(yes)).desc(), "entry")
            .limit(LEXICON)
        )
        found[kind] = {bytes(r.entry) for r in best.select("entry").collect()}
    return Lexicons(frozenset(found[0]), tuple(frozenset(found[c]) for c in CUTS))


def _count_votes(lexicons: Lexicons):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_pieces(batches):
            seen = Counter(_pattern(_votes(_hits(t, lexicons)[1])) for t in batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], ["pattern", "n"]
            )

    return run


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Posterior of class toxic for each row of ``patterns`` (votes), which ``counts`` documents have.

    Class, and each voter given the class and one other voter: the tree of largest conditional mutual information,
    found anew while the posterior settles. Two voters that say the same thing so count about once.
    """
    yes, no = (patterns == TOXIC).sum(1), (patterns == CLEAN).sum(1)
    posterior = np.where(yes > no, 0.95, np.where(yes + no == 0, 0.05, np.where(yes == no, 0.4, 0.02)))
    voters = patterns.shape[1]
    onehot = np.stack([patterns == v for v in range(3)], 2).astype(float)
    for turn in range(rounds):
        weight = np.stack([(1 - posterior) * counts, posterior * counts])
        prior = weight.sum(1) + 1.0
        joint = np.einsum("yp,pia,pjb->yijab", weight, onehot, onehot) + 0.1
        if turn % 10 == 0:
            total = joint / joint.sum((0, 3, 4), keepdims=True)
            of_class = total.sum((3, 4), keepdims=True)
            a, b = total.sum(4, keepdims=True), total.sum(3, keepdims=True)
            information = (total * np.log(total * of_class / (a * b))).sum((0, 3, 4))
            parent = _tree(information)
        score = np.log(prior)[:, None] + np.zeros((2, len(patterns)))
        for i in range(voters):
            j = parent[i]
            if j < 0:
                table_ = joint[:, i, i].diagonal(0, 1, 2)
                score += np.log(table_ / table_.sum(1, keepdims=True))[:, patterns[:, i]]
            else:
                given = joint[:, i, j] / joint[:, i, j].sum(1, keepdims=True)
                score += np.log(given[:, patterns[:, i], patterns[:, j]])
        posterior = 1 / (1 + np.exp(np.clip(score[0] - score[1], -40, 40)))
    return posterior


def _tree(information: np.ndarray) -> list[int]:
    """Parents of a spanning tree of largest information; the root has -1."""
    voters = len(information)
    parent, inside = [-1] * voters, {0}
    while len(inside) < voters:
        i, j = max(((i, j) for i in inside for j in range(voters) if j not in inside), key=lambda e: information[e])
        parent[j] = i
        inside.add(j)
    return parent


def _inputs(text: bytes | None, lexicons: Lexicons) -> tuple[list[int], list[float], list[float]]:
    """Hashed inputs (index, value; length 1 together) and lexicon inputs."""
    counts, hits = _hits(text, lexicons)
    hashed: dict[int, float] = {}
    stems: Counter = Counter()
    for w, n in counts.items():
        stems[w[: CUTS[0]]] += n
    for stem, n in stems.items():
        k = zlib.crc32(stem) % HASHED
        hashed[k] = hashed.get(k, 0.0) + math.log1p(n)
    norm = math.sqrt(sum(v * v for v in hashed.values())) or 1.0
    word, stem4, stem5, listed, n, different, addressed = hits
    dense = [
        1.0,
        min(word, 3.0),
        min(stem4, 4.0),
        min(stem5, 4.0),
        float(stem4 >= 2),
        float(stem5 >= 2),
        min(listed, 2.0),
        min(different, 4.0),
        min(100.0 * stem4 / n, 3.0) if n else 0.0,
        min(addressed, 2.0),
    ]
    return list(hashed), [v / norm for v in hashed.values()], dense


DENSE = 10


def _linear(text: bytes | None, model: Model) -> float:
    index, value, dense = _inputs(text, model.lexicons)
    w = model.weights
    return float(np.dot(w[:DENSE], dense) + (np.dot(w[DENSE:][index], value) if index else 0.0))


def _training_rows(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_pieces(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                pattern = _pattern(_votes(_hits(text, model.lexicons)[1]))
                rows.append((*_inputs(text, model.lexicons), model.posterior.get(pattern, 0.5)))
            kinds = [pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                ["index", "value", "dense", "target"],
            )

    return run


def fit_linear(rows: pa.Table, rounds: int = 200, rate: float = 0.1, shrink: float = 1e-3) -> np.ndarray:
    """Logistic regression with soft labels, by Adam over all rows at once. The rows stay columns: as objects they would take the
    driver some ten times the memory."""
    weights = np.zeros(DENSE + HASHED)
    if not rows.num_rows:
        weights[0] = -4.0
        return weights
    dense = pc.list_flatten(rows["dense"]).to_numpy().reshape(-1, DENSE)
    target = rows["target"].to_numpy()
    index = pc.list_flatten(rows["index"]).to_numpy().astype(np.int64)
    value = pc.list_flatten(rows["value"]).to_numpy()
    owner = np.repeat(np.arange(rows.num_rows), pc.list_value_length(rows["index"]).to_numpy())
    mean, spread = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, rounds + 1):
        z = dense @ weights[:DENSE] + np.bincount(owner, value * weights[DENSE:][index], rows.num_rows)
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target) / rows.num_rows
        slope = np.concatenate([dense.T @ error, np.bincount(index, value * error[owner], HASHED)]) + shrink * weights / 10
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.999 * spread + 0.001 * slope * slope
        weights = weights - rate * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
    return weights


def _scores_of(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_pieces(batches):
            z = [_linear(t, model) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(z, pa.float64()), batch.column("toxic")], ["z", "toxic"])

    return run


def best_cut(z: np.ndarray, toxic: np.ndarray) -> float:
    """Cut of largest F1 among those above which more rows are toxic than clean; of several the middle of the widest
    gap. Without such a cut it lies above all scores: a model that learned nothing rejects nothing."""
    if not len(z) or toxic.min() == toxic.max():
        return 0.0
    order = np.argsort(-z, kind="stable")
    z, toxic = z[order], toxic[order]
    hit = np.cumsum(toxic)
    f1 = 2 * hit / (np.arange(1, len(z) + 1) + toxic.sum())
    # A cut lies between different scores only.
    f1[:-1][z[:-1] == z[1:]] = -1
    f1[2 * hit <= np.arange(1, len(z) + 1)] = -1
    if f1.max() < 0:
        return float(z.max() + 1)
    best = np.flatnonzero(f1 == f1.max())
    low = np.append(z, z[-1] - 2)[best + 1]
    widest = best[np.argmax(z[best] - low)]
    return float((z[widest] + np.append(z, z[-1] - 2)[widest + 1]) / 2)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    with small_batches(docs.sparkSession):
        return _fitted(docs.select("doc_id", "text"), labels)


def _fitted(docs: DataFrame, labels: DataFrame) -> Model:
    model = Model(learn_lexicons(docs, labels))
    body = docs.select(F.col("text").cast("binary").alias("text"))
    seen = (
        body.mapInArrow(_count_votes(model.lexicons), "pattern int, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    ).collect()
    if seen:
        codes = np.array([r.pattern for r in seen])
        votes = np.stack([codes // 3**k % 3 for k in reversed(range(len(VOTERS)))], 1)
        order = np.argsort(codes)
        found = label_model(votes[order], np.array([float(r.n) for r in seen])[order])
        model.posterior = dict(zip(codes[order].tolist(), found.tolist()))
    sample = (
        docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .select("doc_id")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAINING_ROWS)
    )
    rows = (
        docs.join(F.broadcast(sample), "doc_id")
        .select(F.col("text").cast("binary").alias("text"))
        .mapInArrow(_training_rows(model), "index array<int>, value array<double>, dense array<double>, target double")
        .toArrow()
    )
    model.weights = fit_linear(rows)
    scored = _labelled(docs, labels).mapInArrow(_scores_of(model), "z double, toxic int").toArrow()
    model.weights[0] -= best_cut(scored["z"].to_numpy(), scored["toxic"].to_numpy().astype(float))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    added = {"score", "predicted", "__text"}
    kept = [c for c in docs.columns if c.lower() not in added]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col("text").cast("binary").alias("__text"))
    schema = T.StructType([*rows.drop("__text").schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_pieces(batches):
            z = np.array([_linear(t, model) for t in batch.column("__text").to_pylist()])
            p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            rest = batch.drop_columns(["__text"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))],
                names=[*rest.schema.names, "score", "predicted"],
            )

    return rows.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those predicted toxic, in the same columns."""
    scored = score(docs, fit(docs, labels))
    return scored.where("predicted = 0").select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of ``op2_weak_supervision``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
