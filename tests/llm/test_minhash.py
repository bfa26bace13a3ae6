"""Bottom-k near duplicates against all pairs, and on odd tables."""

from __future__ import annotations

import random

import numpy as np
import pytest
from transitlake.llm import minhash

WORDS = "red blue green stone river mountain cloud field house garden table window".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 60)) for _ in range(n))


def shingled(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words)} if 0 < len(words) < size else {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size):
    """(id, set size, component) of all rows, by all pairs."""
    sets = [shingled(t, size) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if group[i] != group[j] and a and 100 * len(a & b) >= 80 * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    first = {g: min((i for (i, _), h in zip(rows, group) if h == g and i is not None), default=None) for g in group}
    return sorted(((i, len(s), first[g]) for (i, _), s, g in zip(rows, sets, group)), key=repr)


def found(frame, **parameters):
    return sorted(((r.doc_id, r.n, r.component_id) for r in minhash.near_duplicates(frame, **parameters).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    """A crowd of near copies of which some are similar to few others only, chains, a passage that many share, short and empty texts."""
    rng = random.Random(12)
    base = prose(rng, 150).split()
    texts = [" ".join(base)]
    for n in range(110):
        words = list(base)
        for at in rng.sample(range(150), rng.randint(1, 14)):
            words[at] = f"other{n}x{at}"
        texts.append(" ".join(words))
    chain = prose(rng, 100).split()
    for n in range(12):
        chain = [*chain[:5], *chain[7:], f"a{n}", f"b{n}"]
        texts.append(" ".join(chain))
    passage = prose(rng, 40)
    texts += [passage + " " + prose(rng, rng.randint(2, 60)) for _ in range(60)]
    texts += ["one two", "ONE  two", "one", "One", "one two three four five six seven", "one two three four five six", "", " \t", None, prose(rng, 20_000)]
    made = list(enumerate(texts))
    return made + [made[5], made[5], (7, "same id, another text"), (None, base[0]), (None, texts[3]), (None, None), (None, "nobody else")]


@pytest.mark.parametrize("size", [2, 5])
def test_components(spark, rows, size):
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS n", "1 AS fp", "doc_id AS component_id")
    expected = brute(rows, size)
    assert found(frame, shingle=size) == expected
    assert len({c for _, _, c in expected}) < len(rows) - 45


def test_blocks_do_not_change_the_result(spark, rows, monkeypatch):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for name, value in (("BLOCK", 7), ("BLOCK_SETS", 5), ("BLOCK_SHINGLES", 900), ("SLAB", 50), ("BUCKETS", 16), ("PIECE", 300), ("PICKED", 3), ("SMALL", 3), ("TOGETHER", 1)):
        monkeypatch.setattr(minhash, name, value)
    assert found(frame) == brute(rows, 2)


def test_texts_longer_than_the_sketch(spark):
    """Pairs around the threshold, far more shingles than a sketch holds."""
    rng = random.Random(2)
    rows = []
    for n in range(40):
        words = [f"w{n}x{i}" for i in range(rng.randint(200, 2000))]
        cut = int(len(words) * rng.uniform(0.84, 0.94))
        rows += [(2 * n, " ".join(words)), (2 * n + 1, " ".join(words[:cut] + [f"v{n}x{i}" for i in range(len(words) - cut)]))]
    expected = brute(rows, 2)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == expected
    assert 5 < len({c for _, _, c in expected}) - 40 < 35


def test_shingle_sets(monkeypatch):
    """Equal words have equal hashes wherever they stand, different ones different hashes, in pieces of any size."""
    rng = random.Random(5)
    pool = ["".join(rng.choice("abcé\x00z1") for _ in range(rng.randint(1, 9))) for _ in range(400)] + ["a", "A", "aa", "aaa", "1" * 5000]
    texts = [rng.choice(["", " ", "\n\t"]) + "".join(rng.choice(pool) + rng.choice([" ", "\x0b", " \x0c\r", "  "]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += [None, "", "x" * 9000, " ".join(pool * 3)]
    for size in (1, 2, 5):
        for piece in (64, 1 << 18):
            monkeypatch.setattr(minhash, "PIECE", piece)
            sets = minhash.shingle_sets([None if t is None else t.encode() for t in texts], size)
            plain = [shingled(t, size) for t in texts]
            names: dict = {}
            assert [len(s) for s in sets] == [len(p) for p in plain]
            for own, words in zip(sets, plain):
                assert (np.diff(own.astype(object)) > 0).all()
                for w in words:
                    names.setdefault(w, set(own.tolist()))
                    names[w] &= set(own.tolist())
            assert all(names.values()) and len({h for s in sets for h in s.tolist()}) == len({w for p in plain for w in p})


def test_estimates():
    rng = np.random.default_rng(1)
    least = minhash.shared_least()
    assert 20 < least < 0.8 * minhash.SKETCH
    for _ in range(300):
        values = rng.choice(1 << 40, 1000, replace=False).astype(np.int64)
        a, b = np.sort(values[:900])[:64], np.sort(values[100:])[:64]
        both, size = minhash.union_share(a, b, 64)
        union = np.sort(values)[:64]
        assert (both, size) == (len(set(union) & set(a) & set(b)), 64) and both >= least
    values, owner = np.array([1, 2, 3, 2, 3, 9, 3, 3]), np.array([0, 0, 0, 1, 1, 1, 2, 3])
    assert minhash.overlaps(values, owner, np.array([0, 2]), np.array([1, 3])).tolist() == [[2, 1], [1, 1]]


def test_query_and_odd_tables(spark, tmp_path, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    out = minhash.query(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())
    assert minhash.near_duplicates(frame.limit(0)).count() == 0
    assert minhash.near_duplicates(frame.where("text is null")).count() == 2
    one = minhash.keep_one(frame.selectExpr("text", "doc_id", "1 AS fp"))
    assert one.columns == ["text", "doc_id", "fp"]
    kept = {r.doc_id for r in one.collect()}
    assert {c for _, n, c in brute(rows, 5) if n and c is not None} <= kept
