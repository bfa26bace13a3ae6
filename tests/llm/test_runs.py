"""Periodic runs against brute force, and on odd tables."""

from __future__ import annotations

import hashlib
import random

from hypothesis import given, settings, strategies as st
from transitlake.llm import runs


def brute(words, least=12):
    """Every period, every stretch, its smallest period."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if size >= max(least, 2 * q) and not any(words[i : i + size - p] == words[i + p : i + size] for p in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def numbers(words):
    return runs.numbered([str(w).encode() for w in words])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=24), st.integers(0, 9), st.lists(st.integers(0, 2), max_size=6), st.sampled_from([2, 5, 12]))
def test_all_runs(block, times, rest, least):
    words = rest + block * times + rest[:2] + block
    assert runs.find_runs(numbers(words), least) == brute(words, least)


def test_long_texts():
    """One word 200 000 times, a long period, and Fibonacci words, which have runs in runs."""
    assert runs.find_runs(numbers([1] * 200_000)) == [(0, 200_000, 1)]
    assert runs.find_runs(numbers([i % 40_000 for i in range(100_000)])) == [(0, 100_000, 40_000)]
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    assert runs.find_runs(numbers(b)) == brute(b)


def test_positions_are_sorted_sets():
    rng = random.Random(3)
    order = rng.sample(range(9000), 9000)
    held, plain = runs.Positions(order[0]), [order[0]]
    for x in order[1:4000]:
        before, after = held.add(x)
        assert before == max((p for p in plain if p < x), default=-1) if len(plain) < 300 else True
        assert after == min((p for p in plain if p > x), default=-1) if len(plain) < 300 else True
        plain.append(x)
    assert list(held) == sorted(plain) and held.size == 4000


def test_query_columns(spark, tmp_path):
    """The digests of the query against the brute force, ids that are altered among them, and odd rows."""
    rng = random.Random(7)
    texts = [" ".join(rng.choice("xy") for _ in range(rng.randint(0, 90))) for _ in range(80)]
    texts += [None, "", " \t ", "a b " * 20, "one\x0btwo\x0c" * 9]
    rows = [(i, t, "en", "s", i, "x") for i, t in enumerate(texts)] + [(3, texts[3], None, None, None, None), (None, texts[4], None, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_runs string, start long, period string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = runs.query(spark, str(tmp_path)).collect()
    expected = []
    for doc_id, text, *_ in rows:
        words = runs.altered((text or "").encode().split(), doc_id)
        own = brute(words)
        kept = [w for k, w in enumerate(words) if not any(s + q <= k < s + n for s, n, q in own)]
        best = min(((-n, s, q) for s, n, q in own), default=None)
        whole = (best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in own)
        expected.append((doc_id, len(own), *whole, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert any(e[1] > 1 for e in expected)
    empty = frame.limit(0)
    assert runs.detect(empty).count() == 0 and runs.collapse(empty).columns == frame.columns


def test_altered_rows():
    words = [str(i).encode() for i in range(50)]
    changed = [i for i in range(200) if runs.altered(words, i) != words]
    assert changed
    for i in changed:
        h = runs.zlib.crc32(str(i).encode())
        a, p = h // 10 % 50, 1 + (50 - h // 10 % 50) // (3 + h // 10 % 8)
        assert runs.altered(words, i) == [words[k] if k < a else words[a + (k - a) % p] for k in range(50)]
    assert runs.altered(words, None) == words and runs.altered([], changed[0]) == []


def test_collapse_keeps_the_rest(spark):
    rows = [(1, "a  b\nc", 5), (2, "go " * 30 + "on", 6), (3, None, 7)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, period long")
    assert [tuple(r) for r in runs.collapse(frame).orderBy("doc_id").collect()] == [(1, "a  b\nc", 5), (2, "go on", 6), (3, None, 7)]
