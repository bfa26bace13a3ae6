"""What a Python worker of the training-data operators holds at once."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
from transitlake.llm import common, decontamination, minhash, toxicity


def texts(n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"text": [f"harbour tram number {i} stops at quay {i % 7}" for i in range(n)]})


def test_functions_of_batches_get_pieces():
    sizes = []

    def make(batch):
        sizes.append(batch.num_rows)
        return batch

    batch = texts(1_100)
    assert pa.Table.from_batches(common.by_batch(make)(iter([batch]))) == pa.Table.from_batches([batch])
    assert max(sizes) == common.PIECE_ROWS and sum(sizes) == 1_100


def test_texts_are_cleaned_and_counted_in_pieces():
    batch = texts(1_100)
    cleaned = list(decontamination._cleaner([[(0, "i", [b"no", b"such", b"words"])]], 10, 0.5)(iter([batch])))
    assert pa.Table.from_batches(cleaned) == pa.Table.from_batches([batch])
    raw = pa.RecordBatch.from_arrays([batch.column("text").cast(pa.binary())], ["text"])
    votes = list(toxicity._count_votes(toxicity.Lexicons())(iter([raw])))
    assert sum(v for b in votes for v in b.column("n").to_pylist()) == 1_100
    assert len(cleaned) == len(votes) == -(-1_100 // common.PIECE_ROWS)


def test_held_jobs_run_on_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def count(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    before = spark.conf.get(key)
    found = common.hold(spark.range(0, 2_500, 1, 1).mapInArrow(count, "n long"), "batches")
    sizes = [r.n for r in found.collect()]
    assert max(sizes) == common.BATCH_ROWS and sum(sizes) == 2_500 and spark.conf.get(key) == before


def test_a_block_of_near_copies_stays_small():
    rng, size = np.random.default_rng(3), 2 * minhash.BLOCK
    values = rng.integers(0, 20_000, size * minhash.SKETCH)
    owner = np.repeat(np.arange(size), minhash.SKETCH)
    left, right = np.arange(minhash.BLOCK), np.arange(minhash.BLOCK, size)
    tracemalloc.start()
    common_values = minhash.overlaps(values, owner, left, right)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
    for a, b in rng.integers(0, minhash.BLOCK, (50, 2)).tolist():
        sets = [set(values[owner == row].tolist()) for row in (left[a], right[b])]
        assert common_values[a, b] == len(sets[0] & sets[1])
