"""The corpus pipeline: toxicity, near duplicates, benchmark passages, source weights, shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the
``docs`` of the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from transitlake.llm import decontamination, minhash, mixing, sharding, simhash, toxicity
from transitlake.llm.common import hold, table


# Words of a shingle in the stage of near duplicates.
PIPELINE_SHINGLE = 5


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents predicted toxic."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates. Texts are linked by the SimHash blocks of ``op7_simhash_blocks``, and by
    similarity 0.8 in five-word shingles, which 2 of 64 bits do not reach."""
    similar = minhash.near_duplicates(docs, PIPELINE_SHINGLE, minhash.SIMILARITY, empty_alike=True)
    return simhash.kept(docs, simhash.united(simhash.near_duplicates(docs), similar))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes passages of benchmark items out of texts; documents that are mostly such passages go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emits every document as often as the mix has it."""
    return mixing.emitted(mixing.mix(docs), docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot."""
    return sharding.shard_documents(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_passages),
    ("mixing", source_weights),
    ("sharding", shards),
]

# SQL can express neither the classifier nor the fingerprints: the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = hold(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
