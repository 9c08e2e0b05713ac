"""The training-corpus pipeline: five stages, each written and read again by the next.

Toxicity drops documents whose expected severity is too high; SimHash keeps one
document of each near-duplicate group; decontamination drops documents that hold
a passage of a test item; mixing keeps good documents and thins poor ones to
their target weight; sharding lays out what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlake.llm import decontaminate, mixing, shards, simhash_dups, toxicity
from meterlake.llm.common import read, stored
from meterlake.llm.queries import SHARDS

WEIGHTS = {"good": 0.95, "poor": 0.05}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the rejected severity; the model is fitted on the labelled rows of ``docs``."""
    model = toxicity.fit(toxicity.sample_labelled(docs, read(spark, sf_dir, "labels")))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group: 4-word shingles, 4 bits."""
    return simhash_dups.keep_one(docs, shingle=4, max_bits=4)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that aligns with a test item."""
    return decontaminate.drop_leaked(docs, read(spark, sf_dir, "benchmark"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Good documents all stay, poor ones are thinned to their target; toxic ones have gone before."""
    return mixing.sample_mix(docs, mixing.label_quality(read(spark, sf_dir, "labels")), WEIGHTS, keep="good")


def lay_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard along the Hilbert curve."""
    return shards.shard_documents(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_domains),
    ("sharding", lay_out),
]

# The classifiers and SimHash have no SQL form; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
