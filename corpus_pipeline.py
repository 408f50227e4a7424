"""A training corpus from raw documents, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps with the
columns of ``docs`` (the last returns the token files' index). ``run`` writes each
stage's result to the shared folder as Parquet and rereads it for the next, so a
lost executor costs part of one stage.

Rows with null or empty texts pass the first three stages unless their group of
equal fingerprints is represented by another row; mixing takes them as documents
without words. Repeated rows leave one in the second stage; very long texts are worked on
whole. Empty tables pass through. Further columns are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from screenlake.llm import decontaminate, mixing, simhash, token_pack, toxicity
from screenlake.llm.queries import VOCAB_SIZE, table, vocab_path
from screenlake.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash."""
    return simhash.near_dedup(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the shuffled order of their shards."""
    return mixing.mixed_in_order(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and where each document lies in them."""
    return token_pack.token_files(docs, vocab_path(), VOCAB_SIZE)


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("decontamination", drop_benchmark),
          ("mixing", mix_sources), ("token_files", write_tokens)]

# Model scores, XXH64 fingerprints and tokenizer ids have no SQL form: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
