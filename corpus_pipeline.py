"""The corpus pipeline: documents in, a filtered, mixed and sharded corpus out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quotemill.llm import decontam, mixing, sharding, simhash, toxicity
from quotemill.session import materialize, sized_shuffles
from quotemill.sources.tables import stored_bytes

#: Bytes that a stage may shuffle for each stored one: Parquet unpacked, and the mix's larger share.
EXPANSION = 5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger rejects go; it learns from the labelled ones at hand."""
    tagger = toxicity.fit_toxicity(spark, docs, _table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, tagger)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, that with the smallest id.

    Near copies are what the operator's contract links: fingerprints of three-word
    shingles that differ in at most two bits.
    """
    return simhash.drop_near_copies(docs, width=3, max_bits=2)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a test item go, short items included."""
    return decontam.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document comes once per pass that takes it."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their size, shard and place in it."""
    return sharding.shard_documents(docs)


STAGES = [
    ("toxicity", toxic),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark_leaks),
    ("mixing", mix),
    ("sharding", shard),
]

#: SQL can't train and apply the tagger of the first stage; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again.

    Shuffles start with as many partitions as the size of ``documents`` asks for, unless the
    session has a number set.
    """
    docs = _table(spark, sf_dir, "documents")
    with sized_shuffles(spark, stored_bytes(spark, f"{sf_dir}/documents.parquet") * EXPANSION):
        for name, stage in STAGES:
            docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
