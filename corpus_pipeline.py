"""A corpus pipeline: toxic documents go, near copies and benchmark leaks go, personal data is replaced, texts are encoded.

Each stage takes ``(spark, docs, sf_dir)`` and all that the stage before it kept. It returns the columns of ``documents``;
the last returns the digests of the encoded texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import byte_bpe, decontamination, jaccard_join, surrogates, toxicity
from ledgerline.llm.common import crc_mod, save, ship
from ledgerline.llm.queries import PRE_TOKENS, VOCABULARY

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more go; it learns from the labels that op6 learns from."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels, crc_mod("doc_id", 5) != 0))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links connect, the one with the smallest id stays."""
    ship(spark)
    return jaccard_join.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go."""
    ship(spark)
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; personal data in their texts gets surrogates."""
    ship(spark)
    return surrogates.pseudonymise(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every text's byte-level BPE ids and of the bytes they decode to."""
    ship(spark)
    return byte_bpe.digests(byte_bpe.round_trip(docs, byte_bpe.share_vocabulary(spark, VOCABULARY), PRE_TOKENS))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near_copies", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("pii", pseudonymised),
    ("encoding", encoded),
]

#: A trained classifier, near copies and encoding are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
