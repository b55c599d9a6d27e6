"""From raw documents to shards: quality, near duplicates, benchmark leaks, mixture, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the
next stage's documents. All but the last return exactly the columns they were given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm.common import scratch
from cartwheel.llm.decontaminate import clean_documents
from cartwheel.llm.minhash_dedup import distinct_documents
from cartwheel.llm.mixing import mixed_documents
from cartwheel.llm.quality import good_documents
from cartwheel.llm.sharding import shard_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score under 0.3) go. Nulls, empty texts and repeated rows: see ``quality.good_documents``."""
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more on five-word shingles, the one with the least doc_id stays."""
    return distinct_documents(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go, also with other numbers, names and units."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of the sources interleaved by their target weights, rows in schedule order. No row is dropped; sources that end
    early start again, so their documents repeat."""
    return mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard (0 to 15); equal texts share one, shard sizes are near equal."""
    return shard_documents(docs, 16)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("near-duplicate removal", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("source mixture", mixture),
    ("shards", shards),
]

#: The classifier's score can't be written in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch(docs, f"stage-{k + 1}")
    return docs
