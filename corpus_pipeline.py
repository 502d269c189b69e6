"""From raw documents to a sharded training mix: quality, near duplicates, benchmark leaks, source weights, shards.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the
documents of the next. All but the last return the columns of ``documents``. The quality stage trains on the ``labels``
table; the leak stage reads ``benchmark``. Columns beyond those of ``documents`` pass through the filters unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import decontamination, minhash, mixing, quality, sharding
from tierflow.runtime import materialize

SHARDS = 16
ORACLE_SQL = None  # a trained classifier and hashed sketches are not expressible; tests hold the stages against brute force


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects (score under 0.3)."""
    model = quality.train(
        materialize(docs.select("doc_id", quality.statistics("text").alias("features")), "features"),
        spark.read.parquet(f"{sf_dir}/labels.parquet"),
    )
    return docs.where(model.score(quality.statistics("text")) >= quality.THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every group linked by a similarity of 0.8 on five-word shingles."""
    return minhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold ten consecutive words of a benchmark item, or a whole shorter item."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The weighted mix of sources; a document taken more than once is there as often."""
    return mixing.mixture(docs, mixing.word_count(F.col("text")))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard number."""
    return sharding.assign_shards(docs, "doc_id", {k: 1.0 for k in range(SHARDS)})


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows stored before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
