"""From raw documents to shards of a mixed training corpus: five stages, each a Spark job on what the last one kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import decontaminate, langid, mixing, near, sharding
from tripflow.llm.common import table
from tripflow.session import scratch_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Language identification rejects what has no language or a score below this.
LEAST_SCORE = 0.5


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language, or of uncertain language. Null and empty texts go."""
    found = langid.identify(docs.select(*COLUMNS), langid.learn(docs))
    return found.where((F.col("lang_pred") != langid.NO_LANGUAGE) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.keep_one_of_each(docs.select(*COLUMNS))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; sources weigh 1, 2, 3 in turn."""
    return mixing.mix(docs.select(*COLUMNS))


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard of 40. Copies of a document share a shard."""
    return sharding.assign_shards(docs.select(*COLUMNS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_languages),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

# Language models and min-hashes are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
