"""From raw documents to sharded training data: five stages, each written and reread."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradeloom.llm import decontamination, mixing, quality, sharding, simhash
from tradeloom.llm import queries as registered
from tradeloom.plans.staging import new_folder


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier keeps."""
    return quality.accepted(docs, registered.table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash group: the one with the smallest id."""
    return simhash.one_of_each(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.clean_documents(docs, registered.table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, each as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard they go to."""
    return sharding.with_shard(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good),
    ("SimHash near-dedup", distinct),
    ("benchmark decontamination", uncontaminated),
    ("mixing sources to target weights", mixed),
    ("sharding", sharded),
]

# The first stage trains a model and the second hashes with XXH64, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each is a table in the shared folder."""
    docs = registered.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {**registered.QUERIES, "pipeline": run}
ORACLES = dict(registered.ORACLES)
