"""From raw documents to shuffled shards: quality, near duplicates, benchmarks, mix, shards."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import decontamination, mixing, ngram_join, quality, sharding
from daybook.llm.common import noted, release, written

SHARDS = 8
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: What stages have written for themselves, by application.
_SCRATCH: dict[str, list[str]] = defaultdict(list)


def stage(function: Stage) -> Stage:
    """A stage that first removes what earlier ones wrote for themselves, unless ``docs`` is read from it."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        scratch = _SCRATCH[spark.sparkContext.applicationId]
        release(scratch, docs)
        with noted(scratch):
            return function(spark, docs, sf_dir)

    return run_stage



@stage
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the rules learned from the labels keep."""
    return quality.kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@stage
def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.one_row_of_each_group(docs)


@stage
def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    return mixing.mix(docs)


@stage
def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and their place in it."""
    return sharding.shuffled_shards(docs, SHARDS)


STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", keep_clean),
    ("mixing sources", mix_sources),
    ("sharding", shard),
]

#: Learned rules and random draws are not SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before wrote, which goes when the next has written."""
    docs, outputs = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, function in STAGES[:-1]:
        with noted(outputs):
            docs = written(function(spark, docs, sf_dir), name.replace(" ", "_"))
        release(outputs, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
