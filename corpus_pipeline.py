"""Corpus pipeline: quality classifier, near-duplicate join, decontamination, source mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again for the next stage. All stages but
the last return the columns of ``documents``; ``labels`` and ``benchmark`` are read from the folder.

Every stage works on all rows it is given: null ids, null and empty texts, texts of any length, equal rows, ties and an empty table have the results that
the docstrings of the stages and of the operators behind them state. Further columns go through all stages but the last unchanged, also where they have names that
the operators use themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from herdframe.llm import decontaminate, mixing, quality, sharding, similar
from herdframe.session import cut_lineage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the labelled documents of its input.

    Null texts are empty ones; rows without an id have no label; equal rows go together; a table without rows stays empty."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id, then the first text.

    Null texts are empty; all texts without words are one group; a null id comes before all others; of rows equal in id and text any one stays."""
    return similar.keep_one(docs)


def keep_unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a test item.

    Null and empty texts stay, and so do all rows if there are no items; equal rows are judged alike."""
    return decontaminate.drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or up to three times.

    A null source is a source of its own; equal rows get their copies one by one; rows of no words are taken once."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row gets its shard and its slot in it; equal rows, and rows without an id, get slots of their own."""
    return sharding.shard_documents(docs, shards=40)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", keep_unleaked),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]

#: Learned and random stages have no SQL; tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
