"""The corpus pipeline: stages over ``documents``, each one operator of ``cohortlens.llm``.

1. ``language_id`` drops documents whose language is not determined.
2. ``near_duplicates`` keeps one document of each SimHash component.
3. ``decontamination`` drops documents that benchmark passages contaminate.
4. ``mixing`` replicates documents to the target weights of their sources.
5. ``sharding`` lays the copies into shards of equal bytes.

Each stage works on all rows its predecessor kept, written as Parquet to the
shared folder and read back. All but the last return the columns of
``documents``; a null id, text, language or source is kept as it is unless the
stage's operator says otherwise, and extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import decontam, langid, mixing, shard, simhash
from cohortlens.llm.common import materialise, table

SHARDS = 16


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a determined language; the model learns from all that are labelled."""
    return langid.keep_identified(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, that of the smallest id."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which less than a twentieth of the words lies in benchmark windows."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies at the rates of square-root weighted sources, globally shuffled."""
    return mixing.mix(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy with its size, shard and slot."""
    return shard.shard(docs, SHARDS)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_stage),
    ("sharding", sharding),
]
# The language model and the fingerprints have no SQL; tests run every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
