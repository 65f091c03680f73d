"""Corpus preparation in five stages: quality, near duplicates, contamination, mix, shards.

A stage is a function of (spark, docs, sf_dir). Each gets the rows that the stage before has kept, read
from Parquet, and all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind import session
from tradewind.llm import decontaminate, hash_ring, minhash_dedup, mixing, quality_gam
from tradewind.llm.common import durable, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model, learned from the labels of this corpus, accepts."""
    session.ensure(spark)
    model = quality_gam.fit(docs, read(spark, sf_dir, "labels"))
    return quality_gam.accepted(docs, model)


#: (shingle, alike, of): texts that either rule links are near duplicates, that of stages on word shingles or that of op1.
NEAR = ((5, 80, 100), (minhash_dedup.SHINGLE, minhash_dedup.ALIKE, minhash_dedup.OF))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    session.ensure(spark)
    return minhash_dedup.deduplicated(docs, NEAR)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark items don't contaminate."""
    session.ensure(spark)
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the weighted mix takes: a row for each run of words of a document in each round; `text` and
    `n_chars` are those of the run."""
    session.ensure(spark)
    return mixing.mixed_documents(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows on 40 shards, with shard and slot."""
    session.ensure(spark)
    return hash_ring.assign(docs, shards=40)


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", contamination),
    ("source mix", mix),
    ("sharding", shards),
]

#: The stages learn a model, hash and draw: no SQL gives these rows. Tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
