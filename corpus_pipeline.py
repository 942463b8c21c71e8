"""The corpus pipeline: quality, near-duplicates, personal data, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the next
stage's docs. All but the last return the columns of `documents`. SQL can express none of the stages but the mix, so
ORACLE_SQL is None; tests compare each stage, and the rows of all of them, with plain versions.

Defined results: null and empty texts are scored like any text and are near copies of each other; equal rows are near
copies; rows without doc_id stay until the mix; extra columns of any names are carried to the last stage; an empty table
gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import bagminhash, crf, mixing, pieces, pii
from colloquy.llm.shared import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out what the line classifier rejects; it learns from the labelled rows of these documents."""
    model = crf.fit(crf.sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return crf.scored(docs, model, out="_score").where(F.col("_score") >= crf.THRESHOLD).drop("_score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near copies."""
    return bagminhash.kept(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put pseudonyms for personal data and secrets; n_chars follows the text.

    The key is the session's setting spark.colloquy.pseudonym.key; without it, the public one of tests.
    """
    key = spark.conf.get("spark.colloquy.pseudonym.key", pii.PUBLIC_KEY)
    return pii.pseudonymised(docs, key).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, with digests, round trip and parity."""
    return pieces.digest(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mix", mix), ("tokens", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
