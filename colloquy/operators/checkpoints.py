"""Resuming work: results are kept by the content of their inputs, and only what is missing is computed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def content_key(*parts: Column, version: str = "1") -> Column:
    """A digest of the inputs and of the version of what is computed; nulls and empty texts differ."""
    return F.sha2(F.to_json(F.array(F.lit(version), *[F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts])), 256)


def missing(wanted: DataFrame, done: DataFrame, key: str = "key") -> DataFrame:
    """Rows of `wanted` whose key isn't done."""
    return wanted.join(done.select(key).distinct(), key, "left_anti")


def resumed(wanted: DataFrame, path: str, compute, key: str = "key") -> DataFrame:
    """Results of all wanted rows: kept ones from the table at `path`, the rest computed and appended to it."""
    spark = wanted.sparkSession
    from pyspark.errors import AnalysisException

    try:
        done = spark.read.parquet(path)
        todo = missing(wanted, done, key)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        todo = wanted
    compute(todo).write.mode("append").parquet(path)
    return spark.read.parquet(path).join(wanted.select(key).distinct(), key, "left_semi").dropDuplicates([key])


def fresh_prefix(rows: DataFrame, keys: list[str], order: str, fresh: str) -> DataFrame:
    """Rows before the first stale one of each group."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("_stale", F.max(F.when(F.col(fresh), 0).otherwise(1)).over(w)).where("_stale = 0").drop("_stale")


def up_to_date(output: Column, inputs: Column) -> Column:
    """Whether an output's time is there and no input's is later; missing inputs don't count."""
    return output.isNotNull() & ~F.exists(F.filter(inputs, lambda x: x.isNotNull()), lambda x: x > output)


def status(runs: DataFrame, state: str) -> DataFrame:
    """Counts of succeeded, failed and skipped runs."""
    return runs.agg(*[F.count_if(F.col(state) == s).alias(s) for s in ("succeeded", "failed", "skipped")])
