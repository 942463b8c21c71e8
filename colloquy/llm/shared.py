"""Tables that outlive a stage, in a folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset and driver and executors are one process (local[n]), a folder of this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="colloquy-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(docs: DataFrame, name: str) -> str:
    """The name with as many underscores before it as it takes to be no column's."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name = "_" + name
    return name
