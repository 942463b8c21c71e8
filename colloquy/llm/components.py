"""Connected components of a table of links, without collecting them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.shared import written


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, comp) for each end of an edge (a, b): comp is the smallest id of its component.

    Alternating large-star and small-star steps: each hangs neighbours on the smallest id of their neighbourhood, so
    the number of rounds grows with the logarithm of the longest path. Every round is written to the shared folder.
    A hub's neighbours are never gathered in one row: minima are summed before the shuffle. The joins to them stand on
    the same shuffle, so a hub's rows of two longs are one task's; they stream through it and aren't held.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    known = None
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: larger neighbours hang on the smallest id around
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: smaller neighbours and the node itself hang on the smallest
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        now = written(small, "links")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == known:
            break
        known = seen
    else:
        raise RuntimeError("components didn't settle")
    return now.groupBy("a").agg(F.min("b").alias("comp")).withColumnRenamed("a", "id").union(now.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct())
