"""Cutting sequences: fixed chunks, greedy chunks, running cut-offs, paragraphs, prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fixed(ws: Column, size: int) -> Column:
    """Chunks of `size` words: array of arrays; none for no words."""
    n = F.size(ws)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.slice(ws, s + 1, F.lit(size)))


def greedy(sizes: Column, cap: int) -> Column:
    """The chunk of each size in an array of sizes: a new chunk starts where the current one isn't empty and would pass `cap`."""
    start = F.struct(F.lit(0).alias("chunk"), F.lit(0).cast("long").alias("n"), F.lit(0).alias("rows"), F.array().cast("array<int>").alias("out"))

    def add(s: Column, x: Column) -> Column:
        new = (s["rows"] > 0) & (s["n"] + x > cap)
        chunk = s["chunk"] + F.when(new, 1).otherwise(0)
        return F.struct(chunk.alias("chunk"), (F.when(new, 0).otherwise(s["n"]) + x).cast("long").alias("n"), F.when(new, 1).otherwise(s["rows"] + 1).alias("rows"), F.array_append(s["out"], chunk).alias("out"))

    return F.aggregate(sizes, start, add, lambda s: s["out"])


def running(rows: DataFrame, keys: list[str], order: list[str], n: str, most: float) -> DataFrame:
    """Rows in order while their running sum is at most `most`; the first row above ends it."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_sum", F.sum(n).over(w))
    return rows.withColumn("_over", F.max(F.when(F.col("_sum") > most, 1).otherwise(0)).over(w)).where("_over = 0").drop("_sum", "_over")


def running_total(rows: DataFrame, order: list[str], n: str, most: float, buckets: int = 1 << 10) -> DataFrame:
    """`running` over a whole table of non-negative n without one task for all: ids are dealt by range, only range sums meet."""
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = rows.repartitionByRange(min(parts, buckets), *order).withColumn("_part", F.spark_partition_id())
    sums = rows.groupBy("_part").agg(F.sum(n).alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    inner = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    both = rows.join(F.broadcast(sums.drop("_n")), "_part")  # one row a range
    return both.withColumn("_sum", F.col("_before") + F.sum(n).over(inner)).where(F.col("_sum") <= most).drop("_part", "_before", "_sum")


def sentences(text: Column) -> Column:
    """Sentences end with . ! or ?, white space, and a capital letter after it."""
    return F.split(F.trim(text), r"(?<=[.!?])\s+(?=[A-Z])")


def paragraphs(text: Column, size: int = 3) -> Column:
    """Sentences in groups, with a blank line between groups."""
    groups = fixed(sentences(text), size)
    return F.array_join(F.transform(groups, lambda g: F.array_join(g, " ")), "\n\n")


def unwrapped(text: Column) -> Column:
    """Hard-wrapped lines joined to paragraphs; blank lines stay between; `word- word` loses its space."""
    t = F.array_join(F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), "\n")
    t = F.regexp_replace(t, r"(?<=[^\n])\n(?=[^\n])", " ")
    t = F.regexp_replace(t, r"(?<=[^\n])\n(?=\n)", "\n")
    return F.regexp_replace(t, r"([\p{L}\p{N}_])- ([\p{L}\p{N}_])", "$1-$2")


def aligned_slice(ws: Column, places: Column, start: Column, stop: Column) -> Column:
    """The words of another source that stand where words start .. stop of the anchor do."""
    a, z = F.get(places, start), F.get(places, stop)
    got = F.array_join(F.slice(ws, a + 1, F.greatest(z - a, F.lit(0))), " ")
    return F.when(got == "", F.lit("(no corresponding text)")).otherwise(got)
