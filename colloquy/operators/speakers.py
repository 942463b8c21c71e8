"""Who speaks when: turns, interval joins, votes, names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered_text(text: str, order: str, by: str = " ") -> Column:
    """Texts in order, joined."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), by)


def turns(rows: DataFrame, keys: list[str], speaker: str, order: list[str]) -> DataFrame:
    """Add `turn`, which counts runs of rows with one speaker from 1 on."""
    w = Window.partitionBy(*keys).orderBy(*order)
    new = F.when(F.lag(speaker).over(w).eqNullSafe(F.col(speaker)), 0).otherwise(1)
    return rows.withColumn("_new", new).withColumn("turn", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def with_ends(rows: DataFrame, keys: list[str], start: str, order: list[str], n_words: Column, per_second: float) -> DataFrame:
    """Add `stop`: the next start, and after the last one the time its words take, a second at least."""
    nxt = F.lead(start).over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("stop", F.coalesce(nxt, F.col(start) + F.greatest(F.lit(1.0), n_words / per_second)))


def speaker_at(words: DataFrame, segments: DataFrame, key: str, word: str, at: str, width: float) -> DataFrame:
    """Add `speaker` to words (key, word, at): of the segment (key, ord, start, stop, speaker) that has the time within
    its ends, the first in order if there are several; without any, of the segment whose end is nearest.

    Segments are spread over buckets of `width` seconds, so that the search for a containing one is an equality join.
    The nearest of the others is the last to stop before or the first to start after, found by running extremes.
    """
    bucket = lambda c: F.floor(c / width).cast("long")
    spread = segments.withColumn("bucket", F.explode(F.sequence(bucket(F.col("start")), bucket(F.col("stop")))))
    asked = words.select(key, word, F.col(at).alias("_at")).withColumn("bucket", bucket(F.col("_at")))
    hit = asked.join(spread, [key, "bucket"]).where("_at between start and stop").groupBy(key, word).agg(F.min_by("speaker", "ord").alias("hit"))
    both = words.join(hit, [key, word], "left")
    miss = both.where("hit is null").select(key, F.col(word).alias("_word"), F.col(at).alias("_t"), F.lit(None).cast("long").alias("ord"), F.lit(None).cast("string").alias("speaker"))
    null = F.lit(None).cast("string")
    before = segments.select(key, null.alias("_word"), F.col("stop").alias("_t"), "ord", "speaker")
    after = segments.select(key, null.alias("_word"), F.col("start").alias("_t"), "ord", "speaker")
    miss = miss.withColumn("_word", F.col("_word").cast("string"))

    def nearest(ends: DataFrame, forward: bool) -> DataFrame:
        # rows of segments come before words at the same time in the direction of search
        rows = ends.unionByName(miss)
        order = [F.col("_t") if forward else F.col("_t").desc(), F.col("_word").isNotNull()]
        w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        t = F.col("_t") if forward else -F.col("_t")
        best = F.max(F.when(F.col("_word").isNull(), F.struct(t.alias("t"), (-F.col("ord")).alias("o"), F.col("speaker").alias("s")))).over(w)
        got = rows.withColumn("best", best).where("_word is not null")
        return got.select(key, "_word", F.abs(F.abs(F.col("best.t")) - F.col("_t")).alias("d"), (-F.col("best.o")).alias("o"), F.col("best.s").alias("s")).where("s is not null")

    sides = nearest(before, True).union(nearest(after, False))
    near = sides.groupBy(key, "_word").agg(F.min_by("s", F.struct("d", "o")).alias("near"))
    out = both.withColumn("_word", F.col(word).cast("string")).join(near, [key, "_word"], "left")
    return out.withColumn("speaker", F.coalesce("hit", "near")).withColumn("contained", F.col("hit").isNotNull()).drop("hit", "near", "_word")


def majority(rows: DataFrame, keys: list[str], speaker: str) -> DataFrame:
    """The most frequent speaker of each group; among equals the smallest label; empty labels don't count."""
    n = rows.where(F.col(speaker).isNotNull() & (F.col(speaker) != "")).groupBy(*keys, speaker).agg(F.count("*").alias("votes"))
    best = n.groupBy(*keys).agg(F.min(F.struct((-F.col("votes")).alias("v"), F.col(speaker).alias("s"))).alias("best"))
    return best.select(*keys, F.col("best.s").alias("speaker"), (-F.col("best.v")).alias("votes"))


def segment_speakers(segments: DataFrame, turns_of: DataFrame, key: str, width: float = 60.0) -> DataFrame:
    """Add `speaker` to segments (key, ord, start, stop, words): the majority of its words' speakers at their midpoints, or
    without words the speaker at its own; UNKNOWN in a recording without turns. Words are struct(start, stop)."""
    from functools import reduce

    mid = lambda a, b: (a + b) / 2
    none = F.col("words").isNull() | (F.size("words") == 0)
    mids = F.when(none, F.array(mid(F.col("start"), F.col("stop")))).otherwise(F.transform("words", lambda w: mid(w["start"], w["stop"])))
    asked = segments.select(key, F.col("ord").alias("_ord"), F.posexplode(mids).alias("_i", "_mid")).withColumn("_asked", F.concat_ws(":", F.col("_ord").cast("string"), F.col("_i").cast("string")))
    found = speaker_at(asked, turns_of, key, "_asked", "_mid", width)
    votes = majority(found, [key, "_ord"], "speaker").select(key, F.col("_ord").alias("ord"), F.col("speaker").alias("_speaker"))
    left = reduce(lambda d, c: d.drop(c), ["speaker"], segments)
    return left.join(votes, [key, "ord"], "left").withColumn("speaker", F.coalesce("_speaker", F.lit("UNKNOWN"))).drop("_speaker")


def appearance(rows: DataFrame, keys: list[str], speaker: str, order: str) -> DataFrame:
    """`rank` of each speaker by first appearance, from 1 on."""
    first = rows.groupBy(*keys, speaker).agg(F.min(order).alias("first"))
    return first.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("first", speaker)))


def named(speakers: DataFrame, names: list[str], speaker: str = "speaker") -> DataFrame:
    """Add `name`: the i-th name for the i-th speaker to appear; the others keep their label."""
    given = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    return speakers.withColumn("name", F.coalesce(F.get(given, F.col("rank") - 1), F.col(speaker)))


def renamed(label: Column, names: Column) -> Column:
    """A label by a map of names; unknown labels stay."""
    return F.coalesce(F.try_element_at(names, label), label)


def names_applied(segments: DataFrame, names: Column, speaker: str = "speaker", words: str = "words") -> DataFrame:
    """Labels by a map of names, on segments and on the words in them."""
    inner = F.transform(words, lambda w: w.withField(speaker, renamed(w[speaker], names)))
    return segments.withColumn(speaker, renamed(F.col(speaker), names)).withColumn(words, inner)


def intro(rows: DataFrame, keys: list[str], order: str, n: str, most: int) -> DataFrame:
    """The first rows until `most` words are reached, with the row that reaches them."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("_upto", F.sum(n).over(w) - F.col(n)).where(F.col("_upto") < most).drop("_upto")
