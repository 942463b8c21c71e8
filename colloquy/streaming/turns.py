"""Turns of speakers in a stream of timed words: session windows with a watermark, and running word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def turn_sessions(words: DataFrame, recording: str, speaker: str, ts: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """(recording, speaker, start, stop, words): runs of a speaker's words with no gap of `gap`; words over `late` behind are dropped when streaming."""
    df = words.withWatermark(ts, late) if words.isStreaming else words
    got = df.groupBy(F.col(recording), F.col(speaker), F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("words"), F.max(ts).alias("last"))
    return got.select(recording, speaker, F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "words", "last")


def windowed_counts(words: DataFrame, speaker: str, ts: str, width: str = "1 hour", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """(speaker, start, words) in tumbling or sliding windows."""
    df = words.withWatermark(ts, late) if words.isStreaming else words
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return df.groupBy(w.alias("w"), F.col(speaker)).agg(F.count("*").alias("words")).select(speaker, F.col("w.start").alias("start"), "words")
