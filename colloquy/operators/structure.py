"""Texts with speakers' names and times: finding the form, parsing, rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.functions.fixed import STRUCTURE


def like(pattern: str):
    return lambda x: F.regexp_like(x, F.lit(pattern))


def form(text: Column) -> Column:
    """lex, bracketed or speaker_only if two of the first 20 lines with content look so, in that order; else null."""
    lines = F.filter(F.split(F.trim(text), "\n"), lambda x: (F.trim(x) != "") & ~F.trim(x).startswith("#"))
    sample = F.slice(lines, 1, 20)
    out = F.lit(None).cast("string")
    for name in reversed(list(STRUCTURE)):
        pattern = STRUCTURE[name][0]
        out = F.when(F.size(F.filter(sample, like(pattern))) >= 2, name).otherwise(out)
    return out


def segments(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, form, seg_ord, speaker, stamp, text): lines from a speaker's line on, joined; what is before the first is left out."""
    df = texts.select(key, F.col(text).alias("_t"), form(F.col(text)).alias("form")).where("form is not null")
    df = df.select(key, "form", F.posexplode(F.split("_t", "\n")).alias("line", "raw"))
    lex, bracketed, named = STRUCTURE["lex"][0], STRUCTURE["bracketed"][1], STRUCTURE["speaker_only"][1]

    def by_form(a: Column, b: Column, c: Column) -> Column:
        return F.when(F.col("form") == "lex", a).when(F.col("form") == "bracketed", b).otherwise(c)

    raw = F.col("raw")
    head = by_form(raw.rlike(lex), raw.rlike(bracketed), raw.rlike(named))
    rest = F.regexp_replace(F.trim(F.regexp_replace(raw, lex, "")), r"^\([^)]*\)\s*", "")
    df = df.withColumn("head", head).withColumn("seg_ord", F.sum(F.when(head, 1).otherwise(0)).over(Window.partitionBy(key).orderBy("line")))
    df = df.where("seg_ord > 0").withColumn(
        "part",
        F.when(F.col("head"), by_form(rest, F.trim(F.regexp_extract(raw, bracketed, 3)), F.trim(F.regexp_extract(raw, named, 2)))).when(F.trim(raw) != "", F.trim(raw)).when(F.col("form") == "lex", F.lit("\n")),
    )
    df = df.withColumn("speaker", F.when(F.col("head"), F.trim(by_form(F.regexp_extract(raw, lex, 1), F.regexp_extract(raw, bracketed, 2), F.regexp_extract(raw, named, 1)))))
    df = df.withColumn("stamp", F.when(F.col("head"), by_form(F.regexp_extract(raw, lex, 2), F.regexp_extract(raw, bracketed, 1), F.lit(None).cast("string"))))
    parts = F.array_sort(F.collect_list(F.when(F.col("part").isNotNull() & (F.col("part") != ""), F.struct("line", "part"))))
    got = df.groupBy(key, "form", "seg_ord").agg(F.max("speaker").alias("speaker"), F.max("stamp").alias("stamp"), parts.alias("parts"))
    # a space before each part but the first and the blank lines
    text = F.aggregate("parts", F.lit(""), lambda s, x: F.when(x["part"] == "\n", F.when(s == "", s).otherwise(F.concat(s, F.lit("\n")))).when(s == "", x["part"]).otherwise(F.concat(s, F.lit(" "), x["part"])))
    return got.select(key, "form", "seg_ord", "speaker", "stamp", F.regexp_replace(text, r"^\s+|\s+$", "").alias("text"))


def rendered(speaker: Column, stamp: Column, text: Column) -> Column:
    """**Speaker** (stamp), then the text."""
    return F.concat(F.lit("**"), speaker, F.lit("**"), F.coalesce(F.concat(F.lit(" ("), stamp, F.lit(")")), F.lit("")), F.lit("\n"), text)
