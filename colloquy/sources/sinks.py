"""Writers: JSON, texts, STM, RTTM, markdown. Each takes columns or rows and leaves the file format to Spark's writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fixed_point(x: Column, digits: int) -> Column:
    """A number with so many decimals, as text; halves go up."""
    return F.round(x, digits).cast(f"decimal(20,{digits})").cast("string")


def stm_line(file_id: Column, speaker: Column, start: Column, stop: Column, text: Column) -> Column:
    from colloquy.functions.text import speaker_id

    return F.concat_ws(" ", file_id, F.lit("1"), speaker_id(speaker), fixed_point(start, 2), fixed_point(stop, 2), text)


def rttm_line(file_id: Column, start: Column, stop: Column, speaker: Column) -> Column:
    return F.concat_ws(" ", F.lit("SPEAKER"), file_id, F.lit("1"), fixed_point(start, 3), fixed_point(stop - start, 3), F.lit("<NA> <NA>"), speaker, F.lit("<NA> <NA>"))


def diarized_line(start: Column, speaker: Column, text: Column) -> Column:
    from colloquy.functions.text import hms

    return F.concat(F.lit("["), hms(start), F.lit("] "), F.coalesce(speaker, F.lit("UNKNOWN")), F.lit(": "), text)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def write_text(df: DataFrame, column: str, path: str, mode: str = "errorifexists") -> None:
    df.select(F.col(column).alias("value")).write.mode(mode).text(path)


def markdown_row(cells: list[Column]) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(c.cast("string"), F.lit("-")) for c in cells]), F.lit(" |"))


def markdown(title: Column, url: Column, paragraphs: Column) -> Column:
    """A page: title, source, and paragraphs, which may be slides, in order."""
    return F.concat(F.lit("# "), title, F.lit("\n\n"), F.coalesce(F.concat(F.lit("Source: "), url, F.lit("\n\n")), F.lit("")), F.array_join(paragraphs, "\n\n"), F.lit("\n"))


def slide_line(number: Column, title: Column, file: Column) -> Column:
    return F.concat(F.lit("!["), F.coalesce(title, F.concat(F.lit("Slide "), number.cast("string"))), F.lit("](slides/"), file, F.lit(")"))


def report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Rows as one JSON record each, with nulls kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def grouped_digits(n: Column) -> Column:
    return F.format_number(n, 0)


def survival_report(rows: DataFrame, key: str, merged: str = "merged") -> DataFrame:
    """(key, page): which sources the merged text is made of. rows: (key, ord, source, words_a: of the source, words_b: of
    the merged text, common, pct_a: retention, pct_b: coverage)."""
    cell = lambda x, c: grouped_digits(x[c])
    pct = lambda x, c: F.concat(F.coalesce(x[c].cast("string"), F.lit("-")), F.lit("%"))
    per = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("ord", "source", "words_a", "words_b", "common", "pct_a", "pct_b"))).alias("r"), F.max("words_b").alias("n"), F.min(F.struct((-F.coalesce("pct_b", F.lit(0))).alias("p"), "ord", "source")).alias("best"))
    line = lambda x: F.concat(F.lit("| "), F.concat_ws(" | ", x["source"], cell(x, "words_a"), cell(x, "common"), pct(x, "pct_b"), pct(x, "pct_a")), F.lit(" |"))
    page = F.concat(
        F.lit(f"# Source Survival Analysis\n\nMerged text: `{merged}` ("), grouped_digits(F.col("n")), F.lit(" words)\n\n| Source | Words | Common | Output Coverage | Retention |\n|--------|------:|-------:|----------------:|----------:|\n"),
        F.array_join(F.transform("r", line), "\n"), F.lit("\n| **Merged output** | **"), grouped_digits(F.col("n")), F.lit("** | | | |\n\n**Most similar source:** "), "best.source", F.lit(" ("), (-F.col("best.p")).cast("string"), F.lit("% output coverage)\n"),
    )
    return per.select(key, page.alias("page"))


def interleaved(segments: DataFrame, slides: DataFrame, key: str, title: Column) -> DataFrame:
    """(key, page): paragraphs by speaker with slides at their times. segments: (key, start, ord, speaker, text); slides:
    (key, start, number, title, file). Text comes before a slide of the same time."""
    from pyspark.sql import Window

    from colloquy.operators.chunks import paragraphs

    null = F.lit(None).cast("string")
    rows = segments.select(key, "start", F.lit(0).alias("kind"), F.col("ord").cast("long").alias("n"), "speaker", F.col("text").alias("line"))
    rows = rows.unionByName(slides.select(key, "start", F.lit(1).alias("kind"), F.col("number").cast("long").alias("n"), null.alias("speaker"), slide_line(F.col("number"), F.col("title"), F.col("file")).alias("line")))
    w = Window.partitionBy(key).orderBy("start", "kind", "n")
    before = F.lag(F.struct("kind", "speaker")).over(w)
    new = before.isNull() | (F.col("kind") == 1) | (before["kind"] == 1) | ~before["speaker"].eqNullSafe(F.col("speaker"))
    rows = rows.withColumn("_new", F.when(new, 1).otherwise(0)).withColumn("part", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    parts = rows.groupBy(key, "part").agg(F.max("kind").alias("kind"), F.max("speaker").alias("speaker"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "n", "line"))), lambda x: x["line"]), " ").alias("t"))
    shown = F.when(F.col("kind") == 1, F.col("t")).otherwise(F.concat(F.coalesce(F.concat(F.lit("**"), "speaker", F.lit("**\n\n")), F.lit("")), paragraphs(F.col("t"))))
    per = parts.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", shown.alias("s")))), lambda x: x["s"]), "\n\n").alias("body"))
    return per.select(key, F.concat(F.lit("# "), title, F.lit("\n\n---\n\n"), "body", F.lit("\n\n---\n")).alias("page"))


def sequential(title: Column, text: Column, slides: Column) -> Column:
    """A page without times: the text, then the slides, an array of struct(title, description, file)."""
    link = lambda n, f: F.concat(F.lit("[![Slide "), n, F.lit("](slides/"), f, F.lit(")](slides/"), f, F.lit(")"))
    told = lambda s: F.coalesce(F.concat(F.lit(" - "), F.nullif(s["title"], F.lit(""))), F.concat(F.lit(" - "), F.left(F.nullif(s["description"], F.lit("")), F.lit(50))), F.lit(""))
    gallery = F.array_join(F.transform(slides, lambda s, i: F.concat(F.lit("### Slide "), (i + 1).cast("string"), told(s), F.lit("\n\n"), link((i + 1).cast("string"), s["file"]), F.lit("\n"))), "\n")
    return F.concat(F.lit("# "), title, F.lit("\n\n---\n\n## Text\n\n"), F.coalesce(text, F.lit("")), F.lit("\n"), F.when(F.size(slides) > 0, F.concat(F.lit("\n---\n\n## Slides\n\n"), gallery)).otherwise(F.lit("")))


def run_status(runs: DataFrame) -> DataFrame:
    """(file_id, status, json) of runs (file_id, at, code: null if it ran out of time, message: of what broke it): each
    file's last run and its record."""
    status = F.when(F.col("message").isNotNull(), "error").when(F.col("code").isNull(), "timeout").when(F.col("code") == 0, "success").otherwise("failed")
    last = runs.groupBy("file_id").agg(F.max_by(F.struct(status.alias("status"), F.when(status == "success", F.col("at").cast("string")).alias("timestamp"), F.when(status == "failed", F.col("code")).alias("returncode"), "message"), F.struct("at", F.coalesce("code", F.lit(-1)))).alias("s"))
    return last.select("file_id", "s.status", F.to_json("s").alias("json"))
