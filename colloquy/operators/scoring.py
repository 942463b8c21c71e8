"""The scoring run: every entry of a dataset against every text there is of it, with a row for what can't be scored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions.fixed import MODEL_ORDER
from colloquy.functions.text import normalized, words
from colloquy.operators import score

METRICS = ("wer", "cpwer", "der")
# Texts that are scored, in this order.
VARIANTS = (*(f"whisper_{m}" for m in MODEL_ORDER), "whisper_merged", "merged")


def variants(outputs: DataFrame) -> DataFrame:
    """(file_id, variant, ord, text) of outputs (file_id, name, text) that are scored, by the names of their files; the
    text merged from all sources has a name that ends with _merged.txt, but for the one of speech models."""
    known = F.array(*[F.lit(v) for v in VARIANTS])
    variant = F.regexp_replace(F.regexp_extract("name", r"^(.*)\.txt$", 1), "^(?!whisper_)[a-z]+_merged$", "merged")
    return outputs.withColumn("variant", variant).withColumn("ord", F.array_position(known, F.col("variant"))).where("ord > 0").select("file_id", "variant", "ord", "text")


def scored(entries: DataFrame, outputs: DataFrame, references: DataFrame, turns: DataFrame, metrics: tuple[str, ...] = METRICS, hypothesis: Column | None = None) -> DataFrame:
    """(file_id, duration_secs, variant, wer, cpwer, der, errors), one row an entry and variant.

    entries: (file_id, duration_secs, has_turns: whether the reference tells speakers); outputs: (file_id, name, text);
    references: (file_id, ref: array<struct<speaker, words>>, ref_turns: array<struct<start, stop, speaker>>);
    turns: (file_id, hyp_turns). An entry without outputs, reference or a text that is scored keeps one row that says so.
    `hypothesis`, a condition on variants, scores some only. Equality joins; a recording is worked on in its own row.
    """
    found = variants(outputs)
    found = found.where(hypothesis) if hypothesis is not None else found
    found = found.join(references.select("file_id"), "file_id", "left_semi")
    df = entries.join(outputs.select("file_id", F.lit(True).alias("any")).distinct(), "file_id", "left").join(references, "file_id", "left").join(found, "file_id", "left").join(turns, "file_id", "left")
    why = F.when(F.col("any").isNull(), "no outputs").when(F.col("ref").isNull(), "no reference").when(F.col("variant").isNull(), "no text to score")
    df = df.withColumn("why", why).withColumn("hyp", F.when(F.col("why").isNull(), normalized(words(F.col("text")))))
    df = df.withColumn("rs", F.when(F.col("why").isNull(), F.transform("ref", lambda r: normalized(r["words"])))).withColumn("r", F.flatten("rs"))
    told = F.coalesce("has_turns", F.lit(False))
    df = df.withColumn("hs", F.when(F.col("hyp").isNotNull(), F.array("hyp")))
    df = score.word_errors(df, "hyp", "r").drop("errors", "ref_words")
    df = score.cp_word_errors(df, "rs", "hs").drop("cp_errors", "ref_words")
    df = score.diarization_errors(df, "ref_turns", "hyp_turns")
    plain = F.col("why").isNull()
    keep = {"wer": plain, "cpwer": plain & told, "der": plain & told & F.col("hyp_turns").isNotNull()}
    errors = [F.col("why")]
    if "cpwer" in metrics:
        errors.append(F.when(plain & ~told, "cpwer: the reference tells no speakers"))
    if "der" in metrics:
        errors += [F.when(plain & ~told, "der: the reference has no turns"), F.when(plain & told & F.col("hyp_turns").isNull(), "der: the output has no turns")]
    cols = [F.when(keep[m], F.col(m)).alias(m) if m in metrics else F.lit(None).cast("double").alias(m) for m in METRICS]
    return df.select("file_id", "duration_secs", F.coalesce("variant", F.lit("")).alias("variant"), *cols, F.array_compact(F.array(*errors)).alias("errors"))


def percent(x: Column) -> Column:
    """A share as per cent to one decimal; a dash for none."""
    return F.coalesce(F.concat(F.replace(F.format_number(x * 100, 1), F.lit(","), F.lit("")), F.lit("%")), F.lit("-"))


def duration(secs: Column) -> Column:
    """H:MM:SS, or M:SS below an hour."""
    s = F.floor(secs).cast("long")
    two = lambda x: F.lpad(F.floor(x).cast("string"), 2, "0")
    h = F.floor(s / 3600)
    return F.when(h > 0, F.concat(h.cast("string"), F.lit(":"), two(s % 3600 / 60), F.lit(":"), two(s % 60))).otherwise(F.concat(F.floor(s / 60).cast("string"), F.lit(":"), two(s % 60)))


def summary(results: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """(variant, files, avg_<metric>, weighted_<metric>, line): the comparison of variants, with its markdown row."""
    sums = [f for m in metrics for f in (F.avg(m).alias(f"avg_{m}"), score.weighted(F.col(m), F.col("duration_secs")).alias(f"weighted_{m}"))]
    got = results.groupBy("variant").agg(F.count("*").alias("files"), *sums)
    cells = [F.col("variant"), *[percent(F.col(f"{kind}_{m}")) for m in metrics for kind in ("avg", "weighted")]]
    return got.withColumn("line", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")))


def report(results: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """(page): the whole report in one row: files scored, hours with each file once, variants compared if there are
    several, a table for each, and warnings. As long as the dataset's list of files."""
    label = {"wer": "WER", "cpwer": "cpWER", "der": "DER"}
    rows = results.withColumn("row", F.concat(F.lit("| "), F.concat_ws(" | ", "file_id", duration(F.col("duration_secs")), *[percent(F.col(m)) for m in metrics]), F.lit(" |")))
    head = "| File ID | Duration | " + " | ".join(label[m] for m in metrics) + " |\n|" + "---|" * (2 + len(metrics)) + "\n"
    avg = lambda kind: F.concat_ws(", ", *[F.concat(F.lit(f"{label[m]}="), percent(F.col(f"{kind}_{m}"))) for m in metrics])
    per = rows.groupBy("variant").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("file_id", "row"))), lambda x: x["row"]), "\n").alias("rows")).join(summary(results, metrics), "variant")
    table = F.concat(F.lit(head), "rows", F.lit("\n\n**Macro average**: "), avg("avg"), F.lit("\n**Duration-weighted average**: "), avg("weighted"), F.lit("\n"))
    per = per.agg(F.array_sort(F.collect_list(F.struct("variant", "line", table.alias("table")))).alias("v"))
    some = F.coalesce(*[F.col(m) for m in metrics]).isNotNull()
    once = results.groupBy("file_id").agg(F.max("duration_secs").alias("secs"), F.max(some).alias("scored"), F.max(F.nullif("variant", F.lit(""))).alias("x"), F.min(F.nullif("variant", F.lit(""))).alias("y"))
    totals = once.agg(F.count("*").alias("files"), F.count_if("scored").alias("n"), (F.sum("secs") / 3600).alias("hours"), (F.max("x") > F.min("y")).alias("several"))
    warned = results.select("file_id", "variant", F.posexplode("errors").alias("n", "e"))
    who = F.when(F.col("variant") != "", F.concat("file_id", F.lit(" ("), "variant", F.lit(")"))).otherwise(F.col("file_id"))
    warned = warned.agg(F.array_sort(F.collect_list(F.struct("file_id", "variant", "n", F.concat(F.lit("- **"), who, F.lit("**: "), "e").alias("line")))).alias("w"))
    compared = "## Comparison\n\n| Variant | " + " | ".join(f"{label[m]} ({k})" for m in metrics for k in ("avg", "wtd")) + " |\n|" + "---|" * (1 + 2 * len(metrics)) + "\n"
    join = lambda c, f, by: F.array_join(F.transform(c, f), by)
    many = F.concat(F.lit(compared), join("v", lambda x: x["line"], "\n"), F.lit("\n\n"), join("v", lambda x: F.concat(F.lit("## "), x["variant"], F.lit("\n\n"), x["table"]), "\n"))
    page = F.concat(
        F.lit("# Evaluation Results\n\n- **Files scored**: "), F.col("n").cast("string"), F.lit(" / "), F.col("files").cast("string"), F.lit("\n- **Total duration**: "), F.replace(F.format_number(F.col("hours"), 1), F.lit(","), F.lit("")), F.lit(" hours\n\n"),
        F.when(F.coalesce("several", F.lit(False)), many).otherwise(join("v", lambda x: x["table"], "\n")), F.when(F.size("w") > 0, F.concat(F.lit("\n## Warnings\n\n"), join("w", lambda x: x["line"], "\n"), F.lit("\n"))).otherwise(F.lit("")),
    )
    # three tables of one row each, put side by side by a key that all have
    one = lambda df: df.withColumn("_one", F.lit(1))
    return one(totals).join(one(per), "_one").join(one(warned), "_one").select(page.alias("page"))


def report_json(results: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """(variant, json): per-file entries and aggregates of each variant, nulls kept."""
    entry = F.struct("file_id", "duration_secs", *metrics, "errors")
    per = results.groupBy("variant").agg(F.array_sort(F.collect_list(entry)).alias("per_file"), F.count("*").alias("num_files")).join(summary(results, metrics).drop("line", "files"), "variant")
    names = [F.col(f"{kind}_{m}").alias(f"{m}_{name}") for m in metrics for kind, name in (("avg", "macro"), ("weighted", "weighted"))]
    return per.select("variant", F.to_json(F.struct("per_file", F.struct(*names).alias("aggregate"), "num_files"), {"ignoreNullFields": "false"}).alias("json"))
