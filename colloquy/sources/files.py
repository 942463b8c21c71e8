"""Scans of files: each function takes a path that Spark can read and gives one row a record.

Schemas are explicit; missing numbers are 0 and missing texts empty, as the formats' readers expect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEGMENT = "struct<start:double,`end`:double,text:string,speaker:string,words:array<struct<word:string,start:double,`end`:double,speaker:string>>>"
SPEECH = f"segments array<{SEGMENT}>, language string, text string"
TURN = "start double, `end` double, speaker string"
MANIFEST = "version int, dataset string, entries array<struct<file_id:string,audio_path:string,ref_stm_path:string,ref_rttm_path:string,duration_secs:double,subset_tags:array<string>,metadata:map<string,string>>>"
METADATA = "url string, video_id string, id string, title string, channel string, upload_date string, duration double, description string"


def whole(spark: SparkSession, path: str) -> DataFrame:
    """(file, text): whole text files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))


def speech_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, model, text) of files whisper_<model>.txt; merged ones are left out."""
    return model_texts(whole(spark, path))


def model_texts(raw: DataFrame) -> DataFrame:
    """(file, model, text) of (file, text) by the files' names."""
    got = raw.withColumn("model", F.regexp_extract("file", r"whisper_(.*)\.txt$", 1))
    return got.where("model <> '' and not contains(model, 'merged')").select("file", "model", "text")


def speech_segments(spark: SparkSession, path: str) -> DataFrame:
    """(file, ord, start, stop, text, speaker, words) of speech JSON; segments without text are left out."""
    raw = spark.read.schema(SPEECH).json(path, multiLine=True).select(F.col("_metadata.file_name").alias("file"), F.posexplode("segments").alias("ord", "s"))
    return parsed_segments(raw)


def parsed_segments(raw: DataFrame) -> DataFrame:
    words = F.transform(F.coalesce("s.words", F.array().cast("array<struct<word:string,start:double,end:double,speaker:string>>")), lambda w: F.struct(F.coalesce(w["word"], F.lit("")).alias("word"), F.coalesce(w["start"], F.lit(0.0)).alias("start"), F.coalesce(w["end"], F.lit(0.0)).alias("stop"), w["speaker"].alias("speaker")))
    got = raw.where("trim(coalesce(s.text, '')) <> ''")
    return got.select(*[c for c in raw.columns if c != "s"], F.coalesce("s.start", F.lit(0.0)).alias("start"), F.coalesce("s.end", F.lit(0.0)).alias("stop"), F.trim("s.text").alias("text"), F.col("s.speaker").alias("speaker"), words.alias("words"))


def speaker_turns(spark: SparkSession, path: str) -> DataFrame:
    """(file, ord, start, stop, speaker) of diarization JSON, a list of turns in order."""
    return parsed_turns(whole(spark, path))


def parsed_turns(texts: DataFrame) -> DataFrame:
    """(file, ord, start, stop, speaker) of (file, text)."""
    raw = texts.select("file", F.posexplode(F.from_json("text", f"array<struct<{', '.join(x.replace(' ', ':', 1) for x in TURN.split(', '))}>>")).alias("ord", "s"))
    return raw.select("file", "ord", F.round("s.start", 3).alias("start"), F.round("s.end", 3).alias("stop"), F.col("s.speaker").alias("speaker"))


def captions(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of WebVTT files."""
    return whole(spark, path).select("file", caption_text(F.col("text")).alias("text"))


def caption_text(raw):
    """Caption lines without header, times and tags; of equal lines the first; joined by spaces."""
    lines = F.transform(F.split(raw, "\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    kept = F.filter(lines, lambda x: (x != "") & ~x.rlike(r"^(?:WEBVTT|Kind:|Language:)|^[0-9]{2}:[0-9]{2}:[0-9]{2}|-->"))
    plain = F.transform(kept, lambda x: F.trim(F.regexp_replace(x, "<[^>]+>", "")))
    return F.array_join(F.array_distinct(F.filter(plain, lambda x: x != "")), " ")


def metadata(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Media metadata, a record a file or a line; descriptions are cut to 500 characters."""
    m = spark.read.schema(METADATA).json(path, multiLine=not lines)
    return m.select("url", F.coalesce("video_id", "id").alias("video_id"), "title", "channel", "upload_date", F.coalesce("duration", F.lit(0.0)).alias("duration_seconds"), F.left(F.coalesce("description", F.lit("")), F.lit(500)).alias("description"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(ord, file_id, audio_path, ...) of an evaluation manifest."""
    return spark.read.schema(MANIFEST).json(path, multiLine=True).select(F.posexplode("entries").alias("ord", "e")).select("ord", "e.*")


def filtered(entries: DataFrame, subset: str | None = None, ids: list[str] | None = None, max_hours: float | None = None, limit: int | None = None) -> DataFrame:
    """Subset, ids, running duration, limit, in that order; no ids is no filter."""
    from colloquy.operators import chunks

    if subset:
        entries = entries.where(F.array_contains("subset_tags", subset))
    if ids:
        entries = entries.where(F.col("file_id").isin(ids))
    if max_hours is not None:
        entries = chunks.running_total(entries, ["ord"], "duration_secs", max_hours * 3600)
    return entries.orderBy("ord").limit(limit) if limit else entries


def dataset_csv(spark: SparkSession, path: str) -> DataFrame:
    """(file_id, duration_secs, sampling_rate, speakers, ...) of a dataset's metadata table; numbers that can't be read are 0."""
    df = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True)
    kinds = {"duration_secs": "double", "sampling_rate": "int", "speakers": "int"}
    return df.withColumns({c: F.coalesce(F.col(c).try_cast(t), F.lit(0).cast(t)) for c, t in kinds.items() if c in df.columns})


def external(spark: SparkSession, path: str, raw: DataFrame | None = None) -> DataFrame:
    """(file, text) of published texts: pages by their text, others as they are, trimmed. Any path that Spark reads."""
    from colloquy.functions.text import is_html
    from colloquy.sources.pages import with_text

    df = (raw if raw is not None else whole(spark, path)).select("file", F.regexp_replace("text", r"^\s+|\s+$", "").alias("html"))
    return with_text(df, "html", "plain").select("file", F.when(is_html(F.col("html")), F.col("plain")).otherwise(F.col("html")).alias("text"))


def kept_metadata(spark: SparkSession, path: str, compute) -> DataFrame:
    """Metadata kept at `path` if there is some; else that of `compute()`, written there first."""
    from pyspark.errors import AnalysisException

    try:
        return metadata(spark, path, lines=True)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    compute().write.json(path)
    return metadata(spark, path, lines=True)


def run_files(raw: DataFrame, key: str = "run") -> DataFrame:
    """What a run has on disk, by its files' names: (run, audio, captions, speech: map of model -> file, base, segments,
    diarized, merged). raw: (run, file). The base is the merged speech text, else the best model's."""
    from colloquy.operators.ensemble import base_model

    name = F.element_at(F.split("file", "/"), -1)
    model = F.regexp_extract(name, r"^whisper_(.*)\.txt$", 1)
    one = lambda when: F.min(F.when(when, F.col("file")))
    speech = F.when((model != "") & ~model.contains("merged"), F.struct(model.alias("model"), F.col("file").alias("file")))
    per = raw.groupBy(key).agg(
        F.coalesce(one(name == "audio.mp3"), one(name == "audio.wav")).alias("audio"), one(name == "captions.en.vtt").alias("captions"), F.map_from_entries(F.array_sort(F.collect_list(speech))).alias("speech"),
        one(name == "whisper_merged.txt").alias("_w"), F.collect_set(F.when(name.rlike(r"^whisper_.*\.json$"), F.struct(F.regexp_extract(name, r"^whisper_(.*)\.json$", 1).alias("model"), F.col("file").alias("file")))).alias("_j"),
        one(name == "diarized.txt").alias("diarized"), one(name.rlike("^(?!whisper_)[a-z]+_merged[.]txt$")).alias("merged"),
    )
    best = base_model(F.map_keys("speech"))
    return per.select(key, "audio", "captions", "speech", F.coalesce("_w", F.try_element_at("speech", best)).alias("base"), F.get(F.filter("_j", lambda x: x["model"] == best), F.lit(0))["file"].alias("segments"), "diarized", "merged")


def input_times(raw: DataFrame, key: str, names: list[str]) -> DataFrame:
    """(key, inputs): times of the named files that are there, for `checkpoints.up_to_date`. raw: (key, file, at)."""
    name = F.element_at(F.split("file", "/"), -1)
    return raw.groupBy(key).agg(F.array_sort(F.collect_list(F.when(name.isin(names), F.col("at")))).alias("inputs"))


def references(raw: DataFrame, key: str, text: str) -> DataFrame:
    """(key, idx, token, speaker) of pipe-delimited reference tokens after a header; lines of fewer than six fields don't count."""
    from pyspark.sql import Window

    from colloquy.functions.text import cased

    df = raw.select(key, F.posexplode(F.split(text, "\n")).alias("line", "raw")).where("line > 0").withColumn("f", F.split(F.trim("raw"), r"\|")).where("size(f) >= 6")
    token = cased(F.col("f")[0], F.col("f")[5])
    punct = F.when(F.col("f")[4].isin("", "<NA>"), "").otherwise(F.col("f")[4])
    return df.select(key, (F.row_number().over(Window.partitionBy(key).orderBy("line")) - 1).alias("idx"), F.concat(token, punct).alias("token"), F.col("f")[1].alias("speaker"))


def stm(raw: DataFrame, line: str) -> DataFrame:
    """(file_id, channel, speaker, start, stop, text) of STM lines; lines of fewer than six fields are left out."""
    f = F.split(F.trim(line), r"\s+", 6)
    return raw.withColumn("_f", f).where("size(_f) >= 6").select(*[F.col("_f")[i].alias(n) for i, n in enumerate(("file_id", "channel", "speaker"))], F.col("_f")[3].try_cast("double").alias("start"), F.col("_f")[4].try_cast("double").alias("stop"), F.col("_f")[5].alias("text"))


def rttm(raw: DataFrame, line: str) -> DataFrame:
    """(file_id, start, stop, speaker) of RTTM lines."""
    f = F.split(F.trim(line), r"\s+")
    got = raw.withColumn("_f", f).where("size(_f) >= 8 and _f[0] = 'SPEAKER'")
    start, length = F.col("_f")[3].try_cast("double"), F.col("_f")[4].try_cast("double")
    return got.select(F.col("_f")[1].alias("file_id"), start.alias("start"), (start + length).alias("stop"), F.col("_f")[7].alias("speaker"))


def tensors(spark: SparkSession, path: str) -> DataFrame:
    """(file, shape, values) of .npy files of numbers."""
    return parsed_tensors(spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_name").alias("file"), "content"))


def parsed_tensors(raw: DataFrame) -> DataFrame:
    """(file, shape, values) of (file, content)."""
    import pyarrow as pa

    def work(batches):
        import io

        import numpy as np

        for b in batches:
            arrays = [np.load(io.BytesIO(x), allow_pickle=False) for x in b.column("content").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("file"), pa.array([list(a.shape) for a in arrays], pa.list_(pa.int64())), pa.array([a.astype("f4").ravel().tolist() for a in arrays], pa.list_(pa.float32()))], ["file", "shape", "values"])

    return raw.mapInArrow(work, "file string, shape array<long>, values array<float>")


def slide_log(raw: DataFrame, key: str, text: str) -> DataFrame:
    """(key, slide_number, timestamp) of a scene filter's log."""
    return raw.select(key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(r"pts_time:([0-9]+\.?[0-9]*)"), F.lit(1))).alias("n", "t")).select(key, (F.col("n") + 1).alias("slide_number"), F.col("t").cast("double").alias("timestamp"))


def slide_answer(answer, schema: str = "type string, title string, subtitle string, bullet_points array<string>, description string"):
    """A slide's fields from a model's answer: the text from the first { to the last }, null fields if it can't be read."""
    return F.from_json(F.regexp_extract(answer, r"(?s)(\{.*\})", 1), schema)


def names_answer(answer):
    """map of speaker label -> name from a model's answer: the first {...} without inner braces; empty if there is none."""
    return F.coalesce(F.from_json(F.regexp_extract(answer, r"(\{[^{}]*\})", 1), "map<string,string>"), F.create_map().cast("map<string,string>"))


def with_metadata(entries: DataFrame, table: DataFrame, key: str, duration: str) -> DataFrame:
    """Entries with their duration, 0 where the table has no row, and a map of the table's other columns, empty there."""
    rest = [c for c in table.columns if c not in (key, duration)]
    pairs = [x for c in rest for x in (F.lit(c), F.col(c).cast("string"))]
    side = table.select(key, F.col(duration).alias("_secs"), F.create_map(*pairs).alias("_meta") if pairs else F.create_map().cast("map<string,string>").alias("_meta"))
    got = entries.join(side, key, "left")
    return got.withColumn(duration, F.coalesce("_secs", F.lit(0.0))).withColumn("metadata", F.coalesce("_meta", F.create_map().cast("map<string,string>"))).drop("_secs", "_meta")
