"""Queries that write and read files and records: metadata, manifests, tables, tensors, logs, pages of reports, runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.functions import text
from colloquy.operators import choose, loops, scoring, speakers
from colloquy.plans.speech import E, SEG, events, segments
from colloquy.plans.texts import WORDS, docs
from colloquy.session import scratch, table
from colloquy.sources import files, sinks


def metadata_files(spark, sf):
    """Documents as media metadata, written as JSON, kept and read back."""
    d = docs(spark, sf).select(F.lit("https://example.org").alias("url"), F.col("doc_id").cast("string").alias("id"), F.lit(None).cast("string").alias("video_id"), F.col("source").alias("title"), F.col("lang").alias("channel"), F.lit("20260101").alias("upload_date"), F.when(F.col("doc_id") % 2 == 0, F.col("n_chars") / 10).alias("duration"), F.regexp_replace("text", "[^a-z]", "").alias("description"))
    return files.kept_metadata(spark, scratch(spark, "metadata"), lambda: d)


METADATA_FILES = """SELECT 'https://example.org' AS url, doc_id::VARCHAR AS video_id, source AS title, lang AS channel, '20260101' AS upload_date, CASE WHEN doc_id % 2 = 0 THEN n_chars / 10 ELSE 0.0 END AS duration_seconds,
  left(regexp_replace(text, '[^a-z]', '', 'g'), 500) AS description FROM documents"""


def model_files(spark, sf):
    """Texts by their files' names, written and read as whole texts: one of each model, merged ones left out."""
    name = F.concat(F.lit("whisper_"), F.element_at(F.array(*[F.lit(m) for m in ("small", "medium", "merged")]), (F.col("doc_id") % 3 + 1).cast("int")), F.lit(".txt"))
    d = docs(spark, sf).select(F.col("doc_id").cast("string").alias("n"), name.alias("name"), F.regexp_replace("text", r"[\r\n]", " ").alias("value"))
    path = scratch(spark, "texts")
    sinks.write_text(d.select(F.concat_ws("\t", "n", "name", "value").alias("line")), "line", path)
    back = spark.read.text(path, lineSep="\n").select(F.split("value", "\t", 3).alias("f")).select(F.concat(F.col("f")[0], F.lit("/"), F.col("f")[1]).alias("file"), F.col("f")[2].alias("text"))
    return files.model_texts(back).select("file", "model", F.md5("text").alias("digest"))


MODEL_FILES = r"""SELECT doc_id || '/whisper_' || ['small', 'medium'][doc_id % 3 + 1] || '.txt' AS file, ['small', 'medium'][doc_id % 3 + 1] AS model, md5(regexp_replace(text, '[\r\n]', ' ', 'g')) AS digest FROM documents WHERE doc_id % 3 < 2"""


def turn_json(spark, sf):
    """Speaker turns as JSON lists, read back with times to the millisecond."""
    one = F.struct((F.col("start") % 86400 + 0.00049).alias("start"), (F.col("stop") % 86400).alias("end"), "speaker")
    raw = segments(spark, sf).groupBy(F.col("rec").cast("string").alias("file")).agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("ord", one.alias("s")))), lambda x: x["s"])).alias("text"))
    return files.parsed_turns(raw)


TURN_JSON = f"WITH {SEG} SELECT rec::VARCHAR AS file, (row_number() OVER (PARTITION BY rec ORDER BY ord) - 1)::INTEGER AS ord, round(start % 86400 + 0.00049, 3) AS start, round(stop % 86400, 3) AS stop, speaker FROM s"


def tensor_files(spark, sf):
    """Embeddings as .npy contents, read back."""
    import pyarrow as pa

    def work(batches):
        import io

        import numpy as np

        for b in batches:
            out = []
            for x in b.column(1).to_pylist():
                f = io.BytesIO()
                np.save(f, np.array(x, "f4").reshape(2, -1))
                out.append(f.getvalue())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["file", "content"])

    raw = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("file"), "embedding").mapInArrow(work, "file string, content binary")
    got = files.parsed_tensors(raw)
    return got.select("file", F.array_join(F.transform("shape", lambda x: x.cast("string")), "x").alias("shape"), F.size("values").alias("n"), F.round(F.aggregate("values", F.lit(0.0), lambda s, x: s + x.cast("double")), 4).alias("total"), F.round(F.get("values", F.lit(3)).cast("double"), 6).alias("fourth"))


TENSOR_FILES = """SELECT vec_id::VARCHAR AS file, '2x' || (len(embedding) // 2) AS shape, len(embedding)::INTEGER AS n, round(list_sum([x::DOUBLE FOR x IN embedding]), 4) AS total, round(embedding[4]::DOUBLE, 6) AS fourth FROM embeddings"""


def scene_logs(spark, sf):
    """Times of scenes in a filter's log of each recording."""
    line = F.format_string("[showinfo @ 0x1] n: %d pts: 1 pts_time:%s pos", F.col("event_id"), (F.floor(F.col("value") * 10) / 10).cast("decimal(12,1)").cast("string"))
    log = events(spark, sf).groupBy("rec").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("t", "event_id", line.alias("l")))), lambda x: x["l"]), "\nframe= 1 fps=0\n").alias("log"))
    return files.slide_log(log, "rec", "log")


SCENE_LOGS = f"WITH {E} SELECT rec, row_number() OVER (PARTITION BY rec ORDER BY t, event_id)::INTEGER AS slide_number, floor(value * 10) / 10 AS timestamp FROM e"


def dataset_table(spark, sf):
    """A dataset's table with typed columns, written as CSV and read back; what is no number is 0."""
    path = scratch(spark, "dataset")
    d = docs(spark, sf).select(F.col("doc_id").alias("file_id"), F.when(F.col("doc_id") % 4 == 0, F.lit("n/a")).otherwise(F.format_string("%.3f", F.col("n_chars") / 8)).alias("duration_secs"), F.when(F.col("doc_id") % 3 > 0, "16000").alias("sampling_rate"), F.regexp_replace(F.left("text", F.lit(40)), r"[\\\s]+", " ").alias("title"), F.lit(2).alias("speakers"))
    d.write.csv(path, header=True, quote='"', escape='"')
    return files.dataset_csv(spark, path).select("file_id", "duration_secs", "sampling_rate", "speakers", F.trim(F.coalesce("title", F.lit(""))).alias("title"))


DATASET_TABLE = r"""SELECT doc_id::VARCHAR AS file_id, CASE WHEN doc_id % 4 = 0 THEN 0.0 ELSE n_chars / 8 END AS duration_secs, CASE WHEN doc_id % 3 > 0 THEN 16000 ELSE 0 END AS sampling_rate, 2 AS speakers, trim(regexp_replace(left(text, 40), '[\\\s]+', ' ', 'g')) AS title FROM documents"""


def manifest_files(spark, sf):
    """A manifest a source, written and read; entries by ids and by a limit."""
    entry = F.struct(F.col("doc_id").cast("string").alias("file_id"), F.lit("a.mp3").alias("audio_path"), F.lit("r.stm").alias("ref_stm_path"), F.when(F.col("doc_id") % 2 == 0, F.lit("r.rttm")).alias("ref_rttm_path"), (F.col("n_chars") / 4).alias("duration_secs"), F.array("lang").alias("subset_tags"), F.create_map(F.lit("source"), F.col("source")).alias("metadata"))
    m = docs(spark, sf).groupBy("source").agg(F.array_sort(F.collect_list(F.struct("doc_id", entry.alias("e"))), lambda a, b: (a["doc_id"] - b["doc_id"]).cast("int")).alias("l")).select(F.lit(1).alias("version"), F.col("source").alias("dataset"), F.transform("l", lambda x: x["e"]).alias("entries"))
    path = scratch(spark, "manifest")
    sinks.write_json(m, path)
    back = spark.read.schema(files.MANIFEST).json(path).select("dataset", F.posexplode("entries").alias("ord", "e")).select("dataset", "ord", "e.*")
    return back.select("dataset", "ord", "file_id", "duration_secs", "ref_rttm_path", F.col("metadata")["source"].alias("source"), F.array_join("subset_tags", ",").alias("tags"))


MANIFEST_FILES = """SELECT source AS dataset, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1)::INTEGER AS ord, doc_id::VARCHAR AS file_id, n_chars / 4 AS duration_secs, CASE WHEN doc_id % 2 = 0 THEN 'r.rttm' END AS ref_rttm_path, source, lang AS tags FROM documents"""


def first_entries(spark, sf):
    """The first 20 entries of those that are asked for by id."""
    d = docs(spark, sf).select(F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("file_id"), F.array("lang").alias("subset_tags"), F.col("n_chars").cast("double").alias("duration_secs"))
    return files.filtered(d, ids=[str(3 * i) for i in range(60)], limit=20).select("ord", "file_id")


FIRST_ENTRIES = "SELECT doc_id AS ord, doc_id::VARCHAR AS file_id FROM documents WHERE doc_id % 3 = 0 AND doc_id < 180 ORDER BY doc_id LIMIT 20"


def external_texts(spark, sf):
    """Pages and plain texts as published texts: which are pages, and plain ones as they are."""
    p = table(spark, sf, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("file"), F.col("html").alias("text"))
    d = docs(spark, sf).select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("file"), F.concat(F.lit("\n "), "text", F.lit("\t\n")).alias("text"))
    got = files.external(spark, "", p.union(d))
    return got.select("file", F.when(F.col("file").startswith("d"), F.md5("text")).alias("digest"), F.col("text").rlike("<(html|p|div)>").alias("marked"))


EXTERNAL_TEXTS = r"""SELECT 'p' || page_id AS file, NULL AS digest, false AS marked FROM pages
UNION ALL SELECT 'd' || doc_id, md5(regexp_replace(text, '^\s+|\s+$', '', 'g')), regexp_matches(text, '<(html|p|div)>') FROM documents"""


def run_folders(spark, sf):
    """What runs have on disk: the base text is the merged speech text, else the best model's."""
    names = ["audio.mp3", "audio.wav", "captions.en.vtt", "whisper_small.txt", "whisper_medium.txt", "whisper_medium.json", "whisper_merged.txt", "diarized.txt"]
    d = docs(spark, sf).select(F.col("doc_id").alias("run"), F.posexplode(F.array(*[F.lit(n) for n in names])).alias("i", "n")).where("(run >> i) % 2 = 1")
    got = files.run_files(d.select("run", F.concat(F.lit("r/"), "n").alias("file")))
    return got.select("run", "audio", "captions", F.array_join(F.map_keys("speech"), ",").alias("models"), "base", "segments", "diarized")


RUN_FOLDERS = """WITH d AS (SELECT doc_id AS run, [(doc_id >> i) % 2 = 1 FOR i IN range(0, 8)] AS b FROM documents)
SELECT run, CASE WHEN b[1] THEN 'r/audio.mp3' WHEN b[2] THEN 'r/audio.wav' END AS audio, CASE WHEN b[3] THEN 'r/captions.en.vtt' END AS captions,
  concat_ws(',', CASE WHEN b[5] THEN 'medium' END, CASE WHEN b[4] THEN 'small' END) AS models,
  CASE WHEN b[7] THEN 'r/whisper_merged.txt' WHEN b[5] THEN 'r/whisper_medium.txt' WHEN b[4] THEN 'r/whisper_small.txt' END AS base,
  CASE WHEN b[5] AND b[6] THEN 'r/whisper_medium.json' END AS segments, CASE WHEN b[8] THEN 'r/diarized.txt' END AS diarized
FROM d WHERE list_contains(b, true)"""


def fresh_inputs(spark, sf):
    """Outputs of orders that are no older than the inputs that count."""
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.concat(F.lit("d/"), F.element_at(F.array(*[F.lit(n) for n in ("a.txt", "b.vtt", "x.log")]), (F.col("l_linenumber") % 3 + 1).cast("int"))).alias("file"), F.col("l_shipdate").cast("timestamp").alias("at"))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderdate").cast("timestamp") + F.expr("interval 60 days")).alias("made"))
    from colloquy.operators import checkpoints

    got = o.join(files.input_times(li, "k", ["a.txt", "b.vtt"]), "k")
    return got.select("k", F.size("inputs").alias("n"), checkpoints.up_to_date(F.col("made"), F.col("inputs")).alias("fresh"))


FRESH_INPUTS = """SELECT l_orderkey AS k, count(*) FILTER (l_linenumber % 3 < 2)::INTEGER AS n, coalesce(max(CASE WHEN l_linenumber % 3 < 2 THEN l_shipdate END) <= any_value(o_orderdate) + INTERVAL 60 DAY, true) AS fresh
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey"""


def run_records(spark, sf):
    """Each file's last run and its record."""
    e = table(spark, sf, "events").select(F.col("user_id").alias("file_id"), F.col("ts").cast("timestamp").alias("at"), F.when(F.col("event_id") % 5 > 0, (F.col("event_id") % 3).cast("int")).alias("code"), F.when(F.col("event_id") % 7 == 0, F.lit("broken")).alias("message"))
    return sinks.run_status(e).select("file_id", "status", F.get_json_object("json", "$.returncode").alias("code"), F.get_json_object("json", "$.message").alias("message"))


RUN_RECORDS = """SELECT user_id AS file_id, CASE WHEN event_id % 7 = 0 THEN 'error' WHEN event_id % 5 = 0 THEN 'timeout' WHEN event_id % 3 = 0 THEN 'success' ELSE 'failed' END AS status,
  CASE WHEN event_id % 7 <> 0 AND event_id % 5 > 0 AND event_id % 3 > 0 THEN (event_id % 3)::VARCHAR END AS code, CASE WHEN event_id % 7 = 0 THEN 'broken' END AS message
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1"""


def run_costs(spark, sf):
    d = docs(spark, sf).select("doc_id", F.size(text.words(F.col("text"))).alias("n"))
    c = choose.total_cost(F.col("n"), F.when(F.col("doc_id") % 2 == 0, F.col("n") % 7), F.lit(2) + F.col("doc_id") % 2, F.col("doc_id") % 4, F.lit("claude-sonnet-4-5"))
    return d.select("doc_id", *[F.round(c[k], 9).alias(k) for k in ("slides", "merge", "ensemble", "total")])


RUN_COSTS = f"""WITH d AS (SELECT doc_id, len({WORDS})::INTEGER AS n FROM documents), p AS (SELECT *, greatest(1, n // 500 + 1) AS c, 2 + doc_id % 2 AS s, doc_id % 4 AS m FROM d),
q AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN n % 7 * 0.02::DOUBLE ELSE 0.0 END AS slides, floor((n * s // c + 500) * c * 1.3::DOUBLE) * 0.003::DOUBLE / 1000 + floor(n // c * c * 1.3::DOUBLE) * 0.015::DOUBLE / 1000 AS merge,
  CASE WHEN m > 1 THEN floor((n * m // c + 500) * c * 1.3::DOUBLE) * 0.003::DOUBLE / 1000 + floor(n // c * c * 1.3::DOUBLE) * 0.015::DOUBLE / 1000 ELSE 0.0 END AS ensemble FROM p)
SELECT doc_id, round(slides, 9) AS slides, round(merge, 9) AS merge, round(ensemble, 9) AS ensemble, round(slides + merge + ensemble, 9) AS total FROM q"""


def hypothesis_kinds(spark, sf):
    """Which of a run's texts is scored, by HYPOTHESES: by itself, of the merged text, and of speech models."""
    d = docs(spark, sf).select("doc_id")
    bit = {"diarized": 16, "merged": 2, "speech_merged": 4, "speech_medium": 8, "speech_small": 1}
    has = lambda k: F.floor(F.col("doc_id") / bit[k]) % 2 == 1
    merged = F.when(F.col("doc_id") % 3 == 0, F.lit("Hello\n**Ann** (0:01:02)\n\nWell.")).otherwise(F.lit("**Ann** said"))
    return d.select("doc_id", *[choose.hypothesis(k, has, merged).alias(k) for k in choose.HYPOTHESES])


HYPOTHESIS_KINDS = """WITH d AS (SELECT doc_id, doc_id // 16 % 2 = 1 AS d, doc_id // 2 % 2 = 1 AS m, doc_id // 4 % 2 = 1 AS w, doc_id // 8 % 2 = 1 AS e, doc_id % 2 = 1 AS s, CASE WHEN doc_id % 3 = 0 THEN 'structured_merged' ELSE 'plain_merged' END AS k FROM documents)
SELECT doc_id, CASE WHEN m THEN k END AS merged, CASE WHEN d THEN 'diarized' END AS diarized, CASE WHEN w THEN 'speech_merged' WHEN e THEN 'speech_medium' WHEN s THEN 'speech_small' END AS speech,
  CASE WHEN d THEN 'diarized' WHEN m THEN k WHEN w THEN 'speech_merged' WHEN e THEN 'speech_medium' WHEN s THEN 'speech_small' END AS auto FROM d"""


def segment_votes(spark, sf):
    """Segments of a day by the majority of their words, by their own midpoint where they have none, and UNKNOWN in
    recordings without turns."""
    e = events(spark, sf).withColumn("ord", F.floor(F.col("t") / 86400).cast("long"))
    segs = e.groupBy("rec", "ord").agg(F.min("t").alias("start"), F.max("t").alias("stop"), F.sort_array(F.collect_list(F.struct(F.col("t").alias("start"), (F.col("t") + 1).alias("stop")))).alias("w"))
    segs = segs.withColumn("words", F.when(F.col("ord") % 2 == 1, F.col("w"))).drop("w")
    return speakers.segment_speakers(segs, segments(spark, sf).where("rec % 4 > 0"), "rec", 3600.0).select("rec", "ord", "speaker")


SEGMENT_VOTES = f"""WITH {SEG}, g AS (SELECT *, floor(t / 86400)::BIGINT AS day FROM e),
m AS (SELECT rec, day, t AS id, (t + (t + 1)) / 2 AS mid FROM g WHERE day % 2 = 1 UNION ALL SELECT rec, day, 0, (min(t) + max(t)) / 2 FROM g WHERE day % 2 = 0 GROUP BY rec, day),
c AS (SELECT m.rec, day, id, s.speaker, row_number() OVER (PARTITION BY m.rec, day, id ORDER BY (mid BETWEEN start AND stop) DESC, CASE WHEN mid BETWEEN start AND stop THEN 0.0 ELSE least(abs(start - mid), abs(stop - mid)) END, ord) AS k FROM m JOIN s ON m.rec = s.rec AND s.rec % 4 > 0),
v AS (SELECT rec, day, speaker, count(*) AS n FROM c WHERE k = 1 GROUP BY ALL), b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY rec, day ORDER BY n DESC, speaker) = 1)
SELECT d.rec, d.day AS ord, coalesce(b.speaker, 'UNKNOWN') AS speaker FROM (SELECT DISTINCT rec, day FROM g) d LEFT JOIN b ON b.rec = d.rec AND b.day = d.day"""


def word_names(spark, sf):
    """Names on segments and on the words in them; labels without a name stay."""
    names = F.create_map(*[F.lit(x) for x in ("click", "Ann", "view", "Ben")])
    s = events(spark, sf).groupBy("rec").agg(F.min("speaker").alias("speaker"), F.sort_array(F.collect_list(F.struct("event_id", "speaker"))).alias("words"))
    got = speakers.names_applied(s, names)
    return got.select("rec", "speaker", F.array_join(F.transform("words", lambda w: w["speaker"]), " ").alias("words"))


WORD_NAMES = f"""WITH {E}, n AS (SELECT *, CASE speaker WHEN 'click' THEN 'Ann' WHEN 'view' THEN 'Ben' ELSE speaker END AS name FROM e)
SELECT rec, CASE min(speaker) WHEN 'click' THEN 'Ann' WHEN 'view' THEN 'Ben' ELSE min(speaker) END AS speaker, string_agg(name, ' ' ORDER BY event_id) AS words FROM n GROUP BY rec"""


def loop_rows(spark, sf):
    """Loops of up to ten words said four times or more, by place, one row each."""
    got = loops.with_loops(docs(spark, sf).select("doc_id", "text"), "text")
    return got.select("doc_id", F.posexplode("loops").alias("n", "l")).select("doc_id", "n", "l.phrase", "l.count", "l.start_pos", "l.end_pos")


def loops_cut(spark, sf):
    """Texts with each loop said twice, and how many words that takes out."""
    got = loops.with_loops(docs(spark, sf).select("doc_id", "text"), "text")
    removed = F.aggregate("loops", F.lit(0), lambda s, x: s + F.size(F.split(x["phrase"], " ")) * (x["count"] - 2))
    return got.select("doc_id", F.md5("collapsed").alias("digest"), removed.alias("words_removed"))


# how far words agree with those `size` later: runs by islands; the shortest phrase of a place; then from the left
LOOPS = f"""w AS MATERIALIZED (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) - 1 AS i FROM (SELECT doc_id, {WORDS} AS ws FROM documents)),
q AS (SELECT w.doc_id, w.i, z.size, coalesce(w.x = lead(w.x, z.size) OVER (PARTITION BY w.doc_id, z.size ORDER BY w.i), false) AS same FROM w, (SELECT unnest(range(1, 11)) AS size) z),
r AS (SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, size ORDER BY i DESC ROWS UNBOUNDED PRECEDING) AS isle FROM q),
u AS (SELECT doc_id, i, size, row_number() OVER (PARTITION BY doc_id, size, isle, same ORDER BY i DESC) AS run FROM r WHERE same),
l AS MATERIALIZED (SELECT doc_id, i, size, run // size + 1 AS times FROM u WHERE run // size + 1 >= 4 QUALIFY row_number() OVER (PARTITION BY doc_id, i ORDER BY size) = 1),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM l) WHERE k = 1 UNION ALL
  SELECT l.doc_id, l.i, l.size, l.times, t.k + 1 FROM t JOIN l ON l.doc_id = t.doc_id AND l.i >= t.i + t.size * t.times
  QUALIFY row_number() OVER (PARTITION BY l.doc_id ORDER BY l.i) = 1)"""
LOOP_ROWS = f"""WITH RECURSIVE {LOOPS},
p AS (SELECT doc_id, i, x, coalesce(sum(length(x) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at FROM w)
SELECT t.doc_id, (t.k - 1)::INTEGER AS n, string_agg(CASE WHEN p.i < t.i + t.size THEN p.x END, ' ' ORDER BY p.i) AS phrase, t.times::INTEGER AS count, min(p.at)::INTEGER AS start_pos, max(p.at + length(p.x))::INTEGER AS end_pos
FROM t JOIN p ON p.doc_id = t.doc_id AND p.i >= t.i AND p.i < t.i + t.size * t.times GROUP BY t.doc_id, t.k, t.times"""
LOOPS_CUT = f"""WITH RECURSIVE {LOOPS},
g AS (SELECT w.doc_id, w.i, w.x FROM w WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.doc_id = w.doc_id AND w.i >= t.i + 2 * t.size AND w.i < t.i + t.size * t.times)),
j AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS said FROM g GROUP BY doc_id), n AS (SELECT doc_id, sum(size * (times - 2)) AS n FROM t GROUP BY doc_id)
SELECT d.doc_id, md5(CASE WHEN n.n IS NULL THEN d.text ELSE j.said END) AS digest, coalesce(n.n, 0)::INTEGER AS words_removed FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN j ON j.doc_id = d.doc_id"""


def survival_reports(spark, sf):
    """Which sources a merged text is made of, as a page for each language."""
    d = docs(spark, sf).groupBy("lang", "source").agg(F.sum("n_chars").cast("int").alias("words_a"), F.count("*").cast("int").alias("c"))
    rows = d.select("lang", F.ascii("source").alias("ord"), "source", "words_a", F.lit(12345).alias("words_b"), F.col("c").alias("common"), (F.col("words_a") % 100).alias("pct_a"), (F.col("c") % 7).alias("pct_b"))
    return sinks.survival_report(rows, "lang")


SURVIVAL_REPORTS = """WITH r AS (SELECT lang, source, ascii(source) AS ord, sum(n_chars)::INTEGER AS a, count(*)::INTEGER AS c FROM documents GROUP BY lang, source),
b AS (SELECT lang, source, c % 7 AS p FROM r QUALIFY row_number() OVER (PARTITION BY lang ORDER BY c % 7 DESC, ord, source) = 1)
SELECT r.lang, '# Source Survival Analysis' || chr(10) || chr(10) || 'Merged text: `merged` (12,345 words)' || chr(10) || chr(10) || '| Source | Words | Common | Output Coverage | Retention |' || chr(10) || '|--------|------:|-------:|----------------:|----------:|' || chr(10)
  || string_agg('| ' || r.source || ' | ' || format('{:,}', a) || ' | ' || format('{:,}', c) || ' | ' || (c % 7) || '% | ' || (a % 100) || '% |', chr(10) ORDER BY ord, r.source) || chr(10) || '| **Merged output** | **12,345** | | | |' || chr(10) || chr(10)
  || '**Most similar source:** ' || any_value(b.source) || ' (' || any_value(b.p) || '% output coverage)' || chr(10) AS page FROM r JOIN b ON b.lang = r.lang GROUP BY r.lang"""


def interleaved_pages(spark, sf):
    """Turns and slides by time: a page a conversation."""
    c = table(spark, sf, "conversations")
    seg = c.select("conv_id", (F.col("turn") * 10.0).alias("start"), F.col("turn").alias("ord"), "role", F.concat(F.lit("turn "), F.col("turn").cast("string")).alias("text")).withColumnRenamed("role", "speaker")
    slides = c.where("turn % 3 = 0").select("conv_id", (F.col("turn") * 10.0 + 10).alias("start"), F.col("turn").alias("number"), F.when(F.col("turn") % 2 == 0, F.col("role")).alias("title"), F.concat(F.lit("s"), F.col("turn").cast("string"), F.lit(".png")).alias("file"))
    return sinks.interleaved(seg, slides, "conv_id", F.concat(F.lit("Talk "), F.col("conv_id").cast("string")))


INTERLEAVED_PAGES = """WITH r AS (SELECT conv_id, turn * 10.0 AS start, 0 AS kind, turn AS n, role AS speaker, 'turn ' || turn AS line FROM conversations
  UNION ALL SELECT conv_id, turn * 10.0 + 10, 1, turn, NULL, '![' || CASE WHEN turn % 2 = 0 THEN role ELSE 'Slide ' || turn END || '](slides/s' || turn || '.png)' FROM conversations WHERE turn % 3 = 0),
f AS (SELECT *, CASE WHEN kind = 1 OR lag(kind) OVER w IS DISTINCT FROM 0 OR lag(speaker) OVER w IS DISTINCT FROM speaker THEN 1 ELSE 0 END AS b FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY start, kind, n)),
g AS (SELECT *, sum(b) OVER (PARTITION BY conv_id ORDER BY start, kind, n ROWS UNBOUNDED PRECEDING) AS part FROM f),
p AS (SELECT conv_id, part, CASE WHEN max(kind) = 1 THEN '' ELSE '**' || max(speaker) || '**' || chr(10) || chr(10) END || string_agg(line, ' ' ORDER BY start, n) AS s FROM g GROUP BY conv_id, part)
SELECT conv_id, '# Talk ' || conv_id || chr(10) || chr(10) || '---' || chr(10) || chr(10) || string_agg(s, chr(10) || chr(10) ORDER BY part) || chr(10) || chr(10) || '---' || chr(10) AS page FROM p GROUP BY conv_id"""


def sequential_pages(spark, sf):
    """Pages without times: the text, then the slides."""
    s = F.array(F.struct(F.lit("One").alias("title"), F.lit("x").alias("description"), F.lit("a.png").alias("file")), F.struct(F.lit("").alias("title"), F.lit("long " * 20).alias("description"), F.lit("b.png").alias("file")))
    return docs(spark, sf).select("doc_id", F.md5(sinks.sequential(F.col("source"), F.col("text"), F.when(F.col("doc_id") % 2 == 0, s).otherwise(F.slice(s, 1, 0)))).alias("digest"))


SEQUENTIAL_PAGES = """SELECT doc_id, md5('# ' || source || chr(10) || chr(10) || '---' || chr(10) || chr(10) || '## Text' || chr(10) || chr(10) || text || chr(10) || CASE WHEN doc_id % 2 = 0 THEN chr(10) || '---' || chr(10) || chr(10) || '## Slides' || chr(10) || chr(10)
  || '### Slide 1 - One' || chr(10) || chr(10) || '[![Slide 1](slides/a.png)](slides/a.png)' || chr(10) || chr(10) || '### Slide 2 - ' || left(repeat('long ', 20), 50) || chr(10) || chr(10) || '[![Slide 2](slides/b.png)](slides/b.png)' || chr(10) ELSE '' END) AS digest FROM documents"""


def scoring_parts(spark, sf):
    c = table(spark, sf, "conversations")
    w = text.words(F.col("text"))
    said = lambda ws: F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("turn", ws.alias("w")))), lambda x: x["w"])), " ")
    every = F.sort_array(F.collect_list(F.struct((F.col("turn") * 10.0).alias("start"), (F.col("turn") * 10.0 + 8).alias("stop"), F.col("role").alias("speaker"))))
    some = F.sort_array(F.collect_list(F.when(F.col("turn") % 4 > 0, F.struct((F.col("turn") * 10.0).alias("start"), (F.col("turn") * 10.0 + 8).alias("stop"), F.col("role").alias("speaker")))))
    per = c.groupBy(F.col("conv_id").alias("file_id")).agg((F.count("*") * 10.0).alias("duration_secs"), said(w).alias("ref"), said(F.filter(w, lambda x, i: i % 11 != 10)).alias("less"), every.alias("ref_turns"), some.alias("hyp_turns"))
    entries = per.select("file_id", "duration_secs", (F.col("file_id") % 3 > 0).alias("has_turns"))
    refs = per.where("file_id % 7 > 0").select("file_id", F.array(F.struct(F.lit("Ann").alias("speaker"), text.words(F.col("ref")).alias("words"))).alias("ref"), "ref_turns")
    outs = [("whisper_medium.txt", F.col("less"), "file_id % 5 > 1"), ("all_merged.txt", F.col("ref"), "file_id % 5 > 2"), ("notes.txt", F.lit("x"), "file_id % 5 > 0")]
    from functools import reduce

    outputs = reduce(lambda a, b: a.union(b), [per.where(when).select("file_id", F.lit(n).alias("name"), t.alias("text")) for n, t, when in outs])
    return entries, outputs, refs, per.where("file_id % 2 = 0").select("file_id", "hyp_turns")


def scoring_run(spark, sf):
    """Every conversation against every text of it, with rows for those that can't be scored."""
    got = scoring.scored(*scoring_parts(spark, sf))
    return got.select("file_id", "duration_secs", "variant", *[F.round(m, 9).alias(m) for m in scoring.METRICS], F.array_join("errors", "; ").alias("errors"))


SCORED = f"""c AS (SELECT conv_id AS file_id, turn, len({WORDS}) AS n FROM conversations),
p AS (SELECT file_id, count(*) * 10.0::DOUBLE AS duration_secs, sum(n) AS n, sum(n // 11) AS lost, count(*) FILTER (turn % 4 = 0) / count(*)::DOUBLE AS d FROM c GROUP BY file_id),
v AS (SELECT p.*, variant FROM p LEFT JOIN (VALUES ('whisper_medium', 1), ('merged', 2)) x(variant, m) ON file_id % 5 > m AND file_id % 7 > 0),
r AS (SELECT file_id, duration_secs, coalesce(variant, '') AS variant, CASE WHEN variant = 'merged' THEN 0.0 WHEN variant IS NOT NULL THEN lost / nullif(n, 0) END AS wer,
  CASE WHEN variant IS NULL OR file_id % 3 = 0 THEN NULL WHEN variant = 'merged' THEN 0.0 ELSE lost / nullif(n, 0) END AS cpwer, CASE WHEN variant IS NOT NULL AND file_id % 3 > 0 AND file_id % 2 = 0 THEN d END AS der,
  CASE WHEN file_id % 5 = 0 THEN 'no outputs' WHEN file_id % 7 = 0 THEN 'no reference' WHEN variant IS NULL THEN 'no text to score' WHEN file_id % 3 = 0 THEN 'cpwer: the reference tells no speakers; der: the reference has no turns' WHEN file_id % 2 > 0 THEN 'der: the output has no turns' ELSE '' END AS errors
  FROM v WHERE NOT (variant IS NULL AND file_id % 7 > 0 AND file_id % 5 > 1))"""
SCORING_RUN = f"WITH {SCORED} SELECT file_id, duration_secs, variant, round(wer, 9) AS wer, round(cpwer, 9) AS cpwer, round(der, 9) AS der, errors FROM r"


def scoring_summary(spark, sf):
    """Variants compared: averages, plain and by duration, with the report's rows."""
    got = scoring.summary(scoring.scored(*scoring_parts(spark, sf)))
    return got.select("variant", "files", *[F.round(f"{k}_{m}", 9).alias(f"{k}_{m}") for m in scoring.METRICS for k in ("avg", "weighted")], "line")


_W = lambda m: f"sum({m} * duration_secs) / nullif(sum(CASE WHEN {m} IS NOT NULL THEN duration_secs END), 0)"
SCORING_SUMMARY = f"""WITH {SCORED}, s AS (SELECT variant, count(*) AS files, {", ".join(f"avg({m}) AS avg_{m}, {_W(m)} AS weighted_{m}" for m in scoring.METRICS)} FROM r GROUP BY variant)
SELECT variant, files, {", ".join(f"round({k}_{m}, 9) AS {k}_{m}" for m in scoring.METRICS for k in ("avg", "weighted"))},
  '| ' || variant || {" || ".join(f"' | ' || coalesce(format('{{:.1f}}%', {k}_{m} * 100), '-')" for m in scoring.METRICS for k in ("avg", "weighted"))} || ' |' AS line FROM s"""

_ALL = {
    "metadata_files": (metadata_files, METADATA_FILES), "model_files": (model_files, MODEL_FILES), "turn_json": (turn_json, TURN_JSON), "tensor_files": (tensor_files, TENSOR_FILES), "scene_logs": (scene_logs, SCENE_LOGS),
    "dataset_table": (dataset_table, DATASET_TABLE), "manifest_files": (manifest_files, MANIFEST_FILES), "first_entries": (first_entries, FIRST_ENTRIES), "external_texts": (external_texts, EXTERNAL_TEXTS),
    "run_folders": (run_folders, RUN_FOLDERS), "fresh_inputs": (fresh_inputs, FRESH_INPUTS), "run_records": (run_records, RUN_RECORDS), "run_costs": (run_costs, RUN_COSTS), "hypothesis_kinds": (hypothesis_kinds, HYPOTHESIS_KINDS),
    "segment_votes": (segment_votes, SEGMENT_VOTES), "word_names": (word_names, WORD_NAMES), "loop_rows": (loop_rows, LOOP_ROWS), "loops_cut": (loops_cut, LOOPS_CUT), "survival_reports": (survival_reports, SURVIVAL_REPORTS),
    "interleaved_pages": (interleaved_pages, INTERLEAVED_PAGES), "sequential_pages": (sequential_pages, SEQUENTIAL_PAGES), "scoring_run": (scoring_run, SCORING_RUN), "scoring_summary": (scoring_summary, SCORING_SUMMARY),
}
QUERIES = {k: q for k, (q, _) in _ALL.items()}
ORACLES = {k: s for k, (_, s) in _ALL.items()}
