"""Queries on timed rows: `events` as words and segments of a recording (user_id), event_type as speaker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions import fixed, text
from colloquy.operators import chunks, speakers
from colloquy.session import table


def events(spark, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(F.col("user_id").alias("rec"), "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"), F.col("event_type").alias("speaker"), "value")


E = "e AS (SELECT user_id AS rec, event_id, epoch_us(ts) / 1e6 AS t, event_type AS speaker, value FROM events)"
TURNS = f"""{E}, f AS (SELECT *, CASE WHEN lag(speaker) OVER w IS NOT DISTINCT FROM speaker THEN 0 ELSE 1 END AS n FROM e WINDOW w AS (PARTITION BY rec ORDER BY t, event_id)),
i AS (SELECT *, sum(n) OVER (PARTITION BY rec ORDER BY t, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS turn FROM f)"""
SEG = f"{TURNS}, s AS (SELECT rec, turn AS ord, any_value(speaker) AS speaker, min(t) AS start, max(t) AS stop FROM i GROUP BY rec, turn)"


def turn_islands(spark, sf):
    rows = speakers.turns(events(spark, sf), ["rec"], "speaker", ["t", "event_id"]).withColumn("word", F.col("event_id").cast("string")).withColumn("o", F.struct("t", "event_id"))
    return rows.groupBy("rec", "turn").agg(F.first("speaker").alias("speaker"), F.min("t").alias("start"), F.max("t").alias("stop"), F.count("*").alias("n"), speakers.ordered_text("word", "o").alias("text"))


TURN_ISLANDS = f"WITH {TURNS} SELECT rec, turn, any_value(speaker) AS speaker, min(t) AS start, max(t) AS stop, count(*) AS n, string_agg(event_id::VARCHAR, ' ' ORDER BY t, event_id) AS text FROM i GROUP BY rec, turn"


def segments(spark, sf) -> DataFrame:
    rows = speakers.turns(events(spark, sf), ["rec"], "speaker", ["t", "event_id"])
    return rows.groupBy("rec", F.col("turn").alias("ord")).agg(F.first("speaker").alias("speaker"), F.min("t").alias("start"), F.max("t").alias("stop"))


def midpoints(spark, sf) -> DataFrame:
    from pyspark.sql import Window

    nxt = F.lead("t").over(Window.partitionBy("rec").orderBy("t", "event_id"))
    return events(spark, sf).select("rec", "event_id", ((F.col("t") + F.coalesce(nxt, F.col("t") + 1)) / 2).alias("mid"))


def speaker_interval_join(spark, sf):
    return speakers.speaker_at(midpoints(spark, sf), segments(spark, sf), "rec", "event_id", "mid", 3600.0).select("rec", "event_id", "mid", "speaker", "contained")


MID = f"{SEG}, m AS (SELECT rec, event_id, (t + coalesce(lead(t) OVER (PARTITION BY rec ORDER BY t, event_id), t + 1)) / 2 AS mid FROM e)"
SPEAKER_JOIN = f"""WITH {MID}, c AS (
  SELECT m.rec, event_id, mid, s.speaker, mid BETWEEN start AND stop AS inside,
         row_number() OVER (PARTITION BY m.rec, event_id ORDER BY (mid BETWEEN start AND stop) DESC, CASE WHEN mid BETWEEN start AND stop THEN 0.0 ELSE least(abs(start - mid), abs(stop - mid)) END, ord) AS k
  FROM m JOIN s ON m.rec = s.rec)
SELECT rec, event_id, mid, speaker, inside AS contained FROM c WHERE k = 1"""


def end_inference(spark, sf):
    rows = speakers.with_ends(events(spark, sf), ["rec"], "t", ["t", "event_id"], F.floor(F.col("value")), fixed.WORDS_PER_SECOND)
    return rows.select("event_id", F.col("t").alias("start"), "stop")


END_INFERENCE = f"WITH {E} SELECT event_id, t AS start, coalesce(lead(t) OVER (PARTITION BY rec ORDER BY t, event_id), t + greatest(1.0, floor(value) / 2.5)) AS stop FROM e"


def majority_speaker(spark, sf):
    rows = events(spark, sf).withColumn("segment", F.floor(F.col("t") / 86400).cast("long"))
    return speakers.majority(rows, ["rec", "segment"], "speaker")


MAJORITY = f"""WITH {E}, v AS (SELECT rec, floor(t / 86400)::BIGINT AS segment, speaker, count(*) AS votes FROM e GROUP BY ALL)
SELECT rec, segment, speaker, votes FROM v QUALIFY row_number() OVER (PARTITION BY rec, segment ORDER BY votes DESC, speaker) = 1"""


def first_appearance(spark, sf):
    ranked = speakers.appearance(events(spark, sf).withColumn("o", F.struct("t", "event_id")), ["rec"], "speaker", "o")
    return speakers.named(ranked, ["Ann", "Ben", "Cem"]).select("rec", "speaker", "rank", "name")


FIRST_APPEARANCE = f"""WITH {E}, f AS (SELECT rec, speaker, min((t, event_id)) AS o FROM e GROUP BY ALL),
r AS (SELECT rec, speaker, row_number() OVER (PARTITION BY rec ORDER BY o, speaker)::INTEGER AS rank FROM f)
SELECT rec, speaker, rank, coalesce(['Ann', 'Ben', 'Cem'][rank], speaker) AS name FROM r"""


def speaker_names(spark, sf):
    names = F.create_map(*[F.lit(x) for x in ("click", "Ann", "view", "Ben")])
    e = events(spark, sf)
    return e.select("event_id", speakers.renamed(F.col("speaker"), names).alias("name"), text.speaker_id(F.concat(F.lit("Dr. "), "speaker")).alias("id"), text.hms(F.col("t") % 86400).alias("stamp"), text.seconds_of(text.hms(F.col("t") % 86400)).alias("parsed"))


SPEAKER_NAMES = f"""WITH {E}, h AS (SELECT *, floor(t % 86400)::BIGINT AS s FROM e)
SELECT event_id, CASE speaker WHEN 'click' THEN 'Ann' WHEN 'view' THEN 'Ben' ELSE speaker END AS name,
  regexp_replace('Dr. ' || speaker, '[^a-zA-Z0-9_]', '_', 'g') AS id,
  (s // 3600)::VARCHAR || ':' || lpad((s % 3600 // 60)::VARCHAR, 2, '0') || ':' || lpad((s % 60)::VARCHAR, 2, '0') AS stamp, s::DOUBLE AS parsed FROM h"""


def union_timeline(spark, sf):
    """Text rows and slide rows in one timeline; paragraphs end at a slide or a new speaker; text comes first at ties."""
    e = events(spark, sf)
    kind = F.when(F.col("speaker") == "purchase", "slide").otherwise("text")
    rows = e.where("speaker <> 'purchase'").withColumn("kind", F.lit("text")).unionByName(e.where("speaker = 'purchase'").withColumn("kind", kind))
    rows = rows.withColumn("kind_ord", F.when(F.col("kind") == "text", 0).otherwise(1)).withColumn("who", F.concat_ws(":", "kind", F.when(F.col("kind") == "text", F.col("speaker")).otherwise(F.col("event_id").cast("string"))))
    rows = speakers.turns(rows, ["rec"], "who", ["t", "kind_ord", "event_id"]).withColumn("o", F.struct("t", "kind_ord", "event_id")).withColumn("word", F.col("event_id").cast("string"))
    return rows.groupBy("rec", F.col("turn").alias("paragraph")).agg(F.min("kind").alias("kind"), F.min("t").alias("start"), speakers.ordered_text("word", "o").alias("text"))


UNION_TIMELINE = f"""WITH {E}, k AS (SELECT *, CASE WHEN speaker = 'purchase' THEN 1 ELSE 0 END AS ko FROM e),
w AS (SELECT *, CASE ko WHEN 0 THEN 'text:' || speaker ELSE 'slide:' || event_id END AS who FROM k),
f AS (SELECT *, CASE WHEN lag(who) OVER (PARTITION BY rec ORDER BY t, ko, event_id) IS NOT DISTINCT FROM who THEN 0 ELSE 1 END AS n FROM w),
i AS (SELECT *, sum(n) OVER (PARTITION BY rec ORDER BY t, ko, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS paragraph FROM f)
SELECT rec, paragraph, CASE min(ko) WHEN 0 THEN 'text' ELSE 'slide' END AS kind, min(t) AS start, string_agg(event_id::VARCHAR, ' ' ORDER BY t, ko, event_id) AS text FROM i GROUP BY rec, paragraph"""


def diff_clusters(spark, sf):
    """Positions of order lines as differences of a recording (l_suppkey): clusters by gap and capacity."""
    from colloquy.operators import diffs

    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("rec"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("b_pos"), (F.col("l_linenumber") % 3).alias("b_len"))
    return diffs.clustered(li.groupBy("rec", "b_pos").agg(F.min("b_len").alias("b_len")), ["rec"], 400, 5).select("rec", "b_pos", F.col("cluster").cast("long").alias("cluster"))


DIFF_CLUSTERS = """WITH d AS (SELECT l_suppkey AS rec, l_orderkey * 8 + l_linenumber AS b_pos, min(l_linenumber % 3) AS b_len FROM lineitem GROUP BY ALL),
f AS (SELECT *, CASE WHEN b_pos - lag(b_pos + b_len) OVER (PARTITION BY rec ORDER BY b_pos, b_len) <= 400 THEN 0 ELSE 1 END AS far FROM d),
i AS (SELECT *, sum(far) OVER (PARTITION BY rec ORDER BY b_pos, b_len ROWS UNBOUNDED PRECEDING) AS island FROM f),
p AS (SELECT *, (row_number() OVER (PARTITION BY rec, island ORDER BY b_pos, b_len) - 1) // 5 AS part FROM i)
SELECT rec, b_pos, dense_rank() OVER (PARTITION BY rec ORDER BY island, part) - 1 AS cluster FROM p"""


def multiway_pivot(spark, sf):
    """Readings of three models at places of an order: a model without a line there agrees with the base."""
    from colloquy.operators import diffs

    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("rec"), F.col("l_returnflag").alias("model"), (F.col("l_linenumber") % 4).cast("int").alias("b_pos"), F.lit(1).alias("b_len"), F.lit("base").alias("b_text"), F.col("l_linenumber").alias("a_pos"), F.col("l_linestatus").alias("a_text"))
    names = [("A", 0), ("N", 1), ("R", 2), ("base", 3)]
    models = li.select("rec").distinct().withColumn("m", F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(o).alias("model_ord")) for m, o in names]))).select("rec", "m.*")
    got = diffs.pivoted(li, ["rec"], models, "base").withColumnRenamed("readings", "r")
    return got.select("rec", "b_pos", F.array_join(F.transform("r", lambda r: F.concat(r["model"], F.lit("="), r["text"])), ",").alias("readings"), diffs.plurality(F.col("r")).alias("choice"))


MULTIWAY_PIVOT = """WITH d AS (SELECT l_orderkey AS rec, l_returnflag AS model, (l_linenumber % 4)::INTEGER AS b_pos, arg_max(l_linestatus, (l_linenumber, l_linestatus)) AS a_text FROM lineitem GROUP BY ALL),
p AS (SELECT DISTINCT rec, b_pos FROM d), m(model, o) AS (VALUES ('A', 0), ('N', 1), ('R', 2), ('base', 3)),
g AS (SELECT p.rec, p.b_pos, m.model, o, coalesce(a_text, 'base') AS t FROM p CROSS JOIN m LEFT JOIN d ON d.rec = p.rec AND d.b_pos = p.b_pos AND d.model = m.model),
r AS (SELECT rec, b_pos, string_agg(model || '=' || t, ',' ORDER BY o) AS readings FROM g GROUP BY ALL),
v AS (SELECT rec, b_pos, t, count(*) AS n, min(CASE WHEN t = 'base' THEN -1 ELSE o END) AS o FROM g GROUP BY ALL),
c AS (SELECT rec, b_pos, t AS choice FROM v QUALIFY row_number() OVER (PARTITION BY rec, b_pos ORDER BY n DESC, o) = 1)
SELECT r.rec, r.b_pos, readings, choice FROM r JOIN c ON r.rec = c.rec AND r.b_pos = c.b_pos"""


def running_cutoff(spark, sf):
    """Documents in order while their characters add up to at most half of all: a running sum over the whole table."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    half = d.agg(F.floor(F.sum("n_chars") / 2)).first()[0] or 0
    return chunks.running_total(d, ["doc_id"], "n_chars", half).select("doc_id", "n_chars")


RUNNING_CUTOFF = "SELECT doc_id, n_chars FROM documents QUALIFY sum(n_chars) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) <= (SELECT floor(sum(n_chars) / 2) FROM documents)"


def slide_times(spark, sf):
    """Slides and the times of a log, put together by number; a slide without a time gets 0."""
    e = events(spark, sf)
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("rec").orderBy("t", "event_id"))
    slides = e.where("speaker in ('purchase', 'view')").select("rec", "event_id", n.alias("slide_number"))
    log = e.where("speaker = 'click'").select("rec", "t", "event_id", F.format_string("[showinfo] n: %d pts_time:%s pos", F.col("event_id"), (F.floor(F.col("value") * 10) / 10).cast("string")).alias("line"))
    times = log.select("rec", n.alias("slide_number"), F.regexp_extract("line", r"pts_time:([0-9]+\.?[0-9]*)", 1).cast("double").alias("ts"))
    both = slides.join(times, ["rec", "slide_number"], "left")
    return both.select("rec", "event_id", "slide_number", F.coalesce("ts", F.lit(0.0)).alias("timestamp"), F.concat(F.lit("Slide "), F.col("slide_number").cast("string")).alias("alt"))


SLIDE_TIMES = f"""WITH {E}, s AS (SELECT rec, event_id, row_number() OVER (PARTITION BY rec ORDER BY t, event_id)::INTEGER AS slide_number FROM e WHERE speaker IN ('purchase', 'view')),
c AS (SELECT rec, row_number() OVER (PARTITION BY rec ORDER BY t, event_id)::INTEGER AS slide_number, floor(value * 10) / 10 AS ts FROM e WHERE speaker = 'click')
SELECT s.rec, event_id, s.slide_number, coalesce(ts, 0.0) AS timestamp, 'Slide ' || s.slide_number AS alt FROM s LEFT JOIN c ON s.rec = c.rec AND s.slide_number = c.slide_number"""


QUERIES = {f.__name__: f for f in (turn_islands, speaker_interval_join, end_inference, majority_speaker, first_appearance, speaker_names, union_timeline, diff_clusters, multiway_pivot, running_cutoff, slide_times)}
ORACLES = {"turn_islands": TURN_ISLANDS, "speaker_interval_join": SPEAKER_JOIN, "end_inference": END_INFERENCE, "majority_speaker": MAJORITY, "first_appearance": FIRST_APPEARANCE, "speaker_names": SPEAKER_NAMES, "union_timeline": UNION_TIMELINE, "diff_clusters": DIFF_CLUSTERS, "multiway_pivot": MULTIWAY_PIVOT, "running_cutoff": RUNNING_CUTOFF, "slide_times": SLIDE_TIMES}
