"""Queries that score and report: documents as files of a dataset, labels as their metrics, sources as variants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions import text
from colloquy.operators import checkpoints, choose, score
from colloquy.plans.speech import segments
from colloquy.plans.texts import WORDS
from colloquy.session import table
from colloquy.sources import files, sinks
from colloquy.streaming import turns


def results(spark, sf) -> DataFrame:
    d, lab = table(spark, sf, "documents"), table(spark, sf, "labels")
    both = d.join(lab, "doc_id", "left")
    return both.select("doc_id", F.when(F.col("lang") != "es", F.col("lang")).alias("variant"), F.col("n_chars").cast("double").alias("secs"), F.col("quality").cast("double").alias("wer"), F.col("toxic").cast("double").alias("der"))


def report_rollup(spark, sf) -> DataFrame:
    got = score.per_variant(results(spark, sf), "variant", "doc_id", "secs", ["wer", "der"])
    keep = [F.round(F.col(c), 9).alias(c) for c in ("avg_wer", "avg_der", "weighted_wer", "weighted_der")]
    return got.select("variant", "doc_id", *keep, "files", "scored", F.col("footer").cast("int").alias("footer"))


RES = "r AS (SELECT d.doc_id, coalesce(CASE WHEN lang <> 'es' THEN lang END, '') AS variant, n_chars::DOUBLE AS secs, quality::DOUBLE AS wer, toxic::DOUBLE AS der FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
REPORT = f"""WITH {RES} SELECT variant, doc_id, round(avg(wer), 9) AS avg_wer, round(avg(der), 9) AS avg_der,
  round(sum(wer * secs) / nullif(sum(CASE WHEN wer IS NOT NULL THEN secs END), 0), 9) AS weighted_wer, round(sum(der * secs) / nullif(sum(CASE WHEN der IS NOT NULL THEN secs END), 0), 9) AS weighted_der,
  count(DISTINCT doc_id) AS files, count(DISTINCT CASE WHEN coalesce(wer, der) IS NOT NULL THEN doc_id END) AS scored, grouping(doc_id)::INTEGER AS footer
FROM r GROUP BY GROUPING SETS ((variant, doc_id), (variant))"""


def report_lines(spark, sf) -> DataFrame:
    """Markdown rows of the report: a percentage to one decimal, a dash for what is missing."""
    got = score.per_variant(results(spark, sf), "variant", "doc_id", "secs", ["wer"]).where("footer = 1")
    pct = F.concat(sinks.fixed_point(F.round(F.col("weighted_wer") * 100, 6), 1), F.lit("%"))
    return got.select("variant", sinks.markdown_row([F.col("variant"), F.col("files"), pct]).alias("line"))


REPORT_LINES = f"""WITH {RES} SELECT variant, '| ' || variant || ' | ' || count(DISTINCT doc_id) || ' | ' || coalesce(round(round(100 * sum(wer * secs) / nullif(sum(CASE WHEN wer IS NOT NULL THEN secs END), 0), 6)::DECIMAL(20, 6), 1)::DECIMAL(20, 1) || '%', '-') || ' |' AS line FROM r GROUP BY variant"""


def variant_hours(spark, sf) -> DataFrame:
    """Hours of all files, each once however many variants it has, and of those of a subset; distinct variants."""
    d = table(spark, sf, "documents").select("source", "doc_id", "lang", (F.col("n_chars") * 1.0).alias("secs"))
    both = d.unionByName(d.withColumn("lang", F.lit("second")))
    once = both.groupBy("source", "doc_id").agg(F.min_by("secs", "lang").alias("secs"))
    hours = once.groupBy("source").agg((F.sum("secs") / 3600).alias("hours"), F.count("*").alias("files"))
    kinds = both.groupBy("source").agg((F.countDistinct(F.nullif("lang", F.lit(""))) > 1).alias("several"), F.count_if(F.col("lang") == "en").alias("english"))
    return hours.join(kinds, "source").select("source", F.round("hours", 9).alias("hours"), "files", "several", "english")


VARIANT_HOURS = "SELECT source, round(sum(n_chars * 1.0) / 3600, 9)::DOUBLE AS hours, count(*) AS files, true AS several, count(*) FILTER (lang = 'en') AS english FROM documents GROUP BY source"


def semi_anti(spark, sf) -> DataFrame:
    """Files to do: in the id list (labelled), not done yet (toxic ones are)."""
    d, lab = table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels")
    return checkpoints.missing(d.join(lab, "doc_id", "left_semi"), lab.where("toxic = 1"), "doc_id")


SEMI_ANTI = "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)"


def manifest_filter(spark, sf) -> DataFrame:
    """Entries of a subset, in order, while their hours add up to at most one."""
    d = table(spark, sf, "documents")
    e = d.select(F.col("doc_id").alias("ord"), F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("file_id"), F.array("lang").alias("subset_tags"), (F.col("n_chars") / 100).alias("duration_secs"))
    return files.filtered(e, subset="fr", max_hours=1.0).select("file_id", "duration_secs")


MANIFEST_FILTER = "SELECT 'f' || doc_id AS file_id, n_chars / 100 AS duration_secs FROM documents WHERE lang = 'fr' QUALIFY sum(n_chars / 100) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) <= 3600"


def cost_estimate(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", F.size(text.words(F.col("text"))).alias("n"), F.element_at(F.array(*[F.lit(m) for m in ("claude-opus-4-1", "claude-haiku-3-5", "qwen")]), (F.col("doc_id") % 3 + 1).cast("int")).alias("model"))
    return d.select("doc_id", "n", "model", F.round(choose.cost(F.col("n"), F.lit(3), F.col("model")), 9).alias("cost"), F.round(choose.image_cost(F.col("n") % 7), 9).alias("images"))


COST = f"""WITH d AS (SELECT doc_id, len({WORDS})::INTEGER AS n, ['claude-opus-4-1', 'claude-haiku-3-5', 'qwen'][doc_id % 3 + 1] AS model FROM documents),
p AS (SELECT *, greatest(1, n // 500 + 1) AS c, CASE WHEN starts_with(model, 'claude-opus-4') THEN 0.015::DOUBLE WHEN starts_with(model, 'claude-haiku-3') THEN 0.0008::DOUBLE ELSE 0.003::DOUBLE END AS i,
  CASE WHEN starts_with(model, 'claude-opus-4') THEN 0.075::DOUBLE WHEN starts_with(model, 'claude-haiku-3') THEN 0.004::DOUBLE ELSE 0.015::DOUBLE END AS o FROM d)
SELECT doc_id, n, model, round(floor((n * 3 // c + 500) * c * 1.3::DOUBLE) * i / 1000 + floor(n // c * c * 1.3::DOUBLE) * o / 1000, 9) AS cost, round(n % 7 * 0.02::DOUBLE, 9) AS images FROM p"""


def hypothesis_choice(spark, sf) -> DataFrame:
    """The best text and kind that is there, in a fixed order."""
    d = table(spark, sf, "documents")
    at = {"diarized": F.when(F.col("doc_id") % 3 == 0, F.lit(" ")), "merged": F.when(F.col("doc_id") % 5 == 0, F.col("lang")), "speech": F.when(F.col("doc_id") % 2 == 0, F.col("source"))}
    best = choose.first_text(*[at.get(k, F.lit("captions")) for k in choose.BEST["summary"]])
    kind = choose.first_kind(["merged", "speech"], lambda k: at[k].isNotNull())
    return d.select("doc_id", best.alias("best"), kind.alias("kind"))


HYPOTHESIS = "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN lang WHEN doc_id % 2 = 0 THEN source ELSE 'captions' END AS best, CASE WHEN doc_id % 5 = 0 THEN 'merged' WHEN doc_id % 2 = 0 THEN 'speech' END AS kind FROM documents"


def run_status(spark, sf) -> DataFrame:
    e = table(spark, sf, "events").withColumn("state", F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "click", "skipped").otherwise("succeeded"))
    return checkpoints.status(e, "state")


RUN_STATUS = "SELECT count(*) FILTER (event_type NOT IN ('error', 'click')) AS succeeded, count(*) FILTER (event_type = 'error') AS failed, count(*) FILTER (event_type = 'click') AS skipped FROM events"


def fresh_checkpoints(spark, sf) -> DataFrame:
    """Chunks up to the first stale one, and what is up to date by times of inputs."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("made"), (F.col("l_returnflag") != "R").alias("fresh"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate").alias("o"))
    got = checkpoints.fresh_prefix(li, ["l_orderkey"], "o", "fresh")
    return got.select("l_orderkey", "l_linenumber", checkpoints.up_to_date(F.col("made"), F.array(F.lit(None).cast("timestamp"), F.lit("1996-01-01").cast("timestamp"))).alias("fresh_file"))


FRESH = """WITH l AS (SELECT l_orderkey, l_linenumber, l_shipdate, max((l_returnflag = 'R')::INTEGER) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate ROWS UNBOUNDED PRECEDING) AS stale FROM lineitem)
SELECT l_orderkey, l_linenumber, l_shipdate >= TIMESTAMP '1996-01-01' AS fresh_file FROM l WHERE stale = 0"""


def best_source(spark, sf) -> DataFrame:
    """The source with the best coverage of each language; the first in order wins ties."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    per = d.groupBy("lang", "source").agg(F.floor(100 * F.avg("quality")).alias("coverage"))
    best = per.groupBy("lang").agg(F.min(F.struct((-F.col("coverage")).alias("c"), "source")).alias("b"))
    return best.select("lang", F.col("b.source").alias("source"), (-F.col("b.c")).alias("coverage"))


BEST_SOURCE = "WITH p AS (SELECT lang, source, floor(100 * avg(quality))::BIGINT AS coverage FROM documents JOIN labels USING (doc_id) GROUP BY ALL) SELECT lang, source, coverage FROM p QUALIFY row_number() OVER (PARTITION BY lang ORDER BY coverage DESC, source) = 1"


def cpwer(spark, sf) -> DataFrame:
    """Conversations by role against the same words with other labels and every 20th word missing."""
    c = table(spark, sf, "conversations").withColumn("w", text.normalized(text.words(F.col("text"))))
    less = F.filter("w", lambda x, i: i % 20 != 19)
    per = c.groupBy("conv_id", "role").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("turn", "w"))), lambda x: x["w"])).alias("r"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("turn", less.alias("l")))), lambda x: x["l"])).alias("h"))
    both = per.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("role", "r"))), lambda x: x["r"]).alias("ref"), F.transform(F.sort_array(F.collect_list(F.struct("role", "h")), False), lambda x: x["h"]).alias("hyp"))
    return score.cp_word_errors(both, "ref", "hyp").select("conv_id", "cp_errors", "ref_words", "cpwer")


# the words that are missing are all the errors there are
CPWER = f"""WITH c AS (SELECT conv_id, len({WORDS}) AS n FROM conversations)
SELECT conv_id, sum(n // 20)::BIGINT AS cp_errors, sum(n)::BIGINT AS ref_words, sum(n // 20) / nullif(sum(n), 0) AS cpwer FROM c GROUP BY conv_id"""


def der(spark, sf) -> DataFrame:
    """Segments of each recording against the same ones 120 seconds late and with other labels."""
    s = segments(spark, sf).where("stop > start")
    ref = F.sort_array(F.collect_list(F.struct("start", "stop", "speaker"))).alias("ref")
    hyp = F.sort_array(F.collect_list(F.struct((F.col("start") + 120).alias("start"), (F.col("stop") + 120).alias("stop"), F.upper("speaker").alias("speaker")))).alias("hyp")
    got = score.diarization_errors(s.groupBy("rec").agg(ref, hyp), "ref", "hyp")
    return got.select("rec", *[F.round(c, 3).alias(c) for c in ("scored", "missed", "false_alarm", "confusion")], "der")


def turn_sessions(spark, sf) -> DataFrame:
    """Turns as session windows; the same function runs on streams. An extension."""
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    got = turns.turn_sessions(e, "user_id", "event_type", "ts", "6 hours")
    return got.select("user_id", "event_type", (F.unix_micros("start") / 1e6).alias("start"), "words", (F.unix_micros("last") / 1e6).alias("last"))


TURN_SESSIONS = """WITH e AS (SELECT user_id, event_type, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS b FROM events),
i AS (SELECT *, sum(b) OVER (PARTITION BY user_id, event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM e)
SELECT user_id, event_type, epoch_us(min(ts)) / 1e6 AS start, count(*) AS words, epoch_us(max(ts)) / 1e6 AS last FROM i GROUP BY user_id, event_type, g"""

QUERIES = {f.__name__: f for f in (report_rollup, report_lines, variant_hours, semi_anti, manifest_filter, cost_estimate, hypothesis_choice, run_status, fresh_checkpoints, best_source, cpwer, der, turn_sessions)}
ORACLES = {"report_rollup": REPORT, "report_lines": REPORT_LINES, "variant_hours": VARIANT_HOURS, "semi_anti": SEMI_ANTI, "manifest_filter": MANIFEST_FILTER, "cost_estimate": COST, "hypothesis_choice": HYPOTHESIS, "run_status": RUN_STATUS, "fresh_checkpoints": FRESH, "best_source": BEST_SOURCE, "cpwer": CPWER, "turn_sessions": TURN_SESSIONS}
