"""Queries on answers, settings and resumed work: conversations as interviews, documents as answers of a model."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from colloquy import config
from colloquy.functions import text
from colloquy.operators import checkpoints, choose
from colloquy.plans.texts import docs
from colloquy.session import scratch, table
from colloquy.sources import files, pages


def answers_cleaned(spark, sf):
    """Texts without header lines, and answers without rules and headings."""
    return docs(spark, sf).select("doc_id", F.md5(text.without_headers(F.concat(F.lit("**Ann** (0:01:02)\n"), "text", F.lit("\n**Bob**")))).alias("bare"), F.md5(text.clean_answer(F.concat(F.lit("---\n## Title\n"), "text", F.lit("\n***\n=====")))).alias("answer"))


ANSWERS_CLEANED = r"""SELECT doc_id, md5(array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT regexp_matches(trim(x), '^\*\*[^*]+\*\*(?:\s*\([0-9:]+\))?$')), chr(10))) AS bare,
  md5(trim(array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT regexp_matches(trim(x), '^(?:-{3,}|\*{3,}|={3,})$|^#{1,6}\s')), chr(10)))) AS answer FROM documents"""


def interview_rows(spark, sf):
    """Paragraphs of an article's body, read from its markup, with whether they are bold."""
    c = table(spark, sf, "conversations").withColumn("t", F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")))
    p = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("<p class=x><b>"), "t", F.lit("</b></p>"))).otherwise(F.concat(F.lit("<p>"), "t", F.lit(" <strong>x</strong><p>  </p>")))
    page = c.groupBy("conv_id").agg(F.concat(F.lit('<p>menu</p><section name="articleBody">'), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", p.alias("p")))), lambda x: x["p"]), "<div>no</div>"), F.lit("</section><p>end</p>")).alias("html"))
    got = pages.with_paragraphs(page).select("conv_id", F.posexplode("paragraphs").alias("ord", "p"))
    return got.select("conv_id", "ord", F.md5("p.text").alias("digest"), "p.bold")


INTERVIEW_ROWS = r"""SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS ord, md5(regexp_replace(CASE WHEN turn % 3 = 0 THEN text ELSE text || ' x' END, '^\s+|\s+$', '', 'g')) AS digest,
  turn % 3 = 0 AS bold FROM conversations"""


def speaker_labels(spark, sf):
    """Interviews with labels where the speaker changes, up to their closing matter."""
    c = table(spark, sf, "conversations")
    rows = c.select("conv_id", F.col("turn").alias("ord"), F.when(F.col("turn") == 2, F.concat(F.lit("Guest: "), "text")).when(F.col("turn") == 7, F.lit("This episode of it was made by us.")).otherwise(F.col("text")).alias("text"), (F.length("text") % 3 == 0).alias("bold"))
    rows = pages.without_end(pages.assigned(rows, "conv_id", "Host", "Guest"), "conv_id", ["This episode of", "Follow us"])
    return pages.labelled(rows, "conv_id")


SPEAKER_LABELS = """WITH r AS (SELECT conv_id, turn AS ord, CASE turn WHEN 2 THEN 'Guest: ' || text WHEN 7 THEN 'This episode of it was made by us.' ELSE text END AS text, length(text) % 3 = 0 AS bold FROM conversations),
s AS (SELECT *, max(starts_with(text, 'Host:') OR starts_with(text, 'Guest:')) OVER w AS started, max(starts_with(text, 'This episode of') OR starts_with(text, 'Follow us')) OVER w AS over FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY ord ROWS UNBOUNDED PRECEDING)),
a AS (SELECT *, CASE WHEN starts_with(text, 'Host:') THEN 'Host' WHEN starts_with(text, 'Guest:') THEN 'Guest' WHEN NOT started OR bold THEN 'Host' ELSE 'Guest' END AS speaker FROM s WHERE NOT over),
b AS (SELECT *, lag(speaker) OVER (PARTITION BY conv_id ORDER BY ord) AS before FROM a)
SELECT conv_id, string_agg(CASE WHEN before IS DISTINCT FROM speaker AND NOT starts_with(text, speaker || ':') THEN speaker || ': ' || text ELSE text END, chr(10) || chr(10) ORDER BY ord) || chr(10) AS text FROM b GROUP BY conv_id"""


def slide_answers(spark, sf):
    """Fields of slides and names of speakers from a model's answers; none where there is nothing to read."""
    d = docs(spark, sf)
    fields = F.to_json(F.struct(F.col("lang").alias("type"), F.col("source").alias("title"), F.array("lang", "source").alias("bullet_points")))
    d = d.withColumn("s", files.slide_answer(F.when(F.col("doc_id") % 5 == 0, F.lit("Sorry.")).otherwise(F.concat(F.lit("Here:\n```\n"), fields, F.lit("\n```\n")))))
    d = d.withColumn("m", files.names_answer(F.when(F.col("doc_id") % 4 == 0, F.lit("none")).otherwise(F.concat(F.lit("I think "), F.to_json(F.create_map(F.lit("SPEAKER_00"), "source", F.lit("SPEAKER_01"), "lang"))))))
    return d.select("doc_id", "s.type", "s.title", F.size("s.bullet_points").alias("points"), F.size("m").alias("n_names"), F.try_element_at("m", F.lit("SPEAKER_00")).alias("first"))


SLIDE_ANSWERS = """SELECT doc_id, CASE WHEN doc_id % 5 > 0 THEN lang END AS type, CASE WHEN doc_id % 5 > 0 THEN source END AS title, CASE WHEN doc_id % 5 > 0 THEN 2 END AS points,
  CASE WHEN doc_id % 4 > 0 THEN 2 ELSE 0 END AS n_names, CASE WHEN doc_id % 4 > 0 THEN source END AS first FROM documents"""


def retried_answers(spark, sf):
    """Answers of an adjudicator that is busy at each prompt's first two tries."""
    seen: dict = {}

    class Busy(Exception):
        status_code = 529

    def call(prompt: str) -> str:
        seen[prompt] = seen.get(prompt, 0) + 1
        if seen[prompt] == 1:
            raise TimeoutError("late")
        if seen[prompt] == 2:
            raise Busy("busy")
        return prompt[::-1]

    d = docs(spark, sf).select("doc_id", F.when(F.col("doc_id") % 3 > 0, F.concat(F.col("doc_id").cast("string"), F.lit("-"), "source")).alias("prompt"))
    return choose.adjudicated(d, "prompt", call, wait=0.0)


RETRIED_ANSWERS = "SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN doc_id || '-' || source END AS prompt, CASE WHEN doc_id % 3 > 0 THEN reverse(doc_id || '-' || source) END AS answer FROM documents"


def resumed_work(spark, sf):
    """Results kept by the content of their inputs: half of them first, then all; `made` tells which pass made a row."""
    d = docs(spark, sf).select(checkpoints.content_key(F.col("doc_id"), F.col("text")).alias("key"), "doc_id", "n_chars")
    path = scratch(spark, "resumed")
    work = lambda made: lambda todo: todo.select("key", "doc_id", (F.col("n_chars") * 2).alias("twice"), F.lit(made).alias("made"))
    checkpoints.resumed(d.where("doc_id % 2 = 0"), path, work("first"))
    return checkpoints.resumed(d, path, work("second")).select("doc_id", "twice", "made")


RESUMED_WORK = "SELECT doc_id, n_chars * 2 AS twice, CASE WHEN doc_id % 2 = 0 THEN 'first' ELSE 'second' END AS made FROM documents"


def routes(spark, sf):
    """Steps and routes of runs: which steps a run takes, what it skips, and how its texts are merged."""
    rows = []
    for n, ext, dia, only, fresh, dry in product(range(3), (None, "lex"), (None, "bracketed"), (None, "merge"), (False, True), (False, True)):
        c = config.Config(steps=(only,) if only else None, dry_run=dry)
        kind, base = config.ensemble_route(["small", "medium"][:n])
        rows.append((n, ext, dia, only, fresh, dry, config.merge_route(["a", "b"][:n], ext, dia), kind, base, c.runs("slides"), c.skips(fresh)))
    return spark.createDataFrame(rows, "n int, ext string, dia string, only string, fresh boolean, dry boolean, merge string, ensemble string, base string, slides boolean, skips boolean")


ROUTES = """SELECT n::INTEGER AS n, ext, dia, "only", fresh, dry, CASE WHEN ext IS NOT NULL THEN 'structured:external' WHEN dia IS NOT NULL AND n > 1 THEN 'structured:diarized' WHEN dia IS NOT NULL THEN 'diarized' WHEN n > 1 THEN 'flat' ELSE 'none' END AS merge,
  CASE WHEN n < 2 THEN 'none' ELSE 'resolve' END AS ensemble, CASE n WHEN 1 THEN 'small' WHEN 2 THEN 'medium' END AS base, "only" IS NULL AS slides, dry OR fresh AS skips
FROM range(0, 3) a(n), (VALUES (NULL), ('lex')) b(ext), (VALUES (NULL), ('bracketed')) c(dia), (VALUES (NULL), ('merge')) d("only"), (VALUES (true), (false)) e(fresh), (VALUES (true), (false)) f(dry)"""


def entry_metadata(spark, sf):
    """Entries with a table of metadata beside them, where it has a row."""
    d = docs(spark, sf).select(F.col("doc_id").alias("file_id"), "source")
    m = table(spark, sf, "labels").select(F.col("doc_id").alias("file_id"), (F.col("quality") * 60.5).alias("duration_secs"), F.col("toxic").cast("string").alias("accent"))
    got = files.with_metadata(d, m, "file_id", "duration_secs")
    return got.select("file_id", "source", "duration_secs", F.try_element_at("metadata", F.lit("accent")).alias("accent"), F.size("metadata").alias("n"))


ENTRY_METADATA = "SELECT d.doc_id AS file_id, source, coalesce(quality * 60.5, 0.0)::DOUBLE AS duration_secs, toxic::VARCHAR AS accent, CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 END AS n FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"

# elements that are passed over, then line ends, then the other tags; references are read twice, as the operator does
HTML_TEXT = r"""WITH a AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace(html, '(?s)<script[^>]*>.*?</script>', '', 'g'), '(?s)<style[^>]*>.*?</style>', '', 'g'), nav, repeat(chr(10), len(regexp_extract_all(nav, '<(?:p|br|div|h[1-4]|li)[\s/>]|</(?:p|div)>'))::INTEGER)), '(?s)<footer[^>]*>.*?</footer>', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '(?s)<![^>]*>', '', 'g') AS h FROM (SELECT page_id, html, regexp_extract(regexp_replace(regexp_replace(html, '(?s)<script[^>]*>.*?</script>', '', 'g'), '(?s)<style[^>]*>.*?</style>', '', 'g'), '(?s)<nav[^>]*>.*?</nav>') AS nav FROM pages)),
b AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(h, '<(?:p|br|div|h1|h2|h3|h4|li)(?:\s[^>]*)?/?>', chr(10), 'g'), '</(?:p|div)>', chr(10), 'g'), '</?[a-zA-Z][^>]*>', '', 'g') AS h FROM a),
c AS (SELECT page_id, html_unescape FROM (SELECT page_id, replace(replace(replace(replace(replace(replace(replace(h, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS html_unescape FROM b))
SELECT page_id, regexp_replace(regexp_replace(html_unescape, '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS text FROM c"""

_ALL = {
    "answers_cleaned": (answers_cleaned, ANSWERS_CLEANED), "interview_rows": (interview_rows, INTERVIEW_ROWS), "speaker_labels": (speaker_labels, SPEAKER_LABELS), "slide_answers": (slide_answers, SLIDE_ANSWERS),
    "retried_answers": (retried_answers, RETRIED_ANSWERS), "resumed_work": (resumed_work, RESUMED_WORK), "routes": (routes, ROUTES), "entry_metadata": (entry_metadata, ENTRY_METADATA),
}
QUERIES = {k: q for k, (q, _) in _ALL.items()}
ORACLES = {k: s for k, (_, s) in _ALL.items()} | {"html_text": HTML_TEXT}
