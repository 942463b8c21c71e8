"""Queries on texts: `documents` as captions, texts with speakers and line files, `conversations` as turns, `pages` as pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.functions import fixed, text
from colloquy.operators import chunks, loops, speakers, structure
from colloquy.session import table
from colloquy.sources import files, pages, sinks

SP = fixed.SPACE
WORDS = f"list_filter(regexp_split_to_array(text, '{SP}+'), lambda w: w <> '')"
NORM = f"list_transform({WORDS}, lambda w: CASE WHEN regexp_replace(w, '{fixed.NOT_WORD}', '', 'g') = '' THEN '_' ELSE lower(regexp_replace(w, '{fixed.NOT_WORD}', '', 'g')) END)"


def docs(spark, sf):
    return table(spark, sf, "documents")


def normalize_words(spark, sf):
    return docs(spark, sf).select("doc_id", F.size(text.words(F.col("text"))).alias("n"), text.joined(text.normalized(text.words(F.col("text")))).alias("norm"))


NORMALIZE = f"SELECT doc_id, len({WORDS})::INTEGER AS n, array_to_string({NORM}, ' ') AS norm FROM documents"


def fixed_chunks(spark, sf):
    c = chunks.fixed(text.words(F.col("text")), fixed.CHUNK_WORDS)
    return docs(spark, sf).select("doc_id", F.posexplode(c).alias("chunk", "w")).select("doc_id", "chunk", F.size("w").alias("n"), F.md5(F.array_join("w", " ")).alias("digest"))


FIXED_CHUNKS = f"""WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents), c AS (SELECT doc_id, w, unnest(range(0, len(w), 500)) AS s FROM w)
SELECT doc_id, (s // 500)::INTEGER AS chunk, len(w[s + 1 : s + 500])::INTEGER AS n, md5(array_to_string(w[s + 1 : s + 500], ' ')) AS digest FROM c"""


def vtt_clean(spark, sf):
    return docs(spark, sf).select("doc_id", files.caption_text(F.col("text")).alias("text"))


VTT_CLEAN = r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
s AS (SELECT doc_id, n, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS x FROM l),
c AS (SELECT doc_id, n, trim(regexp_replace(x, '<[^>]+>', '', 'g')) AS y FROM s WHERE x <> '' AND NOT regexp_matches(x, '^(?:WEBVTT|Kind:|Language:)|^[0-9]{2}:[0-9]{2}:[0-9]{2}|-->')),
k AS (SELECT doc_id, y, min(n) AS n FROM c WHERE y <> '' GROUP BY ALL),
t AS (SELECT doc_id, string_agg(y, ' ' ORDER BY n) AS text FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(t.text, '') AS text FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id"""


def sentence_groups(spark, sf):
    return docs(spark, sf).select("doc_id", F.size(chunks.sentences(F.col("text"))).alias("n_sentences"), chunks.paragraphs(F.col("text")).alias("text"))


SENTENCE_GROUPS = r"""WITH m AS (SELECT doc_id, string_split(regexp_replace(trim(text), '([.!?])\s+([A-Z])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS s FROM documents),
n AS (SELECT doc_id, string_split(regexp_replace(array_to_string(s, chr(1)), '([.!?])\s+([A-Z])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS s FROM m)
SELECT doc_id, len(s)::INTEGER AS n_sentences, array_to_string(list_transform(range(0, len(s), 3), lambda i: array_to_string(s[i + 1 : i + 3], ' ')), chr(10) || chr(10)) AS text FROM n"""


def join_lines(spark, sf):
    return docs(spark, sf).select("doc_id", chunks.unwrapped(F.col("text")).alias("text"), text.plain_quotes(F.concat(F.lit("“"), F.left("text", F.lit(20)), F.lit("”"))).alias("quoted"), text.slug(F.col("text")).alias("slug"))


JOIN_LINES = r"""WITH l AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')) AS l FROM documents),
u AS (SELECT doc_id, unnest(l) AS x, generate_subscripts(l, 1) AS n FROM l),
p AS (SELECT *, sum(CASE WHEN x = '' OR coalesce(lag(x) OVER (PARTITION BY doc_id ORDER BY n), '') = '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS g FROM (SELECT *, lag(x) OVER (PARTITION BY doc_id ORDER BY n) AS before FROM u)),
q AS (SELECT doc_id, g, string_agg(x, ' ' ORDER BY n) AS x FROM p GROUP BY ALL),
t AS (SELECT doc_id, string_agg(x, chr(10) ORDER BY g) AS t FROM q GROUP BY doc_id)
SELECT t.doc_id, regexp_replace(t, '([\p{L}\p{N}_])- ([\p{L}\p{N}_])', '\1-\2', 'g') AS text, '"' || translate(left(d.text, 20), '‘’“”', '''''""') || '"' AS quoted,
  lower(regexp_replace(trim(left(regexp_replace(d.text, '[^\p{L}\p{N}_\s-]', '', 'g'), 50)), '\s+', '-', 'g')) AS slug
FROM t JOIN documents d ON d.doc_id = t.doc_id"""
JOIN_LINES = JOIN_LINES.replace("p AS (SELECT *, sum(CASE WHEN x = '' OR coalesce(lag(x) OVER (PARTITION BY doc_id ORDER BY n), '') = '' THEN 1 ELSE 0 END)", "p AS (SELECT *, sum(CASE WHEN x = '' OR coalesce(before, '') = '' THEN 1 ELSE 0 END)")


def loop_words(spark, sf):
    """Runs of one word said four times or more, by islands alone: the part of the loops that SQL can express."""
    w = docs(spark, sf).select("doc_id", F.posexplode(text.words(F.col("text"))).alias("pos", "word"))
    rows = speakers.turns(w, ["doc_id"], "word", ["pos"])
    return rows.groupBy("doc_id", "turn").agg(F.min("pos").alias("pos"), F.first("word").alias("word"), F.count("*").alias("n")).where("n >= 4").select("doc_id", "pos", "word", "n")


LOOP_WORDS = f"""WITH w AS (SELECT doc_id, unnest({WORDS}) AS word, generate_subscripts({WORDS}, 1) - 1 AS pos FROM documents),
f AS (SELECT *, CASE WHEN lag(word) OVER (PARTITION BY doc_id ORDER BY pos) IS NOT DISTINCT FROM word THEN 0 ELSE 1 END AS b FROM w),
i AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS g FROM f)
SELECT doc_id, min(pos)::INTEGER AS pos, any_value(word) AS word, count(*) AS n FROM i GROUP BY doc_id, g HAVING count(*) >= 4"""


def loops_collapsed(spark, sf):
    got = loops.with_loops(docs(spark, sf).select("doc_id", "text"), "text")
    removed = F.aggregate("loops", F.lit(0), lambda s, x: s + F.size(F.split(x["phrase"], " ")) * (x["count"] - 2))
    return got.select("doc_id", "loops", "collapsed", removed.alias("words_removed"))


def html_text(spark, sf):
    return pages.with_text(table(spark, sf, "pages").select("page_id", "html")).select("page_id", "text")


def html_segments(spark, sf):
    """Marked segments made of the pages' address parts, and read back."""
    made = F.concat(F.lit('<div class="ts-segment"><span class="ts-name">'), F.col("page_id").cast("string"), F.lit('</span> <span class="ts-timestamp"><a href="#">(0:01:02)</a></span> <span class="ts-text">'), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("</span></div>"))
    return table(spark, sf, "pages").select("page_id", pages.segment_text(made).alias("text"), pages.segment_text(F.col("html")).alias("own"), text.is_html(F.col("html")).alias("is_html"), text.is_url(F.col("url")).alias("is_url"))


HTML_SEGMENTS = """SELECT page_id, page_id || ' (0:01:02)' || chr(10) || url || chr(10) AS text, '' AS own,
  contains(lower(left(html, 500)), '<html') OR contains(lower(left(html, 1000)), '<body') AS is_html, starts_with(url, 'http://') OR starts_with(url, 'https://') AS is_url FROM pages"""


def interview_paragraphs(spark, sf):
    """Paragraphs of pages as an interview: bold ones are the host's."""
    body = F.concat(F.lit('<section name="articleBody">'), F.col("html"), F.lit("</section>"))
    p = pages.with_paragraphs(table(spark, sf, "pages").select("page_id", body.alias("html"))).select("page_id", F.posexplode("paragraphs").alias("ord", "p")).select("page_id", "ord", "p.*")
    rows = pages.without_end(pages.assigned(p, "page_id", "Host", "Guest"), "page_id", fixed.END_MATTER)
    return pages.labelled(rows, "page_id")


def speaker_carry(spark, sf):
    """The same assignment on conversation turns, where SQL can follow it."""
    c = table(spark, sf, "conversations")
    rows = c.select("conv_id", F.col("turn").alias("ord"), F.when(F.col("turn") == 2, F.concat(F.lit("Guest: "), "text")).otherwise(F.col("text")).alias("text"), (F.length("text") % 3 == 0).alias("bold"))
    return pages.assigned(rows, "conv_id", "Host", "Guest").select("conv_id", "ord", "speaker")


SPEAKER_CARRY = """WITH r AS (SELECT conv_id, turn AS ord, CASE WHEN turn = 2 THEN 'Guest: ' || text ELSE text END AS text, length(text) % 3 = 0 AS bold FROM conversations),
s AS (SELECT *, max(starts_with(text, 'Host:') OR starts_with(text, 'Guest:')) OVER (PARTITION BY conv_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS started FROM r)
SELECT conv_id, ord, CASE WHEN starts_with(text, 'Host:') THEN 'Host' WHEN starts_with(text, 'Guest:') THEN 'Guest' WHEN NOT started OR bold THEN 'Host' ELSE 'Guest' END AS speaker FROM s"""


def intro_prefix(spark, sf):
    c = table(spark, sf, "conversations").withColumn("n", F.size(text.words(F.col("text"))))
    return speakers.intro(c, ["conv_id"], "turn", "n", 150).select("conv_id", "turn", "n")


INTRO_PREFIX = f"""WITH c AS (SELECT conv_id, turn, len({WORDS})::INTEGER AS n FROM conversations)
SELECT conv_id, turn, n FROM c QUALIFY sum(n) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) - n < 150"""


def greedy_chunks(spark, sf):
    c = table(spark, sf, "conversations").withColumn("n", F.size(text.words(F.col("text"))))
    per = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "n"))).alias("r"))
    per = per.withColumn("chunks", chunks.greedy(F.col("r.n"), 200))
    return per.select("conv_id", F.explode(F.arrays_zip(F.col("r.turn").alias("turn"), "chunks")).alias("z")).select("conv_id", F.col("z.turn").alias("turn"), F.col("z.chunks").alias("chunk"))


GREEDY_CHUNKS = f"""WITH RECURSIVE c AS (SELECT conv_id, turn, len({WORDS})::INTEGER AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
g AS (SELECT conv_id, turn, k, 0 AS chunk, n AS used FROM c WHERE k = 1 UNION ALL
  SELECT c.conv_id, c.turn, c.k, CASE WHEN g.used + c.n > 200 THEN g.chunk + 1 ELSE g.chunk END, CASE WHEN g.used + c.n > 200 THEN c.n ELSE g.used + c.n END FROM g JOIN c ON c.conv_id = g.conv_id AND c.k = g.k + 1)
SELECT conv_id, turn, chunk FROM g"""


def rendered_conversations(spark, sf):
    c = table(spark, sf, "conversations")
    line = F.concat(F.lit("["), text.hms(F.col("turn") * 61), F.lit("] "), F.col("role"), F.lit(": "), F.regexp_replace("text", r"\n", " "))
    return c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("x")))), lambda x: x["x"]), "\n").alias("text"))


def structure_detect(spark, sf):
    got = structure.segments(rendered_conversations(spark, sf), "conv_id", "text")
    return got.select("conv_id", "form", "seg_ord", "speaker", "stamp", "text", structure.rendered(F.col("speaker"), F.col("stamp"), F.col("text")).alias("shown"))


STRUCTURE = r"""WITH t AS (SELECT conv_id, turn, role, regexp_replace(regexp_replace(text, '\n', ' ', 'g'), '^\s+|\s+$', '', 'g') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS seg_ord, turn * 61 AS s, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
u AS (SELECT *, (s // 3600)::VARCHAR || ':' || lpad((s % 3600 // 60)::VARCHAR, 2, '0') || ':' || lpad((s % 60)::VARCHAR, 2, '0') AS stamp FROM t WHERE n >= 2)
SELECT conv_id, 'bracketed' AS form, seg_ord, role AS speaker, stamp, text, '**' || role || '** (' || stamp || ')' || chr(10) || text AS shown FROM u"""


def choice_cleanup(spark, sf):
    c = table(spark, sf, "conversations")
    wild = F.concat(F.lit('Model B: "'), F.left(F.regexp_replace("text", r'[\n|"]', " "), F.lit(30)), F.lit('" | Model C: "x"'))
    return c.select("conv_id", "turn", text.clean_choice(wild).alias("clean"), text.clean_choice(F.concat(F.lit("Decision: "), F.left(F.regexp_replace("text", r'[\n|":]', " "), F.lit(10)))).alias("plain"), text.shown_reading(F.lit("")).alias("none"))


CHOICE_CLEANUP = r"""SELECT conv_id, turn, trim(left(regexp_replace(text, '[\n|"]', ' ', 'g'), 30)) AS clean, trim(left(regexp_replace(text, '[\n|":]', ' ', 'g'), 10)) AS plain, '(omit)' AS none FROM conversations"""


def quotes_whole(spark, sf):
    """Straight quotes in whole texts, whose stops and commas are made curly quotes."""
    return docs(spark, sf).select("doc_id", text.plain_quotes(F.concat(F.lit("“‘"), F.translate("text", ".,", "”’"))).alias("quoted"))


QUOTES_WHOLE = "SELECT doc_id, chr(34) || chr(39) || replace(replace(text, '.', chr(34)), ',', chr(39)) AS quoted FROM documents"


def choice_whole(spark, sf):
    """Whole turns as readings, with line feeds, bars and quotes."""
    c = table(spark, sf, "conversations")
    said = F.concat(F.lit('a | "b"\n'), "text", F.lit(' "c" | d'))
    return c.select("conv_id", "turn", text.clean_choice(F.concat(F.lit('Model B: "'), said, F.lit('" | Model C: "x"'))).alias("clean"), text.clean_choice(F.concat(F.lit("Decision: "), said)).alias("plain"))


CHOICE_WHOLE = """SELECT conv_id, turn, 'a | "b"' || chr(10) || text || ' "c" | d' AS clean, 'a | "b"' || chr(10) || text || ' "c" | d' AS plain FROM conversations"""


def print_clean(spark, sf):
    made = F.concat(F.lit("\fTHE EZRA KLEIN SHOW\n2/3/2026, 4:05 PM   Opinion | A - The New York Times\nFeb. 24, 2026\n"), F.col("text"), F.lit("\nhttps://www.nytimes.com/a 3/7\nOPINION\nThis episode of 'The Ezra Klein Show' was produced by nobody.\nx"))
    return docs(spark, sf).select("doc_id", pages.print_text(made).alias("text"), text.without_headers(F.concat(F.lit("**Ann** (0:01:02)\n"), F.col("text"))).alias("bare"), text.clean_answer(F.concat(F.lit("---\n## Title\n"), F.col("text"))).alias("answer"))


def nlp_tokens(spark, sf):
    """Document words as pipe-delimited reference tokens, read back, and islands of speakers with times."""
    w = docs(spark, sf).select("doc_id", F.posexplode(text.words(F.col("text"))).alias("i", "w"))
    line = F.concat_ws("|", F.replace("w", F.lit("|"), F.lit("")), (F.col("i") % 100 / 40).cast("int").cast("string"), F.lit("0"), F.lit("0"), F.when(F.col("i") % 7 == 6, ".").otherwise("<NA>"), F.when(F.col("i") % 5 == 0, "UC").otherwise("LC"), F.lit("[]"), F.lit("[]"))
    raw = w.groupBy("doc_id").agg(F.concat(F.lit("token|speaker|ts|endTs|punctuation|case|tags|wer_tags\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", line.alias("l")))), lambda x: x["l"]), "\n")).alias("nlp"))
    tokens = files.references(raw, "doc_id", "nlp")
    rows = speakers.turns(tokens, ["doc_id"], "speaker", ["idx"])
    got = rows.groupBy("doc_id", "turn").agg(F.first("speaker").alias("speaker"), (F.min("idx") * fixed.NLP_TOKEN_SECONDS).alias("start"), ((F.max("idx") + 1) * fixed.NLP_TOKEN_SECONDS).alias("stop"), speakers.ordered_text("token", "idx").alias("text"))
    return got.select("doc_id", "turn", "speaker", F.round("start", 1).alias("start"), F.round("stop", 1).alias("stop"), "text")


NLP_TOKENS = f"""WITH w AS (SELECT doc_id, unnest({WORDS}) AS w, generate_subscripts({WORDS}, 1) - 1 AS i FROM documents),
t AS (SELECT doc_id, i, (i % 100 // 40)::VARCHAR AS speaker, replace(w, '|', '') AS w FROM w),
k AS (SELECT doc_id, i, speaker, CASE WHEN i % 5 = 0 THEN replace(upper(left(w, 1)), 'ẞ', 'SS') || substr(w, 2) ELSE lower(w) END || CASE WHEN i % 7 = 6 THEN '.' ELSE '' END AS token FROM t),
f AS (SELECT *, CASE WHEN lag(speaker) OVER (PARTITION BY doc_id ORDER BY i) IS NOT DISTINCT FROM speaker THEN 0 ELSE 1 END AS b FROM k),
g AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING)::BIGINT AS turn FROM f)
SELECT doc_id, turn, any_value(speaker) AS speaker, round(min(i) * 0.3::DOUBLE, 1) AS start, round((max(i) + 1) * 0.3::DOUBLE, 1) AS stop, string_agg(token, ' ' ORDER BY i) AS text FROM g GROUP BY doc_id, turn"""


def stm_rttm(spark, sf):
    """STM and RTTM lines of conversation turns, written and read back."""
    c = table(spark, sf, "conversations").where("trim(text) <> ''")
    rows = c.select("conv_id", "turn", F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("file_id"), F.concat(F.lit("Dr. "), "role").alias("speaker"), (F.col("turn") * 1.5).alias("start"), (F.col("turn") * 1.5 + 1.25).alias("stop"), F.regexp_replace(F.trim("text"), r"\s+", " ").alias("words"))
    lines = rows.withColumn("line", sinks.stm_line(F.col("file_id"), F.col("speaker"), F.col("start"), F.col("stop"), F.col("words"))).withColumn("mark", sinks.rttm_line(F.col("file_id"), F.col("start"), F.col("stop"), F.col("speaker")))
    back = files.stm(lines, "line")
    turns = files.rttm(lines.withColumn("mark", sinks.rttm_line(F.col("file_id"), F.col("start"), F.col("stop"), text.speaker_id(F.col("speaker")))), "mark").select("file_id", "start", F.col("stop").alias("rttm_stop"), F.col("speaker").alias("rttm_speaker"))
    return back.join(turns, ["file_id", "start"])


STM_RTTM = r"""SELECT 'c' || conv_id AS file_id, '1' AS channel, 'Dr__' || role AS speaker, turn * 1.5::DOUBLE AS start, turn * 1.5::DOUBLE + 1.25 AS stop, regexp_replace(regexp_replace(text, '^ +| +$', '', 'g'), '\s+', ' ', 'g') AS text,
  turn * 1.5::DOUBLE + 1.25 AS rttm_stop, 'Dr__' || role AS rttm_speaker FROM conversations WHERE trim(text) <> ''"""


def segment_json(spark, sf):
    """Speech JSON made of conversations, read back: segments without text are left out, missing numbers are 0."""
    c = table(spark, sf, "conversations")
    seg = F.struct(F.when(F.col("turn") % 4 != 0, F.col("turn") * 1.0).alias("start"), (F.col("turn") + 0.5).alias("end"), F.when(F.col("turn") % 3 == 0, F.lit("  ")).otherwise(F.col("text")).alias("text"))
    made = c.groupBy("conv_id").agg(F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(F.struct("turn", seg.alias("s")))), lambda x: x["s"]).alias("segments"))).alias("j"))
    raw = made.select("conv_id", F.posexplode(F.from_json("j", files.SPEECH)["segments"]).alias("ord", "s"))
    return files.parsed_segments(raw).select("conv_id", "ord", "start", "stop", "text", F.size("words").alias("n_words"))


SEGMENT_JSON = """WITH c AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS ord FROM conversations)
SELECT conv_id, ord, CASE WHEN turn % 4 <> 0 THEN turn::DOUBLE ELSE 0.0 END AS start, turn + 0.5::DOUBLE AS stop, trim(text) AS text, 0 AS n_words FROM c WHERE turn % 3 <> 0 AND trim(text) <> ''"""


QUERIES = {f.__name__: f for f in (normalize_words, fixed_chunks, vtt_clean, sentence_groups, join_lines, loop_words, loops_collapsed, html_text, html_segments, interview_paragraphs, speaker_carry, intro_prefix, greedy_chunks, structure_detect, choice_cleanup, quotes_whole, choice_whole, print_clean, nlp_tokens, stm_rttm, segment_json)}
ORACLES = {"normalize_words": NORMALIZE, "fixed_chunks": FIXED_CHUNKS, "vtt_clean": VTT_CLEAN, "sentence_groups": SENTENCE_GROUPS, "join_lines": JOIN_LINES, "loop_words": LOOP_WORDS, "html_segments": HTML_SEGMENTS, "speaker_carry": SPEAKER_CARRY, "intro_prefix": INTRO_PREFIX, "greedy_chunks": GREEDY_CHUNKS, "structure_detect": STRUCTURE, "choice_cleanup": CHOICE_CLEANUP, "quotes_whole": QUOTES_WHOLE, "choice_whole": CHOICE_WHOLE, "nlp_tokens": NLP_TOKENS, "stm_rttm": STM_RTTM, "segment_json": SEGMENT_JSON}
