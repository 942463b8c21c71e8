"""Queries that merge three witnesses of each conversation turn: by plurality, and by a scripted adjudicator."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from colloquy.functions import text
from colloquy.operators import adjudicate, diffs, ensemble, score, structure
from colloquy.plans import alignment
from colloquy.plans.collate import pairs
from colloquy.plans.texts import NORM, WORDS
from colloquy.session import table


def witnesses(spark, sf):
    """(k, source_ord, source, text): a turn as it is, without every 13th word from the sixth on, and with every 23rd said as `um`."""
    w = text.words(F.col("text"))
    less = F.filter(w, lambda x, i: i % 13 != 5)
    other = F.transform(w, lambda x, i: F.when(i % 23 == 22, F.lit("um")).otherwise(x))
    kinds = [F.struct(F.lit(n).alias("source"), F.array_join(t, " ").alias("text")) for n, t in (("medium", w), ("small", less), ("distil-large-v3", other))]
    c = table(spark, sf, "conversations").select((F.col("conv_id") * 100_000 + F.col("turn")).alias("k"), F.posexplode(F.array(*kinds)).alias("source_ord", "s"))
    return c.select("k", "source_ord", "s.*")


# ws (k, v0, v1, v2): the three witnesses' words; al (k, o, a, b): the first against the others, normalised.
WITNESSES = f"""v AS MATERIALIZED (SELECT conv_id * 100000 + turn AS k, w AS v0, [w[i + 1] FOR i IN range(0, len(w)) IF i % 13 <> 5] AS v1, [CASE WHEN i % 23 = 22 THEN 'um' ELSE w[i + 1] END FOR i IN range(0, len(w))] AS v2
  FROM (SELECT conv_id, turn, {WORDS} AS w FROM conversations))"""


def normalised(ws: str) -> str:
    return NORM.replace(WORDS, ws)


def aligned(cut: str) -> str:
    """`cut` CTEs give s (k, n, lo, hi): passages of the first witness by words; rd (k, n, own, r1, r2) are the readings there."""
    pair = " UNION ALL ".join(f"SELECT k * 10 + {o} AS k, {normalised('v0')} AS a, {normalised(f'v{o}')} AS b FROM v" for o in (1, 2))
    at = lambda c: f"coalesce(max(CASE WHEN h.i = {c} THEN h.j END), max(CASE WHEN h.i < {c} THEN h.j + 1 END), 0)"
    return f"""{WITNESSES},
{alignment.gaps(pair)},
{cut},
e AS (SELECT s.k, s.n, s.lo, s.hi, o, CASE WHEN o = 1 THEN v1 ELSE v2 END AS ws, v0 FROM s JOIN v ON v.k = s.k, (VALUES (1), (2)) t(o)),
f AS (SELECT e.k, e.n, e.o, any_value(e.ws) AS ws, any_value(e.v0) AS v0, any_value(e.lo) AS lo, any_value(e.hi) AS hi,
  CASE WHEN any_value(e.lo) = len(any_value(e.v0)) THEN len(any_value(e.ws)) ELSE {at("e.lo")} END AS a,
  CASE WHEN any_value(e.hi) = len(any_value(e.v0)) THEN len(any_value(e.ws)) ELSE {at("e.hi")} END AS z
  FROM e LEFT JOIN hits h ON h.k = e.k * 10 + e.o GROUP BY e.k, e.n, e.o),
r AS (SELECT k, n, o, array_to_string(v0[lo + 1 : hi], ' ') AS own, coalesce(nullif(array_to_string(ws[a + 1 : z], ' '), ''), '(no corresponding text)') AS x FROM f),
rd AS (SELECT k, n, any_value(own) AS own, max(CASE WHEN o = 1 THEN x END) AS r1, max(CASE WHEN o = 2 THEN x END) AS r2 FROM r GROUP BY k, n)"""


CHUNKS = "s AS (SELECT k, c // 20 AS n, c AS lo, least(c + 20, len(v0)) AS hi FROM (SELECT k, v0, unnest(range(0, len(v0), 20)) AS c FROM v))"
SEGMENTS = CHUNKS.replace("20", "15")
VOTE = "CASE WHEN r1 = r2 AND r1 <> own THEN r1 ELSE own END"


def flat_turns(spark, sf):
    return ensemble.flat_merge(witnesses(spark, sf), "k", 20)


FLAT = "WITH RECURSIVE " + aligned(CHUNKS) + f"""
SELECT v.k, count(rd.k) AS n_chunks, coalesce(string_agg({VOTE}, chr(10) || chr(10) ORDER BY rd.n), '') AS text FROM v LEFT JOIN rd ON rd.k = v.k GROUP BY v.k"""


def second_source(prompt: str) -> str:
    """A scripted adjudicator: the second source's words."""
    return re.search(r"(?s)Source 2:\n(.*?)\nSource 3:", prompt)[1]


def flat_adjudicated(spark, sf):
    return adjudicate.flat(witnesses(spark, sf), "k", second_source, 20)


FLAT_ADJUDICATED = "WITH RECURSIVE " + aligned(CHUNKS) + """
SELECT v.k, count(rd.k) AS n_chunks, coalesce(string_agg(r1, chr(10) || chr(10) ORDER BY rd.n), '') AS text FROM v LEFT JOIN rd ON rd.k = v.k GROUP BY v.k"""


def skeleton(spark, sf):
    """Segments of 15 words of the first witness, which is told from the others by name."""
    own, rest = ensemble.separated(witnesses(spark, sf), "k", "medium")
    ws = text.words(F.col("text"))
    starts = F.when(F.size(ws) > 0, F.sequence(F.lit(0), F.size(ws) - 1, F.lit(15))).otherwise(F.array().cast("array<int>"))
    seg = own.select("k", F.posexplode(F.transform(starts, lambda a: F.array_join(F.slice(ws, a + 1, F.lit(15)), " "))).alias("seg_ord", "text"))
    return seg.select("k", "seg_ord", F.lit("Ann").alias("speaker"), F.lit("0:00:01").alias("stamp"), "text"), rest


def structured_turns(spark, sf):
    return ensemble.structured_merge(*skeleton(spark, sf), "k", 30)


def structured_sql(chosen: str) -> str:
    return "WITH RECURSIVE " + aligned(SEGMENTS) + f"""
SELECT k, n::INTEGER AS seg_ord, (n // 2)::INTEGER AS chunk, 'Ann' AS speaker, '0:00:01' AS stamp, {chosen} AS text, 3 AS n_sources FROM rd"""


def odd_passages(prompt: str) -> str:
    """A scripted adjudicator: the third source's words of the first of every two passages."""
    found = re.findall(r"PASSAGE (\d+):\n(?:Source [12]: [^\n]*\n){2}Source 3: ([^\n]*)", prompt)
    return "\n".join(f"PASSAGE {n}: {t}" for n, t in found if int(n) % 2)


def structured_adjudicated(spark, sf):
    return adjudicate.structured(*skeleton(spark, sf), "k", odd_passages, 30)


def structured_pages(spark, sf):
    """Merged segments as paragraphs under their speakers' names."""
    return ensemble.rendering(structured_turns(spark, sf), "k")


STRUCTURED_PAGES = "WITH RECURSIVE " + aligned(SEGMENTS) + f"""
SELECT k, string_agg('**Ann** (0:00:01)' || chr(10) || chr(10) || {VOTE} || chr(10), chr(10) ORDER BY n) AS text FROM rd GROUP BY k"""


def pair_listing(spark, sf):
    """Differences of all pairs of witnesses, by number instead of name."""
    rows = adjudicate.telling(adjudicate.pairwise(witnesses(spark, sf), ["k"]))
    return adjudicate.listing(rows, ["k"])


PAIR_LISTING = f"""WITH RECURSIVE {WITNESSES},
{alignment.gaps(" UNION ALL ".join(f"SELECT k * 100 + {10 * i + j} AS k, {normalised(f'v{i}')} AS a, {normalised(f'v{j}')} AS b FROM v" for i, j in ((0, 1), (0, 2), (1, 2))))},
g AS (SELECT pp.k // 100 AS k, pp.k % 100 // 10 AS i, pp.k % 10 AS j, a_pos, b_pos, a[a_pos + 1 : a_hi] AS x, b[b_pos + 1 : b_hi] AS y FROM gap JOIN pp ON pp.k = gap.k),
d AS (SELECT k, i, j, 0 AS kind, a_pos AS pos, x, y FROM g WHERE len(x) BETWEEN 1 AND 5 AND NOT list_contains({alignment.COMMON}, array_to_string(x, ' '))
  UNION ALL SELECT k, i, j, 1, b_pos, x, y FROM g WHERE len(y) BETWEEN 1 AND 5 AND NOT list_contains({alignment.COMMON}, array_to_string(y, ' '))
  UNION ALL SELECT k, i, j, 2, a_pos, x, y FROM g WHERE len(x) > 0 AND len(y) > 0 AND NOT ({alignment.only_common('x')} AND {alignment.only_common('y')})),
l AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY i, j, kind, pos) AS n, CASE kind WHEN 2 THEN 'Source ' || (i + 1) || ': "' || array_to_string(x, ' ') || '" vs Source ' || (j + 1) || ': "' || array_to_string(y, ' ') || '"'
  ELSE 'Source ' || (CASE kind WHEN 0 THEN i ELSE j END + 1) || ' has: "' || array_to_string(CASE kind WHEN 0 THEN x ELSE y END, ' ') || '" (missing in other)' END AS line FROM d)
SELECT k, count(*)::INTEGER AS n, 'IDENTIFIED DIFFERENCES (normalized, no punctuation):' || chr(10) || string_agg(n || '. ' || line, chr(10) ORDER BY n) || chr(10) AS listing FROM l GROUP BY k"""


def models(spark, sf):
    return witnesses(spark, sf).select("k", F.col("source").alias("model"), "text")


def ensemble_turns(spark, sf):
    return ensemble.resolve(models(spark, sf), "k")


def ensemble_sql(chosen: str) -> str:
    """`chosen` picks from m (medium), q (small) and b_text (the base), with n the number within the cluster."""
    pair = " UNION ALL ".join(f"SELECT k * 10 + {o} AS k, {normalised(f'v{o}')} AS a, {normalised('v2')} AS b FROM v" for o in (0, 1))
    return f"""WITH RECURSIVE {WITNESSES},
{alignment.gaps(pair)},
d AS (SELECT gap.k // 10 AS k, gap.k % 10 AS o, a_pos, b_pos, b_hi - b_pos AS b_len, CASE WHEN gap.k % 10 = 0 THEN v0[a_pos + 1 : a_hi] ELSE v1[a_pos + 1 : a_hi] END AS x, v2[b_pos + 1 : b_hi] AS y FROM gap JOIN v ON v.k = gap.k // 10),
t AS (SELECT * FROM d WHERE NOT ({alignment.only_common('x')} AND {alignment.only_common('y')})),
pl AS (SELECT k, b_pos, b_len, array_to_string(any_value(y), ' ') AS b_text, arg_max(array_to_string(x, ' '), a_pos) FILTER (o = 0) AS m0, arg_max(array_to_string(x, ' '), a_pos) FILTER (o = 1) AS q0 FROM t GROUP BY k, b_pos, b_len),
rr AS (SELECT *, coalesce(m0, b_text) AS m, coalesce(q0, b_text) AS q, CASE WHEN b_pos - lag(b_pos + b_len) OVER (PARTITION BY k ORDER BY b_pos, b_len) <= 30 THEN 0 ELSE 1 END AS far FROM pl),
ii AS (SELECT *, sum(far) OVER (PARTITION BY k ORDER BY b_pos, b_len ROWS UNBOUNDED PRECEDING) AS isle FROM rr),
cl AS (SELECT *, (row_number() OVER (PARTITION BY k, isle ORDER BY b_pos, b_len) - 1) // 50 AS part, (row_number() OVER (PARTITION BY k, isle ORDER BY b_pos, b_len) - 1) % 50 + 1 AS n FROM ii),
ch AS MATERIALIZED (SELECT k, b_pos, b_len, isle * 1000 + part AS cluster, {chosen} AS pick, row_number() OVER (PARTITION BY k ORDER BY b_pos, b_len) AS rn FROM cl),
go AS (SELECT k, 0::BIGINT AS rn, 0::BIGINT AS upto, []::VARCHAR[] AS out FROM v UNION ALL
  SELECT go.k, ch.rn, CASE WHEN ch.b_pos >= go.upto THEN ch.b_pos + ch.b_len ELSE go.upto END,
    CASE WHEN ch.b_pos >= go.upto THEN list_concat(list_concat(go.out, v2[go.upto + 1 : ch.b_pos]), CASE WHEN pick IS NULL THEN v2[ch.b_pos + 1 : ch.b_pos + ch.b_len] ELSE list_filter(string_split(pick, ' '), lambda w: w <> '') END) ELSE go.out END
  FROM go JOIN ch ON ch.k = go.k AND ch.rn = go.rn + 1 JOIN v ON v.k = go.k),
fin AS (SELECT k, arg_max(upto, rn) AS upto, arg_max(out, rn) AS out FROM go GROUP BY k),
ns AS (SELECT k, count(*) AS n_diffs, count(DISTINCT cluster) AS n_clusters FROM ch GROUP BY k)
SELECT fin.k, 'distil-large-v3' AS base, 3::BIGINT AS n_models, coalesce(n_diffs, 0)::BIGINT AS n_diffs, coalesce(n_clusters, 0)::BIGINT AS n_clusters, array_to_string(list_concat(out, v2[upto + 1 : len(v2)]), ' ') AS text
FROM fin JOIN v ON v.k = fin.k LEFT JOIN ns ON ns.k = fin.k"""


def turn_prompts(spark, sf):
    """Questions about each cluster of differences: words around, marks, and lettered readings."""
    c = ensemble.clusters(ensemble.differences(models(spark, sf), "k"), "k")
    return c.select("k", "cluster", F.size("d").alias("n_diffs"), adjudicate.choices_asked(F.col("d"))[0].alias("n_choices"), diffs.prompt(F.col("b"), F.col("d"), 5).alias("prompt"))


def prompts_sql() -> str:
    head = ensemble_sql("''")
    shown = lambda c: f"CASE WHEN {c} = '' THEN '(omit)' ELSE '\"' || {c} || '\"' END"
    return head[: head.index("ch AS MATERIALIZED")] + f"""
cn AS (SELECT cl.*, (dense_rank() OVER (PARTITION BY k ORDER BY isle, part) - 1)::INTEGER AS cluster FROM cl),
lm AS (SELECT k, cluster, greatest(0, min(b_pos) - 5) AS lo, arg_max(b_pos + b_len, (b_pos, b_len)) + 5 AS hi FROM cn GROUP BY k, cluster),
st AS (SELECT cn.*, lo, least(len(v2), hi) AS hi, len(v2) AS size, v2, row_number() OVER w AS i, greatest(lo, coalesce(max(b_pos + b_len) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS upto
  FROM cn JOIN lm ON lm.k = cn.k AND lm.cluster = cn.cluster JOIN v ON v.k = cn.k WINDOW w AS (PARTITION BY cn.k, cn.cluster ORDER BY b_pos, b_len)),
ln AS (SELECT k, cluster, count(*)::INTEGER AS n_diffs, any_value(lo) AS lo, any_value(hi) AS hi, any_value(size) AS size, any_value(v2) AS v2, greatest(any_value(lo), max(b_pos + b_len)) AS fin,
  string_agg(CASE WHEN array_to_string(v2[upto + 1 : b_pos], ' ') <> '' THEN array_to_string(v2[upto + 1 : b_pos], ' ') || ' ' ELSE '' END || '[' || i || '] ', '' ORDER BY i) AS said,
  string_agg(i || '. A) ' || {shown('m')} || '  B) ' || {shown('q')} || '  C) ' || {shown('b_text')}, chr(10) ORDER BY i) AS asked FROM st GROUP BY k, cluster)
SELECT k, cluster, n_diffs, 3 AS n_choices, CASE WHEN lo > 0 THEN '... ' ELSE '' END || said || array_to_string(v2[fin + 1 : hi], ' ') || CASE WHEN hi < size THEN ' ...' ELSE '' END || chr(10) || asked AS prompt FROM ln"""


def odd_letters(prompt: str) -> str:
    """A scripted adjudicator: silent where it sees the words around; else B for the first of every two differences."""
    if "[1]" in prompt:
        return "I would rather not."
    return "\n".join(f"{n}. b" for n in re.findall(r"(?m)^(\d+)\. A\)", prompt) if int(n) % 2)


def ensemble_adjudicated(spark, sf):
    return adjudicate.ensemble_resolved(models(spark, sf), "k", odd_letters)


def ensemble_routes(spark, sf):
    """Recordings with one, two and three models' texts, without an adjudicator."""
    some = models(spark, sf).where("(k % 3 = 0 and model = 'medium') or (k % 3 = 1 and model <> 'distil-large-v3') or k % 3 = 2")
    return ensemble.driven(some, "k", adjudicate=False)


ENSEMBLE_ROUTES = f"""WITH {WITNESSES}
SELECT k, CASE WHEN k % 3 = 2 THEN 'distil-large-v3' ELSE 'medium' END AS base, k % 3 + 1 AS n_models, CASE k % 3 WHEN 1 THEN array_to_string(v0, ' ') WHEN 2 THEN array_to_string(v2, ' ') END AS text FROM v"""


def turn_coverage(spark, sf):
    """Differences of neighbouring turns by kind, in normalised words, and how many of them mean something."""
    d = diffs.positioned(pairs(spark, sf), ["conv_id", "turn"], "a", "b", "a", "b")
    u = diffs.unpositioned(d, ["conv_id", "turn"])
    u = u.withColumn("meaningful", diffs.is_meaningful(F.col("type"), F.col("a_text"), F.col("b_text")))
    return u.groupBy("conv_id", "turn", "type").agg(F.count("*").alias("n"), F.count_if("meaningful").alias("meaningful"))


TURNS = f"""c AS (SELECT conv_id, turn, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS later FROM conversations),
q AS MATERIALIZED (SELECT conv_id, turn, conv_id * 100000 + turn AS k, {WORDS} AS wa, {WORDS.replace('(text,', '(later,')} AS wb, {NORM} AS na, {NORM.replace('(text,', '(later,')} AS nb FROM c WHERE later IS NOT NULL),
{alignment.gaps("SELECT k, na AS a, nb AS b FROM q")}"""
TURN_COVERAGE = f"""WITH RECURSIVE {TURNS},
g AS (SELECT conv_id, turn, na[a_pos + 1 : a_hi] AS x, nb[b_pos + 1 : b_hi] AS y FROM gap JOIN q ON q.k = gap.k),
u AS (SELECT conv_id, turn, 'changed' AS type, NOT ({alignment.only_common('x')} AND {alignment.only_common('y')}) AS means FROM g WHERE len(x) > 0 AND len(y) > 0
  UNION ALL SELECT conv_id, turn, 'a_only', NOT list_contains({alignment.COMMON}, array_to_string(x, ' ')) FROM g WHERE len(x) BETWEEN 1 AND 5
  UNION ALL SELECT conv_id, turn, 'b_only', NOT list_contains({alignment.COMMON}, array_to_string(y, ' ')) FROM g WHERE len(y) BETWEEN 1 AND 5)
SELECT conv_id, turn, type, count(*) AS n, count(*) FILTER (means) AS meaningful FROM u GROUP BY ALL"""
DIFF_POSITIONS = f"""WITH RECURSIVE {TURNS},
g AS (SELECT conv_id, turn, wa[a_pos + 1 : a_hi] AS x, wb[b_pos + 1 : b_hi] AS y, a_pos, b_pos, a_hi - a_pos AS a_len, b_hi - b_pos AS b_len FROM gap JOIN q ON q.k = gap.k),
h AS (SELECT *, CASE WHEN b_pos - lag(b_pos + b_len) OVER (PARTITION BY conv_id, turn ORDER BY b_pos, b_len) <= 30 THEN 0 ELSE 1 END AS far FROM g),
i AS (SELECT *, sum(far) OVER (PARTITION BY conv_id, turn ORDER BY b_pos, b_len ROWS UNBOUNDED PRECEDING) AS isle FROM h),
p AS (SELECT *, (row_number() OVER (PARTITION BY conv_id, turn, isle ORDER BY b_pos, b_len) - 1) // 50 AS part FROM i)
SELECT conv_id, turn, CASE WHEN a_len > 0 AND b_len > 0 THEN 'substitution' WHEN a_len > 0 THEN 'insertion' ELSE 'deletion' END AS type, array_to_string(x, ' ') AS a_text, array_to_string(y, ' ') AS b_text,
  a_pos::INTEGER AS a_pos, b_pos::INTEGER AS b_pos, a_len::INTEGER AS a_len, b_len::INTEGER AS b_len, {alignment.only_common('x')} AND {alignment.only_common('y')} AS trivial,
  (dense_rank() OVER (PARTITION BY conv_id, turn ORDER BY isle, part) - 1)::INTEGER AS cluster FROM p"""
COVERAGE_PAIRS = f"""WITH RECURSIVE {TURNS},
g AS (SELECT conv_id, turn, wa[a_pos + 1 : a_hi] AS x, wb[b_pos + 1 : b_hi] AS y FROM gap JOIN q ON q.k = gap.k),
u AS (SELECT conv_id, turn, 'changed' AS type, NOT ({alignment.only_common('x')} AND {alignment.only_common('y')}) AS means FROM g WHERE len(x) > 0 AND len(y) > 0
  UNION ALL SELECT conv_id, turn, 'a_only', NOT list_contains({alignment.COMMON}, lower(array_to_string(x, ' '))) FROM g WHERE len(x) BETWEEN 1 AND 5
  UNION ALL SELECT conv_id, turn, 'b_only', NOT list_contains({alignment.COMMON}, lower(array_to_string(y, ' '))) FROM g WHERE len(y) BETWEEN 1 AND 5)
SELECT conv_id, turn, type, count(*) AS n, count(*) FILTER (means) AS meaningful FROM u GROUP BY ALL"""

def survival_best(spark, sf):
    """How much of each witness the first one holds, and which of the others it is most like; the first in order at ties."""
    w = witnesses(spark, sf).withColumn("n", text.normalized(text.words(F.col("text"))))
    merged = w.where("source_ord = 0").select("k", F.col("n").alias("b"))
    got = score.survival(w.where("source_ord > 0").select("k", "source_ord", "source", F.col("n").alias("a")).join(merged, "k"), "a", "b")
    best = got.groupBy("k").agg(F.min(F.struct((-F.col("pct_b")).alias("p"), "source_ord", "source")).alias("best"), F.sum("common").alias("common"))
    return best.select("k", F.col("best.source").alias("source"), (-F.col("best.p")).alias("coverage"), "common")


SURVIVAL_BEST = f"""WITH RECURSIVE {WITNESSES},
{alignment.gaps(" UNION ALL ".join(f"SELECT k * 10 + {o} AS k, {normalised(f'v{o}')} AS a, {normalised('v0')} AS b FROM v" for o in (1, 2)))},
n AS (SELECT pp.k // 10 AS k, pp.k % 10 AS o, any_value(len(b)) AS size, count(h.i) AS common FROM pp LEFT JOIN hits h ON h.k = pp.k GROUP BY pp.k),
c AS (SELECT *, CASE WHEN size > 0 THEN floor(100 * common / size)::INTEGER END AS pct FROM n)
SELECT k, arg_max(CASE o WHEN 1 THEN 'small' ELSE 'distil-large-v3' END, (coalesce(pct, 1000), -o)) AS source, max(pct) AS coverage, sum(common)::BIGINT AS common FROM c GROUP BY k"""


def structure_forms(spark, sf):
    """Conversations in the three forms that are told by their lines, and plain ones."""
    c = table(spark, sf, "conversations")
    said = F.regexp_replace("text", r"\n", " ")
    who = F.when(F.col("turn") % 2 == 0, "Ann Bee").otherwise("Bob")
    stamp = text.hms(F.col("turn") * 61)
    kind = F.col("conv_id") % 4
    line = F.when(kind == 0, F.concat(who, F.lit(" [("), stamp, F.lit(")](u)\n"), said)).when(kind == 1, F.concat(F.lit("["), stamp, F.lit("] "), who, F.lit(": "), said)).when(kind == 2, F.concat(who, F.lit(": "), said)).otherwise(F.concat(F.lit("- "), said))
    t = c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))), lambda x: x["l"]), "\n").alias("text"))
    got = structure.segments(t, "conv_id", "text")
    return got.select("conv_id", "form", "seg_ord", "speaker", "stamp", F.md5("text").alias("digest"))


STRUCTURE_FORMS = r"""WITH c AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS seg_ord, conv_id % 4 AS kind, turn * 61 AS s FROM conversations)
SELECT conv_id, ['lex', 'bracketed', 'speaker_only'][kind + 1] AS form, seg_ord, CASE WHEN turn % 2 = 0 THEN 'Ann Bee' ELSE 'Bob' END AS speaker,
  CASE WHEN kind < 2 THEN (s // 3600)::VARCHAR || ':' || lpad((s % 3600 // 60)::VARCHAR, 2, '0') || ':' || lpad((s % 60)::VARCHAR, 2, '0') END AS stamp,
  md5(regexp_replace(regexp_replace(text, '\n', ' ', 'g'), '^\s+|\s+$', '', 'g')) AS digest FROM c WHERE kind < 3 AND n >= 2"""

QUERIES = {f.__name__: f for f in (flat_turns, flat_adjudicated, structured_turns, structured_adjudicated, structured_pages, pair_listing, ensemble_turns, ensemble_adjudicated, ensemble_routes, turn_coverage, turn_prompts, survival_best, structure_forms)}
ORACLES = {
    "flat_turns": FLAT, "flat_adjudicated": FLAT_ADJUDICATED, "structured_turns": structured_sql(VOTE), "structured_adjudicated": structured_sql("CASE WHEN n % 2 = 0 THEN r2 ELSE own END"),
    "structured_pages": STRUCTURED_PAGES, "pair_listing": PAIR_LISTING, "ensemble_turns": ensemble_sql("CASE WHEN m = q AND m <> b_text THEN m ELSE b_text END"),
    "ensemble_adjudicated": ensemble_sql("CASE WHEN n % 2 = 1 THEN q END"), "ensemble_routes": ENSEMBLE_ROUTES, "turn_coverage": TURN_COVERAGE, "turn_prompts": prompts_sql(), "survival_best": SURVIVAL_BEST, "structure_forms": STRUCTURE_FORMS, "diff_positions": DIFF_POSITIONS, "coverage_pairs": COVERAGE_PAIRS,
}
