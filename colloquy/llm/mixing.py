"""Mixing sources to target weights by Pareto order sampling.

Targets: each source gets its weight's share of the mix, at most `cap` times its own size; what is above goes to the
others by weight until none is above. Within a source a document's expected number of copies is proportional to its
propensity, at most `cap`; what is above goes to the others until the source's target is met. Whole copies are certain,
and the rest is drawn by Pareto order sampling: documents are ranked by random odds divided by inclusion odds,
(u / (1 - u)) / (p / (1 - p)), with u from a keyed digest of doc_id, and taken from the first while the source's words
allow. What is then left of the target, less than one document, is met by up to three documents more, the largest that
fit, and a last one if that comes nearer.

Reruns agree, and no sort of a whole source is needed: two levels of 256 rank buckets, summed before the shuffle, leave
one bucket in 65,536 of each source to be ordered exactly. Sources are ranked by ranges, and what is above their caps is
shared out by sums, so that any number of them will do.

Defined results: null text has size 0; null source is a source of its own and comes last; rows with the same doc_id,
size and propensity are taken or left together; columns of any names stay as they are in `mix`; an empty table gives an
empty result. Propensities count by a few values only (a few hundred at most).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.shared import written

WEIGHTS = (3, 1, 2)
SHARE, CAP, SEED = 1.5, 2, "mix"
#: Documents that are chosen by size to meet what is left of a target.
FITTING = 3
WORD = r"[^\x20\x09-\x0D]+"
#: Per-source figures are broadcast up to this many sources, and joined by shuffle beyond.
MOST_BROADCAST = 100_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit("-"))


def with_sources(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Join per-source figures on `sk`."""
    few = sources.count() <= MOST_BROADCAST
    return docs.join(F.broadcast(sources) if few else sources, "sk")


def ranked_sources(sources: DataFrame) -> DataFrame:
    """Add `at`, the place of each source in code point order, null last, counted by ranges."""
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("source").asc_nulls_last()
    dealt = written(sources.repartitionByRange(parts, order).withColumn("part", F.spark_partition_id()), "mix-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = dealt.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return dealt.join(F.broadcast(starts), "part").withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1 + F.col("start")).drop("part", "start")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Add `target` to a table of one row a source (source, sk, source_size)."""
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    df = ranked_sources(sources).withColumn("w", pick).withColumn("most", (cap * F.col("source_size")).cast("double"))
    level, seen = None, None
    while True:  # at each turn some more sources reach their caps
        above = F.lit(False) if level is None else F.col("most") <= F.col("w") * level
        row = df.agg(F.sum("source_size").alias("all"), F.sum(F.when(above, F.col("most"))).alias("full"), F.sum(F.when(~above, F.col("w"))).alias("w"), F.count_if(above).alias("n")).first()
        if row.n == seen or not row.w:
            break
        seen, level = row.n, (share * float(row.all) - (row.full or 0.0)) / row.w
    target = F.col("most") if level is None or not row.w else F.least("most", F.col("w") * level)
    return df.withColumn("target", target).drop("w", "most", "at")


def rates(classes: DataFrame, sources: DataFrame, cap: int) -> DataFrame:
    """(sk, rate): expected copies are the rate times the propensity, at most `cap`. `classes` has a row for each
    propensity of a source (sk, propensity, size)."""
    df = classes.join(sources.select("sk", "target"), "sk").withColumn("w", F.col("size") * F.col("propensity")).withColumn("most", (cap * F.col("size")).cast("double"))
    every = Window.partitionBy("sk")
    before = every.orderBy(F.col("propensity").desc()).rowsBetween(Window.unboundedPreceding, -1)
    sum_of = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0.0))
    level = F.try_divide(F.col("target") - sum_of("most", before), sum_of("w", every) - sum_of("w", before))
    return df.withColumn("level", level).groupBy("sk").agg(F.coalesce(F.max("level"), F.lit(0.0)).alias("rate"))


def ranked(docs: DataFrame, seed: str, cap: int) -> DataFrame:
    """Add certain copies `whole`, and the rank `v` in 0..1 of Pareto order sampling."""
    copies = F.least(F.lit(float(cap)), F.col("rate") * F.col("propensity"))
    whole = F.floor("copies").cast("long")
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 12), 16, 10).cast("double") + 0.5) / F.lit(2.0**48)
    part = F.col("copies") - F.col("whole")
    odds = F.try_divide(F.col("u") / (1 - F.col("u")), F.col("part") / (1 - F.col("part")))
    v = F.when(F.col("whole") >= cap, F.lit(None).cast("double")).when(F.col("part") <= 0, F.lit(1.0)).otherwise(F.col("odds") / (1 + F.col("odds")))
    return docs.withColumn("copies", copies).withColumn("whole", whole).withColumn("u", u).withColumn("part", part).withColumn("odds", odds).withColumn("v", v).drop("u", "part", "odds", "copies")


def bucket(level: int):
    return F.least(F.floor(F.col("v") * F.lit(256.0**level)), F.lit(256**level - 1)).cast("long")


def figures(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """Per source: source_size, target, rate, the last rank (v, doc_id, size) that the sample takes in order, and the
    documents (doc_id, size) that it takes besides. `sized` has doc_id, source, sk, size and propensity."""
    classes = written(sized.groupBy("sk", "propensity").agg(F.first("source").alias("source"), F.sum("size").alias("size")), "mix-classes")
    sources = classes.groupBy("sk").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    sources = written(targets(sources, weights, share, cap), "mix-targets")
    sources = written(sources.join(rates(classes, sources, cap), "sk"), "mix-rates")
    docs = ranked(with_sources(sized.drop("source"), sources.select("sk", "rate")), seed, cap)
    # equal rows are one document of their words together
    one = docs.groupBy("sk", "doc_id", "size", "propensity").agg(F.first("whole").alias("whole"), F.first("v").alias("v"), F.sum("size").alias("n"))
    one = written(one, "mix-ranks")
    certain = one.groupBy("sk").agg(F.sum(F.col("whole") * F.col("n")).alias("certain"))
    state = sources.join(certain, "sk").select("sk", F.greatest(F.col("target") - F.col("certain"), F.lit(0.0)).alias("rest"))
    open_docs = one.where("v is not null")
    for level in (1, 2):  # the bucket in which the source's words are met
        within = open_docs if level == 1 else with_sources(open_docs, state.select("sk", "cut")).where(bucket(1) == F.col("cut")).drop("cut")
        sums = within.groupBy("sk", bucket(level).alias("b")).agg(F.sum("n").alias("n"))
        w = Window.partitionBy("sk").orderBy("b")
        sums = sums.withColumn("upto", F.sum("n").over(w)).join(state.select("sk", "rest"), "sk")
        met = sums.groupBy("sk").agg(F.min(F.when(F.col("upto") > F.col("rest"), F.col("b"))).alias("cut"), F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto"))).alias("full"))
        met = state.drop("cut").join(met, "sk", "left")
        # without a cut all the buckets fit: the cut is then above the last
        state = written(met.select("sk", (F.col("rest") - F.coalesce("full", F.lit(0))).alias("rest"), F.coalesce("cut", F.lit(256**level)).alias("cut")), f"mix-level{level}")
    last = with_sources(open_docs, state).where(bucket(2) == F.col("cut"))
    upto = F.sum("n").over(Window.partitionBy("sk").orderBy("v", F.col("doc_id").asc_nulls_first(), "size", "propensity").rowsBetween(Window.unboundedPreceding, 0))
    taken = last.withColumn("upto", upto).where(F.col("upto") <= F.col("rest"))
    ends = taken.groupBy("sk").agg(F.max(F.struct("v", "doc_id", "size", "propensity")).alias("end"), F.max("upto").alias("upto"))
    nothing = F.array().cast("array<struct<doc_id:long,size:long,propensity:double>>")
    state = state.join(ends, "sk", "left").select("sk", "cut", "end", (F.col("rest") - F.coalesce("upto", F.lit(0))).alias("left"), nothing.alias("more"))
    state = written(state, "mix-ends")
    for k in range(FITTING + 1):
        final = k == FITTING
        free = with_sources(open_docs, state).where(~in_order() & ~F.array_contains("more", F.struct("doc_id", "size", "propensity")) & (F.col("n") > 0))
        off = F.abs(F.col("n") - F.col("left")) if final else -F.col("n").cast("double")
        free = free.where(off < F.col("left") if final else F.col("n") <= F.col("left"))
        best = free.groupBy("sk").agg(F.min_by(F.struct("doc_id", "size", "propensity", "n"), F.struct(off.alias("off"), F.col("n").alias("m"), "v", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("i"), F.col("size").alias("z"), F.col("propensity").alias("p"))).alias("best"))
        pick = F.struct("best.doc_id", "best.size", "best.propensity")
        state = state.join(best, "sk", "left").select("sk", "cut", "end", (F.col("left") - F.coalesce("best.n", F.lit(0))).alias("left"), F.when(F.col("best").isNull(), F.col("more")).otherwise(F.array_append("more", pick)).alias("more"))
        state = written(state, f"mix-more{k}")
    return written(sources.drop("source").join(state.drop("left"), "sk"), "mix-figures")


def in_order() -> Column:
    """Whether a document's rank is within what its source's sample takes in order."""
    rank = F.struct("v", "doc_id", "size", "propensity")
    return F.when(F.col("cut") >= 65536, True).otherwise((bucket(2) < F.col("cut")) | ((bucket(2) == F.col("cut")) & F.coalesce(rank <= F.col("end"), F.lit(False))))


def decided(sized: DataFrame, found: DataFrame, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """Add `n_copies` to documents (doc_id, sk, size, propensity, any others) by the figures of their source."""
    docs = ranked(with_sources(sized, found), seed, cap)
    more = F.col("v").isNotNull() & (in_order() | F.array_contains("more", F.struct("doc_id", "size", "propensity")))
    return docs.withColumn("n_copies", F.col("whole") + F.when(more, 1).otherwise(0)).drop("v", "whole", "cut", "end", "rate", "more")


def sized_docs(docs: DataFrame, propensity: Column | None = None) -> DataFrame:
    p = (propensity if propensity is not None else F.lit(1.0)).cast("double")
    return docs.withColumns({"sk": key(F.col("source")), "size": n_words(F.col("text")), "propensity": p})


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP, seed: str = SEED, propensity: Column | None = None) -> DataFrame:
    """The mix itself: each row of `docs` as many times as it is taken, with the columns of `docs`."""
    narrow = sized_docs(docs, propensity).select(F.col("doc_id").cast("long").alias("doc_id"), "source", "sk", "size", "propensity")
    found = figures(written(narrow, "mix-sizes"), weights, share, cap, seed)
    # the row stays whole beside what decides on it, so that its other columns may have any names
    sized = sized_docs(docs.withColumn("_row", F.struct(*docs.columns)), propensity).select("_row", F.col("doc_id").cast("long").alias("doc_id"), "sk", "size", "propensity")
    got = decided(sized, found, cap, seed)
    return got.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("n_copies").cast("int")))).select("_row.*")


def by_length(size: Column) -> Column:
    """The query's propensities: short texts are half and a quarter as likely."""
    return F.when(size < 20, 0.25).when(size < 100, 0.5).otherwise(1.0)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    narrow = sized_docs(docs).withColumn("propensity", by_length(F.col("size"))).select(F.col("doc_id").cast("long").alias("doc_id"), "source", "sk", "size", "propensity")
    narrow = written(narrow, "mix-sizes")
    got = decided(narrow, figures(narrow))
    return got.select("doc_id", "size", "source_size", "target", (F.col("n_copies") * F.col("size")).alias("taken"), "source", "propensity", "n_copies")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u
  FROM documents),
e AS (SELECT *, CASE WHEN size < 20 THEN 0.25::DOUBLE WHEN size < 100 THEN 0.5 ELSE 1.0 END AS propensity FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0 ELSE 2.0 END AS w FROM s),
l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum((2 * source_size)::DOUBLE) OVER o, 0.0))
            / (sum(w) OVER () - coalesce(sum(w) OVER o, 0.0)) AS level
  FROM w WINDOW o AS (ORDER BY (2 * source_size)::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least((2 * source_size)::DOUBLE, w * max(level) OVER ()) AS target FROM l),
c AS (SELECT source, propensity, sum(size)::BIGINT AS size FROM e GROUP BY source, propensity),
f AS (
  SELECT c.source, target, source_size,
         CASE WHEN sum(c.size * propensity) OVER a - coalesce(sum(c.size * propensity) OVER o, 0.0) <> 0
              THEN (target - coalesce(sum((2 * c.size)::DOUBLE) OVER o, 0.0)) / (sum(c.size * propensity) OVER a - coalesce(sum(c.size * propensity) OVER o, 0.0)) END AS level
  FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
  WINDOW a AS (PARTITION BY c.source), o AS (PARTITION BY c.source ORDER BY propensity DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
r AS (SELECT source, any_value(target) AS target, any_value(source_size) AS source_size, coalesce(max(level), 0.0) AS rate FROM f GROUP BY source),
p AS (
  SELECT *, floor(copies)::BIGINT AS whole, copies - floor(copies) AS part
  FROM (SELECT e.*, source_size, target, least(2.0::DOUBLE, rate * propensity) AS copies FROM e JOIN r ON e.source IS NOT DISTINCT FROM r.source)),
v AS (
  SELECT *, CASE WHEN whole >= 2 THEN NULL WHEN part <= 0 THEN 1.0::DOUBLE
                 ELSE ((u / (1 - u)) / (part / (1 - part))) / (1 + (u / (1 - u)) / (part / (1 - part))) END AS v,
         greatest(target - sum(whole * size) OVER (PARTITION BY source), 0.0) AS rest
  FROM p),
g AS (SELECT source, v, doc_id, size, propensity, any_value(rest) AS rest, sum(size)::BIGINT AS n FROM v WHERE v IS NOT NULL GROUP BY source, v, doc_id, size, propensity),
k0 AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY v, doc_id NULLS FIRST, size, propensity ROWS UNBOUNDED PRECEDING) <= rest AS t0,
         sum(n) OVER (PARTITION BY source ORDER BY v, doc_id NULLS FIRST, size, propensity ROWS UNBOUNDED PRECEDING) AS upto FROM g),
k1 AS (SELECT *, rest - coalesce(max(CASE WHEN t0 THEN upto END) OVER (PARTITION BY source), 0) AS l1 FROM k0),
{rounds}
SELECT v.doc_id, v.size, v.source_size, v.target, v.source, v.propensity,
       (v.whole + CASE WHEN z.taken THEN 1 ELSE 0 END)::BIGINT AS n_copies,
       (v.size * (v.whole + CASE WHEN z.taken THEN 1 ELSE 0 END))::BIGINT AS taken
FROM v LEFT JOIN (SELECT *, {last} AS taken FROM k5) z ON v.source IS NOT DISTINCT FROM z.source AND v.v = z.v AND v.doc_id IS NOT DISTINCT FROM z.doc_id AND v.size = z.size AND v.propensity = z.propensity
"""


def fitted(k: int) -> str:
    """One round of filling up what is left, as SQL: the document that fits best among those not taken yet."""
    fits = f"n > 0 AND NOT t{k - 1} AND " + (f"n <= l{k}" if k <= FITTING else f"abs(n - l{k}) < l{k}")
    first = "n DESC" if k <= FITTING else f"abs(n - l{k}), n"
    order = f"ORDER BY CASE WHEN {fits} THEN 0 ELSE 1 END, {first}, v, doc_id NULLS FIRST, size, propensity"
    return f"""j{k} AS (SELECT *, t{k - 1} OR ({fits} AND row_number() OVER (PARTITION BY source {order}) = 1) AS t{k} FROM k{k}),
k{k + 1} AS (SELECT *, l{k} - coalesce(sum(CASE WHEN t{k} AND NOT t{k - 1} THEN n END) OVER (PARTITION BY source), 0) AS l{k + 1} FROM j{k})"""


SQL = SQL.replace("{rounds}", ",\n".join(fitted(k) for k in range(1, FITTING + 2))).replace("{last}", f"t{FITTING + 1}")
