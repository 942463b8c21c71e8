"""Document fingerprints by Order MinHash, with DataFrame functions only.

k-mers of words are numbered by their occurrence in the text, so that each (k-mer, number) is there once. A hash deals
them to m buckets; in each bucket those with the smallest hashes are chosen, put back into text order, and hashed as a
tuple. Two texts agree in a bucket only if the chosen k-mers and their order agree, so the share of agreeing buckets
falls with edit distance, moved passages included.

All is array work within a row: k-mers, numbers and places are packed in longs and sorted as longs. Defined results:
null text is empty text; texts without words have no bucket filled and are alike among themselves only; texts of fewer
than k words have one k-mer.

`neighbours` gives each doc_id the next one without a sort in one task: ids are dealt by range, and only the ends of
ranges meet. Rows with the same doc_id are one place in that order, with the smallest of their texts; rows without
doc_id have no next document, whose text then counts as empty. Columns but doc_id and text don't matter, whatever their
names; an empty table gives an empty one. Places have 28 bits: texts of up to 268 million words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.pii import let
from colloquy.llm.shared import written

K, BUCKETS, CHOSEN = 3, 32, 2
PLACE, HASH = 28, 30  # bits of a place in the text, and of a hash in its bucket
_PLACES, _HASHES = (1 << PLACE) - 1, (1 << HASH) - 1
WHITE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, WHITE), lambda w: w != "")


def bits(x: Column, mask: int) -> Column:
    return x.bitwiseAND(F.lit(mask).cast("long"))


def upto(n: Column) -> Column:
    """0 .. n - 1; empty for 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def kmers(words: Column, k: int) -> Column:
    """A hash of each k-mer in text order."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def each(h: Column) -> Column:
        n = F.size(h)
        tall = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))
        return F.when(n >= k, tall).when(n > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<long>"))

    return let(hashes, each)


def numbered(hashes: Column, buckets: int) -> Column:
    """One long for each numbered k-mer: bucket, hash, place from the highest bits on; sorted."""
    if not 0 < buckets <= 32:
        raise ValueError("a bucket's number has five bits")
    packed = F.sort_array(F.transform(hashes, lambda h, i: F.shiftleft(F.shiftrightunsigned(h, PLACE), PLACE).bitwiseOR(i.cast("long"))))

    def runs(s: Column) -> Column:
        same = lambda i: F.shiftrightunsigned(F.get(s, i), PLACE) == F.shiftrightunsigned(F.get(s, i - 1), PLACE)
        starts = F.filter(upto(F.size(s)), lambda i: (i == 0) | ~same(i))

        def one(x: Column, number: Column) -> Column:
            e = F.xxhash64(F.shiftrightunsigned(x, PLACE), number)
            bucket = F.pmod(F.shiftrightunsigned(e, 40), F.lit(buckets))
            return F.shiftleft(bucket, PLACE + HASH).bitwiseOR(F.shiftleft(bits(e, _HASHES), PLACE)).bitwiseOR(bits(x, _PLACES))

        def run(starts: Column) -> Column:
            stop = lambda r: F.coalesce(F.get(starts, r + 1), F.size(s)) - 1
            return F.flatten(F.transform(starts, lambda at, r: F.transform(F.sequence(at, stop(r)), lambda i: one(F.get(s, i), i - at))))

        return let(starts, run)

    return F.sort_array(let(packed, runs))


def fingerprint(text: Column, k: int = K, buckets: int = BUCKETS, chosen: int = CHOSEN) -> Column:
    """array<long> with an entry a bucket, null where the bucket is empty."""
    top = PLACE + HASH

    def pick(v: Column) -> Column:
        return F.filter(v, lambda x, i: (i < chosen) | (F.shiftright(F.get(v, i - chosen), top) != F.shiftright(x, top)))

    def in_order(v: Column) -> Column:
        turn = lambda x: F.shiftleft(F.shiftright(x, top), top).bitwiseOR(F.shiftleft(bits(x, _PLACES), HASH)).bitwiseOR(bits(F.shiftright(x, PLACE), _HASHES))
        return F.sort_array(F.transform(v, turn))

    def entries(v: Column) -> Column:
        mine = lambda b: F.filter(v, lambda x: F.shiftright(x, top) == b)
        full = F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)), lambda b: F.xxhash64(*[bits(F.get(v, b * chosen + j), _HASHES) for j in range(chosen)]))
        part = F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)), lambda b: let(mine(b), lambda t: F.when(F.size(t) > 0, F.xxhash64(*[F.coalesce(bits(F.get(t, F.lit(j)), _HASHES), F.lit(-1).cast("long")) for j in range(chosen)]))))
        return F.when(F.size(v) == buckets * chosen, full).otherwise(part)

    return let(let(let(numbered(kmers(words_of(text), k), buckets), pick), in_order), entries)


def likeness(a: Column, b: Column) -> Column:
    """The share of agreeing entries among those that either has; 1 if neither has any."""
    both = F.zip_with(a, b, lambda x, y: F.when(x.isNull() & y.isNull(), F.lit(None).cast("int")).when(x.eqNullSafe(y), 1).otherwise(0))
    return let(F.filter(both, lambda x: x.isNotNull()), lambda s: F.when(F.size(s) == 0, F.lit(1.0)).otherwise(F.aggregate(s, F.lit(0), lambda t, x: t + x) / F.greatest(F.size(s), F.lit(1))))


def shown(entries: Column) -> Column:
    """A fingerprint as text: 16 hexadecimal digits a bucket, dots for an empty one."""
    return F.array_join(F.transform(entries, lambda x: F.coalesce(F.lpad(F.lower(F.hex(x)), 16, "0"), F.lit("." * 16))), "")


def neighbours(ids: DataFrame) -> DataFrame:
    """(doc_id, n, prev_id, prev_n, next_id) of a table of distinct (doc_id, n); the last is before the first."""
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(ids.repartitionByRange(parts, "doc_id").withColumn("part", F.spark_partition_id()), "order-ids")
    w = Window.partitionBy("part").orderBy("doc_id")
    dealt = dealt.withColumn("prev", F.lag(F.struct("doc_id", "n")).over(w)).withColumn("next_id", F.lead("doc_id").over(w))
    ends = dealt.groupBy("part").agg(F.min("doc_id").alias("first"), F.max(F.struct("doc_id", "n")).alias("last"))
    every = Window.orderBy("part")  # one row a range
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("part", F.coalesce(F.lag("last").over(every), F.last("last").over(whole)).alias("before"), F.coalesce(F.lead("first").over(every), F.first("first").over(whole)).alias("after"))
    both = dealt.join(F.broadcast(ends), "part").withColumn("prev", F.coalesce("prev", "before"))
    return both.select("doc_id", "n", F.col("prev.doc_id").alias("prev_id"), F.col("prev.n").alias("prev_n"), F.coalesce("next_id", "after").alias("next_id"))


def query(spark, sf_dir: str) -> DataFrame:
    return compared(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text, and how near they are to each other and to the next document's.

    In the edited text the last quarter is replaced by as many characters from the start of the next document's.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sizes = docs.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.length("text")).alias("n"))
    order = written(neighbours(sizes), "order-neighbours")
    # rows with an id on either side of both joins, so that their texts are shuffled once
    known = docs.where("doc_id is not null")
    given = known.join(order.select("doc_id", "prev_id", F.floor(F.col("prev_n") / 4).cast("int").alias("need")), "doc_id")
    given = given.groupBy(F.col("prev_id").alias("doc_id")).agg(F.min(F.expr("substring(text, 1, need)")).alias("given"))
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring(F.coalesce("given", F.lit("")), F.lit(1), quarter))
    both = known.join(given, "doc_id", "left").unionByName(docs.where("doc_id is null").withColumn("given", F.lit("")))
    pairs = both.select("doc_id", "text", n.cast("long").alias("n_chars"), edited.alias("edited"))
    prints = pairs.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("text")).alias("own"), fingerprint(F.col("edited")).alias("other"))
    prints = written(prints, "order-prints")
    nexts = prints.join(order.select("doc_id", "prev_id"), "doc_id").groupBy(F.col("prev_id").alias("doc_id")).agg(F.min("own").alias("next"))
    blank = F.array_repeat(F.lit(None).cast("long"), BUCKETS)
    return prints.join(nexts, "doc_id", "left").select(
        "doc_id", "n_chars", "edited_sha256", shown(F.col("own")).alias("fingerprint"), shown(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.coalesce("next", blank)).alias("near_next"))
