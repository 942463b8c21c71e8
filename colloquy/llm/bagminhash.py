"""Near-duplicate detection by BagMinHash.

A text is a bag of shingles of five words with their counts. Each shingle has Poisson processes over its weight axis,
cut at 0, 1, 2, 4, 8, ... A process of a whole interval is generated at once; where a count ends inside an interval the
points are split in halves, bit by bit, to the discrete weights they belong to, and those above the count are dropped.
Every point carries a register; a register keeps the identity of its earliest point. Two bags agree in a register with
a probability of their weighted Jaccard similarity, without bias. Points later than a bound that depends on the bag's
weight can't be first in any register and aren't generated; where a register stays empty the bound is doubled.

Registers are banded. In each bucket all are compared with one document, its head, and after that those that no link has
joined to the head's component with the whole bucket, in blocks that put out links only. Comparison is exact: overlap of the bags, counts included, over their union.
Classes are the connected components of the links. In large classes the links are those that hold it together, not all
that there are; none between different classes is missed but by the bands. Texts that are equal are one text from the start, so copies are never
paired.

Defined results: null text is empty text; texts without words have no shingles and are near their exact copies only;
texts of one to four words have one shingle, all of their words; rows with the same doc_id are one document if their texts
are equal, and else links between them join their classes. Rows without doc_id are left out of the classes. Columns but
doc_id and text don't matter, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm import words
from colloquy.llm.components import components
from colloquy.llm.shared import unused, written

K, SIMILARITY = 5, Fraction(4, 5)
BANDS, ROWS = 40, 7  # at a similarity of 0.8 a pair shares no bucket with a probability of 0.00008
EIGHT = 8
_LOW = np.uint64(0xFFFFFFFF)
LINKS = "a long, b long, common long, either long"
#: A block of a bucket has about so many documents and shingles that ask, and that are asked; one longer text is a block.
ASKING, ASKED = (64, 1 << 15), (512, 1 << 18)


def bags(data: np.ndarray, offs: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) of each distinct shingle of each text, by text."""
    w = words.Words(data, offs)
    h = w.hashes()
    at, shingle = words.windows(h, w.bound, k)
    doc = w.doc()[at]
    short = np.flatnonzero((w.count > 0) & (w.count < k))
    for n in range(1, k):
        own = short[w.count[short] == n]
        if len(own):
            first, s = words.windows(h, w.bound, n)
            pick = np.isin(first, w.bound[own])
            doc, shingle = np.concatenate([doc, own]), np.concatenate([shingle, words.mix(s[pick] + np.uint64(n))])
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    if not len(doc):
        return doc, shingle, np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])]))
    return doc[new], shingle[new], np.diff(np.append(new, len(doc)))


def points(doc, element, low, rate, keep, until, m):
    """All points up to each text's bound: (text * m + register, time, identity).

    A row is an interval (low, low + rate] of an element's weight axis, of which `keep` is covered.
    """
    # a process is cut into blocks of time that hold EIGHT points on average, each with a seed of its own
    blocks = np.floor(until[doc] * rate / EIGHT).astype(np.int64) + 1
    row = np.repeat(np.arange(len(doc)), blocks)
    block = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    doc, low, rate, keep, element = doc[row], low[row], rate[row], keep[row], element[row]
    slots, times, names = [], [], []
    time, stop = block * (EIGHT / rate), np.minimum(until[doc], (block + 1) * (EIGHT / rate))
    seed, step = words.mix(words.mix(element + low.astype(np.uint64) * words.BASES[0]) + block.astype(np.uint64)), 0
    while len(doc):
        step += 1
        r = words.mix(seed + np.uint64(step * int(words.BASES[1]) & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
        alive = np.flatnonzero(time <= stop)
        doc, seed, rate, keep, time, stop, r = doc[alive], seed[alive], rate[alive], keep[alive], time[alive], stop[alive], r[alive]
        name = words.mix(r ^ words.BASES[0])
        slot = doc * m + ((name >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        part = np.flatnonzero(keep < rate)
        if len(part):  # the interval has a power of two of weights; each bit chooses a half
            inside = (words.mix(name[part] + words.BASES[1]) & (rate[part] - 1).astype(np.uint64)).astype(np.int64) < keep[part]
            ok = np.ones(len(doc), bool)
            ok[part[~inside]] = False
            slots.append(slot[ok]), times.append(time[ok]), names.append(name[ok])
        else:
            slots.append(slot), times.append(time), names.append(name)
    return np.concatenate(slots), np.concatenate(times), np.concatenate(names)


def signatures(doc: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int, m: int) -> np.ndarray:
    """n x m identities of the earliest points; rows of texts without shingles are zero."""
    out = np.zeros(n * m, np.uint64)
    weight = np.bincount(doc, count, n)
    # intervals: (0, 1], (1, 2], (2, 4], ... as far as the count reaches
    top = np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64)
    row = np.repeat(np.arange(len(doc)), top + 1)
    level = np.arange(len(row)) - np.repeat(np.cumsum(top + 1) - (top + 1), top + 1)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    rate = np.where(level > 0, low, 1)
    keep = np.minimum(count[row] - low, rate)
    todo = np.flatnonzero(weight > 0)
    spare = 2.0
    while len(todo):
        until = np.zeros(n)
        until[todo] = m / weight[todo] * (np.log(m) + spare)
        mine = until[doc[row]] > 0
        slot, time, name = points(doc[row][mine], shingle[row][mine], low[mine], rate[mine], keep[mine], until, m)
        # time, as a share of the bound, orders; the identity is kept below it
        share = (time / until[slot // m] * 2.0**31).astype(np.uint64)
        best = np.full(n * m, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(best, slot, (share << np.uint64(32)) | (name & _LOW))
        full = (best.reshape(n, m) != np.iinfo(np.uint64).max).all(1)
        done = todo[full[todo]]
        rows = (done[:, None] * m + np.arange(m)).ravel()
        out[rows] = best[rows] & _LOW
        todo, spare = todo[~full[todo]], spare * 2 + np.log(m)
    return out.reshape(n, m)


def bands(sig: np.ndarray, n_bands: int, n_rows: int) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    part = sig.reshape(len(sig), n_bands, n_rows)
    key = np.broadcast_to(words.mix(np.arange(1, n_bands + 1).astype(np.uint64)), part.shape[:2]).copy()
    for j in range(n_rows):
        key = words.mix(key * words.BASES[0] + part[:, :, j])
    return key.view(np.int64)


def sketch(docs: DataFrame, n_bands: int = BANDS, n_rows: int = ROWS, k: int = K) -> DataFrame:
    """(doc_id, n, keys): the number of shingles, counts included, and the band keys."""
    m = n_bands * n_rows

    def work(batches):
        for b in batches:
            data, offs = words.buffers(b.column("text"))
            for i, j in words.chunks(offs, 1 << 19):
                d, s, c = bags(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], k)
                weight = np.bincount(d, c, j - i).astype(np.int64)
                keys = bands(signatures(d, s, c, j - i, m), n_bands, n_rows)
                sizes = np.where(weight > 0, n_bands, 0)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(keys[weight > 0].ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), pa.array(weight), lists], ["doc_id", "n", "keys"])

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, n long, keys array<long>")


def verified(pairs: DataFrame, texts: DataFrame, similarity: Fraction = SIMILARITY, k: int = K) -> DataFrame:
    """(a, b, common, either) of the pairs whose bags overlap enough: the overlap's size, and the union's."""
    over, under = similarity.numerator, similarity.denominator
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("s"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("t"))

    def work(batches):
        for b in batches:
            good, both_of = np.zeros(b.num_rows, bool), np.zeros((2, b.num_rows), np.int64)
            sides = [words.buffers(b.column(c)) for c in ("s", "t")]
            both = np.diff(sides[0][1]) + np.diff(sides[1][1])
            for i, j in words.chunks(np.concatenate([[0], np.cumsum(both)])):
                (d1, s1, c1), (d2, s2, c2) = (bags(x[o[i] : o[j]], o[i : j + 1] - o[i], k) for x, o in sides)
                d, s, c = np.concatenate([d1, d2]), np.concatenate([s1, s2]), np.concatenate([c1, c2])
                order = np.lexsort((s, d))
                d, s, c = d[order], s[order], c[order]
                twin = np.flatnonzero((d[1:] == d[:-1]) & (s[1:] == s[:-1]))
                common = np.bincount(d[twin], np.minimum(c[twin], c[twin + 1]), j - i)
                union = np.bincount(d, c, j - i) - common
                good[i:j] = (common * under >= union * over) & (union > 0)
                both_of[:, i:j] = common, union
            got = pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), *(pa.array(x) for x in both_of)], ["a", "b", "common", "either"])
            yield got.filter(pa.array(good))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "s", "t").mapInArrow(work, LINKS)


def rest_links(placed: DataFrame, texts: DataFrame, similarity: Fraction, k: int, asking: tuple[int, int] = ASKING, asked: tuple[int, int] = ASKED) -> DataFrame:
    """Links (a, b, common, either) between documents of a bucket in different components, found in blocks and without
    making rows of pairs.

    The query set of a bucket is what isn't in its head's component; it meets all of the bucket whose size allows a link,
    a block at a time, and only links are put out. Sizes are dealt to classes a similarity apart, so that only
    neighbouring classes meet; blocks are bounded by documents and by shingles.
    """
    over, under = similarity.numerator, similarity.denominator
    kinds = placed.groupBy("key").agg(F.max(F.when(F.col("is_head"), F.col("comp"))).alias("main"), F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("size")).where("x < y and size > 2")
    rest = placed.join(written(kinds.select("key", "main"), "near-open"), "key").withColumn("asks", F.col("comp") != F.col("main"))
    # whoever asks meets its own class and the ones beside it; `c` is the class of the one that asks
    own = F.floor(F.log(F.col("n").cast("double")) / float(np.log(under / over) * (1 + 1e-9))).cast("int")
    rest = written(rest.withColumn("own", own).select("key", "own", "doc_id", "n", "comp", "asks"), "near-asking")
    queries = rest.where("asks").withColumn("c", F.col("own"))
    targets = rest.withColumn("c", F.explode(F.array(F.col("own") - 1, F.col("own"), F.col("own") + 1)))
    blocks = lambda most: F.ceil(F.greatest(F.count("*") / most[0], F.sum("n") / most[1])).cast("int")
    n_asking = written(queries.groupBy("key", "c").agg(blocks(asking).alias("nq")), "near-blocks")
    n_asked = written(targets.join(n_asking, ["key", "c"], "left_semi").groupBy("key", "c").agg(blocks(asked).alias("nt")).join(n_asking, ["key", "c"]), "near-blocks")
    queries, targets = queries.join(n_asked, ["key", "c"]), targets.join(n_asked, ["key", "c"])
    block = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    queries = queries.withColumn("q", block("nq")).select("key", "c", "q", every("nt").alias("t"), "doc_id", "n", "comp", F.lit(True).alias("asks"))
    targets = targets.withColumn("t", block("nt")).select("key", "c", every("nq").alias("q"), "t", "doc_id", "n", "comp", F.lit(False).alias("asks"))
    rows = queries.unionByName(targets).join(texts, "doc_id").select("key", "c", "q", "t", "doc_id", "comp", "asks", "text")

    def work(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        asks = group.column("asks").to_numpy(zero_copy_only=False)
        ids, comp = group.column("doc_id").to_numpy(), group.column("comp").to_numpy()
        d, s, c = bags(*words.buffers(group.column("text")), k)
        n = np.bincount(d, c, len(asks)).astype(np.int64)
        # a shingle that is there c times counts as c numbered ones, so that overlaps are those of sets
        row = np.repeat(np.arange(len(d)), c)
        d, s = d[row], words.mix(s[row] + (np.arange(len(row)) - np.repeat(np.cumsum(c) - c, c)).astype(np.uint64) * words.BASES[0])
        order = np.argsort(s, kind="stable")
        d, s = d[order], s[order]
        _, name = np.unique(s, return_inverse=True)
        mine, theirs = asks[d], ~asks[d]
        a, x = d[mine], name[mine]
        b, y = d[theirs], name[theirs]
        lo, hi = np.searchsorted(y, x, "left"), np.searchsorted(y, x, "right")
        mine = np.flatnonzero(asks)
        place = np.zeros(len(asks), np.int64)
        place[mine] = np.arange(len(mine))
        common = np.zeros(len(mine) * len(asks), np.int32) if len(a) else np.zeros(0, np.int32)
        cuts = np.concatenate([[0], np.cumsum(hi - lo)])
        for i, j in words.chunks(cuts, 1 << 21):
            reach = hi[i:j] - lo[i:j]
            at = np.repeat(lo[i:j] - (np.cumsum(reach) - reach), reach) + np.arange(int(reach.sum()))
            common += np.bincount(np.repeat(place[a[i:j]], reach) * len(asks) + b[at], minlength=len(common)).astype(np.int32)
        p = np.flatnonzero(common)
        i, j, o = mine[p // len(asks)], p % len(asks), common[p].astype(np.int64)
        good = (comp[i] != comp[j]) & (o * under >= (n[i] + n[j] - o) * over)
        i, j, o = i[good], j[good], o[good]
        return pa.table({"a": pa.array(np.minimum(ids[i], ids[j]), pa.int64()), "b": pa.array(np.maximum(ids[i], ids[j]), pa.int64()), "common": pa.array(o), "either": pa.array(n[i] + n[j] - o)})

    return rows.groupBy("key", "c", "q", "t").applyInArrow(work, LINKS).distinct()


def near_classes(docs: DataFrame, similarity: Fraction = SIMILARITY, n_bands: int = BANDS, n_rows: int = ROWS, k: int = K) -> DataFrame:
    """(doc_id, class_id, copy_of, linked_to, similarity): class_id is the smallest doc_id of the class, copy_of that of
    the exact copies; linked_to is the document of another text that the copies' first is most alike, of those that it was
    compared with, and null in a class of one text."""
    classes, links = classes_and_links(docs, similarity, n_bands, n_rows, k)
    share = F.struct((F.col("common") / F.col("either")).alias("s"), (-F.col("b")).alias("o"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "common", "either"))
    best = written(both.groupBy(F.col("a").alias("copy_of")).agg(F.max(share).alias("m")), "near-best")
    return classes.join(best, "copy_of", "left").select("doc_id", "class_id", "copy_of", (-F.col("m.o")).alias("linked_to"), F.col("m.s").alias("similarity"))


def classes_and_links(docs: DataFrame, similarity: Fraction = SIMILARITY, n_bands: int = BANDS, n_rows: int = ROWS, k: int = K) -> tuple[DataFrame, DataFrame]:
    """(doc_id, class_id, copy_of), and the links (a, b, common, either) between first documents of texts that hold the
    classes together, each with its exact overlap."""
    docs = docs.where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    names = docs.select("doc_id", F.sha2("text", 256).alias("name"))
    again = written(names.groupBy("name").agg(F.min("doc_id").alias("copy_of"), F.count("*").alias("size")).where("size > 1").select("name", "copy_of"), "near-again")
    copies = written(names.join(again, "name", "left").select("doc_id", F.coalesce("copy_of", "doc_id").alias("copy_of")).distinct(), "near-copies")
    # one row of each text; a doc_id that names several texts keeps them all
    own = written(sketch(docs, n_bands, n_rows, k).join(copies.where("doc_id = copy_of").select("doc_id").distinct(), "doc_id").distinct(), "near-bands")
    keyed = own.select("doc_id", "n", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"), F.count("*").alias("size")).where("x < y").select("key", "size")
    members = written(keyed.join(shared, "key"), "near-members")
    # the head of a bucket is the document that has most company over all its buckets: one in the midst of near copies
    company = members.groupBy("doc_id").agg(F.sum("size").alias("company"))
    heads = members.join(company, "doc_id").groupBy("key").agg(F.max(F.struct("company", (-F.col("doc_id")).alias("x"))).alias("head")).select("key", (-F.col("head.x")).alias("head"))
    members = written(members.join(heads, "key"), "near-headed")
    low, high = F.least("n", "m"), F.greatest("n", "m")
    fits = low * similarity.denominator >= high * similarity.numerator
    sizes = own.select(F.col("doc_id").alias("a"), F.col("n").alias("m"))
    tried = written(members.where("head <> doc_id").select(F.col("head").alias("a"), F.col("doc_id").alias("b"), "n").distinct().join(sizes, "a").where(fits).select("a", "b").distinct(), "near-pairs")
    links = written(verified(tried, docs, similarity, k), "near-links")
    comp = written(components(links.select("a", "b")), "near-components")
    placed = members.join(comp.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("key", "doc_id", "n", (F.col("doc_id") == F.col("head")).alias("is_head"), F.coalesce("comp", "doc_id").alias("comp"))
    links = links.unionByName(rest_links(written(placed, "near-placed"), docs, similarity, k))
    links = written(links.groupBy("a", "b").agg(F.max("common").alias("common"), F.max("either").alias("either")), "near-all-links")
    # copies are joined to their text's first document, which also joins texts that share a doc_id
    joined = components(links.select("a", "b").union(copies.where("copy_of <> doc_id").select(F.col("copy_of").alias("a"), F.col("doc_id").alias("b"))).distinct())
    ids = copies.groupBy("doc_id").agg(F.min("copy_of").alias("copy_of"))
    joined = written(joined, "near-joined")
    classes = ids.join(joined.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("doc_id", F.coalesce("comp", "doc_id").alias("class_id"), "copy_of")
    return written(classes, "near-classes"), links


def kept(docs: DataFrame, **how) -> DataFrame:
    """One document of each class, the one with the smallest doc_id; rows without doc_id stay.

    Of rows that share that doc_id one stays.
    """
    classes, _ = classes_and_links(docs, **how)
    drop = written(classes.where("doc_id <> class_id").select("doc_id"), "near-drop")
    rest = docs.join(drop, "doc_id", "left_anti")
    row = unused(docs, "row")
    same = Window.partitionBy("doc_id", F.when(F.col("doc_id").isNull(), F.xxhash64("text"))).orderBy(F.xxhash64("text"), F.to_json(F.struct(*docs.columns)))
    return rest.withColumn(row, F.row_number().over(same)).where(f"doc_id is null or {row} = 1").select(docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    return near_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
