"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Each line is good or bad. Its potential is a linear function of features of the line and of its neighbours; a 2 x 2
table scores transitions. The forward-backward algorithm gives each line's marginal probability of being good; weighted
by line length they add up to the document's score, which a logistic function maps to the odds of label 1.

Chains are cut into blocks, whose 2 x 2 products are made side by side, so that a text of many lines takes few steps; the
result is that of the whole chain, in learning as in scoring.

Learning: labelled rows outside the held-out fold (crc32 of doc_id modulo 5 is 0) in the order of hashes of doc_id, at
most `MOST_ROWS` of them and as many as have `MOST_LINES` lines together; lines take their document's label. Only their
features reach the driver: 136 bytes a line. Scoring covers every line of every text.

Defined results: null and empty texts count as one empty line; a null doc_id is in no fold to learn from; without
labels of both kinds every score is the share of label 1 (0.5 without any). Equal texts have equal scores; rows that
share a doc_id each count as one in the bound; a column that has the name of the score is replaced by it, any others
stay; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.llm import words

MOST_ROWS, MOST_LINES, BLOCK = 6000, 120_000, 32
FOLDS, THRESHOLD = 5, 0.3

_KIND = np.zeros(256, np.uint8)  # 0 other, 1 upper case, 2 digit, 3 white, 4 plain punctuation, 5 symbol, 6 "!", 7 "|", 8 beyond ASCII
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[[0x20, *range(0x09, 0x0E)]] = 3
_KIND[list(b".,;:'\"?()-")] = 4
_KIND[list(b"#$%&*<>{}[]\\~^_=+@/`")] = 5
_KIND[ord("!")], _KIND[ord("|")] = 6, 7
_KIND[128:] = 8
NEAR = [3, 5, 6, 7, 8, 9, 10, 11]  # features that neighbours lend


def lines(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each line, and the bounds of each text's lines; every text has one line at least."""
    feeds = np.flatnonzero(data == 0x0A)
    start = np.sort(np.concatenate([offs[:-1], feeds + 1]), kind="stable")
    end = np.sort(np.concatenate([offs[1:], feeds]), kind="stable")
    per = np.bincount(np.searchsorted(offs[1:], feeds, "right"), minlength=len(offs) - 1) + 1
    return start, end, np.concatenate([[0], np.cumsum(per)])


def counted(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: how often it is in its text, and whether it is there for the first time."""
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    key = words.mix(h ^ words.mix(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    n = np.diff(np.append(np.flatnonzero(new), len(h)))
    often, first = np.empty(len(h), np.int64), np.empty(len(h), bool)
    often[order], first[order] = np.repeat(n, n), new
    return often, first


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and length of each line, and the bounds of each text's lines."""
    start, end, bound = lines(data, offs)
    n, size = len(start), end - start
    owner = np.repeat(np.arange(n), size)
    inside = np.ones(len(data), bool)
    inside[np.flatnonzero(data == 0x0A)] = False
    kinds = np.bincount(owner * 9 + _KIND[data[inside]], minlength=9 * n).reshape(n, 9).astype(np.float64)
    w = words.Words(data, offs)
    h, doc = w.hashes(), w.doc()
    line = np.searchsorted(start, w.start, "right") - 1
    n_words = np.bincount(line, minlength=n).astype(np.float64)
    some = np.maximum(n_words, 1)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    _, fresh = counted(doc, h)
    at, tri = words.windows(h, w.bound, 3)
    often, _ = counted(doc[at], tri)
    line_doc = np.repeat(np.arange(len(offs) - 1), np.diff(bound))
    same, _ = counted(line_doc, words.spans(data, start, end))
    chars = np.maximum(size, 1)
    last = np.zeros(n, np.uint8)
    last[size > 0] = data[end[size > 0] - 1]
    f = np.empty((n, 16))
    f[:, 0], f[:, 1], f[:, 2] = np.log1p(size), np.log1p(n_words), size / some / 10
    f[:, 3], f[:, 4], f[:, 5] = kinds[:, 1] / chars, kinds[:, 2] / chars, kinds[:, 5] / chars
    f[:, 6], f[:, 7] = kinds[:, 6] / chars, kinds[:, 7] / chars
    f[:, 8] = np.bincount(line, again, n) / some
    f[:, 9] = np.bincount(line[at], often > 1, n) / some
    f[:, 10] = (same > 1) & (size > 0)
    f[:, 11] = np.bincount(line, fresh, n) / some
    f[:, 12], f[:, 13], f[:, 14] = np.isin(last, list(b".!?")), kinds[:, 8] / chars, kinds[:, 4] / chars
    f[:, 15] = n_words == 0
    near = np.zeros((n, 2 * len(NEAR) + 2))
    first, final = bound[:-1], bound[1:] - 1
    k = len(NEAR)
    near[1:, :k], near[:-1, k : 2 * k] = f[:-1, NEAR], f[1:, NEAR]
    near[first, :k], near[final, k : 2 * k] = 0, 0
    near[first, -2], near[final, -1] = 1, 1
    return np.hstack([f, near]), size, bound


def steps(at: np.ndarray, length: np.ndarray):
    """The k-th items of all runs (first item, length) of more than k, for k = 0, 1, ...; with the runs they are of."""
    order = np.argsort(-length, kind="stable")
    at, length = at[order], length[order]
    for k, n in enumerate(np.searchsorted(-length, -np.arange(int(length.max(initial=0))), "left").tolist()):
        yield order[:n], at[:n] + k


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors or matrices that add up to 1, and what they added up to."""
    total = x.sum(tuple(range(1, x.ndim)))
    return x / total.reshape(len(x), *[1] * (x.ndim - 1)), total


def marginals(scores: np.ndarray, bound: np.ndarray, table: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, float]:
    """P(good) of each line, expected transitions summed over all chains, and the sum of the chains' log partition functions.

    A line's matrix is transition times potential; a chain is cut into blocks, and the products of blocks lead from one
    to the next.
    """
    e = np.stack([np.ones(len(scores)), np.exp(np.clip(scores, -30, 30))], 1)
    a = np.exp(table)
    first = np.zeros(len(e), bool)
    first[bound[:-1]] = True
    mats = np.where(first[:, None, None], np.eye(2), a) * e[:, None, :]
    n_blocks = -(-np.diff(bound) // block)
    chain_at = np.concatenate([[0], np.cumsum(n_blocks)])  # blocks of chain i: chain_at[i] .. chain_at[i + 1]
    within = np.arange(chain_at[-1]) - np.repeat(chain_at[:-1], n_blocks)
    start = np.repeat(bound[:-1], n_blocks) + within * block
    size = np.minimum(np.repeat(bound[1:], n_blocks) - start, block)
    product, logs = np.broadcast_to(np.eye(2), (len(start), 2, 2)).copy(), 0.0
    for run, i in steps(start, size):
        product[run], total = unit(product[run] @ mats[i])
        logs += np.log(total).sum()
    before, after = np.ones((len(start), 2)), np.ones((len(start), 2))
    last = np.ones((len(n_blocks), 2))
    for run, i in steps(chain_at[:-1], n_blocks):
        before[i] = last[run]
        last[run], total = unit((last[run][:, None, :] @ product[i])[:, 0])
        logs += np.log(total).sum()
    ends = np.ones((len(n_blocks), 2))
    for run, i in reversed(list(steps(chain_at[:-1], n_blocks))):
        after[i] = ends[run]
        ends[run], _ = unit((product[i] @ ends[run][:, :, None])[:, :, 0])
    forward, back = np.empty_like(e), np.empty_like(e)
    for run, i in steps(start, size):
        before[run], _ = unit((before[run][:, None, :] @ mats[i])[:, 0])
        forward[i] = before[run]
    for run, i in reversed(list(steps(start, size))):
        back[i] = after[run]
        after[run], _ = unit((mats[i] @ after[run][:, :, None])[:, :, 0])
    good = forward[:, 1] * back[:, 1] / (forward * back).sum(1)
    i = np.flatnonzero(~first)
    pairs, _ = unit((forward[i - 1][:, :, None] * a[None]) * (e[i] * back[i])[:, None, :])
    return good, pairs.sum(0), float(logs)


class Model:
    """Weights of the field and of the logistic map."""

    def __init__(self, mean, std, w, table, slope, shift, prior):
        self.mean, self.std, self.w, self.table, self.slope, self.shift, self.prior = mean, std, w, table, slope, shift, prior

    def raw(self, x: np.ndarray, size: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Length-weighted mean of the marginals of each text."""
        good, _, _ = marginals(((x - self.mean) / self.std) @ self.w[:-1] + self.w[-1], bound, self.table)
        doc = np.repeat(np.arange(len(bound) - 1), np.diff(bound))
        weight = size + 1e-9
        return np.bincount(doc, good * weight, len(bound) - 1) / np.bincount(doc, weight, len(bound) - 1)

    def score(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        if self.w is None:
            return np.full(len(offs) - 1, self.prior)
        return 1 / (1 + np.exp(-(self.slope * self.raw(*features(data, offs)) + self.shift)))


def fit(samples: list[tuple[np.ndarray, np.ndarray, int]], rounds: int = 250, ridge: float = 1e-3) -> Model:
    """Learn from (features, line lengths, label) of each text, by full-batch Adam on the conditional likelihood."""
    labels = np.array([y for _, _, y in samples], np.int64)
    prior = float(labels.mean()) if len(labels) else 0.5
    if len(set(labels.tolist())) < 2:
        return Model(None, None, None, None, None, None, prior)
    x = np.concatenate([f for f, _, _ in samples])
    size = np.concatenate([s for _, s, _ in samples])
    bound = np.concatenate([[0], np.cumsum([len(s) for _, s, _ in samples])])
    mean, std = x.mean(0), x.std(0) + 1e-6
    z = np.hstack([(x - mean) / std, np.ones((len(x), 1))]).astype(np.float32)
    y = np.repeat(labels, np.diff(bound))
    inner = np.ones(len(x), bool)
    inner[bound[:-1]] = False
    seen = np.bincount(2 * y[:-1][inner[1:]] + y[1:][inner[1:]], minlength=4).reshape(2, 2)
    p = np.zeros(z.shape[1] + 4)
    m, v = np.zeros_like(p), np.zeros_like(p)
    n = len(x)
    for k in range(1, rounds + 1):
        good, pairs, _ = marginals(z @ p[:-4].astype(np.float32), bound, p[-4:].reshape(2, 2))
        grad = np.concatenate([z.T @ (y - good).astype(np.float32), (seen - pairs).ravel()]) / n - ridge * p
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        p += 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    model = Model(mean, std, p[:-4], p[-4:].reshape(2, 2), 1.0, 0.0, prior)
    r = model.raw(x, size, bound)
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton's method for the logistic map, with a little ridge
        q = 1 / (1 + np.exp(-(slope * r + shift)))
        g = np.array([((labels - q) * r).sum() - 0.05 * slope, (labels - q).sum()])
        u = q * (1 - q)
        hess = np.array([[(u * r * r).sum() + 0.05, (u * r).sum()], [(u * r).sum(), u.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        slope, shift = slope + step[0], shift + step[1]
    model.slope, model.shift = float(slope), float(shift)
    return model


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, most_lines: int = MOST_LINES) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Features of labelled texts outside the held-out fold, in an order that reruns repeat: the first ones whose number
    and whose lines together are within the bounds. A text that has more lines alone is passed over."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.select("doc_id", F.col("quality").cast("int").alias("label"), F.xxhash64("doc_id").alias("order"))
    known = known.orderBy("order", "doc_id", "label").limit(most_rows)  # its size is bounded by the limit
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = ["order", "doc_id", "label", "name"]
    rows = texts.join(F.broadcast(known), "doc_id").select(*order[:3], F.xxhash64("text").alias("name"), "text")
    sizes = rows.select(*order, (F.regexp_count("text", F.lit("\n")) + 1).alias("n")).where(F.col("n") <= most_lines).orderBy(*order).limit(most_rows)
    upto = F.sum("n").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))  # at most most_rows rows
    chosen = sizes.withColumn("upto", upto).where(F.col("upto") <= most_lines).select(*order).distinct()

    def work(batches):
        for b in batches:
            for i in range(b.num_rows):
                data, offs = words.buffers(b.column("text").slice(i, 1))
                x, size, _ = features(data, offs)
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, 1) for c in order), pa.array([x.astype("<f4").tobytes()], pa.binary()), pa.array([size.astype("<i8").tobytes()], pa.binary())], [*order, "x", "size"])

    found = rows.join(F.broadcast(chosen), order).select(*order, "text").mapInArrow(work, "order long, doc_id long, label int, name long, x binary, size binary")
    got = sorted(found.collect(), key=lambda r: tuple(r))[:most_rows]
    out, n = [], 0
    for r in got:
        size = np.frombuffer(r.size, "<i8")
        n += len(size)
        if n <= most_lines:  # equal rows count one by one
            out.append((np.frombuffer(r.x, "<f4").reshape(len(size), -1), size, r.label))
    return out


def scored(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Add each text's score."""
    docs = docs.drop(*[c for c in (out,) if c != text])
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])

    def work(batches):
        for b in batches:
            data, offs = words.buffers(b.column(text))
            found = [model.score(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]) for i, j in words.chunks(offs)]
            yield b.append_column(out, pa.array(np.concatenate([*found, np.zeros(0)]), pa.float64()))

    return docs.mapInArrow(work, schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    got = scored(docs, model)
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
