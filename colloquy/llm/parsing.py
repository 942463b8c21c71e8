"""Substring deduplication over bytes by prefix-free parsing.

A 64-byte string is a core if its rolling hash is the smallest among its neighbours'; every 200-byte string holds one,
and equal strings hold it at the same place. Cores parse each text. The 132 bytes that end with a core and the 132 that
start with it are triggers: one of the two lies in any 200 bytes around the core, whichever way they reach further. A
trigger that the corpus has once can't lie in a repeated string, and nothing more is done for it: what is left is the
highly repetitive part.

For each other trigger, every place has a dictionary part (the bytes before the trigger, one suffix for each length) and
a parse part (the bytes from the trigger on). Places are put in corpus order: the parse parts are sorted once, as in a
suffix array, and for each suffix length this order is merged with that of the dictionary suffixes. Neighbours in that
order that share the suffix and the rest of 200 bytes are repeated strings. Comparison in order is by 64-bit hashes of
the two parts among the places of one trigger.

Triggers with over `HOT` places, which would fill a task's memory, go another way with the same result: the hashes of
their 200-byte strings are counted in the JVM, partly before the shuffle.

Texts that are equal take part once; if they have 200 bytes all their bytes are repeated. Defined results: null text is
empty text; shorter texts keep everything; two equal rows are two documents; ids take no part in the decision, nor do
columns but text, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm import words
from colloquy.llm.shared import written

LENGTH, TRIGGER, HOT = 200, 132, 20_000
_TABLE = words.mix(np.arange(1, 257).astype(np.uint64))


def prepared(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tid"), F.octet_length(text).cast("long").alias("n"))


def sums(data: np.ndarray, seed: int = 0) -> np.ndarray:
    """Prefix sums of a polynomial hash of the bytes."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * words.powers(words.BASES[seed], len(data))[: len(data)], out=out[1:])
    return out


def cut(s: np.ndarray, start: np.ndarray, length, seed: int = 0) -> np.ndarray:
    """Hashes of the strings of `length` bytes that start at `start`, from prefix sums."""
    return words.mix((s[start + length] - s[start]) * words.inverse_powers(words.BASES[seed], len(s))[start])


def triggers(data: np.ndarray, offs: np.ndarray, length: int, trigger: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, text) of each trigger: two for each core, one that ends with it and one that starts with it."""
    n, core = len(data), 2 * trigger - length
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    s = sums(data)
    k = n - core + 1
    h = words.mix((s[core:] - s[:-core]) * words.inverse_powers(words.BASES[0], n)[:k])
    owner = words.owners(offs)
    first = np.flatnonzero(np.arange(n) + length <= offs[1:][owner])
    pick = words.minimizers(h, first, length - core + 1)
    text = owner[pick]
    before, after = pick - (trigger - core), pick + trigger
    place = np.unique(np.concatenate([before[before >= offs[text]], pick[after <= offs[text + 1]]]))
    return place, cut(s, place, trigger), owner[place]


def parse(docs: DataFrame, length: int, trigger: int) -> DataFrame:
    """(h, tid, pos, times) of all triggers: of a trigger's places in a text the first and the last; times add up to all."""

    def work(batches):
        for b in batches:
            data, offs = words.buffers(b.column("text"))
            tid = b.column("tid").to_numpy()
            for i, j in words.chunks(offs):
                o = offs[i : j + 1] - offs[i]
                pick, h, text = triggers(data[offs[i] : offs[j]], o, length, trigger)
                at, times = words.ends_of_runs(h, text)
                pick, h, text = pick[at], h[at], text[at]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(tid[i + text]), pa.array(pick - o[text], pa.int64()), pa.array(times)], ["h", "tid", "pos", "times"])

    return docs.select("text", "tid").mapInArrow(work, "h long, tid long, pos long, times long")


def alive_in(b: pa.RecordBatch, column: str, length: int, trigger: int):
    """For each run of texts of a batch: bytes, offsets, first row, and the triggers whose hashes the column lists."""
    data, offs = words.buffers(b.column("text"))
    known, known_offs = words.lists(b.column(column))
    for i, j in words.chunks(offs):
        o = offs[i : j + 1] - offs[i]
        part = data[offs[i] : offs[j]]
        pick, h, text = triggers(part, o, length, trigger)
        ok = words.members(h, text, known[known_offs[i] : known_offs[j]], known_offs[i : j + 1] - known_offs[i])
        yield part, o, i, pick[ok], h[ok], text[ok]


def contexts(docs: DataFrame, length: int, trigger: int) -> DataFrame:
    """(h, tid, n, pos, before, bytes): the bytes around each place of a repeated trigger."""
    reach = length - trigger

    def work(batches):
        for b in batches:
            tid, size = b.column("tid").to_numpy(), b.column("n").to_numpy()
            for part, o, i, pick, h, text in alive_in(b, "known", length, trigger):
                a, z = np.maximum(pick - reach, o[text]), np.minimum(pick + trigger + reach, o[text + 1])
                raw = part.tobytes()
                around = pa.array([raw[x:y] for x, y in zip(a.tolist(), z.tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(tid[i + text]), pa.array(size[i + text]), pa.array(pick - o[text], pa.int64()), pa.array(pick - a, pa.int64()), around], ["h", "tid", "n", "pos", "before", "around"])

    return docs.select("text", "tid", "n", "known").mapInArrow(work, "h long, tid long, n long, pos long, before long, around binary")


def repeated_among(h: np.ndarray, before: np.ndarray, data: np.ndarray, offs: np.ndarray, length: int, trigger: int) -> np.ndarray:
    """For each place and each suffix length 0 .. length - trigger, whether another place of the trigger has the same string."""
    reach, n = length - trigger, len(h)
    size = np.diff(offs)
    after = size - before - trigger
    wide = np.zeros((n, 2 * reach + trigger), np.uint8)
    column = np.arange(2 * reach + trigger)[None] - (reach - before)[:, None]
    inside = (column >= 0) & (column < size[:, None])
    wide[inside] = data
    # the parse parts in order, for each trigger
    right = np.ascontiguousarray(wide[:, reach + trigger :]).view(f"S{reach}").ravel()
    order = np.argsort(right, kind="stable")
    order = order[np.argsort(h[order], kind="stable")]
    h, before, after, wide = h[order], before[order], after[order], wide[order]
    p = words.powers(words.BASES[0], 2 * reach + trigger)
    body = _TABLE[wide]
    left = np.zeros((n, reach + 1), np.uint64)  # of the suffix of each length before the trigger
    np.cumsum(body[:, reach - 1 :: -1] * p[1 : reach + 1], axis=1, out=left[:, 1:])
    rest = np.zeros((n, reach + 1), np.uint64)  # of the first bytes after it
    np.cumsum(body[:, reach + trigger :] * p[1 : reach + 1], axis=1, out=rest[:, 1:])
    found = np.zeros((n, reach + 1), bool)
    for a in range(reach + 1):
        rows = np.flatnonzero((before >= a) & (after >= reach - a))
        key = words.mix(left[rows, a] ^ words.mix(h[rows]))
        at = np.argsort(key, kind="stable")  # dictionary suffixes, parse order kept within each
        rows, key = rows[at], key[at]
        same = (key[1:] == key[:-1]) & (rest[rows[1:], reach - a] == rest[rows[:-1], reach - a])
        found[rows[1:][same], a] = True
        found[rows[:-1][same], a] = True
    out = np.zeros_like(found)
    out[order] = found
    return out


def ordered(places: DataFrame, length: int, trigger: int, rows: int = 8192) -> DataFrame:
    """(tid, n, start, stop): the union of the repeated strings around each place."""
    reach = length - trigger

    def settle(table: pa.Table):
        h = table.column("h").to_numpy()
        before, pos = table.column("before").to_numpy(), table.column("pos").to_numpy()
        data, offs = words.buffers(table.column("around"))
        found = repeated_among(h, before, data, offs, length, trigger)
        some = np.flatnonzero(found.any(1))
        most, least = reach - np.argmax(found[some, ::-1], 1), np.argmax(found[some], 1)
        return pa.RecordBatch.from_arrays([pa.array(table.column("tid").to_numpy()[some]), pa.array(table.column("n").to_numpy()[some]), pa.array(pos[some] - most), pa.array(pos[some] - least + length)], ["tid", "n", "start", "stop"])

    def work(batches):
        held, n = [], 0
        for b in batches:
            for i in range(0, b.num_rows, rows):
                held.append(b.slice(i, rows))
                n += held[-1].num_rows
                if n < rows:
                    continue
                table = pa.Table.from_batches(held)
                h = table.column("h").to_numpy()
                full = int(np.searchsorted(h, h[-1], "left"))  # the last trigger may go on
                if full:
                    yield settle(table.slice(0, full).combine_chunks())
                held, n = table.slice(full).combine_chunks().to_batches(), table.num_rows - full
        if n:
            yield settle(pa.Table.from_batches(held).combine_chunks())

    return places.repartition("h").sortWithinPartitions("h").mapInArrow(work, "tid long, n long, start long, stop long")


def counted(docs: DataFrame, length: int, trigger: int) -> DataFrame:
    """The same as `ordered` for the triggers in `hot`, by counting strings' hashes."""
    reach = length - trigger

    def work(batches):
        for b in batches:
            tid, size = b.column("tid").to_numpy(), b.column("n").to_numpy()
            for part, o, i, pick, _, text in alive_in(b, "hot", length, trigger):
                start = (pick[:, None] - np.arange(reach + 1)[None]).ravel()
                owner = np.repeat(text, reach + 1)
                ok = (start >= o[owner]) & (start + length <= o[owner + 1])
                start, at = np.unique(start[ok], return_index=True)
                owner = owner[ok][at]
                g = [cut(sums(part, s), start, length, s).view(np.int64) for s in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*g, tid[i + owner], size[i + owner], start - o[owner])], ["g", "k", "tid", "n", "start"])

    strings = docs.select("text", "tid", "n", "hot").mapInArrow(work, "g long, k long, tid long, n long, start long")
    strings = written(strings, "parse-hot")
    again = written(strings.groupBy("g", "k").count().where("count > 1").select("g", "k"), "parse-again")
    return strings.join(again, ["g", "k"]).select("tid", "n", "start", (F.col("start") + length).alias("stop"))


def removed(docs: DataFrame, length: int = LENGTH, trigger: int = TRIGGER, hot: int = HOT, text_out: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and on request the kept bytes."""
    docs = prepared(docs)
    place = F.xxhash64("tid", "pos")  # tells places apart; a long, so that sums need no sort
    places = parse(docs, length, trigger)
    # sums first, then a join that can be split: one trigger may have a third of all places
    often = written(places.groupBy("h").agg(F.min(place).alias("x"), F.max(place).alias("y"), F.sum("times").alias("places")).where("x <> y").select("h", "places"), "parse-often")
    level = places.select("h", "tid").join(often, "h")
    lists = level.groupBy("tid").agg(F.collect_set(F.when(F.col("places") <= hot, F.col("h"))).alias("known"), F.collect_set(F.when(F.col("places") > hot, F.col("h"))).alias("hot"))
    alive = written(lists, "parse-alive")
    texts = written(docs.groupBy("tid", "n").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")), "parse-texts")
    chosen = docs.join(alive.join(texts, "tid"), ["tid", "n"]).where(F.col("doc_id").eqNullSafe(F.col("first")))
    spans = ordered(contexts(chosen.where("size(known) > 0"), length, trigger), length, trigger)
    if alive.where("size(hot) > 0").limit(1).count():
        spans = spans.union(counted(chosen.where("size(hot) > 0"), length, trigger))
    found = spans.groupBy("tid", "n").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    copies = texts.where((F.col("copies") > 1) & (F.col("n") >= length)).select("tid", "n", F.lit(True).alias("whole"))
    marks = written(found.join(copies, ["tid", "n"], "full_outer"), "parse-marks")
    names = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * text_out

    def work(batches):
        for b in batches:
            data, offs = words.buffers(b.column("text"))
            raw, rows = data.tobytes(), []
            whole, spans = b.column("whole").to_pylist(), b.column("spans")
            for i in range(b.num_rows):
                a, z = int(offs[i]), int(offs[i + 1])
                gone, n_spans, kept = 0, 0, raw[a:z]
                if whole[i]:
                    gone, n_spans, kept = z - a, 1, b""
                elif spans[i].is_valid and len(spans[i]):
                    both = spans[i].values
                    start, stop = (both.field(k).to_numpy() for k in (0, 1))
                    step = np.zeros(z - a + 1, np.int64)
                    np.add.at(step, start, 1)
                    np.add.at(step, stop, -1)
                    out = np.cumsum(step[:-1]) > 0
                    gone = int(out.sum())
                    n_spans = int(np.count_nonzero(out[1:] & ~out[:-1]) + out[0])
                    kept = data[a:z][~out].tobytes()
                rows.append((z - a, gone, n_spans, hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            arrays = [b.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols[:4], (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True))]
            arrays += [pa.array(cols[4], pa.binary())] * text_out
            yield pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in names.split(", ")])

    return docs.join(marks, ["tid", "n"], "left").select("doc_id", "text", "spans", "whole").mapInArrow(work, names)


def query(spark, sf_dir: str) -> DataFrame:
    return removed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
