"""Substring deduplication over words by level-wise doubling.

Windows of half the length come first: those that are repeated anywhere survive, and only where one does is a window of
twice the length looked at. At this first level one window is enough for each window of full length: the one with the
smallest hash among those inside, which equal windows choose alike, so one in 13 is looked at. The result is that of
looking at all windows. From the full length on, a window of twice the length is looked at only where both its halves
survive, and is named by the pair of their names, until no candidates survive.

A word is removed if a window of `length` words that covers it starts in a document with a smaller doc_id too; windows
are judged on the input. `longest` is the largest level, length times a power of two, at which such a window is there.
Texts that are equal take part once, by their smallest doc_id.

Repeated windows are found by sums, made partly before the shuffle, and then by a join that can be split, so that a
window that very many texts share is no single task's work.

Defined results: null text is empty text; texts shorter than a window keep all words; rows with the same doc_id are one
document, so that windows they share are no reason to remove; rows without doc_id are after all others and take no part
in removing, but windows that they share with a document are removed from them. Columns but doc_id and text don't
matter, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm import words
from colloquy.llm.shared import written

LENGTH = 50
NO_ID = (1 << 63) - 1


def prepared(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").isNull().alias("no_id"))


def copies(docs: DataFrame) -> DataFrame:
    """(doc_id, name, first) of texts that are there more than once: the smallest doc_id with the same text."""
    names = docs.select("doc_id", F.substring(F.unhex(F.sha2("text", 256)), 1, 16).alias("name"))
    again = names.groupBy("name").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("name", "first")
    return names.join(written(again, "repeat-texts"), "name").distinct()


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """(h, doc_id, spot): the half-length windows that stand for full windows; spot tells different places apart.

    Of the places of a window in a text the first and the last are enough.
    """
    half = length // 2

    def work(batches):
        for b in batches:
            data, offs = words.buffers(b.column("text"))
            ids = b.column("doc_id").to_numpy()
            for i, j in words.chunks(offs):
                w = words.Words(part := data[offs[i] : offs[j]], o := offs[i : j + 1] - offs[i])
                h = w.hashes()
                at, x = words.windows(h, w.bound, half)
                full, _ = places(w.bound, length)
                grid = np.zeros(len(h), np.uint64)
                grid[at] = x
                pick = words.minimizers(grid, full, length - half + 1)
                at, _ = words.ends_of_runs(grid[pick], words.owners(w.bound)[pick])
                pick = pick[at]
                text = words.spans(part, o[:-1], o[1:])[owner := words.owners(w.bound)[pick]]
                spot = words.mix(text + (pick - w.bound[owner]).astype(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(grid[pick].view(np.int64)), pa.array(ids[i + owner]), pa.array(spot.view(np.int64))], ["h", "doc_id", "spot"])

    return docs.select("doc_id", "text").mapInArrow(work, "h long, doc_id long, spot long")


def places(bound: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows that lie in one text, and their texts."""
    n = int(bound[-1])
    owner = words.owners(bound)
    first = np.flatnonzero(np.arange(n) + length <= bound[1:][owner]) if n else np.zeros(0, np.int64)
    return first, owner[first]


WINDOWS = "h long, g long, doc_id long, pos int"
_COLUMNS = [x.split()[0] for x in WINDOWS.split(", ")]


def candidates(docs: DataFrame, length: int) -> DataFrame:
    """(h, g, doc_id, pos): two hashes of each full window whose own half-length window survived (`known`)."""
    half = length // 2

    def work(batches):
        for b in batches:
            data, offs = words.buffers(b.column("text"))
            ids = b.column("doc_id").to_numpy()
            known, known_offs = words.lists(b.column("known"))
            for i, j in words.chunks(offs):
                w = words.Words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                h = w.hashes()
                at, x = words.windows(h, w.bound, half)
                grid = np.zeros(len(h), np.uint64)
                grid[at] = x
                first, text = places(w.bound, length)
                own = grid[words.chosen(grid, first, length - half + 1)] if len(first) else np.zeros(0, np.uint64)
                near = words.members(own, text, known[known_offs[i] : known_offs[j]], known_offs[i : j + 1] - known_offs[i])
                first, text = first[near], text[near]
                both = [full[np.searchsorted(pos, first)] if len(first) else np.zeros(0, np.uint64) for pos, full in (words.windows(h, w.bound, length, s) for s in (0, 1))]
                yield pa.RecordBatch.from_arrays([*(pa.array(x.view(np.int64)) for x in both), pa.array(ids[i + text]), pa.array(first - w.bound[text], pa.int32())], _COLUMNS)

    return docs.mapInArrow(work, WINDOWS)


def doubled(alive: DataFrame, length: int) -> DataFrame:
    """(h, g, doc_id, pos): windows of twice `length` words whose halves are both in `windows` (h, g, pos, later)."""

    def work(batches):
        for b in batches:
            for i in range(b.num_rows):
                own = b.column("windows")[i].values
                pos = own.field("pos").to_numpy().astype(np.int64)
                order = np.argsort(pos)
                pos, names = pos[order], [own.field(c).to_numpy().view(np.uint64)[order] for c in ("h", "g")]
                half = np.minimum(np.searchsorted(pos, pos + length), max(len(pos) - 1, 0))
                both = np.flatnonzero(pos[half] == pos + length)
                if len(both):
                    names = [words.mix(words.mix(x[both]) * words.BASES[0] + x[half[both]]) for x in names]
                    yield pa.RecordBatch.from_arrays([*(pa.array(x.view(np.int64)) for x in names), pa.array(np.full(len(both), b.column("doc_id")[i].as_py())), pa.array(pos[both], pa.int32())], _COLUMNS)

    return alive.select("doc_id", "windows").mapInArrow(work, WINDOWS)


def survivors(windows: DataFrame, tag: str) -> DataFrame:
    """(doc_id, windows): each document's windows (h, g, pos, later) that another document has too; later: one before it."""
    windows = written(windows, f"{tag}-windows")
    again = written(windows.groupBy("h", "g").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x < y").select("h", "g", "x"), f"{tag}-again")
    both = windows.join(again, ["h", "g"]).select("doc_id", F.struct("h", "g", "pos", (F.col("x") < F.col("doc_id")).alias("later")).alias("w"))
    return written(both.groupBy("doc_id").agg(F.collect_list("w").alias("windows")), f"{tag}-alive")


def copies_only(docs: DataFrame, same: DataFrame) -> DataFrame:
    """The doc_ids of one text that an earlier document has too; what those repeat, the earlier one does."""
    several = docs.groupBy("doc_id").count().where("count > 1").select("doc_id")
    return written(same.where("first < doc_id").select("doc_id").distinct().join(several, "doc_id", "left_anti"), "repeat-passed")


def levels(docs: DataFrame, length: int, passed: DataFrame) -> list[tuple[int, DataFrame]]:
    """(words, survivors) of each level from `length` on, as long as there are any; `passed` doc_ids take no part.

    What is left falls at each level, so that the last ones are small.
    """
    often = written(anchors(docs, length).groupBy("h").agg(F.min("spot").alias("x"), F.max("spot").alias("y")).where("x <> y").select("h"), "repeat-often")
    near = anchors(docs, length).join(often, "h").select("doc_id", "h").join(passed, "doc_id", "left_anti")
    known = written(sets(near, "known"), "repeat-level1")
    out, now = [], survivors(candidates(docs.select("doc_id", "text").join(known, "doc_id"), length), f"repeat-{length}")
    while not now.isEmpty():
        out.append((length, now))
        now = survivors(doubled(now, length), f"repeat-{2 * length}")
        length *= 2
    return out


def sets(df: DataFrame, name: str) -> DataFrame:
    """One sorted list of hashes a document; its size is bounded by the document's length."""
    return df.groupBy("doc_id").agg(F.collect_set("h").alias(name))


def removed(docs: DataFrame, length: int = LENGTH, text_out: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, longest, and on request the kept words as text."""
    if length < 2 or length % 2:
        raise ValueError("the length of a window is even")
    docs = prepared(docs)
    same = written(copies(docs), "repeat-copies")
    found = levels(docs, length, copies_only(docs, same))
    later = [df.select("doc_id", F.filter("windows", lambda w: w["later"]).alias("w")).where("size(w) > 0") for _, df in found]
    known = later[0].select("doc_id", F.transform("w", lambda w: w["h"]).alias("known")) if later else docs.sparkSession.createDataFrame([], "doc_id long, known array<long>")
    reach = docs.sparkSession.createDataFrame([], "doc_id long, longest long")
    for (n, _), df in zip(found, later, strict=True):
        reach = reach.union(df.select("doc_id", F.lit(n).cast("long")))
    reach = reach.groupBy("doc_id").agg(F.max("longest").alias("longest"))
    copy = same.groupBy("doc_id").agg(F.collect_set(F.when(F.col("first") < F.col("doc_id"), F.col("name"))).alias("copy")).where("size(copy) > 0")
    marks = known.join(reach, "doc_id").join(copy, "doc_id", "full_outer")
    marks = written(marks.select("doc_id", "known", "longest", "copy"), "repeat-marks")
    names = "doc_id long, n_words long, n_removed long, kept_sha256 string, longest long" + ", kept string" * text_out

    def work(batches):
        for b in batches:
            data, offs = words.buffers(b.column("text"))
            known, known_offs = words.lists(b.column("known"))
            whole, longest = b.column("copy").to_pylist(), b.column("longest").to_pylist()
            rows = []
            for i, j in words.chunks(offs):
                part = data[offs[i] : offs[j]]
                w = words.Words(part, offs[i : j + 1] - offs[i])
                owner = words.owners(w.bound)
                mine = known_offs[i : j + 1] - known_offs[i]
                gone = np.zeros(len(owner), bool)
                if mine[-1]:
                    at, x = words.windows(w.hashes(), w.bound, length)
                    ok = words.members(x, owner[at], known[known_offs[i] : known_offs[j]], mine)
                    gone = words.covered(len(owner), at[ok], length)
                for k in range(j - i):
                    a, z = w.bound[k], w.bound[k + 1]
                    text = part[w.offs[k] : w.offs[k + 1]].tobytes()
                    level = longest[i + k] or 0
                    if whole[i + k] and z - a >= length and hashlib.sha256(text).digest()[:16] in whole[i + k]:
                        gone[a:z] = True
                        level = length << int((z - a) // length).bit_length() - 1
                    elif not gone[a:z].any():
                        level = 0
                    keep = a + np.flatnonzero(~gone[a:z])
                    kept = b" ".join([part[s:e].tobytes() for s, e in zip(w.start[keep].tolist(), w.end[keep].tolist(), strict=True)]) if len(keep) < z - a else b" ".join(text.split())
                    rows.append((int(z - a), int(z - a - len(keep)), hashlib.sha256(kept).hexdigest(), level, kept))
            n, gone_n, sha, level, kept = zip(*rows, strict=True) if rows else [()] * 5
            ids = pa.array([None if x else y for x, y in zip(b.column("no_id").to_pylist(), b.column("doc_id").to_pylist(), strict=True)], pa.int64())
            cols = [ids, pa.array(n, pa.int64()), pa.array(gone_n, pa.int64()), pa.array(sha, pa.string()), pa.array(level, pa.int64())]
            cols += [pa.array([x.decode() for x in kept], pa.string())] * text_out
            yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in names.split(", ")])

    return docs.join(marks, "doc_id", "left").select("doc_id", "text", "no_id", "known", "longest", "copy").mapInArrow(work, names)


def query(spark, sf_dir: str) -> DataFrame:
    return removed(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def sql(levels: int = 9) -> str:
    """The same rows by all windows, of `levels` lengths from 50 on; for small tables."""
    out = [r"""WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
l0 AS MATERIALIZED (SELECT doc_id, p, md5(array_to_string(ws[p + 1 : p + 50], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - 49)) AS p FROM w WHERE len(ws) >= 50))"""]
    for k in range(levels):
        out.append(f"h{k} AS MATERIALIZED (SELECT doc_id, p FROM l{k} JOIN (SELECT h, min(doc_id) AS x FROM l{k} GROUP BY h) f ON f.h = l{k}.h WHERE x < doc_id)")
        out.append(f"l{k + 1} AS MATERIALIZED (SELECT a.doc_id, a.p, md5(a.h || b.h) AS h FROM l{k} a JOIN l{k} b ON b.doc_id = a.doc_id AND b.p = a.p + {LENGTH << k})")
    reach = " UNION ALL ".join(f"SELECT DISTINCT doc_id, {LENGTH << k} AS n FROM h{k}" for k in range(levels))
    out.append("""i AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) - 1 AS i FROM w),
c AS (SELECT i.doc_id, i.i, x, coalesce(max(h0.p) OVER (PARTITION BY i.doc_id ORDER BY i.i ROWS UNBOUNDED PRECEDING) > i.i - 50, false) AS gone FROM i LEFT JOIN h0 ON h0.doc_id = i.doc_id AND h0.p = i.i),
k AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(x, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept FROM c GROUP BY doc_id)""")
    return ",\n".join(out) + f"""
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256, coalesce(r.n, 0)::BIGINT AS longest
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, max(n) AS n FROM ({reach}) GROUP BY doc_id) r ON r.doc_id = d.doc_id"""


SQL = sql()
