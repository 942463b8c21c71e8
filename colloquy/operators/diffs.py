"""Differences between witnesses: extraction, filters, pivot, clusters, choices, resolution."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.functions.fixed import CLUSTER_DIFFS, COMMON_WORDS, CONTEXT_WORDS
from colloquy.functions.text import all_common, shown_reading
from colloquy.operators.lcs import blocks


COMMON = frozenset(COMMON_WORDS)


def gaps(a: list, b: list, a_norm: list, b_norm: list):
    """(type, a_text, b_text, a_pos, b_pos, a_len, b_len) of each run that differs, in order."""
    i = j = 0
    for x, y, n in (*blocks(a_norm, b_norm), (len(a), len(b), 0)):
        if x > i or y > j:
            kind = "substitution" if x > i and y > j else "insertion" if x > i else "deletion"
            yield kind, " ".join(a[i:x]), " ".join(b[j:y]), i, j, x - i, y - j
        i, j = x + n, y + n


def trivial(a: str, b: str) -> bool:
    """`is_trivial` of two texts whose words are joined by spaces."""
    return all(w.lower() in COMMON for t in (a, b) for w in t.split(" ") if w)


def compared(base: tuple, others: list[tuple], gap: int = CONTEXT_WORDS, most: int = CLUSTER_DIFFS) -> list[list[dict]]:
    """Clusters of the differences of one recording, as `positioned`, `pivoted` and `clustered` find them, trivial ones left
    out: each a list of {b_pos, b_len, readings} in order. Texts are (model, words, normalised words)."""
    model, b, b_norm = base
    places, mine = {}, []
    for _, a, a_norm in others:
        found = {(b_pos, b_len): (a_text, b_text) for _, a_text, b_text, _, b_pos, _, b_len in gaps(a, b, a_norm, b_norm) if not trivial(a_text, b_text)}
        places.update((k, b_text) for k, (_, b_text) in found.items())
        mine.append(found)
    out, end, n = [], None, 0
    for at in sorted(places):
        own = places[at]
        if end is None or at[0] - end > gap:
            n = 0
        if n % most == 0:
            out.append([])
        n, end = n + 1, sum(at)
        readings = [{"model": m, "text": found[at][0] if at in found else own} for (m, _, _), found in zip(others, mine, strict=True)]
        out[-1].append({"b_pos": at[0], "b_len": at[1], "readings": [*readings, {"model": model, "text": own}]})
    return out


def positioned(pairs: DataFrame, keys: list[str], a: str, b: str, a_norm: str, b_norm: str) -> DataFrame:
    """(keys, type, a_text, b_text, a_pos, b_pos, a_len, b_len): runs that differ, in the original casing.

    A deleted run with an inserted run behind it is a substitution. Runs are cut within a pair's row, so that no text is
    copied to its runs.
    """
    kinds = {"type": "string", "a_text": "string", "b_text": "string", "a_pos": "int", "b_pos": "int", "a_len": "int", "b_len": "int"}
    schema = T.StructType([*(pairs.schema[k] for k in keys), *T._parse_datatype_string(", ".join(f"{k} {v}" for k, v in kinds.items()))])
    texts = [a, b, a_norm, b_norm]

    def work(batches):
        # a table takes the product of two lengths over eight, so a few pairs at a time
        for batch in (x.slice(i, 256) for x in batches for i in range(0, x.num_rows, 256)):
            rows, found = [], []
            for n, row in enumerate(zip(*(batch.column(len(keys) + i).to_pylist() for i in range(4)), strict=True)):
                got = list(gaps(*(ws or [] for ws in row)))
                rows += [n] * len(got)
                found += got
            columns = list(zip(*found, strict=True)) or [[]] * len(kinds)
            own = [batch.column(i).take(pa.array(rows, pa.int32())) for i in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(c, pa.string() if t == "string" else pa.int32()) for c, t in zip(columns, kinds.values(), strict=True))], names=[*keys, *kinds])

    return pairs.select(*keys, *(F.col(c).alias(f"_{i}") for i, c in enumerate(texts))).mapInArrow(work, schema)


def unpositioned(diffs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, type, a_text, b_text): what only a or only b has, of up to five words, and what changed, which counts as all three."""
    only_a = diffs.where("a_len between 1 and 5").select(*keys, F.lit("a_only").alias("type"), "a_text", F.lit(None).cast("string").alias("b_text"))
    only_b = diffs.where("b_len between 1 and 5").select(*keys, F.lit("b_only").alias("type"), F.lit(None).cast("string").alias("a_text"), "b_text")
    changed = diffs.where("a_len > 0 and b_len > 0").select(*keys, F.lit("changed").alias("type"), "a_text", "b_text")
    return changed.union(only_a).union(only_b)


def is_meaningful(kind: Column, a: Column, b: Column) -> Column:
    """A change unless both sides are common words only; else a text unless it is empty or one common word."""
    one = F.lower(F.coalesce(a, b))
    return F.when(kind == "changed", ~(all_common(F.split(a, " ")) & all_common(F.split(b, " ")))).otherwise((one != "") & ~one.isin(COMMON_WORDS))


def is_trivial(a: Column, b: Column) -> Column:
    """Whether both sides have common words only; a side without words has."""
    ws = lambda x: F.filter(F.split(x, r"\s+"), lambda w: w != "")
    return all_common(ws(a)) & all_common(ws(b))


def pivoted(diffs: DataFrame, keys: list[str], models: DataFrame, base: str) -> DataFrame:
    """(keys, b_pos, b_len, b_text, readings): a reading of each model, those without a difference there agreeing with the base, the base last.

    `models` has the keys, model, and model_ord. Equality joins only: a place meets its own recording's models.
    """
    places = diffs.groupBy(*keys, "b_pos", "b_len").agg(F.min("b_text").alias("b_text"))
    grid = places.join(models, keys)
    mine = diffs.groupBy(*keys, "b_pos", "b_len", "model").agg(F.max(F.struct("a_pos", "a_text")).alias("last")).select(*keys, "b_pos", "b_len", "model", F.col("last.a_text").alias("a_text"))
    both = grid.join(mine, [*keys, "b_pos", "b_len", "model"], "left")
    order = F.when(F.col("model") == base, 1 << 30).otherwise(F.col("model_ord"))
    reading = F.struct(order.alias("ord"), "model", F.coalesce("a_text", "b_text").alias("text"))
    got = both.groupBy(*keys, "b_pos", "b_len", "b_text").agg(F.array_sort(F.collect_list(reading)).alias("r"))
    return got.select(*keys, "b_pos", "b_len", "b_text", F.transform("r", lambda x: F.struct(x["model"].alias("model"), x["text"].alias("text"))).alias("readings"))


def clustered(diffs: DataFrame, keys: list[str], gap: int = CONTEXT_WORDS, most: int = CLUSTER_DIFFS) -> DataFrame:
    """Add `cluster` from 0 on: a new one where the words since the last difference are over `gap` or the cluster is full."""
    w = Window.partitionBy(*keys).orderBy("b_pos", "b_len")
    far = F.when(F.col("b_pos") - F.lag(F.col("b_pos") + F.col("b_len")).over(w) <= gap, 0).otherwise(1)
    rows = diffs.withColumn("_far", far).withColumn("_island", F.sum("_far").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("_part", F.floor((F.row_number().over(Window.partitionBy(*keys, "_island").orderBy("b_pos", "b_len")) - 1) / most))
    return rows.withColumn("cluster", F.dense_rank().over(Window.partitionBy(*keys).orderBy("_island", "_part")) - 1).drop("_far", "_island", "_part")


def plurality(readings: Column) -> Column:
    """The most frequent reading; the base's, which is last, wins ties, then the first in order."""
    texts = F.transform(readings, lambda r: r["text"])
    votes = lambda t: F.size(F.filter(texts, lambda x: x == t))
    ranked = F.transform(texts, lambda t, i: F.struct((-votes(t)).alias("v"), F.when(t == F.element_at(texts, -1), -1).otherwise(i).alias("i"), t.alias("t")))
    return F.array_min(ranked)["t"]


def agreed(readings: list[dict]) -> str:
    """`plurality` of one difference's readings."""
    texts = [r["text"] for r in readings]
    return min((-texts.count(t), -1 if t == texts[-1] else i, t) for i, t in enumerate(texts))[2]


def by_letter(readings: Column, letter: Column) -> Column:
    """The reading that a letter A, B, ... chooses; anything else is the base's."""
    i = F.ascii(F.upper(F.trim(letter))) - 65
    return F.coalesce(F.when(i >= 0, F.get(readings, i)["text"]), F.element_at(readings, -1)["text"])


def answers(reply: Column) -> Column:
    """map of number -> letter from lines `n. X`; a later line for a number wins."""
    lines = F.regexp_extract_all(reply, F.lit(r"(?m)^\s*([0-9]+)[.):]\s*(.*)$"), F.lit(0))
    pairs = F.transform(lines, lambda x: F.struct(F.regexp_extract(x, r"([0-9]+)", 1).cast("int").alias("n"), F.regexp_extract(x, r"[.):]\s*(.*)$", 1).alias("t")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["n"] == p["n"]))
    return F.map_from_entries(last)


def prompt(words: Column, diffs: Column, around: int = CONTEXT_WORDS) -> Column:
    """A cluster's question: words around it with [i] marks at the differences, and lettered readings, no model named.

    `diffs` is an array of struct(b_pos, b_len, readings) in order.
    """
    first, last = F.element_at(diffs, 1), F.element_at(diffs, -1)
    lo, hi = F.greatest(F.lit(0), first["b_pos"] - around), F.least(F.size(words), last["b_pos"] + last["b_len"] + around)
    start = F.struct(lo.alias("at"), F.when(lo > 0, F.lit("... ")).otherwise(F.lit("")).alias("out"), F.lit(0).alias("i"))
    piece = lambda a, z: F.array_join(F.slice(words, a + 1, F.greatest(z - a, F.lit(0))), " ")

    def add(s: Column, d: Column) -> Column:
        gap = piece(s["at"], d["b_pos"])
        i = s["i"] + 1
        out = F.concat(s["out"], F.when(gap != "", F.concat(gap, F.lit(" "))).otherwise(""), F.lit("["), i.cast("string"), F.lit("] "))
        return F.struct(F.greatest(s["at"], d["b_pos"] + d["b_len"]).alias("at"), out.alias("out"), i.alias("i"))

    context = F.aggregate(diffs, start, add, lambda s: F.concat(s["out"], piece(s["at"], hi), F.when(hi < F.size(words), F.lit(" ...")).otherwise("")))
    letters = F.array(*[F.lit(chr(65 + i)) for i in range(26)])
    choice = lambda r: F.array_join(F.transform(r, lambda x, j: F.concat(F.get(letters, j), F.lit(") "), shown_reading(x["text"]))), "  ")
    asked = F.array_join(F.transform(diffs, lambda d, i: F.concat((i + 1).cast("string"), F.lit(". "), choice(d["readings"]))), "\n")
    return F.concat(context, F.lit("\n"), asked)


def resolved(words: Column, diffs: Column) -> Column:
    """Base words with each difference's choice in its place. `diffs`: array of struct(b_pos, b_len, text) in order.

    Null text keeps the base; empty text leaves the words out. A difference that starts before the last one ended is
    passed over, so that no word is said twice.
    """
    piece = lambda a, z: F.slice(words, a + 1, F.greatest(z - a, F.lit(0)))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(s: Column, d: Column) -> Column:
        stop = d["b_pos"] + d["b_len"]
        new = F.when(d["text"].isNull(), piece(d["b_pos"], stop)).otherwise(F.filter(F.split(d["text"], r"\s+"), lambda w: w != ""))
        done = F.struct(stop.cast("int").alias("at"), F.concat(s["out"], piece(s["at"], d["b_pos"]), new).alias("out"))
        return F.when(d["b_pos"] >= s["at"], done).otherwise(s)

    return F.aggregate(diffs, start, add, lambda s: F.array_join(F.concat(s["out"], piece(s["at"], F.size(words))), " "))


def applied(words: list[str], chosen: list[tuple[int, int, str]]) -> str:
    """`resolved` of one recording: (b_pos, b_len, text) in order, no text null."""
    out, at = [], 0
    for b_pos, b_len, text in chosen:
        if b_pos >= at:
            out += words[at:b_pos]
            out += [w for w in text.split(" ") if w]
            at = b_pos + b_len
    return " ".join(out + words[at:])
