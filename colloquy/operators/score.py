"""Scores of texts: word error rate, cpWER, diarization error rate, survival. Recordings are worked on alone."""

from __future__ import annotations

from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.operators import lcs

COLLAR = 0.25


def survival(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Add words_a, words_b, common, and their shares in whole per cent; a side without words has null."""
    got = lcs.with_lcs(pairs, a, b, common="common").withColumn("words_a", F.size(a)).withColumn("words_b", F.size(b))
    share = lambda n: F.when(F.col(n) > 0, F.floor(100 * F.col("common") / F.greatest(F.col(n), F.lit(1))).cast("int"))
    return got.withColumn("pct_a", share("words_a")).withColumn("pct_b", share("words_b"))


def word_errors(pairs: DataFrame, hyp: str, ref: str) -> DataFrame:
    """Add errors, ref_words, and wer, which is null without reference words."""
    got = lcs.with_lcs(pairs, hyp, ref, edits="_e").withColumn("errors", F.col("_e.s") + F.col("_e.d") + F.col("_e.i")).withColumn("ref_words", F.size(ref))
    return got.withColumn("wer", F.try_divide("errors", "ref_words")).drop("_e")


def assignment(cost: list[list[float]]) -> tuple[float, list[int]]:
    """The cheapest one-to-one choice of a column for each row of a square table: Hungarian method with potentials."""
    n = len(cost)
    u, v, owner = [0.0] * (n + 1), [0.0] * (n + 1), [0] * (n + 1)
    for i in range(1, n + 1):
        owner[0], j = i, 0
        least, before, done = [float("inf")] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        while owner[j]:
            done[j] = True
            row, delta, nxt = owner[j], float("inf"), 0
            for k in range(1, n + 1):
                if not done[k]:
                    c = cost[row - 1][k - 1] - u[row] - v[k]
                    if c < least[k]:
                        least[k], before[k] = c, j
                    if least[k] < delta:
                        delta, nxt = least[k], k
            for k in range(n + 1):
                if done[k]:
                    u[owner[k]] += delta
                    v[k] -= delta
                else:
                    least[k] -= delta
            j = nxt
        while j:
            owner[j] = owner[before[j]]
            j = before[j]
    chosen = [0] * n
    for k in range(1, n + 1):
        chosen[owner[k] - 1] = k - 1
    return sum(cost[i][chosen[i]] for i in range(n)), chosen


def cp_errors(ref: list[list[str]], hyp: list[list[str]]) -> int:
    """Fewest word errors over all matchings of speakers; one without a partner counts in full."""
    n = max(len(ref), len(hyp))
    ref, hyp = ref + [[]] * (n - len(ref)), hyp + [[]] * (n - len(hyp))
    return int(assignment([[float(sum(lcs.edits(h, r))) for h in hyp] for r in ref])[0]) if n else 0


def cp_errors_by_force(ref: list[list[str]], hyp: list[list[str]]) -> int:
    n = max(len(ref), len(hyp))
    ref, hyp = ref + [[]] * (n - len(ref)), hyp + [[]] * (n - len(hyp))
    return min(sum(sum(lcs.edits(hyp[k], r)) for k, r in zip(p, ref, strict=True)) for p in permutations(range(n)))


def cp_word_errors(df: DataFrame, ref: str, hyp: str) -> DataFrame:
    """Add cp_errors, ref_words and cpwer for columns of one list of words a speaker (array<array<string>>)."""

    def work(batches):
        for b in batches:
            rows = list(zip(b.column(ref).to_pylist(), b.column(hyp).to_pylist(), strict=True))
            yield b.append_column("cp_errors", pa.array([cp_errors(r or [], h or []) for r, h in rows], pa.int64())).append_column("ref_words", pa.array([sum(map(len, r or [])) for r, _ in rows], pa.int64()))

    schema = T.StructType([*df.schema.fields, T.StructField("cp_errors", T.LongType()), T.StructField("ref_words", T.LongType())])
    return df.mapInArrow(work, schema).withColumn("cpwer", F.try_divide("cp_errors", "ref_words"))


def der_parts(ref: list[tuple], hyp: list[tuple], collar: float = COLLAR) -> tuple[float, float, float, float]:
    """(reference time, missed, false alarm, confusion) in seconds of segments (start, stop, speaker).

    Time within `collar` of a reference border isn't scored. The line is swept once over all borders; speakers are
    matched so that most time agrees.
    """
    marks = []
    for start, stop, who in ref:
        marks += [(start, 1, 0, who), (stop, -1, 0, who)]
        if collar:
            for t in (start, stop):
                marks += [(t - collar, 1, 2, None), (t + collar, -1, 2, None)]
    for start, stop, who in hyp:
        marks += [(start, 1, 1, who), (stop, -1, 1, who)]
    marks.sort(key=lambda m: m[0])
    on, closed, last = ({}, {}), 0, None
    total = missed = false = both = 0.0
    agree: dict = {}
    for t, step, side, who in marks:
        if last is not None and t > last and not closed:
            r, h = [k for k, n in on[0].items() if n > 0], [k for k, n in on[1].items() if n > 0]
            d = t - last
            total += d * len(r)
            missed += d * max(0, len(r) - len(h))
            false += d * max(0, len(h) - len(r))
            both += d * min(len(r), len(h))
            for x in r:
                for y in h:
                    agree[x, y] = agree.get((x, y), 0.0) + d
        if side == 2:
            closed += step
        else:
            on[side][who] = on[side].get(who, 0) + step
        last = t
    rs, hs = sorted({x for x, _ in agree}), sorted({y for _, y in agree})
    n = max(len(rs), len(hs))
    best = -assignment([[-agree.get((rs[i], hs[j]), 0.0) if i < len(rs) and j < len(hs) else 0.0 for j in range(n)] for i in range(n)])[0] if n else 0.0
    return total, missed, false, both - best


def diarization_errors(df: DataFrame, ref: str, hyp: str, collar: float = COLLAR) -> DataFrame:
    """Add scored, missed, false_alarm, confusion and der for columns of array<struct<start,stop,speaker>>."""
    names = ("scored", "missed", "false_alarm", "confusion")

    def work(batches):
        for b in batches:
            plain = lambda c: [[(s["start"], s["stop"], s["speaker"]) for s in x or []] for x in b.column(c).to_pylist()]  # noqa: E731, B023
            got = [der_parts(r, h, collar) for r, h in zip(plain(ref), plain(hyp), strict=True)]
            for i, name in enumerate(names):
                b = b.append_column(name, pa.array([g[i] for g in got], pa.float64()))
            yield b

    schema = T.StructType([*df.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])
    return df.mapInArrow(work, schema).withColumn("der", F.try_divide(F.col("missed") + F.col("false_alarm") + F.col("confusion"), F.col("scored")))


def weighted(value: Column, weight: Column) -> Column:
    """Average of values with weights; rows without a value count in neither sum; null without weight."""
    return F.try_divide(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def per_variant(rows: DataFrame, variant: str, file: str, weight: str, metrics: list[str]) -> DataFrame:
    """One row a file and variant, and one a variant: averages, weighted averages, counts of files and of scored files."""
    v = rows.withColumn(variant, F.coalesce(variant, F.lit("")))
    sums = [F.avg(m).alias(f"avg_{m}") for m in metrics] + [weighted(F.col(m), F.col(weight)).alias(f"weighted_{m}") for m in metrics]
    scored = F.countDistinct(F.when(F.coalesce(*metrics).isNotNull(), F.col(file)))
    return v.groupingSets([[variant, file], [variant]], variant, file).agg(*sums, F.countDistinct(F.col(file)).alias("files"), scored.alias("scored"), F.grouping(file).alias("footer"))
