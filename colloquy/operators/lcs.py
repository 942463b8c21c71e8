"""Alignment of two word lists by longest common subsequence.

The table is built row by row with whole-row integer arithmetic (one bit a word of A), after common ends are cut off, so
a row costs a few machine operations for every 30 words. Rows of pairs are worked on alone; memory is bounded by the
product of the two lengths over eight.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

OPS = "array<struct<kind string, a_lo int, a_hi int, b_lo int, b_hi int>>"


def ends(a: list, b: list) -> tuple[int, int]:
    """Lengths of the common start and of the common end behind it."""
    n, i, j = min(len(a), len(b)), 0, 0
    while i < n and a[i] == b[i]:
        i += 1
    while j < n - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return i, j


def rows(a: list, b: list):
    """For each word of b, the bits of a at which the common subsequence doesn't grow."""
    at: dict = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for w in b:
        u = s & at.get(w, 0)
        s = ((s + u) | (s - u)) & full
        yield s


def common(a: list, b: list) -> int:
    """Length of the longest common subsequence."""
    head, tail = ends(a, b)
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    last = None
    if a:
        for last in rows(a, b):
            pass
    return head + tail + (len(a) - last.bit_count() if last is not None else 0)


def blocks(a: list, b: list) -> list[tuple[int, int, int]]:
    """(place in a, place in b, length) of the runs of words that a longest common subsequence meets, in order."""
    head, tail = ends(a, b)
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    at, bit = {}, 1
    for w in x:
        bit <<= 1  # the lowest bit stands for no word, and always counts
        at[w] = at.get(w, 0) | bit
    s = full = 2 * bit - 2
    table = [s]
    for m in map(at.get, y):
        if m and (u := s & m):
            s = ((s + u) | (s ^ u)) & full
        table.append(s)
    found, i, j, n, below, last = [], len(x), len(y), 0, None, None
    back = reversed(table)
    s = next(back)
    for t in back:
        j -= 1
        while s >> i & 1:
            i -= 1  # a's word i doesn't count among the first of b
        if t >> i & 1:  # it doesn't count without b's word j
            if i == below and j == last - 1:
                n += 1
            else:
                if n:
                    found.append((below + head, last + head, n))
                n = 1
            i -= 1
            below, last = i, j
        s = t
    if n:
        found.append((below + head, last + head, n))
    found.reverse()
    return [(0, 0, head)] * (head > 0) + found + [(len(a) - tail, len(b) - tail, tail)] * (tail > 0)


def matches(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs of positions of a longest common subsequence, in order."""
    return [(i + k, j + k) for i, j, n in blocks(a, b) for k in range(n)]


def opcodes(a: list, b: list) -> list[tuple[str, int, int, int, int]]:
    """Runs: common, deleted (in a only), inserted (in b only); a deleted run comes before an inserted one."""
    out, i, j, start = [], 0, 0, None
    for x, y in [*matches(a, b), (len(a), len(b))]:
        if (x > i or y > j or x == len(a) and y == len(b)) and start is not None:
            out.append(("common", *start[:1], i, *start[1:], j))
            start = None
        if x > i:
            out.append(("deleted", i, x, j, j))
        if y > j:
            out.append(("inserted", x, x, j, y))
        if x < len(a) and y < len(b) and start is None:
            start = (x, y)
        i, j = x + 1, y + 1
    return out


def position_map(a: list, b: list) -> list[int]:
    """For each word of a its place in b; a word that isn't there gets the place reached so far; last the length of b."""
    out, cursor, found = [], 0, dict(matches(a, b))
    for i in range(len(a)):
        if i in found:
            out.append(found[i])
            cursor = found[i] + 1
        else:
            out.append(cursor)
    return [*out, len(b)]


def edits(a: list, b: list) -> tuple[int, int, int]:
    """Fewest (substitutions, deletions, insertions) that make a of b; b is the reference. Among equals, fewest insertions."""
    head, tail = ends(a, b)
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    import numpy as np

    number = {w: i for i, w in enumerate({*a, *b})}
    x = np.array([number[w] for w in a], np.int64)
    base = 1 << 20
    # cost * base**2 + insertions * base + deletions, so that a minimum settles ties
    ins, dele, sub = base * base + base, base * base + 1, base * base
    steps = np.arange(len(a) + 1, dtype=object) * ins if len(a) >= 1 << 20 else np.arange(len(a) + 1, dtype=np.int64) * ins
    row = steps
    for w in b:
        diagonal = row[:-1] + np.where(x == number[w], 0, sub)
        best = np.concatenate([[row[0] + dele], np.minimum(diagonal, row[1:] + dele)])
        row = np.minimum.accumulate(best - steps) + steps
    cost = int(row[-1])
    total, i, d = cost // base**2, cost // base % base, cost % base
    return total - i - d, d, i


def with_lcs(pairs: DataFrame, a: str, b: str, **outs: str) -> DataFrame:
    """Add columns for two columns of words: common (count), ops (runs), places (position map), edits (S, D, I)."""
    kinds = {
        "common": (T.IntegerType(), common),
        "ops": (T._parse_datatype_string(OPS), lambda x, y: [dict(zip(("kind", "a_lo", "a_hi", "b_lo", "b_hi"), o, strict=True)) for o in opcodes(x, y)]),
        "places": (T.ArrayType(T.IntegerType()), position_map),
        "edits": (T._parse_datatype_string("struct<s int, d int, i int>"), lambda x, y: dict(zip("sdi", edits(x, y), strict=True))),
    }
    arrow = {
        "common": pa.int32(),
        "ops": pa.list_(pa.struct([("kind", pa.string()), *((k, pa.int32()) for k in ("a_lo", "a_hi", "b_lo", "b_hi"))])),
        "places": pa.list_(pa.int32()),
        "edits": pa.struct([(k, pa.int32()) for k in "sdi"]),
    }
    schema = T.StructType([*pairs.schema.fields, *(T.StructField(name, kinds[what][0]) for what, name in outs.items())])

    def work(batches):
        # a table takes the product of two lengths over eight, so a few pairs at a time
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            left, right = batch.column(a).to_pylist(), batch.column(b).to_pylist()
            for what, name in outs.items():
                f = kinds[what][1]
                batch = batch.append_column(name, pa.array([f(x or [], y or []) for x, y in zip(left, right, strict=True)], arrow[what]))
            yield batch

    return pairs.mapInArrow(work, schema)
