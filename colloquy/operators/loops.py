"""Repetition loops that speech models fall into: a phrase of up to ten words four times or more in a row."""

from __future__ import annotations

from itertools import islice
from operator import eq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

PHRASE, TIMES, KEPT = 10, 4, 2
LOOPS = "array<struct<phrase string, count int, start_pos int, end_pos int>>"


def find(ws: list[str], longest: int = PHRASE, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(first word, phrase length, count) of each loop from the left; the shortest phrase wins."""
    # where each word agrees with the one `size` words later, and the first place from which that goes on long enough
    agree, first = {}, {}
    for size in range(1, min(longest, len(ws) // times) + 1):
        marks = bytes(map(eq, ws, islice(ws, size, None)))
        if (at := marks.find(b"\1" * (size * (times - 1)))) >= 0:
            agree[size], first[size] = marks, at
    found = []
    while first:
        i, size = min((at, size) for size, at in first.items())
        stop = agree[size].find(b"\0", i)
        count = ((stop if stop >= 0 else len(agree[size])) - i) // size + 1
        found.append((i, size, count))
        for k, at in [*first.items()]:
            if at < i + size * count:
                first[k] = agree[k].find(b"\1" * (k * (times - 1)), i + size * count)
                if first[k] < 0:
                    del first[k]
    return found


def collapsed(text: str) -> tuple[list[dict], str]:
    """The loops of a text with their places in its words joined by spaces, and the text with each loop said twice."""
    ws = text.split()
    found = find(ws)
    if not found:
        return [], text
    at = [0]
    for w in ws:
        at.append(at[-1] + len(w) + 1)
    loops, out, i = [], [], 0
    for first, size, count in found:
        stop = first + size * count
        loops.append({"phrase": " ".join(ws[first : first + size]), "count": count, "start_pos": at[first], "end_pos": at[stop] - 1})
        out += ws[i : first + KEPT * size]
        i = stop
    return loops, " ".join(out + ws[i:])


def with_loops(texts: DataFrame, text: str, loops: str = "loops", out: str = "collapsed") -> DataFrame:
    """Add the loops, by place, and the collapsed text; null text has none and stays null."""
    schema = T.StructType([*texts.schema.fields, T.StructField(loops, T._parse_datatype_string(LOOPS)), T.StructField(out, T.StringType())])
    kind = pa.list_(pa.struct([("phrase", pa.string()), *((k, pa.int32()) for k in ("count", "start_pos", "end_pos"))]))

    def work(batches):
        for b in batches:
            got = [collapsed(x) if x is not None else ([], None) for x in b.column(text).to_pylist()]
            yield b.append_column(loops, pa.array([x for x, _ in got], kind)).append_column(out, pa.array([x for _, x in got], pa.string()))

    return texts.mapInArrow(work, schema)
