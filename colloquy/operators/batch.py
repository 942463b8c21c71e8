"""Runs of many files: each file's work is one row's, with its outcome, and files that are done aren't run again."""

from __future__ import annotations

import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.operators import checkpoints
from colloquy.sources import sinks

RUNS = "file_id string, at timestamp, code int, message string, seconds double"


def outcome(work: Callable[[str], int], file_id: str) -> tuple[int | None, str | None]:
    """(code, message) of one file's work: no code if it ran out of time, a message if it broke."""
    try:
        return int(work(file_id)), None
    except TimeoutError:
        return None, None
    except Exception as e:
        return None, f"{type(e).__name__}: {e}"


def run(entries: DataFrame, work: Callable[[str], int], done: DataFrame | None = None, spread: int = 0) -> DataFrame:
    """(file_id, at, code, message, seconds) of entries (file_id) that aren't among the successes of `done` (file_id,
    status). `work` runs in the Python workers, a file at a time; `spread` deals files to as many tasks."""
    todo = entries.select(F.col("file_id").cast("string").alias("file_id"))
    if done is not None:
        todo = checkpoints.missing(todo, done.where("status = 'success'").select(F.col("file_id").cast("string").alias("file_id")), "file_id")

    def rows(batches):
        for b in batches:
            out = []
            for f in b.column(0).to_pylist():
                began = time.time()
                code, message = outcome(work, f)
                out.append((f, int(time.time() * 1e6), code, message, time.time() - began))
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = (pa.string(), pa.timestamp("us", tz="UTC"), pa.int32(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], [x.split()[0] for x in RUNS.split(", ")])

    return (todo.repartition(spread, "file_id") if spread else todo).mapInArrow(rows, RUNS)


def status(runs: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(file_id, status, json): each file's last run, those of an earlier table (file_id, status, json) kept where there is
    no later one."""
    now = sinks.run_status(runs.select("file_id", "at", "code", "message"))
    if before is None:
        return now
    return now.unionByName(before.select("file_id", "status", "json").join(now.select("file_id"), "file_id", "left_anti"))
