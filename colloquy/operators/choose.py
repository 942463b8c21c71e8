"""Choosing: hypotheses, texts, prices, and adjudicators that may answer over a network."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.functions import fixed

# Which text is taken for the best, by use; which hypothesis is scored.
BEST = {"markdown": ("merged", "speech"), "summary": ("diarized", "merged", "speech", "captions")}
HYPOTHESES = {"merged": ("structured_merged", "plain_merged"), "diarized": ("diarized",), "auto": ("diarized", "structured_merged", "plain_merged", "speech_merged", "speech_medium", "speech_small"), "speech": ("speech_merged", "speech_medium", "speech_small")}
RETRIED, WAIT, TRIES = (429, 500, 502, 503, 529), 5.0, 5


def first_text(*texts: Column) -> Column:
    """The first text that isn't blank."""
    return F.coalesce(*[F.when(F.trim(t) != "", t) for t in texts])


def first_kind(kinds: list[str], has: Callable[[str], Column]) -> Column:
    """The first kind that is there; null if none is."""
    return F.coalesce(*[F.when(has(k), F.lit(k)) for k in kinds])


def price(model: Column) -> Column:
    """struct(input, output): price of 1,000 tokens by the start of the model's name, the first that fits, else the default."""
    pair = lambda a, b: F.struct(F.lit(a).alias("input"), F.lit(b).alias("output"))
    out = pair(*fixed.DEFAULT_PRICE)
    for start, a, b in reversed(fixed.PRICES):
        out = F.when(model.startswith(start), pair(a, b)).otherwise(out)
    return out


def cost(words: Column, sources: Column, model: Column, chunk: int = fixed.CHUNK_WORDS) -> Column:
    """What `sources` texts of `words` words cost to merge chunk by chunk."""
    n = F.greatest(F.lit(1), F.floor(words / chunk) + 1)
    tokens = lambda each: F.floor(each * n * fixed.TOKENS_PER_WORD)
    p = price(model)
    return tokens(F.floor(words * sources / n) + 500) * p["input"] / 1000 + tokens(F.floor(words / n)) * p["output"] / 1000


def total_cost(words: Column, slides: Column, sources: Column, models: Column, model: Column, chunk: int = fixed.CHUNK_WORDS) -> Column:
    """struct(slides, merge, ensemble, total): what a run costs; null slides or sources are left out, as are ensembles of
    less than two models."""
    parts = [F.coalesce(image_cost(slides), F.lit(0.0)), F.coalesce(cost(words, sources, model, chunk), F.lit(0.0)), F.when(models > 1, cost(words, models, model, chunk)).otherwise(F.lit(0.0))]
    return F.struct(*[p.alias(n) for p, n in zip(parts, ("slides", "merge", "ensemble"), strict=True)], (parts[0] + parts[1] + parts[2]).alias("total"))


def hypothesis(kind: str, has: Callable[[str], Column], merged: Column | None = None) -> Column:
    """The text kind that is scored: the first of HYPOTHESES that is there; a merged text counts as structured if its lines
    have speakers and stamps."""
    shaped = F.coalesce(F.regexp_like(merged, F.lit(r"(?m)^\*\*.+?\*\*\s*\([0-9]+:[0-9]{2}:[0-9]{2}\)")), F.lit(False)) if merged is not None else F.lit(False)
    there = lambda k: has("merged") & shaped if k == "structured_merged" else has("merged") & ~shaped if k == "plain_merged" else has(k)
    return first_kind(list(HYPOTHESES[kind]), there)


def image_cost(slides: Column) -> Column:
    return slides * fixed.IMAGE_PRICE


def retried(call: Callable[[str], str], prompt: str, tries: int = TRIES, wait: float = WAIT, sleep: Callable[[float], None] = time.sleep) -> str:
    """The call's answer; timeouts and busy servers are tried again after a wait that doubles, at most `tries` times."""
    for k in range(tries):
        try:
            return call(prompt)
        except Exception as e:
            code = getattr(e, "status_code", None)
            if k == tries - 1 or not (isinstance(e, TimeoutError) or code in RETRIED):
                raise
        sleep(wait * 2**k)
    raise ValueError("tries must be positive")


def adjudicated(prompts: DataFrame, prompt: str, call: Callable[[str], str], out: str = "answer", tries: int = TRIES, wait: float = WAIT) -> DataFrame:
    """Add the answers of `call`, which each Python worker runs for its own rows."""
    schema = T.StructType([*prompts.schema.fields, T.StructField(out, T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.append_column(out, pa.array([None if p is None else retried(call, p, tries, wait) for p in b.column(prompt).to_pylist()], pa.string()))

    return prompts.mapInArrow(work, schema)
