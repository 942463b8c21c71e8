"""Several witnesses of one speech to one text: ensembles of speech models, flat and structured merges."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from colloquy.functions.fixed import CHUNK_WORDS, MODEL_ORDER
from colloquy.functions.text import Normalised, normalized, words
from colloquy.operators import chunks, diffs, lcs
from colloquy.operators.loops import collapsed


def model_rank(model: Column) -> Column:
    """struct(place in the fixed order, name): models that aren't in it come last, by name."""
    order = F.array(*[F.lit(m) for m in MODEL_ORDER])
    return F.struct(F.coalesce(F.nullif(F.array_position(order, model), F.lit(0).cast("long")), F.lit(1 << 20).cast("long")).alias("r"), model.alias("m"))


def base_model(models: Column) -> Column:
    """The best of an array of models by the fixed order; models that aren't in it come last, by name."""
    return F.array_min(F.transform(models, model_rank))["m"]


def ranked(texts: list[dict]) -> list[tuple[str, str | None]]:
    """(model, text) of a recording from best to worst, as `model_rank` has it."""
    place = {m: i for i, m in enumerate(MODEL_ORDER)}
    return sorted(((t["model"], t["text"]) for t in texts if t["model"] is not None), key=lambda t: (place.get(t[0], len(place)), t[0], t[1] or ""))


def per_recording(texts: DataFrame, key: str, schema: str, result) -> DataFrame:
    """(key, schema): result(normalise, texts) of each row's `texts`, an array of struct(model, text); rows for which it is
    None are left out. A recording is worked on within its row, so that no text is copied to its differences."""
    kinds = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(kinds)

    def work(batches):
        normalise = Normalised().__getitem__
        # a table takes the product of two lengths over eight, so a few recordings at a time
        for b in (x.slice(i, 128) for x in batches for i in range(0, x.num_rows, 128)):
            got = [(i, r) for i, t in enumerate(b.column(1).to_pylist()) if (r := result(normalise, t or [])) is not None]
            own = b.column(0).take(pa.array([i for i, _ in got], pa.int32()))
            yield pa.RecordBatch.from_arrays([own, *(pa.array([r[k] for _, r in got], f.type) for k, f in enumerate(arrow))], names=[key, *arrow.names])

    return texts.select(key, "texts").mapInArrow(work, T.StructType([texts.schema[key], *kinds]))


CLUSTERS = "clusters array<array<struct<b_pos int, b_len int, readings array<struct<model string, text string>>>>>"


def found(normalise, texts: list[dict]) -> tuple | None:
    """(base, n_models, b, clusters) of one recording's texts; None without a model."""
    named = ranked(texts)
    if not named:
        return None
    ws = [(m, w := collapsed(t or "")[1].split(), [*map(normalise, w)]) for m, t in named]
    return named[0][0], len(texts), ws[0][1], diffs.compared(ws[0], ws[1:])


def chosen(normalise, texts: list[dict]) -> tuple | None:
    """(base, n_models, n_diffs, n_clusters, text) of one recording's texts by plurality; None without a model."""
    if not (got := found(normalise, texts)):
        return None
    base, n_models, b, clusters = got
    sets = [(d["b_pos"], d["b_len"], diffs.agreed(d["readings"])) for c in clusters for d in c]
    return base, n_models, len(sets), len(clusters), diffs.applied(b, sets)


def gathered(texts: DataFrame, key: str, model: str = "model", text: str = "text") -> DataFrame:
    """(key, texts): a row for each recording, with an array of struct(model, text)."""
    return texts.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_list(F.struct(F.col(model).alias("model"), F.col(text).alias("text"))).alias("texts"))


def differences(texts: DataFrame, key: str, model: str = "model", text: str = "text") -> DataFrame:
    """(key, base, n_models, b: the base's words, clusters): where models differ from the base, loops collapsed and trivial
    differences left out; a cluster is an array of struct(b_pos, b_len, readings) in order."""
    return per_recording(gathered(texts, key, model, text), key, f"base string, n_models bigint, b array<string>, {CLUSTERS}", found)


def clusters(differing: DataFrame, key: str) -> DataFrame:
    """(key, cluster, d, b): clusters of `differences`, d an array of struct(b_pos, b_len, readings) in order, with the base's words."""
    return differing.select(key, F.posexplode("clusters").alias("cluster", "d"), "b")


def resolve(texts: DataFrame, key: str, model: str = "model", text: str = "text", choose=diffs.plurality, resolver=None) -> DataFrame:
    """(key, base, n_models, n_diffs, n_clusters, text): loops collapsed, differences of each model from the best one
    found, trivial ones left out, pivoted, clustered, chosen by `choose`, and applied to the base. A `resolver` instead
    adds `choices` to clusters (key, cluster, b, d), with d an array of struct(b_pos, b_len, readings)."""
    if choose is diffs.plurality and not resolver:
        return per_recording(gathered(texts, key, model, text), key, "base string, n_models bigint, n_diffs bigint, n_clusters bigint, text string", chosen)
    found = differences(texts, key, model, text)
    choices = (resolver or (lambda c: c.withColumn("choices", F.transform("d", lambda x: choose(x["readings"])))))(clusters(found, key))
    sets = choices.select(key, "cluster", F.explode(F.arrays_zip("d", "choices")).alias("z")).select(key, "cluster", "z.d.b_pos", "z.d.b_len", F.col("z.choices").alias("text"))
    per = sets.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("b_pos", "b_len", "text"))).alias("d"), F.countDistinct("cluster").alias("n_clusters"), F.count("*").alias("n_diffs"))
    got = found.join(per, key, "left")
    none = F.array().cast("array<struct<b_pos:int,b_len:int,text:string>>")
    return got.select(key, "base", "n_models", F.coalesce("n_diffs", F.lit(0)).alias("n_diffs"), F.coalesce("n_clusters", F.lit(0)).alias("n_clusters"), diffs.resolved(F.col("b"), F.coalesce("d", none)).alias("text"))


def aligned(sources: DataFrame, key: str) -> DataFrame:
    """(key, anchor, others): the first source's words, and the place map and words of each other source, in order."""
    ws = sources.select(key, "source_ord", "source", words(F.col("text")).alias("ws"))
    first = ws.groupBy(key).agg(F.min_by("ws", "source_ord").alias("anchor"), F.min("source_ord").alias("first"))
    rest = ws.join(first, key).where("source_ord > first").withColumn("an", normalized(F.col("anchor"))).withColumn("bn", normalized(F.col("ws")))
    rest = lcs.with_lcs(rest, "an", "bn", places="places")
    others = rest.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("source_ord", "source", "places", "ws"))).alias("others"))
    return first.select(key, "anchor").join(others, key, "left")


def keep_anchor(anchor: Column, others: Column) -> Column:
    """The default choice for a passage: the reading most sources agree on, the anchor's among equals."""
    return diffs.plurality(F.concat(F.transform(F.coalesce(others, F.array().cast("array<string>")), lambda t: F.struct(F.lit("x").alias("model"), t.alias("text"))), F.array(F.struct(F.lit("").alias("model"), anchor.alias("text")))))


def flat_passages(sources: DataFrame, key: str, size: int = CHUNK_WORDS) -> DataFrame:
    """(key, chunk, own, given): the first source's words by chunks, and the others' at the same places; one row with
    null chunk for a recording without words. All is cut within the recording's row, so that no text is copied."""
    df = aligned(sources, key)
    n = F.size("anchor")
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))

    def cut(a: Column) -> Column:
        z = F.least(a + size, n)
        return F.struct(F.array_join(F.slice("anchor", a + 1, z - a), " ").alias("own"), F.transform("others", lambda o: chunks.aligned_slice(o["ws"], o["places"], a, z)).alias("given"))

    return df.select(key, F.posexplode_outer(F.transform(starts, cut)).alias("chunk", "p")).select(key, "chunk", "p.own", "p.given")


def flat_joined(passages: DataFrame, key: str) -> DataFrame:
    """(key, n_chunks, text): chosen passages in order, with blank lines between."""
    some = F.when(F.col("chunk").isNotNull(), F.struct("chunk", "chosen"))
    return passages.groupBy(key).agg(F.count("chunk").alias("n_chunks"), F.array_join(F.transform(F.array_sort(F.collect_list(some)), lambda x: x["chosen"]), "\n\n").alias("text"))


def flat_merge(sources: DataFrame, key: str, size: int = CHUNK_WORDS, choose=keep_anchor) -> DataFrame:
    """(key, n_chunks, text): the first source cut into chunks, each with the others' words at the same places, chosen, and joined by blank lines."""
    return flat_joined(flat_passages(sources, key, size).withColumn("chosen", choose(F.col("own"), F.col("given"))), key)


def structured_passages(skeleton: DataFrame, sources: DataFrame, key: str, cap: int = CHUNK_WORDS) -> DataFrame:
    """(key, seg_ord, chunk, speaker, stamp, own, given, n_sources): segments of the skeleton with the other sources' words
    at the same places; chunks are filled greedily up to `cap` words. Cut within the recording's row."""
    seg = skeleton.select(key, "seg_ord", "speaker", "stamp", words(F.col("text")).alias("ws")).withColumn("n", F.size("ws"))
    start = F.coalesce(F.sum("n").over(Window.partitionBy(key).orderBy("seg_ord").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int")
    seg = seg.withColumn("start", start)
    whole = seg.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("seg_ord", "speaker", "stamp", "ws", "n", "start"))).alias("s")).withColumn("chunks", chunks.greedy(F.col("s.n"), cap))
    anchor = whole.select(key, F.lit(0).alias("source_ord"), F.lit("skeleton").alias("source"), F.array_join(F.transform("s", lambda x: F.array_join(x["ws"], " ")), " ").alias("text"))
    both = aligned(anchor.unionByName(sources.select(key, (F.col("source_ord") + 1).alias("source_ord"), "source", "text")), key)

    def cut(x: Column, chunk: Column) -> Column:
        given = F.transform("others", lambda o: chunks.aligned_slice(o["ws"], o["places"], x["start"], x["start"] + x["n"]))
        return F.struct(x["seg_ord"].alias("seg_ord"), chunk.alias("chunk"), x["speaker"].alias("speaker"), x["stamp"].alias("stamp"), F.array_join(x["ws"], " ").alias("own"), given.alias("given"))

    rows = whole.join(both.select(key, "others"), key).select(key, F.explode(F.zip_with("s", "chunks", cut)).alias("p"), (F.coalesce(F.size("others"), F.lit(0)) + 1).alias("n_sources"))
    return rows.select(key, "p.*", "n_sources")


def separated(sources: DataFrame, key: str, skeleton: str) -> tuple[DataFrame, DataFrame]:
    """The source of that name and the others, in order; a recording without it is an error when its rows are read."""
    found = sources.withColumn("_has", F.max(F.col("source") == skeleton).over(Window.partitionBy(key)))
    found = found.withColumn("_ok", F.when(F.col("_has"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"source {skeleton} isn't there for "), F.col(key).cast("string"))).cast("boolean")))
    found = found.where("_ok").drop("_has", "_ok")
    return found.where(F.col("source") == skeleton), found.where(F.col("source") != skeleton)


def structured_merge(skeleton: DataFrame, sources: DataFrame, key: str, cap: int = CHUNK_WORDS, choose=keep_anchor) -> DataFrame:
    """(key, seg_ord, chunk, speaker, stamp, text, n_sources): segments of the skeleton with the other sources' words at
    the same places, chosen; chunks are filled greedily up to `cap` words."""
    seg = structured_passages(skeleton, sources, key, cap)
    return seg.select(key, "seg_ord", "chunk", "speaker", "stamp", choose(F.col("own"), F.col("given")).alias("text"), "n_sources")


def driven(texts: DataFrame, key: str, adjudicate: bool = True, resolver=None) -> DataFrame:
    """(key, base, n_models, text): the route a recording's models take: no text for less than two, the base's own
    without an adjudicator, else the resolved one."""
    by = texts.groupBy(key).agg(base_model(F.collect_set("model")).alias("base"), F.count("*").alias("n_models"))
    own = texts.join(by, key).where("model = base").select(key, "base", "n_models", F.col("text").alias("own"))
    if not adjudicate:
        return own.select(key, "base", "n_models", F.when(F.col("n_models") > 1, F.col("own")).alias("text"))
    got = resolve(texts.join(by.where("n_models > 1").select(key), key, "left_semi"), key, resolver=resolver).select(key, "text")
    return own.join(got, key, "left").select(key, "base", "n_models", "text")


def rendering(segments: DataFrame, key: str) -> DataFrame:
    """(key, text): segments as paragraphs under **Speaker** (stamp) lines, a blank line after each."""
    head = F.concat(F.lit("**"), "speaker", F.lit("**"), F.coalesce(F.concat(F.lit(" ("), "stamp", F.lit(")")), F.lit("")))
    one = F.concat(head, F.lit("\n\n"), "text", F.lit("\n"))
    return segments.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg_ord", one.alias("t")))), lambda x: x["t"]), "\n").alias("text"))
