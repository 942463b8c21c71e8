"""Merges that an adjudicator decides: what it is asked, how its answers are read, and what stands where it gives none.

An adjudicator is a function from a prompt to an answer. It sees sources by number or letter only. Prompts and answers
are columns; only the call itself runs in Python workers (`choose.adjudicated`), each for its own rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions.fixed import CHUNK_WORDS, COMMON_WORDS, INTRO_WORDS
from colloquy.functions.text import clean_answer, clean_choice, normalized, shown_reading, words
from colloquy.operators import choose, diffs, ensemble
from colloquy.sources import files

TASK = "Several versions of one speech differ. None is better than the others; judge each difference on its own."
ONLY = "Answer with words that were said, and with nothing else."


def pairwise(sources: DataFrame, keys: list[str], order: str = "source_ord", text: str = "text") -> DataFrame:
    """(keys, i, j, kind, pos, a_text, b_text): differences of each source from each later one of the same passage, without
    punctuation and case; kind 0: of up to five words only in i, 1: only in j, 2: changed. An equality join on the keys."""
    ws = sources.select(*keys, F.col(order).alias("i"), normalized(words(F.col(text))).alias("a"))
    pairs = ws.join(ws.select(*keys, F.col("i").alias("j"), F.col("a").alias("b")), keys).where("i < j")
    found = diffs.positioned(pairs, [*keys, "i", "j"], "a", "b", "a", "b")
    some = lambda when, kind, pos: found.where(when).select(*keys, "i", "j", F.lit(kind).alias("kind"), F.col(pos).alias("pos"), "a_text", "b_text")
    return some("a_len between 1 and 5", 0, "a_pos").union(some("b_len between 1 and 5", 1, "b_pos")).union(some("a_len > 0 and b_len > 0", 2, "a_pos"))


def telling(rows: DataFrame) -> DataFrame:
    """Without differences of common words alone."""
    ws = lambda c: F.array_except(F.split(c, " "), F.array(*[F.lit(w) for w in COMMON_WORDS]))
    one = F.when(F.col("kind") == 0, F.col("a_text")).otherwise(F.col("b_text"))
    return rows.where(F.when(F.col("kind") == 2, (F.size(ws("a_text")) > 0) | (F.size(ws("b_text")) > 0)).otherwise(~one.isin(COMMON_WORDS)))


def listing(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, listing): a passage's differences, numbered, by pair, kind and place, with sources by number from 1 on."""
    name = lambda c: F.concat(F.lit("Source "), (F.col(c) + 1).cast("string"))
    only = lambda c, t: F.concat(name(c), F.lit(' has: "'), F.col(t), F.lit('" (missing in other)'))
    line = F.when(F.col("kind") == 0, only("i", "a_text")).when(F.col("kind") == 1, only("j", "b_text")).otherwise(F.concat(name("i"), F.lit(': "'), "a_text", F.lit('" vs '), name("j"), F.lit(': "'), "b_text", F.lit('"')))
    per = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("i", "j", "kind", "pos", line.alias("line")))).alias("l"))
    shown = F.array_join(F.transform("l", lambda x, k: F.concat((k + 1).cast("string"), F.lit(". "), x["line"])), "\n")
    return per.select(*keys, F.size("l").alias("n"), F.concat(F.lit("IDENTIFIED DIFFERENCES (normalized, no punctuation):\n"), shown, F.lit("\n")).alias("listing"))


def numbered(texts: Column, by: str) -> Column:
    """Source 1, Source 2, ... with their texts."""
    return F.array_join(F.transform(texts, lambda t, i: F.concat(F.lit("Source "), (i + 1).cast("string"), F.lit(by), t)), "\n")


def with_listing(passages: DataFrame, keys: list[str]) -> DataFrame:
    """Add `listing` to passages (keys, texts); empty if no difference tells."""
    rows = passages.select(*keys, F.posexplode("texts").alias("source_ord", "text"))
    return passages.join(listing(telling(pairwise(rows, keys)), keys).drop("n"), keys, "left").withColumn("listing", F.coalesce("listing", F.lit("")))


def passages_of(reply: Column) -> Column:
    """map of number -> text from an answer `PASSAGE n: text`; a later passage of a number wins."""
    parts = F.filter(F.split(reply, r"(?=PASSAGE\s{1,9}[0-9]{1,9}\s{0,9}:)"), lambda x: x.rlike(r"^PASSAGE\s{1,9}[0-9]{1,9}\s{0,9}:"))
    pairs = F.transform(parts, lambda x: F.struct(F.regexp_extract(x, r"^PASSAGE\s{1,9}([0-9]{1,9})", 1).cast("int").alias("n"), F.regexp_replace(F.regexp_replace(x, r"^PASSAGE\s{1,9}[0-9]{1,9}\s{0,9}:", ""), r"^\s+|\s+$", "").alias("t")))
    return F.map_from_entries(F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["n"] == p["n"])))


def flat(sources: DataFrame, key: str, call: Callable[[str], str], size: int = CHUNK_WORDS, **how) -> DataFrame:
    """(key, n_chunks, text): as `ensemble.flat_merge`, each passage as the adjudicator writes it; the plurality's reading
    where it writes nothing."""
    texts = ensemble.flat_passages(sources, key, size).withColumn("texts", F.concat(F.array("own"), F.coalesce("given", F.array().cast("array<string>"))))
    asked = with_listing(texts, [key, "chunk"])
    prompt = F.concat(F.lit(f"{TASK}\n\n"), numbered(F.col("texts"), ":\n"), F.lit("\n\n"), "listing", F.lit(f"\nWrite the most accurate text of this passage. {ONLY}"))
    got = choose.adjudicated(asked.withColumn("prompt", prompt), "prompt", call, **how)
    written = clean_answer(F.col("answer"))
    return ensemble.flat_joined(got.withColumn("chosen", F.when(written != "", written).otherwise(ensemble.keep_anchor(F.col("own"), F.col("given")))), key)


def structured(skeleton: DataFrame, sources: DataFrame, key: str, call: Callable[[str], str], cap: int = CHUNK_WORDS, **how) -> DataFrame:
    """(key, seg_ord, chunk, speaker, stamp, text, n_sources): as `ensemble.structured_merge`, with one question a chunk of
    passages; a passage that the answer lacks keeps the skeleton's words. Speakers and stamps aren't shown."""
    seg = ensemble.structured_passages(skeleton, sources, key, cap).withColumn("texts", F.concat(F.array("own"), F.coalesce("given", F.array().cast("array<string>"))))
    seg = with_listing(seg, [key, "chunk", "seg_ord"])
    per = seg.groupBy(key, "chunk").agg(F.array_sort(F.collect_list(F.struct("seg_ord", "texts", "listing"))).alias("p"))
    head = lambda i, end: F.concat(F.lit("PASSAGE "), (i + 1).cast("string"), F.lit(end))
    shown = F.array_join(F.transform("p", lambda x, i: F.concat(head(i, ":\n"), numbered(x["texts"], ": "))), "\n\n")
    noted = F.array_join(F.filter(F.transform("p", lambda x, i: F.when(x["listing"] != "", F.concat(head(i, " DIFFERENCES:\n"), x["listing"]))), lambda x: x.isNotNull()), "\n")
    prompt = F.concat(F.lit(f"{TASK}\n\n"), shown, F.lit("\n\n"), noted, F.lit("\nWrite the most accurate text of each of the "), F.size("p").cast("string"), F.lit(f" passages, each on a line as PASSAGE n: text. {ONLY}"))
    got = choose.adjudicated(per.select(key, "chunk", "p.seg_ord", prompt.alias("prompt")), "prompt", call, **how)
    said = passages_of(F.coalesce("answer", F.lit("")))
    texts = got.withColumn("said", said).select(key, "chunk", F.posexplode("seg_ord").alias("n", "seg_ord"), "said")
    texts = texts.select(key, "chunk", "seg_ord", F.try_element_at("said", F.col("n") + 1).alias("said"))
    return seg.join(texts, [key, "chunk", "seg_ord"]).select(key, "seg_ord", "chunk", "speaker", "stamp", F.coalesce("said", "own").alias("text"), "n_sources")


def choices_asked(d: Column) -> tuple[Column, Column]:
    """The most choices that any difference of a cluster has, and the letters A, B, ... of as many."""
    n = F.array_max(F.transform(d, lambda x: F.size(x["readings"])))
    letters = F.array(*[F.lit(chr(65 + i)) for i in range(26)])
    return n, F.concat(F.array_join(F.slice(letters, F.lit(1), n - 1), ", "), F.lit(" or "), F.get(letters, n - 1))


def disagreements(d: Column) -> Column:
    """Numbered differences of a cluster with lettered readings, without the words around them."""
    reading = lambda r: F.array_join(F.transform(r, lambda x, j: F.concat(F.get(F.array(*[F.lit(chr(65 + i)) for i in range(26)]), j), F.lit(") "), shown_reading(x["text"]))), "  ")
    return F.array_join(F.transform(d, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), reading(x["readings"]))), "\n")


def resolved(clusters: DataFrame, call: Callable[[str], str], words_col: str = "b", diffs_col: str = "d", **how) -> DataFrame:
    """Add `choices` to clusters: the chosen text of each difference, null where the base stands. One that gets no usable
    answer at all is asked once more without the words around."""
    n, letters = choices_asked(F.col(diffs_col))
    ask = lambda shown: F.concat(F.lit(f"{TASK}\n\n"), shown, F.lit("\n\nAnswer each number with "), letters, F.lit(", as in 1. A"))
    keep = clusters.columns

    def answered(df: DataFrame) -> Column:
        m = diffs.answers(clean_answer(F.coalesce("answer", F.lit(""))))
        pick = lambda x, i: F.when(F.map_contains_key(m, i + 1), diffs.by_letter(x["readings"], clean_choice(F.upper(F.trim(F.coalesce(F.try_element_at(m, i + 1), F.lit("")))))))
        return F.transform(diffs_col, pick)

    some = lambda c: F.exists(c, lambda x: x.isNotNull())
    first = choose.adjudicated(clusters.withColumn("prompt", ask(diffs.prompt(F.col(words_col), F.col(diffs_col)))), "prompt", call, **how)
    first = first.withColumn("choices", answered(first)).withColumn("again", ~some(F.col("choices"))).withColumn("n_choices", n)
    first = first.select(*keep, "n_choices", "choices", F.when(F.col("again"), ask(disagreements(F.col(diffs_col)))).alias("prompt"))
    second = choose.adjudicated(first, "prompt", call, **how)
    return second.select(*keep, "n_choices", F.when(F.col("prompt").isNull(), F.col("choices")).otherwise(answered(second)).alias("choices"))


def ensemble_resolved(texts: DataFrame, key: str, call: Callable[[str], str], model: str = "model", text: str = "text", **how) -> DataFrame:
    """(key, base, n_models, n_diffs, n_clusters, text): as `ensemble.resolve`, with the adjudicator's choices."""
    return ensemble.resolve(texts, key, model, text, resolver=lambda clusters: resolved(clusters, call, **how))


def speaker_names(intros: DataFrame, key: str, call: Callable[[str], str], text: str = "text", about: str = "about", most: int = INTRO_WORDS, **how) -> DataFrame:
    """(key, names): names of speaker labels from the first words of a diarized text and what is known about the
    recording; none where the answer can't be read."""
    first = F.array_join(F.slice(words(F.col(text)), 1, most), " ")
    prompt = F.concat(F.lit("Who are the speakers of this recording?\n"), F.coalesce(about, F.lit("")), F.lit("\n\n"), first, F.lit('\n\nAnswer with JSON: {"LABEL": "Name"}. Leave out whom you do not know.'))
    got = choose.adjudicated(intros.withColumn("prompt", prompt), "prompt", lambda p: attempt(call, p), **how)
    return got.select(key, files.names_answer(F.coalesce("answer", F.lit(""))).alias("names"))


def attempt(call: Callable[[str], str], prompt: str) -> str:
    """The answer, or an empty one where the call fails for good."""
    try:
        return call(prompt)
    except TimeoutError:
        raise  # is tried again
    except Exception:
        return ""


SECTIONS = ("Summary", "Main points", "Quotations")


def summaries(texts: DataFrame, key: str, call: Callable[[str], str], text: str = "text", model: str = "", sections: tuple[str, ...] = SECTIONS, **how) -> DataFrame:
    """(key, page): a summary of each whole text, with a line that names the model; texts that are blank have none."""
    prompt = F.when(F.trim(text) != "", F.concat(F.lit(f"Summarise this text under the headings {', '.join(sections)}.\n\n"), F.col(text)))
    got = choose.adjudicated(texts.withColumn("prompt", prompt), "prompt", call, **how)
    return got.where("answer is not null").select(key, F.concat(F.lit("# Summary\n\n"), clean_answer(F.col("answer")), F.lit(f"\n\n*Summarised by {model}*\n" if model else "\n")).alias("page"))


def reply_text(response) -> str:
    """The text of a client's response: a string, a list of content parts, or choices with messages."""
    get = lambda x, k: x.get(k) if isinstance(x, dict) else getattr(x, k, None)
    if isinstance(response, str):
        return response
    if choices := get(response, "choices"):
        return get(get(choices[0], "message"), "content") or ""
    parts = get(response, "content")
    return parts if isinstance(parts, str) else "".join(get(p, "text") or "" for p in parts or [])


class Client:
    """A call of one back end: `send` takes (model, messages, most tokens) and gives whatever its library does."""

    def __init__(self, send: Callable, model: str, system: str = "", most_tokens: int = 4096):
        self.send, self.model, self.system, self.most_tokens = send, model, system, most_tokens

    def messages(self, prompt: str) -> list[dict]:
        return [*([{"role": "system", "content": self.system}] if self.system else []), {"role": "user", "content": prompt}]

    def __call__(self, prompt: str) -> str:
        return reply_text(self.send(self.model, self.messages(prompt), self.most_tokens)).strip()


def client(backends: dict[str, Callable], name: str, model: str, **how) -> Client:
    """The client of a named back end; an unknown name is an error."""
    if name not in backends:
        raise ValueError(f"unknown back end {name}; there are {', '.join(sorted(backends))}")
    return Client(backends[name], model, **how)
