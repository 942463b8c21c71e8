"""Adjudicated merges, scoring runs, reports, runs of many files and the command line on small cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from colloquy import __main__ as cli
from colloquy.functions import text
from colloquy.operators import adjudicate, batch, choose, diffs, ensemble, scoring, speakers
from colloquy.plans import catalog
from colloquy.sources import pages, sinks


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_passages(spark):
    reply = "Sure.\nPASSAGE 1: a b\nc\nPASSAGE 2 : x PASSAGE 3:\n\nPASSAGE 1: later  "
    got = frame(spark, [(reply,), ("nothing",), ("",)], "r string").select(adjudicate.passages_of(F.col("r"))).collect()
    assert [r[0] for r in got] == [{1: "later", 2: "x", 3: ""}, {}, {}]


def test_structured_keeps_what_an_answer_lacks(spark):
    skeleton = frame(spark, [(1, 0, "Ann", None, "the cat sat"), (1, 1, "Bob", "0:00:02", "on a mat")], "key int, seg_ord int, speaker string, stamp string, text string")
    other = frame(spark, [(1, 1, "x", "the bat sat on the mat")], "key int, source_ord int, source string, text string")
    got = adjudicate.structured(skeleton, other, "key", lambda p: "PASSAGE 2: on the mat").orderBy("seg_ord").collect()
    assert [(r.speaker, r.text) for r in got] == [("Ann", "the cat sat"), ("Bob", "on the mat")]
    asked = []
    adjudicate.structured(skeleton, other, "key", lambda p: asked.append(p) or "").collect()
    seen = adjudicate.structured(skeleton, other, "key", lambda p: "PASSAGE 1: " + p.replace("PASSAGE", "passage")).orderBy("seg_ord").first().text
    assert "Source 1: the cat sat" in seen and "Ann" not in seen and 'Source 1: "cat" vs Source 2: "bat"' in seen


def test_missing_skeleton_is_an_error(spark):
    sources = frame(spark, [(1, 0, "a", "x"), (2, 0, "b", "y")], "key int, source_ord int, source string, text string")
    own, rest = ensemble.separated(sources.where("key = 1"), "key", "a")
    assert own.count() == 1 and rest.count() == 0
    with pytest.raises(Exception, match="isn't there"):
        ensemble.separated(sources, "key", "a")[0].collect()


def test_letters_and_second_try(spark):
    texts = frame(spark, [(1, "large", "we saw spectral light today"), (1, "medium", "we saw special light today"), (1, "small", "we saw special light today")], "key int, model string, text string")
    say = lambda answer: adjudicate.ensemble_resolved(texts, "key", answer).first()
    assert say(lambda p: "1. A").text == "we saw special light today" and say(lambda p: "1) c.").text == "we saw spectral light today"
    assert say(lambda p: "1. Z").text == "we saw spectral light today" and say(lambda p: "").text == "we saw spectral light today"
    assert say(lambda p: "no" if "we saw" in p else "1. B").text == "we saw special light today"
    assert say(lambda p: "1. C\n1: B").text == "we saw special light today" and say(lambda p: "").n_diffs == 1
    assert ensemble.driven(texts, "key", adjudicate=False).first().text == "we saw spectral light today"


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_prompts_copy_no_text(spark, sf):
    """Differences and clusters are found within a document's row: nothing is shuffled, no text is copied to each difference."""
    assert exchanges(catalog.QUERIES["cluster_prompts"](spark, sf)) == 0
    pairs = frame(spark, [(1, ["a"], ["b"])], "k int, a array<string>, b array<string>")
    assert exchanges(diffs.positioned(pairs, ["k"], "a", "b", "a", "b")) == 0


def test_resolving_shuffles_texts_once(spark):
    """Texts are brought together once; whatever the models, the choice is that of the columns."""
    rows = [(1, "large", "we saw a spectral light"), (1, "small", "we saw no special lamp"), (1, "tiny", "we saw a special lamp there"), (2, "tiny", None), (3, None, "x"), (None, "tiny", "x"), (4, "x", "so so so so so it is"), (4, "y", "so so it was not")]
    texts = frame(spark, rows, "key int, model string, text string")
    got = ensemble.resolve(texts, "key")
    assert exchanges(got) == 1
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ensemble.resolve(texts, "key", choose=lambda r: diffs.plurality(r)).collect()))
    assert {r.key: (r.base, r.n_models, r.text) for r in got.collect()} == {1: ("large", 3, "we saw a spectral light"), 2: ("tiny", 1, ""), 4: ("x", 2, "so so it is")}


@pytest.mark.parametrize("gap, most", [(30, 50), (2, 3)])
def test_differences_within_rows_are_those_of_tables(spark, gap, most):
    r = random.Random(7)
    said = [[r.choice(["Cat", "dog,", "the", "sat.", "mat", "--", "an"]) for _ in range(r.randrange(40))] for _ in range(30)]
    rows = [(k, m, [w for w in ws if r.random() < keep]) for k, ws in enumerate(said) for m, keep in (("x", 0.8), ("y", 0.9), ("base", 1))]
    df = frame(spark, rows, "k int, model string, ws array<string>").withColumn("norm", text.normalized(F.col("ws"))).cache()
    pairs = df.where("model <> 'base'").toDF("k", "model", "a", "an").join(df.where("model = 'base'").select("k", F.col("ws").alias("b"), F.col("norm").alias("bn")), "k")
    found = diffs.positioned(pairs, ["k", "model"], "a", "b", "an", "bn").where(~diffs.is_trivial(F.col("a_text"), F.col("b_text")))
    models = df.select("k", "model", F.when(F.col("model") == "y", 1).otherwise(0).alias("model_ord"))
    table = diffs.clustered(diffs.pivoted(found, ["k"], models, "base"), ["k"], gap, most).withColumn("pick", diffs.plurality(F.col("readings")))
    want = sorted((x.k, x.cluster, x.b_pos, x.b_len, [tuple(y) for y in x.readings], x.pick) for x in table.collect())
    by = {(x.k, x.model): (x.model, x.ws, x.norm) for x in df.collect()}
    assert all([*map(text.Normalised().__getitem__, ws)] == norm for _, ws, norm in by.values())
    got = [(k, n, d["b_pos"], d["b_len"], [(y["model"], y["text"]) for y in d["readings"]], diffs.agreed(d["readings"])) for k in range(30) for n, c in enumerate(diffs.compared(by[k, "base"], [by[k, "x"], by[k, "y"]], gap, most)) for d in c]
    assert got == want and len(got) > 50


def test_names_and_summaries(spark):
    rows = frame(spark, [(1, "SPEAKER_00: hello I am Ann", "a talk"), (2, "  ", None)], "key int, text string, about string")

    def broken(p):
        raise RuntimeError("no")

    assert [r.names for r in adjudicate.speaker_names(rows, "key", lambda p: 'It is {"SPEAKER_00": "Ann"}.').orderBy("key").collect()] == [{"SPEAKER_00": "Ann"}] * 2
    assert adjudicate.speaker_names(rows, "key", broken).first().names == {}
    got = adjudicate.summaries(rows, "key", lambda p: "## Title\nIt was short.", model="m").collect()
    assert [(r.key, r.page) for r in got] == [(1, "# Summary\n\nIt was short.\n\n*Summarised by m*\n")]


def test_clients():
    class Part:
        text = "b"

    assert [adjudicate.reply_text(x) for x in ("a", {"content": [Part(), {"text": "c"}]}, {"choices": [{"message": {"content": "d"}}]}, {"content": None})] == ["a", "bc", "d", ""]
    c = adjudicate.client({"local": lambda model, messages, most: f" {model}:{messages[-1]['content']}:{len(messages)}:{most} "}, "local", "m", system="s", most_tokens=5)
    assert c("hi") == "m:hi:2:5"
    with pytest.raises(ValueError):
        adjudicate.client({}, "x", "m")


def test_offers_of_any_length(spark):
    offer = "\n Sign up for the Big newsletter now\n{}Get it sent to your inbox.\n"
    texts = ["a" + offer.format("") + "b", "a" + offer.format("x\n" * 50_000) + "b" + offer.format("y\n") + "c", "a\n Sign up for the X newsletter\nb", "plain"]
    got = frame(spark, list(enumerate(texts)), "i int, t string").select("i", pages.without_offers(F.col("t")).alias("o")).collect()
    assert [r.o for r in sorted(got)] == ["a\nb", "a\nb\nc", texts[2], "plain"]
    assert frame(spark, [("Sign up for the X newsletter\n" + "line\n" * 50_000,)], "t string").select(F.length(pages.print_text(F.col("t")))).first()[0] > 200_000


def test_report_page(spark):
    rows = [("f1", 600.0, "a", 0.1, None, 0.25, []), ("f2", 1800.0, "a", 0.2, None, None, ["der: no"]), ("f1", 600.0, "b", None, None, None, []), ("f3", 3600.0, "", None, None, None, ["no outputs"])]
    df = frame(spark, rows, "file_id string, duration_secs double, variant string, wer double, cpwer double, der double, errors array<string>")
    page = scoring.report(df).first().page
    assert page.startswith("# Evaluation Results\n\n- **Files scored**: 2 / 3\n- **Total duration**: 1.7 hours\n\n## Comparison\n")
    assert "| a | 15.0% | 17.5% | - | - | 25.0% | 25.0% |" in page and "| f2 | 30:00 | 20.0% | - | - |" in page and "- **f3**: no outputs\n" in page and "- **f2 (a)**: der: no\n" in page
    assert "**Duration-weighted average**: WER=17.5%, cpWER=-, DER=25.0%" in page
    one = scoring.report(df.where("variant = 'a'")).first().page
    assert "Comparison" not in one and "| f1 | 10:00 | 10.0% | - | 25.0% |" in one
    got = {r.variant: json.loads(r.json) for r in scoring.report_json(df).collect()}
    assert got["a"]["num_files"] == 2 and abs(got["a"]["aggregate"]["wer_weighted"] - 0.175) < 1e-12 and got["a"]["per_file"][0]["cpwer"] is None and got["b"]["aggregate"]["wer_macro"] is None
    assert [scoring.duration(F.lit(s)) is not None for s in (1.0,)] and spark.range(1).select(scoring.duration(F.lit(3725.9)), scoring.duration(F.lit(65.0))).first()[:] == ("1:02:05", "1:05")


def test_segments_without_words(spark):
    seg = frame(spark, [(1, 0, 0.0, 4.0, None), (1, 1, 4.0, 8.0, [(4.0, 5.0), (6.0, 7.0), (7.0, 8.0)]), (2, 0, 0.0, 1.0, None)], "rec int, ord long, start double, stop double, words array<struct<start:double,stop:double>>")
    turns = frame(spark, [(1, 0, 0.0, 5.0, "A"), (1, 1, 6.0, 9.0, "B")], "rec int, ord long, start double, stop double, speaker string")
    got = {(r.rec, r.ord): r.speaker for r in speakers.segment_speakers(seg, turns, "rec").collect()}
    assert got == {(1, 0): "A", (1, 1): "B", (2, 0): "UNKNOWN"}


def test_costs(spark):
    c = spark.range(1).select(choose.total_cost(F.lit(6000), F.lit(45), F.lit(3), F.lit(1), F.lit("claude-sonnet-4")).alias("c")).first().c
    assert c.slides == pytest.approx(0.9) and c.ensemble == 0 and c.total == pytest.approx(c.slides + c.merge)


def test_runs_of_many_files(spark):
    def work(f):
        if f == "b":
            raise TimeoutError
        if f == "c":
            raise OSError("disk")
        return 0 if f == "a" else 2

    entries = frame(spark, [(x,) for x in "abcd"], "file_id string")
    done = batch.status(batch.run(entries, work, spread=2))
    assert {r.file_id: r.status for r in done.collect()} == {"a": "success", "b": "timeout", "c": "error", "d": "failed"}
    again = batch.run(entries, lambda f: 0, done)
    assert sorted(r.file_id for r in again.collect()) == ["b", "c", "d"]
    assert {r.status for r in batch.status(again, done).collect()} == {"success"} and batch.status(again, done).count() == 4


def test_interleaved_without_slides(spark):
    seg = frame(spark, [(1, 0.0, 0, None, "One. Two. Three. Four.")], "key int, start double, ord int, speaker string, text string")
    slides = frame(spark, [], "key int, start double, number int, title string, file string")
    assert sinks.interleaved(seg, slides, "key", F.lit("T")).first().page == "# T\n\n---\n\nOne. Two. Three.\n\nFour.\n\n---\n"


def test_command_line(spark, tmp_path, sf):
    src = frame(spark, [(1, 0, "a", "one two"), (1, 1, "b", "one too")], "key int, source_ord int, source string, text string")
    src.write.parquet(str(tmp_path / "s"))
    cli.main(["merge", str(tmp_path / "s"), str(tmp_path / "m")], spark)
    assert spark.read.parquet(str(tmp_path / "m")).first().text == "one two"
    cli.main(["query", "first_entries", sf, str(tmp_path / "q")], spark)
    assert spark.read.parquet(str(tmp_path / "q")).count() == 20
    with pytest.raises(ValueError):
        cli.main(["merge", "x", "y", "--chunk-words", "0"], spark)
    with pytest.raises(SystemExit):
        cli.main(["--version"])
