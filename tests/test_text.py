"""Small cases of text operators."""

import pytest
from pyspark.sql import functions as F

from colloquy.functions import text
from colloquy.operators import checkpoints, choose, chunks, diffs, loops, structure
from colloquy.sources import files, pages


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(("raw", "want"), [("don't stop", "dont stop"), ("a --- b", "a _ b"), ("café résumé naïve", "café résumé naïve"), ("", ""), (None, ""), ("  A B ", "a b")])
def test_normalized(spark, raw, want):
    assert one(spark, raw, lambda x: text.joined(text.normalized(text.words(x)))) == want


def test_loops():
    assert [x["count"] for x in loops.collapsed("hello hello hello hello")[0]] == [4]
    found, out = loops.collapsed("x " + "It is not. " * 63 + "y")
    assert [(f["phrase"], f["count"]) for f in found] == [("It is not.", 63)] and out == "x It is not. It is not. y"
    assert loops.collapsed("a  a a b") == ([], "a  a a b")
    slow = lambda ws: next(((i, n) for i in range(len(ws)) for n in range(1, min(10, (len(ws) - i) // 4) + 1) if all(ws[i + k * n : i + k * n + n] == ws[i : i + n] for k in range(4))), None)
    import random

    r = random.Random(2)
    for _ in range(300):
        ws = [r.choice("ab") for _ in range(r.randrange(30))]
        got = loops.find(ws)
        assert (got[0][:2] if got else None) == slow(ws)


def test_captions(spark):
    raw = "WEBVTT\nKind: captions\n\n00:00:01.000 --> 00:00:02.000\nhi <c>there</c>\n\n00:00:02.000 --> 00:00:03.000\nhi there\nnext"
    assert one(spark, raw, files.caption_text) == "hi there next"


@pytest.mark.parametrize(("raw", "want"), [("Ann Bee [(0:01:02)](u)\nhi\nBob Cee (0:02:03)\nyo", "lex"), ("[0:00:01] Ann Bee: hi\n[0:00:02] Bob Cee: yo", "bracketed"), ("Ann: hi\nBob: yo", "speaker_only"), ("plain\ntext", None), ("Ann: hi\nplain", None), ("", None)])
def test_form(spark, raw, want):
    assert one(spark, raw, structure.form) == want


def test_segments(spark):
    df = spark.createDataFrame([(1, "before\nAnn Bee (0:01:02)\n one\n\ntwo\nBob Cee (0:02:03) start")], "id int, t string")
    got = [tuple(r) for r in structure.segments(df, "id", "t").select("seg_ord", "speaker", "stamp", "text").orderBy("seg_ord").collect()]
    assert got == [(1, "Ann Bee", "0:01:02", "one\n two"), (2, "Bob Cee", "0:02:03", "start")]


def test_pages():
    assert pages.page_text("<html><script>x</script><p>A &amp; B</p><nav>no</nav><div>C<br>D</div></html>") == "A & B\n\nC\nD"
    assert pages.page_text(None) == ""
    assert pages.interview('<p>no</p><section name="articleBody"><p><strong>Ask?</strong></p><p>An <b>s</b>wer</p></section>') == [{"text": "Ask?", "bold": True}, {"text": "An swer", "bold": False}]


def test_choices(spark):
    assert one(spark, 'Model B: "x y" | Model C: "z"', text.clean_choice) == "x y"
    assert one(spark, "Decision: yes", text.clean_choice) == "yes"
    assert one(spark, "1. A\n2) B\n1: C", lambda x: diffs.answers(x)) == {1: "C", 2: "B"}
    readings = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(t).alias("text")) for m, t in (("a", "x"), ("b", "y"), ("base", "y"))])
    assert one(spark, "", lambda x: diffs.plurality(readings)) == "y"
    assert one(spark, "Q", lambda x: diffs.by_letter(readings, x)) == "y"


def test_resolved(spark):
    words = F.array(*[F.lit(w) for w in "the quick brown fox".split()])
    d = lambda *xs: F.array(*[F.struct(F.lit(p).alias("b_pos"), F.lit(n).alias("b_len"), F.lit(t).cast("string").alias("text")) for p, n, t in xs])
    for diff, want in [([(2, 1, "red")], "the quick red fox"), ([(2, 1, "")], "the quick fox"), ([(2, 1, None)], "the quick brown fox"), ([(2, 0, "big")], "the quick big brown fox"), ([(1, 2, "slow"), (2, 2, "x")], "the slow fox")]:
        assert one(spark, "", lambda x, diff=diff: diffs.resolved(words, d(*diff))) == want


def test_positioned(spark):
    df = spark.createDataFrame([(1, "the quick red fox".split(), "the Quick brown fox jumps".split())], "id int, a array<string>, b array<string>")
    df = df.withColumn("an", text.normalized(F.col("a"))).withColumn("bn", text.normalized(F.col("b")))
    got = sorted(tuple(r) for r in diffs.positioned(df, ["id"], "a", "b", "an", "bn").collect())
    assert got == [(1, "deletion", "", "jumps", 4, 4, 0, 1), (1, "substitution", "red", "brown", 2, 2, 1, 1)]


def test_times_and_numbers(spark):
    assert one(spark, "", lambda x: text.hms(F.lit(3725.9))) == "1:02:05"
    assert one(spark, "1:02:05", text.seconds_of) == 3725 and one(spark, "2:05", text.seconds_of) == 125 and one(spark, "x", text.seconds_of) is None
    assert one(spark, "Hello, World! It's", text.slug) == "hello-world-its"
    assert one(spark, "claude-haiku-3-5", lambda x: choose.price(x)["output"]) == 0.004


def test_greedy(spark):
    sizes = lambda *n: F.array(*[F.lit(k) for k in n])
    assert one(spark, "", lambda x: chunks.greedy(sizes(3, 3, 9, 0, 1), 5)) == [0, 1, 2, 3, 3]


def test_resumed(spark, tmp_path):
    calls = []
    rows = spark.createDataFrame([(str(i), i) for i in range(4)], "key string, n int")

    def compute(df):
        calls.append(df.count())
        return df.withColumn("n", F.col("n") * 2)

    path = str(tmp_path / "kept")
    checkpoints.resumed(rows.where("n < 2"), path, compute)
    assert sorted(r.n for r in checkpoints.resumed(rows, path, compute).collect()) == [0, 2, 4, 6] and calls == [2, 2]


def test_retry():
    seen, waits = [], []

    def call(p):
        seen.append(p)
        if len(seen) < 3:
            raise TimeoutError
        return "ok"

    assert choose.retried(call, "q", sleep=waits.append) == "ok" and waits == [5.0, 10.0]
    with pytest.raises(ValueError):
        choose.retried(lambda p: (_ for _ in ()).throw(ValueError()), "q", sleep=waits.append)


def test_readers(spark, tmp_path):
    (tmp_path / "whisper_small.txt").write_text("hello")
    (tmp_path / "whisper_merged.txt").write_text("no")
    (tmp_path / "s.json").write_text('{"segments": [{"start": 1.0, "end": 2, "text": " a "}, {"text": "  "}, {"text": "b", "words": [{"word": "b"}]}]}')
    (tmp_path / "turns.json").write_text('[{"start": 0, "end": 1.23456, "speaker": "A"}]')
    (tmp_path / "manifest.json").write_text('{"version": 1, "entries": [{"file_id": "x", "duration_secs": 600, "subset_tags": ["all"]}, {"file_id": "y", "duration_secs": 3600, "subset_tags": ["all"]}]}')
    assert [r.model for r in files.speech_texts(spark, f"{tmp_path}/*.txt").collect()] == ["small"]
    assert [(r.ord, r.start, r.text, len(r.words)) for r in files.speech_segments(spark, f"{tmp_path}/s.json").collect()] == [(0, 1.0, "a", 0), (2, 0.0, "b", 1)]
    assert [(r.stop, r.speaker) for r in files.speaker_turns(spark, f"{tmp_path}/turns.json").collect()] == [(1.235, "A")]
    entries = files.manifest(spark, f"{tmp_path}/manifest.json")
    assert [r.file_id for r in files.filtered(entries, subset="all", max_hours=1.0).collect()] == ["x"]
    import numpy as np

    np.save(tmp_path / "a.npy", np.ones((2, 3), "f4"))
    assert [(r.shape, len(r["values"])) for r in files.tensors(spark, f"{tmp_path}/a.npy").collect()] == [([2, 3], 6)]


def test_streamed_turns(spark, sf, tmp_path):
    from colloquy.streaming import turns

    spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    q = turns.turn_sessions(stream, "user_id", "event_type", "ts", "6 hours").writeStream.outputMode("append").format("memory").queryName("turns").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r.user_id, r.event_type, r.start, r.words) for r in spark.table("turns").collect()}
    whole = {(r.user_id, r.event_type, r.start, r.words) for r in turns.turn_sessions(spark.read.parquet(str(tmp_path / "in")), "user_id", "event_type", "ts", "6 hours").collect()}
    assert got and got <= whole
