"""Tokens, fingerprints, pseudonyms, media, pages, mixing, quality, and the pipeline."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from compare import canon, duck
from pyspark.sql import functions as F

from colloquy.llm import catalog, crf, html, mixing, ogg, orderhash, pieces, pii, words

TEXTS = ["", "a", "  two  spaces ", "\n\n line\nfeed", "é ü ñ 日本語 🎉", "a▁b", "tab\tand\x00nul", "x" * 3000, "word " * 500, " x", "  "]


# --- tokens
def test_encoding_is_that_of_sentencepiece(docs):
    import sentencepiece

    buf = pieces.load(pieces.MODEL)
    ref, coder = sentencepiece.SentencePieceProcessor(model_proto=buf), pieces.Encoder(buf, True, most_units=2000)
    texts = TEXTS + [r.text for r in docs.limit(60).collect()]
    for _ in range(2):
        at, ids, same, back = coder.encode(texts)
        assert [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:])] == ref.encode(texts)
        assert same.all() and back == ref.decode(ref.encode(texts))


def field(number, value):
    if isinstance(value, float):
        import struct

        return bytes([number << 3 | 5]) + struct.pack("<f", value)
    if isinstance(value, int):
        out, key = b"", number << 3
        for v in (key, value):
            while True:
                out += bytes([v & 127 | (128 if v > 127 else 0)])
                v >>= 7
                if not v:
                    break
        return out
    return bytes([number << 3 | 2]) + bytes([len(value)]) + value


def test_unigram_scores_and_byte_fallback():
    """A unigram model written by hand, field by field."""
    import sentencepiece

    made = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    made += [("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("ab", -2.2, 1), ("▁ab", -4.0, 1), ("ba", -3.1, 1), ("▁a", -3.3, 1)]
    buf = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in made)
    buf += field(2, field(3, 1) + field(35, 1)) + field(3, field(3, 1) + field(4, 0) + field(5, 1))
    ref = sentencepiece.SentencePieceProcessor(model_proto=buf)
    texts = ["ab ab", "aab bba", "a\nb", "é ab", "", "abab ba"]
    coder = pieces.Encoder(buf, True)
    at, ids, same, back = coder.encode(texts)
    assert [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:])] == ref.encode(texts) and same.all() and back == texts


@pytest.mark.parametrize("kind", [1, 2])
def test_user_defined_symbols(kind):
    import sentencepiece

    made = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    made += [("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("ab", -1.2, 1), ("▁ab", -1.1, 1), ("<x>", 0.0, 4), ("<x>y", 0.0, 4)]
    buf = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in made)
    buf += field(2, field(3, kind) + field(35, 1)) + field(3, field(3, 1) + field(4, 0) + field(5, 1))
    ref, texts = sentencepiece.SentencePieceProcessor(model_proto=buf), ["ab <x>a", "<x>", "a<x>yab <x", "", "<x><x>y <x> ab"]
    at, ids, same, back = pieces.Encoder(buf, True).encode(texts)
    assert [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:])] == ref.encode(texts) and same.all() and back == texts


def test_parity_is_measured_on_every_whole_text():
    """An unused piece that ends in a space changes sentencepiece's whole texts, but none of their units."""
    import sentencepiece

    made = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    made += [("▁", -9.0, 1), ("a", -9.0, 1), ("b", -9.0, 1), ("c", -9.0, 1), ("a▁", -1.0, 5), ("▁b", -2.0, 1), ("bc", -3.0, 1)]
    buf = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in made)
    buf += field(2, field(3, 2) + field(35, 1)) + field(3, field(3, 1) + field(4, 0) + field(5, 1))
    ref, coder = sentencepiece.SentencePieceProcessor(model_proto=buf), pieces.Encoder(buf, True)
    texts = ["c" * i + "a bc" for i in range(1, 60)] + ["c bc", "", "bc\na"]
    for _ in range(2):
        at, ids, same, back = coder.encode(texts)
        assert coder.by_unit and back == texts
        assert same.tolist() == [ids[i:j].tolist() == x for i, j, x in zip(at[:-1], at[1:], ref.encode(texts))]
        assert same.tolist() == [False] * 59 + [True] * 3


def test_tokens_of_odd_rows(odd, empty):
    got = pieces.digest(odd).collect()
    assert len(got) == 9 and all(r.parity and r.round_trip for r in got)
    back = pieces.decode(pieces.encode(odd.select("doc_id", "text")), out="back").where("coalesce(text, '') <> back")
    assert back.count() == 0 and pieces.digest(empty).count() == 0


# --- fingerprints
def test_fingerprints(spark, docs):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = {r.doc_id: r for r in orderhash.compared(docs).collect()}
    for k, (i, t) in enumerate(rows):
        q = len(t) // 4
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256((t[: len(t) - q] + rows[(k + 1) % len(rows)][1][:q]).encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert np.mean([r.near_edited for r in got.values()]) > 0.2 > np.mean([r.near_next for r in got.values()])
    same = {}
    assert all(same.setdefault(t, got[i].fingerprint) == got[i].fingerprint for i, t in rows)


def plain_fingerprint(text, k=3, buckets=32, chosen=2):
    """The entries of a text's fingerprint, one numbered k-mer after another."""
    import struct
    from collections import Counter, defaultdict

    import xxhash

    signed = lambda x: x - (1 << 64) if x >> 63 else x

    def chain(*values, kind="<q"):
        h = 42
        for v in values:
            h = xxhash.xxh64(v if isinstance(v, bytes) else struct.pack("<i" if isinstance(v, tuple) else "<q", v[0] if isinstance(v, tuple) else v), h).intdigest()
        return signed(h)

    w = [chain(x) for x in re.findall(rb"[^\x20\x09-\x0d]+", text.encode())]
    mers = [chain(*w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [chain(*w)] if w else []
    seen, found = Counter(), defaultdict(list)
    for place, h in enumerate(mers):
        name = (h & (1 << 64) - 1) >> 28
        e = chain(name, (seen[name],)) & (1 << 64) - 1
        seen[name] += 1
        found[(e >> 40) % buckets].append((e & (1 << 30) - 1, place))
    out = []
    for b in range(buckets):
        best = [h for h, _ in sorted(sorted(found[b])[:chosen], key=lambda x: x[1])]
        out.append(chain(*(best + [-1] * (chosen - len(best)))) if best else None)
    return out


def test_fingerprints_are_those_of_plain_code(spark, docs):
    texts = TEXTS + [r.text for r in docs.limit(40).collect()] + ["a b c " * 50, "one two", "one"]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", orderhash.fingerprint(F.col("t")).alias("f")).collect()
    assert all(r.f == plain_fingerprint(texts[r.i]) for r in got)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())[:30]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    show = lambda f: "".join("." * 16 if x is None else f"{x & (1 << 64) - 1:016x}" for x in f)
    like = lambda a, b: 1.0 if not (both := [x == y for x, y in zip(a, b) if x is not None or y is not None]) else sum(both) / len(both)
    for k, r in enumerate(sorted(orderhash.compared(df).collect(), key=lambda r: r.doc_id)):
        t, after = rows[k][1], rows[(k + 1) % len(rows)][1]
        q = len(t) // 4
        own, other, near = plain_fingerprint(t), plain_fingerprint(t[: len(t) - q] + after[:q]), plain_fingerprint(after)
        assert (r.fingerprint, r.edited_fingerprint) == (show(own), show(other)) and abs(r.near_edited - like(own, other)) + abs(r.near_next - like(own, near)) < 1e-9
    with pytest.raises(ValueError):
        orderhash.fingerprint(F.col("t"), buckets=33)


def test_fingerprints_follow_edits_and_order(spark):
    r = random.Random(1)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for kind in range(4):
        w = list(base)
        for _ in range((0, 5, 40, 200)[kind]):
            w[r.randrange(400)] = f"z{r.randrange(9999)}"
        rows.append((kind, " ".join(w)))
    rows.append((4, " ".join(base[200:] + base[:200])))
    rows.append((5, " ".join(sum(([base[i], base[i + 1], base[i + 2]] for i in range(396, -1, -3)), []))))
    df = spark.createDataFrame(rows, "k int, t string").select("k", orderhash.fingerprint(F.col("t")).alias("f"))
    first = df.where("k = 0").select(F.col("f").alias("g"))
    like = {x.k: x.s for x in df.crossJoin(first).select("k", orderhash.likeness(F.col("f"), F.col("g")).alias("s")).collect()}
    assert like[0] == 1 and like[1] > like[2] > like[3] and like[4] < 0.95 and like[5] < like[4]


def test_fingerprints_of_odd_rows(odd, empty, spark):
    got = orderhash.compared(odd).collect()
    assert len(got) == 9
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].fingerprint == by[7][0].fingerprint == by[1][1].fingerprint and by[2][0].near_next == 1 and by[3][0].near_next == 1
    assert orderhash.compared(empty).count() == 0
    assert orderhash.compared(spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")).first().near_next == 1


# --- pseudonyms
def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def replaced(spark, texts, key=pii.PUBLIC_KEY):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.text for r in pii.pseudonymised(df, key).orderBy("i").collect()]


def test_pseudonyms_keep_their_format(spark):
    texts = ["a.b7@mail7.example.com", "+1 (017) 555-7713", "4111111111111111", "4111-1111-1111-1111", "233.254.104.120", "123-45-6789", "DE89370400440532013000", "1999-12-31", "31.12.1999", "12/31/1999", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"']
    forms = [r"[a-z]\.[a-z]\d@[a-z]{4}\d\.[a-z]{7}\.com", r"\+1 \(\d{3}\) \d{3}-\d{4}", r"\d{16}", r"\d{4}(-\d{4}){3}", r"\d{1,3}(\.\d{1,3}){3}", r"\d{3}-\d\d-\d{4}", r"DE\d{20}", r"\d{4}-\d\d-\d\d", r"\d\d\.\d\d\.\d{4}", r"\d\d/\d\d/\d{4}", r'token = "[0-9a-f]{40}"']
    got = replaced(spark, texts)
    assert all(re.fullmatch(f, g) and g != t for f, g, t in zip(forms, got, texts))
    assert luhn(got[2]) and got[3].replace("-", "") == got[2]
    assert int("".join(str(int(c, 36)) for c in got[6][4:] + got[6][:4])) % 97 == 1
    assert replaced(spark, [f"x {t}, y" for t in texts]) == [f"x {g}, y" for g in got]
    assert replaced(spark, texts, key="other") != got


def test_what_is_not_valid_stays(spark):
    texts = ["4111111111111112", "300.1.1.1", "666-12-3456", "123-00-4567", "2021-02-30", "DE89370400440532013001", "version 1.2.3", "", "page 12", "1.2.3.4.5", "12345678901234567890123"]
    assert replaced(spark, texts) == texts


def test_permutations_are_one_to_one(spark):
    df = spark.range(2000).withColumn("d", F.lpad(F.col("id").cast("string"), 4, "0"))
    got = df.select(pii.permuted(F.col("d"), "k", ("0123456789",)).alias("x"), pii.permuted_number(F.col("id"), 40, 50, "k").alias("y"))
    assert got.select("x").distinct().count() == 2000 and sorted(r.y for r in got.select("y").collect()) == list(range(2000))


def test_pseudonyms_of_odd_rows(odd, empty):
    got = {(r.doc_id, r.text) for r in pii.pseudonymised(odd.withColumn("found", F.lit(1)), pii.PUBLIC_KEY, counts=True).where("found = 1").collect()}
    assert got == {(r.doc_id, r.text) for r in odd.collect()}
    assert pii.pseudonymised(empty, pii.PUBLIC_KEY).count() == 0


def test_kinds_are_counted(spark):
    df = spark.createDataFrame([(1, "a@example.com and b@example.org, 4111111111111111, 4111111111111112"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymised(df, "k", counts=True).collect()}
    assert (got[1].n_email, got[1].n_card, got[1].n_secret, got[2].n_email) == (2, 1, 0, 0)


def test_dates_are_one_to_one(spark):
    days = spark.sql("SELECT explode(sequence(date'1990-01-01', date'2009-12-31')) AS d")
    texts = days.selectExpr("explode(array(date_format(d, 'MM/dd/yyyy'), date_format(d, 'dd/MM/yyyy'))) AS text").distinct()
    got = pii.pseudonymised(texts, "k")
    assert got.where(r"text RLIKE '^[0-9]{2}/[0-9]{2}/[0-9]{4}$'").distinct().count() == texts.count()


def test_phones_are_linked(spark):
    got = replaced(spark, ["+15550171234", "+1 555 017 1234", "+1 (555) 017-1234", "0015550171234", "001 555 017 1234", "+33612345678", "06 12 34 56 78"])
    digits = [re.sub(r"\D", "", x) for x in got]
    assert all(x.startswith("1") for x in digits[:3]) and len({x[-10:] for x in (*digits[:3], digits[4])}) == 1 and digits[5][2:] == digits[6][1:] and got[3] == "0015550171234"


def test_more_forms_of_personal_data(spark):
    forms = {
        "+33 1 23 45 67 89": r"\+33 \d( \d\d){4}",
        "+81 3-1234-5678": r"\+81 \d-\d{4}-\d{4}",
        "+61 2 9876 5432": r"\+61 \d \d{4} \d{4}",
        "+44 (0)20 7946 0958": r"\+44 \(0\)\d\d \d{4} \d{4}",
        "0033 1 23 45 67 89": r"0033 \d( \d\d){4}",
        "(555) 123-4567": r"\(\d{3}\) \d{3}-\d{4}",
        "1-800-555-0199": r"1-\d{3}-\d{3}-\d{4}",
        "555.123.4567": r"\d{3}\.\d{3}\.\d{4}",
        "06 12 34 56 78": r"0\d( \d\d){4}",
        "(020) 7946 0958": r"\(0\d\d\) \d{4} \d{4}",
        "030/1234567": r"0\d\d/\d{7}",
        "_john.doe@example.com_": r"_[a-z]{4}\.[a-z]{3}@[a-z]{7}\.com_",
        "...john@example.com": r"\.\.\.[a-z]{4}@[a-z]{7}\.com",
        "3/4/2021": r"\d{1,2}/\d{1,2}/\d{4}",
        "3.4.2021": r"\d{1,2}\.\d{1,2}\.\d{4}",
        "2021-3-4": r"\d{4}-\d{1,2}-\d{1,2}",
        "2021/03/04": r"\d{4}/\d\d/\d\d",
        "31-12-1999": r"\d\d-\d\d-\d{4}",
        '"token": "04dbebab91ab85687d33eeaaf9ac699e1188f962"': r'"token": "[0-9a-f]{40}"',
        r'\"api_key\": \"abcdefgh12345678\"': r'\\"api_key\\": \\"[a-z]{8}\d{8}\\"',
        "secret = eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJ": r"secret = \w{12}\.\w{12}\.\w{8}",
    }
    got = replaced(spark, list(forms))
    assert [(t, g) for (t, f), g in zip(forms.items(), got) if not re.fullmatch(f, g) or g == t] == []
    assert replaced(spark, [f"x {t}, y" for t in forms]) == [f"x {g}, y" for g in got]
    same = replaced(spark, ["(555) 123-4567", "555-123-4567", "+1 555 123 4567", "password = abcdefgh12345678.", "password = abcdefgh12345678"])
    digits = ["".join(re.findall(r"\d", x)) for x in same[:3]]
    assert digits[0] == digits[1] == digits[2][1:] and same[3] == same[4] + "."


def test_what_is_like_more_forms_stays(spark):
    texts = ["32/13/2021", "30.2.2021", "2021-13-1", "1.2.3", "05.30-06.45", "0.1234567", "0612345678", "100 200 3000", "12-34-56", "call (12) 34", "token: short.", "@home", "00 12", "1234-567-890", "3.14159265", "2021-2022"]
    assert replaced(spark, texts) == texts


# --- media
def test_ogg_round_trip():
    r = random.Random(2)
    for n in (0, 1, 575, 576, 577, 48_959, 48_960, 48_961, 200_000):
        payload = ogg.pad(r.randbytes(n))
        media = ogg.mux(payload, b"notes" * (n % 60))
        got = ogg.read(media)
        assert got["payload"] == payload and got["notes"] == b"notes" * (n % 60) and got["times"][-1] == len(payload) / ogg.RATE


def test_ogg_checksum_and_damage():
    def slow(data):
        crc = 0
        for x in data:
            crc ^= x << 24
            for _ in range(8):
                crc = (crc << 1 ^ (0x04C11DB7 if crc & 0x80000000 else 0)) & 0xFFFFFFFF
        return crc

    assert all(ogg.checksum(x) == slow(x) for x in (b"", b"a", b"OggS\x00\xff" * 40))
    media = ogg.mux(ogg.pad(b"x" * 90_000))
    for at in range(0, len(media), 997):
        with pytest.raises(ogg.OggError):
            ogg.read(media[:at] + bytes([media[at] ^ 1]) + media[at + 1 :])
    with pytest.raises(ogg.OggError):
        ogg.read(media[:-10])


def test_ogg_chains_foreign_streams_and_damage():
    a, b = ogg.pad(b"first" * 20_000), ogg.pad(b"second" * 9_000)
    other = ogg.Stream(7)
    other.page(b"whatever", ogg.lacing(8), 0, 2)
    other.packets([b"x" * 255 * 300, b"", b"y" * 510], [300, 301, 302], True)
    chain = ogg.mux(a, b"n") + b"".join(other.pages) + ogg.mux(b)
    found = ogg.demux(chain)
    assert [s["link"] for s in found] == [0, 0, 1, 2, 2] and found[2]["packets"] == [b"whatever", b"x" * 255 * 300, b"", b"y" * 510]
    assert b"".join(found[0]["packets"][1:]) == a and b"".join(found[3]["packets"][1:]) == b
    with pytest.raises(ogg.OggError):
        ogg.read(chain)
    mixed = b"".join(other.pages[:1]) + ogg.mux(a, b"n") + b"".join(other.pages[1:])
    assert ogg.read(mixed)["payload"] == a and ogg.read(mixed)["notes"] == b"n"
    # a page is lost: the packets that lie in others wholly are still there, with their times
    media = ogg.mux(a)
    at = [i for i in range(len(media)) if media[i : i + 4] == b"OggS"]
    hurt = media[: at[3] + 40] + b"\0\0\0" + media[at[3] + 43 :]
    with pytest.raises(ogg.OggError):
        ogg.read(hurt)
    got = ogg.read(b"junk" + hurt, strict=False)
    assert 0 < len(a) - len(got["payload"]) <= 2 * 255 * 255 and got["times"][-1] == len(a) / ogg.RATE
    whole = ogg.demux(media)[0]["packets"]
    assert all(p in set(whole) for s in ogg.demux(hurt, False) if s["serial"] == ogg.AUDIO for p in s["packets"])


def test_media_columns(spark, odd):
    files = ogg.store(odd.select("doc_id", "text"))
    got = ogg.read_media(files).collect()
    text = {r.doc_id: (r.text or "").encode() for r in odd.collect()}
    assert all(r.read.payload == ogg.pad(text[r.doc_id]) and r.read.seconds == len(r.read.payload) / ogg.RATE for r in got)
    cut = files.withColumn("media", F.expr("substring(media, 1, length(media) - 9)"))
    assert ogg.read_media(cut).where("read is not null").count() == 0
    n = ogg.packets(files.where("doc_id = 4"), "doc_id").orderBy("serial", "n").collect()
    assert [(r.serial, r.n) for r in n] == [(ogg.AUDIO, 0), (ogg.AUDIO, 1), (ogg.NOTES, 0), (ogg.NOTES, 1)] and n[1].packet == ogg.pad(b" \t\n ") and n[1].granule == 576


def test_media_of_odd_rows(odd, empty):
    rows = {r.doc_id: r for r in ogg.digest(odd).collect()}
    text = {r.doc_id: (r.text or "").encode() for r in odd.collect()}
    for i, r in rows.items():
        p = ogg.pad(text[i])
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(text[i]), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))
    assert ogg.digest(empty).count() == 0 and ogg.store(odd).where("media is null").count() == 0


# --- pages
def test_pages_of_the_tables(spark, sf):
    import html as entities

    for r in html.query(spark, sf).join(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = [" ".join(entities.unescape(re.sub("</?b>", "", p)).split()) for p in re.split("</?(?:p|br|h1)>", article)]
        assert r.text == " ".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_pages_by_weight_alone():
    long = "Sentence with enough words to count. " * 4
    page = f"<body><div id=menu><a href=/>Home</a></div><div><p>{long}</p><p>Of.</p><p>{long}</p></div><div class='reader-comments'><p>{long}</p></div><form>{long}</form><div id='cookie-notice'>{long}</div><footer>{long}</footer>"
    want = " ".join(f"{long} Of. {long}".split())
    assert html.extract(page) == want
    assert html.extract(f"<ul><li><a href=/>{long}</a></li></ul><p>{long}</p>") == long.strip()
    assert html.extract("<article><h1>A &lt;b&gt;</h1><p>x\n\n y<aside>no</aside></p><section class=comments>no</section></article>") == "A <b> x y"
    assert [html.extract(x) for x in (None, "", "<p>", "plain &amp; simple", "<p>cut <b")] == ["", "", "", "plain & simple", "cut"]


def test_pages_whose_markup_misleads():
    long = "Sentence with enough words to count. " * 4
    text = " ".join(f"{long} {long}".split())
    two = f"<p>{long}</p><p>{long}</p>"
    for wrapper in ("layout has-sidebar", "with-ads", "sidebar-layout"):
        assert html.extract(f'<body><div class="{wrapper}"><article>{two}</article></div><footer>{long}</footer>') == text, wrapper
        assert html.extract(f'<body><div class="{wrapper}">{two}</div>') == text, wrapper
    assert html.extract(f"<article>{two}<p class='notice'>Mind the gap.</p></article>") == f"{text} Mind the gap."
    card = "<article><h3>Also read</h3><p>One small card.</p></article>"
    assert html.extract(f"<body><div>{two * 4}</div>{card}") == " ".join([text] * 4)
    # marks still tell: what lies around a long article, cards of related ones, and what is short after an aside within
    assert html.extract(f"<body><div>Some short words around it.</div><article>{two * 4}</article><div>More of them.</div>") == " ".join([text] * 4)
    assert html.extract(f"<body><article>{two}</article><div class='related-posts'><article><p>{long}</p></article></div>") == text
    assert html.extract(f"<article>{two}<aside><p>a</p><p>b</p><p>c</p><p>d</p></aside><p>The end.</p></article>") == f"{text} The end."
    assert html.extract("<body><div>Words around a short article, more than it has.</div><article><p>A short article of few words.</p></article>") == "A short article of few words."


def plain_extract(page):
    """The same by chains of ancestors: every sum is taken anew over all lines."""
    from html.parser import HTMLParser

    lines, chain, parts = [], [], []

    class P(HTMLParser):
        def flush(self):
            if t := " ".join("".join(x for x, _ in parts).split()):
                lines.append((t, sum(len(x.strip()) for x, a in parts if a), [e for e in chain if e[0] not in html.INLINE]))
            parts.clear()

        def handle_starttag(self, tag, attrs):
            if tag not in html.INLINE:
                self.flush()
            if tag not in html.VOID:
                kind, marked = html.kind_of(tag, "".join(f' {k}="{v}"' for k, v in attrs), any(e[3] for e in chain))
                chain.append((tag, len(elements), kind, marked))
                elements.append(chain[-1])

        def handle_endtag(self, tag):
            if tag not in html.INLINE:
                self.flush()
            chain.pop()

        def handle_data(self, data):
            parts.append((data, any(e[0] == "a" for e in chain)))

    elements = []
    p = P()
    p.feed(page)
    p.close()
    p.flush()
    size = lambda e: sum(len(t) for t, _, c in lines if e in c)
    marked = [e for e in elements if e[3]]
    free = [e for e in marked if not any(x[2] for _, _, c in lines if e in c for x in c[: c.index(e)])]
    main = max(free or marked, key=lambda e: (size(e), -e[1]), default=None)
    for kinds in ((1, 2, 3), (2, 3), (3,), ()):
        called = {e for e in elements if e[2] in kinds}
        called -= {x for _, _, c in lines if main in c for x in c[: c.index(main) + 1]}
        while True:
            bare = lambda top: sum(len(t) for t, _, c in lines if (top is None or top in c) and not called & set(c[0 if top is None else c.index(top) + 1 :]))  # noqa: E731, B023
            new = set()
            for _, _, c in lines:
                e = next((x for x in c if x in called), None)
                if e is None or e[2] == 3 or 2 * sum(a for _, a, d in lines if e in d) > size(e):
                    continue
                inside = main is not None and main in c[: c.index(e)]
                if main is None or inside or not bare(main):
                    wide = size(e) > html.WRAPPER * bare(main if inside else None)
                else:
                    wide = e[2] == 1 and size(e) > html.WRAPPER * max(html.SURGE, bare(None))
                new |= {e} if wide else set()
            if not new:
                break
            new = {e for e in new if html.WRAPPER * size(e) > max(map(size, new))}
            new |= {x for _, _, c in lines for e in new & set(c) for x in c[c.index(e) :] if x in called and x[2] != 3 and size(x) == size(e)}
            called -= new
        aside = [bool(called & set(c)) for _, _, c in lines]
        if not all(aside):
            break
    found = []
    for side in (0, 1):
        own = [k for k, (_, _, c) in enumerate(lines) if any(e[3] for e in c) == bool(side) and not (side and aside[k])]
        w = [0 if not side and (aside[k] or 2 * lines[k][1] > len(lines[k][0])) else len(lines[k][0]) for k in own]
        sums = [sum(w[k : k + html.WINDOW]) for k in range(len(w))]
        at = 0
        while at < len(w):
            stop = at
            while stop < len(w) and sums[stop]:
                stop += 1
            if stop > at:
                found.append((side, [own[k] for k in range(at, stop) if w[k]], max(sums[at:stop]), sum(w) * (html.MARKED if side else 1)))
            at = stop + 1
    whole = sum({side: m for side, _, _, m in found}.values())
    found = [(side, run, high * m / whole) for side, run, high, m in found]
    kept = [r for r in found if r[2] >= html.SURGE] or sorted(found, key=lambda r: -r[2] * (html.MARKED if r[0] else 1))[:1]
    box = lambda k: (lines[k][2][-2] if len(lines[k][2]) > 1 else "top") if lines[k][2] and lines[k][2][-1][0] in html.TEXT_TAGS else None
    boxes = {(side, box(k)) for side, run, _ in kept for k in run}
    out = [k for r in found for k in r[1] if r in kept or box(k) and (r[0], box(k)) in boxes]
    return " ".join(lines[k][0] for k in sorted(out))


def test_pages_against_plain_extraction():
    r = random.Random(5)
    names = ["", "", "", " class='sidebar'", " class='has-sidebar'", " class='sidebar-layout'", " id='comments'", " class='ad'", " class='entry-header'", " role='navigation'"]

    def words(most):
        return " ".join(r.choice(["word", "text", "longer", "of"]) for _ in range(r.randint(1, most)))

    def part(depth):
        if depth == 0 or r.random() < 0.3:
            return r.choice(["<p>{}</p>", "<p>{}</p>", "<h2>{}</h2>", "<div>{}</div>", "<p><a href='/x'>{}</a></p>"]).format(words(r.choice([3, 30, 60])))
        tag = r.choice(["div", "div", "section", "article", "nav", "form", "aside", "footer", "header"])
        return f"<{tag}{r.choice(names)}>" + "".join(part(depth - 1) for _ in range(r.randint(1, 4))) + f"</{tag}>"

    for _ in range(400):
        page = "<html><body>" + "".join(part(3) for _ in range(r.randint(1, 4))) + "</body></html>"
        assert html.extract(page) == plain_extract(page), page


def test_pages_told_by_density():
    long = "Sentence with enough words to count. " * 4
    text = long.strip()
    assert html.extract(f'<div class="layout no-sidebar"><p>{long}</p></div>') == text
    assert html.extract(f'<div id=page class="has-sidebar"><article><p>{long}</p></article></div>') == text
    assert html.extract(f'<article><div class="entry-header"><h1>Title</h1></div><p>{long}</p></article>') == f"Title {text}"
    assert html.extract(f'<div id=page><div class="entry-header"><h1>Title</h1></div><p>{long}</p></div>') == f"Title {text}"
    assert html.extract(f"<form><div><p>{long}</p><p>{long}</p></div></form>") == f"{text} {text}"
    page = f"<div class=content><p>{long}</p><div class=ad><p>{long}</p><p>a</p><p>b</p><p>c</p></div><p>The end.</p></div><footer>{long}</footer>"
    assert html.extract(page) == f"{text} The end."
    assert html.extract(f"<div><p>{long}</p></div><div id=comments>{f'<p>{long}</p>' * 20}</div>") == text
    for odd in ("<div>" * 50_000 + "x", "<div class=ad>" * 5_000 + long, "<b>" * 20_000 + "<p>a b</p>" * 2_000, "</p>" * 50_000, "<" * 100_000, "&" * 100_000):
        html.extract(odd)


def test_pages_of_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "", "a"), (None, "<p>x</p>", None)], "page_id long, html string, text string").withColumn("n", F.lit(1))
    got = html.main_text(df)
    assert got.columns == ["page_id", "html", "n", "text"] and sorted(r.text for r in got.collect()) == ["", "", "x"]
    assert html.main_text(df.where("n = 2")).count() == 0


# --- mixing
def test_mix_is_that_of_sql(spark, sf):
    got = catalog.QUERIES["op9_pareto_mix"](spark, sf).toPandas()
    assert canon(got) == canon(duck(sf).sql(catalog.ORACLES["op9_pareto_mix"]).df())


def test_mix_of_skewed_sources(spark):
    rows = [(i, "w " * (1 + i % 40), "hot" if i % 3 else f"s{i % 9}", 1) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang int")
    sized = mixing.sized_docs(df).select("doc_id", "source", "sk", "size", "propensity")
    sized = sized.withColumn("doc_id", F.col("doc_id").cast("long"))
    got = mixing.decided(sized, mixing.figures(sized)).withColumn("taken", F.col("size") * F.col("n_copies"))
    by = got.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.max(F.col("taken") - 2 * F.col("size")).alias("over")).collect()
    assert all(abs(r.t - r.g) <= 40 and r.over <= 0 for r in by)
    assert abs(sum(r.g for r in by) - 1.5 * sum(len(t.split()) for _, t, _, _ in rows)) < 1e-6


def test_mix_comes_near_its_targets(spark, sf):
    """Sources of a hundred documents within a hundredth, those of ten within half a document."""
    for at, share in ((sf, 1.0), (sf.replace("0.001", "0.01"), 0.01)):
        got = catalog.QUERIES["op9_pareto_mix"](spark, at).groupBy("source")
        got = got.agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.max("size").alias("most"), F.max(F.col("taken") - 2 * F.col("size")).alias("over")).collect()
        assert got and all(r.over <= 0 and abs(r.t - r.g) <= min(share * r.g, r.most / 2) for r in got), got


def test_mix_prefers_by_propensity(spark):
    df = spark.createDataFrame([(i, "w w w", "ab"[i % 2], "en") for i in range(2000)], "doc_id long, text string, source string, lang string")
    got = mixing.mix(df, weights=(1, 1), share=0.5, propensity=F.when(F.col("doc_id") % 4 < 2, 3.0).otherwise(1.0))
    n = {r.k: r["count"] for r in got.groupBy((F.col("doc_id") % 4 < 2).alias("k")).count().collect()}
    assert sum(n.values()) == 1000 and 650 < n[True] < 850


def test_mix_of_odd_rows(odd, empty):
    got = mixing.mix(odd)
    assert got.columns == odd.columns and got.count() > 0
    assert mixing.mix(empty).count() == 0


# --- quality
def brute(scores, table):
    """Marginals by summing over all labellings."""
    from itertools import product

    n, total, good = len(scores), 0.0, np.zeros(len(scores))
    for y in product((0, 1), repeat=n):
        p = np.exp(sum(s for s, k in zip(scores, y) if k) + sum(table[i][j] for i, j in zip(y, y[1:])))
        total += p
        good += p * np.array(y)
    return good / total, np.log(total)


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(3)
    sizes = [1, 5, 2, 7]
    scores, table = rng.normal(size=sum(sizes)), rng.normal(size=(2, 2))
    bound = np.concatenate([[0], np.cumsum(sizes)])
    good, pairs, z = crf.marginals(scores, bound, table)
    want = [brute(scores[i:j], table) for i, j in zip(bound[:-1], bound[1:])]
    assert np.allclose(good, np.concatenate([w[0] for w in want])) and np.isclose(z, sum(w[1] for w in want)) and np.isclose(pairs.sum(), sum(sizes) - len(sizes))


def test_blocks_are_the_whole_chain():
    rng = np.random.default_rng(8)
    bound = np.concatenate([[0], np.cumsum([1, 70, 3, 200, 32, 33])])
    scores, table = rng.normal(size=bound[-1]) * 2, rng.normal(size=(2, 2))
    a, b = crf.marginals(scores, bound, table, 7), crf.marginals(scores, bound, table, 1000)
    assert np.allclose(a[0], b[0]) and np.allclose(a[1], b[1]) and np.isclose(a[2], b[2])


def plain_features(text):
    """The features of each line, one by one, with sizes in bytes."""
    import math
    from collections import Counter

    lines = [x.encode() for x in text.split("\n")]
    ws = [re.findall(rb"[^\x20\x09-\x0d]+", x) for x in lines]
    flat = [w for line in ws for w in line]
    owner = [i for i, line in enumerate(ws) for _ in line]
    tri, same = Counter(zip(flat, flat[1:], flat[2:])), Counter(lines)
    out = []
    for i, (x, line) in enumerate(zip(lines, ws)):
        own = [k for k, o in enumerate(owner) if o == i]
        chars, some = max(len(x), 1), max(len(line), 1)
        share = lambda among: sum(c in among for c in x) / chars  # noqa: E731, B023
        out.append([
            math.log1p(len(x)), math.log1p(len(line)), len(x) / some / 10, share(range(65, 91)), share(range(48, 58)), share(b"#$%&*<>{}[]\\~^_=+@/`"), share(b"!"), share(b"|"),
            sum(k > 0 and flat[k] == flat[k - 1] for k in own) / some, sum(k + 2 < len(flat) and tri[tuple(flat[k : k + 3])] > 1 for k in own) / some, float(same[x] > 1 and len(x) > 0),
            sum(flat.index(flat[k]) == k for k in own) / some, float(x[-1:] in (b".", b"!", b"?")), share(range(128, 256)), share(b".,;:'\"?()-"), float(not line),
        ])
    near = [3, 5, 6, 7, 8, 9, 10, 11]
    return [f + ([out[i - 1][k] if i else 0 for k in near]) + ([out[i + 1][k] if i + 1 < len(out) else 0 for k in near]) + [float(not i), float(i + 1 == len(out))] for i, f in enumerate(out)], [len(x) for x in lines]


def test_scores_against_all_labellings(spark, docs):
    """What the operator gives is what plain features and a sum over all labellings of a text's lines give."""
    sizes = [(i, i % 2, 0) for i in range(200)]
    model = crf.fit(crf.sample(docs, spark.createDataFrame(sizes, "doc_id long, quality int, toxic int")))
    texts = [r.text for r in docs.collect() if r.text is not None and r.text.count("\n") < 9][:40] + ["", "a\n\nb b b b\n", "x | y !\nx | y !", "é"]
    got = crf.scored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)
    for r in got.collect():
        f, size = plain_features(texts[r.doc_id])
        good, _ = brute(((np.array(f) - model.mean) / model.std) @ model.w[:-1] + model.w[-1], model.table)
        mean = (good * (np.array(size) + 1e-9)).sum() / (np.array(size) + 1e-9).sum()
        assert abs(r.score - 1 / (1 + np.exp(-(model.slope * mean + model.shift)))) < 1e-5, texts[r.doc_id]


def test_held_out_accuracy(spark, sf):
    got = catalog.QUERIES["op10_line_crf"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    assert got.count() > 5 and got.where("predicted = quality").count() >= 0.9 * got.count()


def test_quality_of_odd_rows(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = crf.fit(crf.sample(odd, none))
    assert {r.score for r in crf.scored(odd, model).collect()} == {0.5}
    some = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 8)], "doc_id long, quality int, toxic int")
    got = crf.scored(odd, crf.fit(crf.sample(odd, some))).collect()
    assert len(got) == 9 and all(0 <= r.score <= 1 for r in got)
    assert crf.scored(empty, model).count() == 0


def test_lines():
    data, offs = words.buffers(pa.array(["a\nb\n", "", None, "c"]))
    start, end, bound = crf.lines(data, offs)
    assert bound.tolist() == [0, 3, 4, 5, 6] and [(bytes(data[s:e])) for s, e in zip(start, end)] == [b"a", b"b", b"", b"", b"", b"c"]


# --- texts that are hard on stacks and memory
def test_very_long_texts_in_every_operator(spark):
    from colloquy.llm import bagminhash, doubling, parsing

    texts = ["word " * 200_000, "x@" + "a." * 50_000 + "com", "\n".join(f"line {i % 97}" for i in range(50_000)), "token=" + "x" * 70_000, "+1 " * 30_000, "0" * 100_000, "secret: " + "a.b" * 20_000, None, ""]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).cache()
    n = len(texts)
    assert pieces.digest(df).where("parity and round_trip").count() == n
    assert bagminhash.near_classes(df).count() == n
    got = {r.doc_id: r for r in doubling.removed(df).collect()}
    assert len(got) == n and got[0].n_words == 200_000 and got[0].n_removed == 0
    assert orderhash.compared(df).count() == n
    safe = {r.doc_id: r.text for r in pii.pseudonymised(df, "k").collect()}
    assert safe[0] == texts[0] and len(safe[3]) == len(texts[3]) and safe[3] != texts[3]
    assert ogg.digest(df).where("payload_bytes >= n_bytes").count() == n
    got = {r.doc_id: r for r in parsing.removed(df).collect()}
    assert got[0].n_removed == got[0].n_bytes == 1_000_000 and got[5].n_removed == 100_000
    assert html.main_text(df.withColumnRenamed("text", "html")).count() == n
    assert mixing.mix(df).count() >= 0
    some = spark.createDataFrame([(i, i % 2, 0) for i in range(n)], "doc_id long, quality int, toxic int")
    assert crf.scored(df, crf.fit(crf.sample(df, some))).where("score between 0 and 1").count() == n
    df.unpersist()


# --- pipeline
def test_pipeline(spark, sf, tmp_path):
    """Each stage, and all of them, against what plain code makes of the same rows."""
    import corpus_pipeline as p
    from test_dedup import classes

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in p.STAGES] == ["quality", "near_duplicates", "personal_data", "mix", "tokens"]
    stage = dict(p.STAGES)
    rows = lambda df: sorted(tuple(r) for r in df.collect())

    model = crf.fit(crf.sample(docs, spark.read.parquet(f"{sf}/labels.parquet")))
    good = stage["quality"](spark, docs, sf)
    keep = [r for r in docs.collect() if model.score(*words.buffers(pa.array([r.text or ""])))[0] >= crf.THRESHOLD]
    assert good.columns == docs.columns and rows(good) == sorted(tuple(r) for r in keep)

    one = stage["near_duplicates"](spark, good, sf)
    of = classes([(r.doc_id, r.text) for r in keep])
    keep = [r for r in keep if of[r.doc_id] == r.doc_id]
    assert one.columns == docs.columns and rows(one) == sorted(tuple(r) for r in keep)

    safe = stage["personal_data"](spark, one, sf)
    got = {r.doc_id: r for r in safe.collect()}
    assert safe.columns == docs.columns and set(got) == {r.doc_id for r in keep}
    for r in keep:
        assert got[r.doc_id].n_chars == len(got[r.doc_id].text) and not set(re.findall(r"[\w.]+@[\w.]+\w", r.text)) & set(re.findall(r"[\w.]+@[\w.]+\w", got[r.doc_id].text))
        if not re.search(r"[0-9@=]", r.text):
            assert got[r.doc_id].text == r.text

    mixed = stage["mix"](spark, safe, sf)
    safe.write.parquet(str(tmp_path / "documents.parquet"))
    con = duck(sf)
    con.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    plain = mixing.SQL.replace("CASE WHEN size < 20 THEN 0.25::DOUBLE WHEN size < 100 THEN 0.5 ELSE 1.0 END", "1.0::DOUBLE")
    want = con.sql(f"SELECT doc_id, n_copies FROM ({plain}) WHERE n_copies > 0").fetchall()
    assert mixed.columns == docs.columns and sorted((r.doc_id, r["count"]) for r in mixed.groupBy("doc_id").count().collect()) == sorted(want)

    tokens = stage["tokens"](spark, mixed, sf)
    import sentencepiece

    ref = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    ids = {i: ref.encode(r.text) for i, r in got.items()}
    assert all(r.ids == ids[r.doc_id] and r.parity and r.round_trip for r in tokens.collect())
    assert sorted((r.doc_id, r.ids_sha256) for r in p.run(spark, sf).collect()) == sorted((r.doc_id, r.ids_sha256) for r in tokens.collect())


def test_pipeline_of_odd_rows(spark, odd, empty, sf):
    import corpus_pipeline as p

    for docs in (odd, empty):
        columns, n = docs.columns, docs.count()
        for name, stage in p.STAGES:
            docs = stage(spark, docs, sf)
            assert name == "tokens" or docs.columns == columns, name
        assert (docs.count() > 0) == (n > 0)
