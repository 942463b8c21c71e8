"""Near and substring duplicates against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from colloquy.llm import bagminhash, components, doubling, parsing, words

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def bag(text, k=5):
    w = WORD.findall((text or "").encode())
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else Counter([tuple(w)] if w else [])


def classes(rows):
    """Class of each doc_id by comparing all pairs that share a shingle."""
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def join(i, j):
        i, j = root(i), root(j)
        parent[max(i, j)] = min(i, j)

    bags, where, same = {}, defaultdict(set), {}
    for i, t in rows:
        join(i, same.setdefault(t or "", i))
    for t, i in same.items():
        bags[t] = bag(t)
        for s in bags[t]:
            where[s].add(t)
    for t, b in bags.items():
        for u in {u for s in b for u in where[s]}:
            common = sum((b & bags[u]).values())
            if 5 * common >= 4 * sum((b | bags[u]).values()):
                join(same[t], same[u])
    return {i: root(i) for i in parent}


def test_near_classes(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r.class_id for r in bagminhash.near_classes(docs).collect()}
    assert got == classes(rows)


def test_near_group_of_many_edits(spark):
    """A dense group, a third of it beyond the threshold from its middle: links are found in blocks, none is lost."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(i % 6):
            w[rng.integers(0, len(w))] = f"e{rng.integers(0, 400)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in bagminhash.near_classes(df).collect()} == classes(rows)


def test_links_are_exact(docs):
    by = {r.doc_id: r.text for r in docs.collect()}
    classes, links = bagminhash.classes_and_links(docs)
    got = links.collect()
    assert got and all(r.common == sum((bag(by[r.a]) & bag(by[r.b])).values()) and r.either == sum((bag(by[r.a]) | bag(by[r.b])).values()) and 5 * r.common >= 4 * r.either for r in got)
    joined = bagminhash.near_classes(docs).where("linked_to is not null").collect()
    assert {r.copy_of for r in joined} == {x for r in got for x in (r.a, r.b)} and all(0.8 <= r.similarity <= 1 for r in joined)


def test_near_odd_rows(odd, empty):
    got = {r.doc_id: r.class_id for r in bagminhash.near_classes(odd).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 4, 5: 5, 6: 6, 7: 1}
    kept = bagminhash.kept(odd).select("doc_id").collect()
    assert sorted(r[0] or 0 for r in kept) == [0, 1, 2, 4, 5, 6]
    assert bagminhash.near_classes(empty).count() == 0 and bagminhash.kept(empty).count() == 0


def test_signatures_are_unbiased():
    rng, errors = np.random.default_rng(0), []
    for trial in range(60):
        a = [f"{trial}_{rng.integers(0, 50)}" for _ in range(150)]
        b = a[: rng.integers(60, 150)] + [f"{trial}_{rng.integers(0, 50)}" for _ in range(40)]
        d, s, c = bagminhash.bags(*words.buffers(pa.array([" ".join(a), " ".join(b)])), 1)
        x, y = bag(" ".join(a), 1), bag(" ".join(b), 1)
        sig = bagminhash.signatures(d, s, c, 2, 1000)
        errors.append((sig[0] == sig[1]).mean() - sum((x & y).values()) / sum((x | y).values()))
    assert abs(np.mean(errors)) < 0.008 and np.std(errors) < 0.03


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 104), (200, 200)]
    got = {r.id: r.comp for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 102: 100, 104: 100}


def windows_removed(rows, length):
    first = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        w = WORD.findall((t or "").encode())
        for k in range(len(w) - length + 1):
            first.setdefault(tuple(w[k : k + length]), i)
    out = []
    for i, t in rows:
        w = WORD.findall((t or "").encode())
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            f = first[tuple(w[k : k + length])]
            if f is not None and (i is None or f < i):
                gone[k : k + length] = [True] * length
        out.append((i or 0, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("length", [50, 8])
def test_doubling(docs, length):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = doubling.removed(docs, length).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == windows_removed(rows, length)


def test_doubling_is_that_of_sql(spark, sf):
    from compare import canon, duck

    assert canon(doubling.query(spark, sf).toPandas()) == canon(duck(sf).sql(doubling.SQL).df())


def test_doubling_goes_on_until_no_window_survives(spark):
    w = [f"w{i}" for i in range(900)]
    rows = [(1, " ".join(w)), (2, " ".join(["x", *w[100:500], "y"])), (3, " ".join(w[:49])), (4, " ".join(w[300:360])), (5, " ".join(w)), (6, "w w " * 40)]
    got = {r.doc_id: (r.n_removed, r.longest) for r in doubling.removed(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (0, 0), 2: (400, 400), 3: (0, 0), 4: (60, 50), 5: (900, 800), 6: (0, 0)}


def test_doubling_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = doubling.removed(odd, 4, text_out=True).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in got) == windows_removed(rows, 4)
    assert doubling.removed(empty).count() == 0


def bytes_removed(rows, length):
    count = Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, t in texts:
        for k in range(len(t) - length + 1):
            count[t[k : k + length]] += 1
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                gone[k : k + length] = b"\x01" * length
        out.append((i or 0, len(t), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(bytes(x for x, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("length", "trigger", "hot"), [(200, 132, 20_000), (200, 132, 2), (24, 16, 20_000), (24, 15, 3)])
def test_parsing(docs, length, trigger, hot):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = parsing.removed(docs, length, trigger, hot).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == bytes_removed(rows, length)


def test_parsing_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = parsing.removed(odd, 10, 7, text_out=True).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == bytes_removed(rows, 10)
    assert parsing.removed(empty).count() == 0


def test_minimizers_are_chosen_alike():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    h[100:120] = h[99]
    got = words.minimizers(h, np.arange(0, 390), 11)
    want = sorted({i + min(range(11), key=lambda k: (int(h[i + k]) >> 32, k)) for i in range(390)})
    assert got.tolist() == want
