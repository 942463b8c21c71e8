import random

import pytest

from colloquy.operators import lcs, score


def table(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def distance(a, b):
    t = list(range(len(a) + 1))
    for y in b:
        p, t = t, [t[0] + 1]
        for i, x in enumerate(a):
            t.append(min(p[i] + (x != y), p[i + 1] + 1, t[i] + 1))
    return t[-1]


def pairs(n=600, most=14):
    r = random.Random(7)
    return [([r.choice("abcd") for _ in range(r.randrange(most))], [r.choice("abcd") for _ in range(r.randrange(most))]) for _ in range(n)]


def test_laws():
    for a, b in pairs():
        m = lcs.matches(a, b)
        assert len(m) == lcs.common(a, b) == table(a, b)
        assert all(a[i] == b[j] for i, j in m) and all(x < u and y < v for (x, y), (u, v) in zip(m, m[1:]))
        ops = lcs.opcodes(a, b)
        assert [w for k, i, j, _, _ in ops if k != "inserted" for w in a[i:j]] == a
        assert [w for k, _, _, i, j in ops if k != "deleted" for w in b[i:j]] == b
        p = lcs.position_map(a, b)
        assert len(p) == len(a) + 1 and p[-1] == len(b) and p == sorted(p)
        assert sum(lcs.edits(a, b)) == distance(a, b)


@pytest.mark.parametrize(("a", "b", "want"), [("a b", "a x b", [0, 2, 3]), ("a x b", "a b", [0, 1, 1, 2]), ("a b c", "a b c", [0, 1, 2, 3])])
def test_position_map(a, b, want):
    assert lcs.position_map(a.split(), b.split()) == want


def test_assignment_against_force():
    r = random.Random(3)
    for _ in range(60):
        ref = [[r.choice("abc") for _ in range(r.randrange(6))] for _ in range(r.randrange(5))]
        hyp = [[r.choice("abc") for _ in range(r.randrange(6))] for _ in range(r.randrange(5))]
        assert score.cp_errors(ref, hyp) == score.cp_errors_by_force(ref, hyp)


def test_der_against_a_fine_grid():
    r = random.Random(5)
    for _ in range(40):
        make = lambda names: [(s, s + r.randrange(1, 9), r.choice(names)) for s in (r.randrange(30) for _ in range(r.randrange(1, 6)))]
        ref, hyp = make("AB"), make("XY")
        at = lambda segs, t: {w for s, e, w in segs if s <= t < e}
        grid = [k + 0.5 for k in range(45)]
        total = sum(len(at(ref, t)) for t in grid)
        missed = sum(max(0, len(at(ref, t)) - len(at(hyp, t))) for t in grid)
        false = sum(max(0, len(at(hyp, t)) - len(at(ref, t))) for t in grid)
        right = max(sum(len({m.get(x) for x in at(ref, t)} & at(hyp, t)) for t in grid) for m in ({"A": "X", "B": "Y"}, {"A": "Y", "B": "X"}))
        both = sum(min(len(at(ref, t)), len(at(hyp, t))) for t in grid)
        assert score.der_parts(ref, hyp, 0) == pytest.approx((total, missed, false, both - right))
    assert score.der_parts([(0, 10, "A")], [(0, 10, "B")]) == (9.5, 0, 0, 0)
