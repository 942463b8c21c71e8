"""Alignment in SQL, for checking: the table of longest common subsequences row by row, the way back through it, and
what lies between the pairs it meets. Common ends are cut off first, as the operator does."""

from __future__ import annotations

from colloquy.functions.fixed import COMMON_WORDS

COMMON = "[" + ", ".join(f"'{w}'" for w in COMMON_WORDS) + "]"


def gaps(pairs: str) -> str:
    """CTEs from `pairs`, a query for (k, a, b): `hits` (k, i, j) are pairs of places, from 0 on; `gap` (k, a_pos, a_hi,
    b_pos, b_hi) are the runs between them that differ. To be put behind WITH RECURSIVE."""
    return f"""pp AS MATERIALIZED ({pairs}),
p1 AS (SELECT *, coalesce(nullif(list_position(list_transform(range(1, least(len(a), len(b)) + 1), lambda i: a[i] = b[i]), false), 0) - 1, least(len(a), len(b))) AS head FROM pp),
p2 AS (SELECT *, coalesce(nullif(list_position(list_transform(range(1, least(len(a), len(b)) - head + 1), lambda i: a[len(a) - i + 1] = b[len(b) - i + 1]), false), 0) - 1, least(len(a), len(b)) - head) AS tail FROM p1),
p3 AS MATERIALIZED (SELECT *, a[head + 1 : len(a) - tail] AS x, b[head + 1 : len(b) - tail] AS y FROM p2),
dp AS (SELECT k, 0 AS i, [0::BIGINT FOR q IN range(0, len(y) + 1)] AS r FROM p3 UNION ALL
  SELECT dp.k, dp.i + 1, list_reduce(list_transform(range(1, len(y) + 1), lambda j: [j]),
    lambda cur, j: list_append(cur, CASE WHEN y[j[1]] = x[dp.i + 1] THEN dp.r[j[1]] + 1 ELSE greatest(dp.r[j[1] + 1], cur[-1]) END), [0::BIGINT])
  FROM dp JOIN p3 ON p3.k = dp.k WHERE dp.i < len(x)),
tb AS MATERIALIZED (SELECT k, list(r ORDER BY i) AS t FROM dp GROUP BY k),
way AS MATERIALIZED (SELECT p3.k, head, list_reduce([[q] FOR q IN range(0, len(x) + len(y))], lambda st, q: CASE
    WHEN st[1] = 0 OR st[2] = 0 THEN st
    WHEN t[st[1] + 1][st[2] + 1] = t[st[1]][st[2] + 1] THEN list_concat([st[1] - 1, st[2]], st[3:])
    WHEN st[2] > 1 AND t[st[1] + 1][st[2]] <> t[st[1]][st[2]] THEN list_concat([st[1], st[2] - 1], st[3:])
    ELSE list_concat([st[1] - 1, st[2] - 1, (st[1] - 1) * 1000000 + st[2] - 1], st[3:]) END, [len(x), len(y)])[3:] AS met
  FROM p3 JOIN tb ON tb.k = p3.k),
hits AS (SELECT k, c // 1000000 + head AS i, c % 1000000 + head AS j FROM (SELECT k, head, unnest(met) AS c FROM way)
  UNION ALL SELECT k, q, q FROM (SELECT k, unnest(range(0, head)) AS q FROM p3)
  UNION ALL SELECT k, n - tail + q, m - tail + q FROM (SELECT k, len(a) AS n, len(b) AS m, tail, unnest(range(0, tail)) AS q FROM p3)),
marks AS (SELECT k, i, j FROM hits UNION ALL SELECT k, len(a), len(b) FROM pp),
steps AS (SELECT k, coalesce(lag(i) OVER w + 1, 0) AS a_pos, i AS a_hi, coalesce(lag(j) OVER w + 1, 0) AS b_pos, j AS b_hi FROM marks WINDOW w AS (PARTITION BY k ORDER BY i, j)),
gap AS (SELECT * FROM steps WHERE a_hi > a_pos OR b_hi > b_pos)"""


def only_common(ws: str) -> str:
    return f"len(list_filter({ws}, lambda w: NOT list_contains({COMMON}, lower(w)))) = 0"
