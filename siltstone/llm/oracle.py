"""DuckDB SQL for the operators that SQL can express.

The divergence audit is counting and whole-number arithmetic. The others are estimates, seeded
orders, encodings or hashes of formatted text; tests/llm compares them with brute force.
"""

from __future__ import annotations

_DIVERGENCE = r"""
WITH d AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[a-z\x{80}-\x{10FFFF}]+') AS terms
    FROM documents),
w AS (SELECT id, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
c AS (SELECT w.lang, w.source, w.term, count(*) AS c
      FROM w JOIN kept k ON k.lang = w.lang AND k.term = w.term GROUP BY w.lang, w.source, w.term),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT g.lang, g.source, coalesce(sum(c.c), 0)::HUGEINT AS n, coalesce(any_value(v.v), 0) AS v
      FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source LEFT JOIN v ON v.lang = g.lang
      GROUP BY g.lang, g.source),
p AS (SELECT n.lang, n.source, k.term, coalesce(c.c, 0) AS c,
          1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 5)) // (n.n + 5 * n.v) AS p
      FROM n JOIN kept k ON k.lang = n.lang
      LEFT JOIN c ON c.lang = n.lang AND c.source = n.source AND c.term = k.term),
t AS (SELECT lang, sum(n) AS n FROM n GROUP BY lang),
q AS (SELECT c.lang, c.term, 1 + (1000000000::HUGEINT * (sum(c.c) + 5)) // (any_value(t.n) + 5 * any_value(v.v)) AS q
      FROM c JOIN t ON t.lang = c.lang JOIN v ON v.lang = c.lang GROUP BY c.lang, c.term),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY a.lang, a.source, b.source
    UNION ALL
    SELECT p.lang, p.source, 'term', p.term, p.p - q.q
    FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.c > 0 AND p.p > q.q),
r AS (SELECT lang, source, part, item, value::BIGINT AS value,
          row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
      FROM found)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_source_divergence": _DIVERGENCE}
