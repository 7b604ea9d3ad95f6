"""DuckDB SQL for the registered queries that SQL can express.

Written on its own, not derived from the Spark expressions: plain patterns
without look-behind, list comprehensions, joins of all pairs, a recursive closure.
"""

from __future__ import annotations

_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_KINDS = [
    # kind, pattern, validity of match m with digits dg, least score without context, context words, class that must not be next to it
    ("email", _EMAIL, "true", None, "", ""),
    ("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
     "len([p for p in string_split(m, '.') if length(ltrim(p, '0')) > 3 or CAST('0' || right(p, 3) AS INT) > 255]) = 0", None, "", ""),
    ("card", r"[0-9](?:[ -]?[0-9])+",
     "length(dg) BETWEEN 14 AND 19 AND list_sum([CASE WHEN j % 2 = 1 THEN CAST(substr(reverse(dg), j, 1) AS INT) "
     "ELSE CAST(substr('0246813579', CAST(substr(reverse(dg), j, 1) AS INT) + 1, 1) AS INT) END for j in range(1, length(dg) + 1)]) % 10 = 0",
     None, "", ""),
    ("phone", r"\+[0-9][ ().0-9-]+[0-9]", "length(dg) BETWEEN 10 AND 15", None, "", ""),
    ("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}",
     "length(replace(m, ' ', '')) BETWEEN 15 AND 34 AND list_reduce([0] || [CAST(strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
     "substr(substr(replace(m, ' ', ''), 5) || left(replace(m, ' ', ''), 4), j, 1)) - 1 AS INT) for j in range(1, length(replace(m, ' ', '')) + 1)], "
     "lambda a, v: (a * CASE WHEN v < 10 THEN 10 ELSE 100 END + v) % 97) = 1", 0.8, "iban|account|bank", "[A-Za-z0-9]"),
    ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
     "m NOT LIKE '000%' AND m NOT LIKE '666%' AND m NOT LIKE '9%' AND m NOT LIKE '___-00%' AND m NOT LIKE '%0000'",
     0.3, "ssn|social security", "[0-9-]"),
    ("secret", r"[0-9a-f]{32,}", "true", 0.3, "token|secret|password|api_key|apikey|api key", "[A-Za-z0-9]"),
]


def _pii() -> str:
    found = " UNION ALL ".join(
        f"SELECT doc_id, t, '{k}' AS kind, {i} AS ord, regexp_extract_all(t, '{p}') AS f, regexp_split_to_array(t, '{p}') AS g FROM d"
        for i, (k, p, *_) in enumerate(_KINDS))
    valid = " ".join(f"WHEN '{k}' THEN {v}" for k, _, v, *_ in _KINDS)
    near = "lower(substr(t, greatest(s - 40, 0) + 1, least(s, 40)) || chr(10) || substr(t, e + 1, 40))"
    score = " ".join(f"WHEN '{k}' THEN {low} + CASE WHEN regexp_matches({near}, '(^|[^a-z])({words})') THEN 0.4 ELSE 0 END >= 0.6"
                     f" AND NOT regexp_matches(substr(t, s, CASE WHEN s > 0 THEN 1 ELSE 0 END), '{cls}')"
                     f" AND NOT regexp_matches(substr(t, e + 1, 1), '{cls}')" for k, _, _, low, words, cls in _KINDS if low)
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k, *_ in _KINDS)
    listed = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord){w}, '')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k AS ({found}),
x AS (SELECT doc_id, t, kind, ord, f[i] AS m,
             CAST(list_sum([length(v) for v in g[1:i]]) + coalesce(list_sum([length(v) for v in f[1:i - 1]]), 0) AS BIGINT) AS s
      FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM k)),
y AS (SELECT *, s + length(m) AS e, regexp_replace(m, '[^0-9]', '', 'g') AS dg FROM x),
z AS (SELECT * FROM y WHERE (CASE kind {valid} END) AND (CASE kind {score} ELSE true END))
SELECT d.doc_id, {counts},
       sha256({listed.format(w=" FILTER (ord < 4)")}) AS base_sha256, {listed.format(w="")} AS spans
FROM d LEFT JOIN z ON z.doc_id = d.doc_id GROUP BY d.doc_id"""


_JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ 	-
]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
             ELSE [array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)] END) AS h FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
b AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT x, y FROM b UNION SELECT r.x, b.y FROM r JOIN b ON r.y = b.x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m.y, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS y FROM r GROUP BY x) m USING (doc_id)"""


_LEXICAL = r"""
WITH t AS (SELECT doc_id, row_number() OVER () AS r,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM t WHERE len(ts) > 0),
o AS (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM t),
f AS (SELECT r, doc_id, n, term, count(*) AS tf FROM o GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM f, s GROUP BY term),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
c AS (SELECT i.item_id, f.r, any_value(f.doc_id) AS doc_id,
             sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 8 * (10 + (90 * f.n * s.n_docs) // s.n_terms))))::BIGINT AS score
      FROM i JOIN f USING (term) JOIN w USING (term) CROSS JOIN s GROUP BY i.item_id, f.r),
k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM c WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM k WHERE rank <= 10"""


# crc32 bit by bit: a byte enters, then eight shifts, marked by -1.
_RUNS = r"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^ \x09-\x0D]+') AS ws FROM documents),
h AS (SELECT *, len(ws) AS n, xor(list_reduce([4294967295::BIGINT] || flatten([[ascii(c)::BIGINT] || [-1 for _ in range(8)]
             for c in string_split(doc_id::VARCHAR, '')]),
             lambda a, c: CASE WHEN c >= 0 THEN xor(a, c) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) AS h FROM w),
g AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM g),
x AS (SELECT r, i, ws[1 + CASE WHEN a IS NULL OR i < a THEN i ELSE a + (i - a) % p END] AS word
      FROM (SELECT *, unnest(range(0, n)) AS i FROM p)),
e AS (SELECT x.r, y.i - x.i AS q, x.i FROM x JOIN x y ON x.r = y.r AND x.word = y.word AND y.i > x.i JOIN p ON p.r = x.r AND 3 * (y.i - x.i) <= p.n),
s AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM e),
t AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM s GROUP BY r, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS (SELECT r, start, length, min(q) AS period FROM t GROUP BY r, start, length),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS words FROM x ANTI JOIN runs u ON u.r = x.r AND x.i >= u.start + u.period AND x.i < u.start + u.length GROUP BY r),
best AS (SELECT r, start, length, period FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY length / period DESC, start, period) = 1),
list AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM runs GROUP BY r)
SELECT w.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, (1000 * length) // period AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM w LEFT JOIN list USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_pii": _pii(), "op7_jaccard_join": _JACCARD, "op11_periodic_runs": _RUNS, "op13_lexical_search": _LEXICAL}
