"""DuckDB SQL of importance resampling, license scans and centroid clustering, from the definitions alone."""

from __future__ import annotations

from barledger.llm.licenses import BASE_SCORE, DRIFT, K, PHRASES, SHARE, TEMPLATES

_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

#: Eight shifts of the reflected polynomial for each byte make the CRC table.
_SHIFT = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END AS v"
_TABLE = "SELECT b, b AS v FROM range(256) t(b)"
for _ in range(8):
    _TABLE = f"SELECT b, {_SHIFT} FROM ({_TABLE})"

OP11 = rf"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT list(CAST(v AS BIGINT) ORDER BY b) AS tab FROM ({_TABLE})
), d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents
), t AS (SELECT {_WORDS} AS ws FROM benchmark
), f AS MATERIALIZED (
  SELECT r, unnest(ws) AS g FROM d UNION ALL
  SELECT r, ws[i] || ' ' || ws[i + 1] FROM (SELECT r, ws, unnest(range(1, len(ws))) AS i FROM d)
), tf AS MATERIALIZED (
  SELECT unnest(ws) AS g FROM t UNION ALL SELECT ws[i] || ' ' || ws[i + 1] FROM (SELECT ws, unnest(range(1, len(ws))) AS i FROM t)
), n AS MATERIALIZED (
  SELECT g, sum(s) AS s, sum(t) AS t FROM (
    SELECT g, count(*) AS s, 0 AS t FROM f GROUP BY g UNION ALL SELECT g, 0, count(*) FROM tf GROUP BY g) GROUP BY g
), b AS MATERIALIZED (
  SELECT g, s, t, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), [CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT) FOR i IN range(length(h) // 2)]),
    lambda a, x: xor(a >> 8, list_extract(tab, 1 + (xor(a, x) & 255))))) % 10000 AS bucket
  FROM (SELECT *, hex(encode(g)) AS h FROM n), crc
), bs AS (SELECT bucket, sum(s) AS s, sum(t) AS t FROM b GROUP BY bucket
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (SELECT CAST(sum(s) AS DOUBLE) + 10000 FROM bs)
    / ((CAST(s AS DOUBLE) + 1) * (SELECT CAST(sum(t) AS DOUBLE) + 10000 FROM bs)))) AS BIGINT) AS gain FROM bs
), w AS (
  SELECT r, count(*) AS n, CAST(sum(gain) AS BIGINT) AS g FROM f JOIN b USING (g) JOIN gain USING (bucket) GROUP BY r
), s AS (
  SELECT r, doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_features,
    CASE WHEN n IS NULL THEN 0 ELSE (g - ((g % n) + n) % n) // n END AS weight,
    CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN w USING (r)
), z AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM s
), k AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, r) AS place FROM z WHERE n_words >= 20
), drawn AS (SELECT r, place FROM k WHERE place <= (SELECT 25 * count(*) // 100 FROM k)
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CAST(place AS BIGINT) AS rank
FROM z LEFT JOIN drawn USING (r)
"""

_TEXT_ROWS = ", ".join(f"({t}, '{label}', string_split('{words}', ' '))" for t, (label, words) in enumerate(TEMPLATES))
_PHRASE_ROWS = ", ".join(f"(string_split('{words}', ' '), '{label}')" for words, label in PHRASES.items())

_AHEAD = ", ".join(f"lead(word, {j}) OVER ahead AS w{j}" for j in range(1, K))
_NEXT = ", ".join(f"w{j}" for j in range(1, K))

OP12 = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents
), tp AS (SELECT t, label, tw, len(tw) AS size, least({DRIFT}, len(tw) // 5) AS drift FROM (VALUES {_TEXT_ROWS}) x(t, label, tw)
), w AS MATERIALIZED (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS p FROM d
), n AS MATERIALIZED (
  SELECT r, p, word, {_AHEAD} FROM w WINDOW ahead AS (PARTITION BY r ORDER BY p)
), g AS (SELECT r, p, concat_ws(' ', word, {_NEXT}) AS gram FROM n WHERE w{K - 1} IS NOT NULL
), tg AS (
  SELECT t, q - 1 AS q, array_to_string(tw[q:q + {K - 1}], ' ') AS gram FROM (SELECT t, tw, unnest(range(1, len(tw) - {K - 2})) AS q FROM tp)
), twords AS (SELECT t, q - 1 AS q, tw[q] AS word FROM (SELECT t, tw, unnest(range(1, len(tw) + 1)) AS q FROM tp)
), diag AS (SELECT DISTINCT r, t, p - q AS diagonal FROM g JOIN tg USING (gram)
), place AS MATERIALIZED (
  SELECT r, t, diagonal, sum(apart) OVER (PARTITION BY r, t ORDER BY diagonal) AS place FROM (
    SELECT r, t, diagonal,
      CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, t ORDER BY diagonal) <= drift THEN 0 ELSE 1 END AS apart
    FROM diag JOIN tp USING (t))
), stands AS (
  SELECT * FROM (SELECT r, t, place, q, q + diagonal AS p, word FROM place JOIN twords USING (t)) JOIN w USING (r, p, word)
), held AS MATERIALIZED (
  SELECT r, t, place, count(DISTINCT q) AS n, count(DISTINCT q) FILTER (WHERE regexp_full_match(word, '[0-9]+')) AS numbers,
    min(p) AS a, max(p) + 1 AS z
  FROM stands GROUP BY ALL
), whole AS (
  SELECT r, t, place, n, a, z, label FROM held JOIN tp USING (t)
  WHERE 100 * n >= {SHARE} * size AND numbers = len([x FOR x IN tw IF regexp_full_match(x, '[0-9]+')])
), kept AS (
  SELECT r, label FROM whole x WHERE NOT EXISTS (
    SELECT 1 FROM whole y WHERE y.r = x.r AND y.t <> x.t AND y.a < x.z AND x.a < y.z AND (y.n > x.n OR y.n = x.n AND y.t < x.t))
), ph AS (SELECT pw, label FROM (VALUES {_PHRASE_ROWS}) x(pw, label)
), base AS (SELECT r, p, label FROM n JOIN ph ON word = pw[1] AND w1 = pw[2] AND (len(pw) = 2 OR w2 = pw[3])
), b AS (
  SELECT r, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, list_sort(list(DISTINCT label)) AS labels FROM base GROUP BY r
), l AS (SELECT r, list_sort(list(DISTINCT label)) AS labels FROM (SELECT r, label FROM base UNION ALL SELECT r, label FROM kept) GROUP BY r
), best AS (SELECT r, max(CAST(n AS DOUBLE) / size) AS share FROM held JOIN tp USING (t) GROUP BY r
), spans AS (SELECT r, count(*) AS n FROM kept GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
  coalesce(array_to_string(b.labels, ','), '') AS base_labels, coalesce(array_to_string(l.labels, ','), '') AS labels,
  greatest(coalesce(share, 0), CASE WHEN n_base > 0 THEN {BASE_SCORE} ELSE 0 END)::DOUBLE AS score, CAST(coalesce(spans.n, 0) AS BIGINT) AS n_spans
FROM d LEFT JOIN b USING (r) LEFT JOIN l USING (r) LEFT JOIN best USING (r) LEFT JOIN spans USING (r)
"""


def _rounds() -> str:
    out = []
    for n in range(11):
        out.append(f"""a{n} AS MATERIALIZED (
  SELECT r, c, d FROM (SELECT r, c, sum((x - y) * (x - y)) AS d FROM p JOIN c{n} USING (i) GROUP BY r, c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
), c{n + 1} AS MATERIALIZED (
  SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, y) AS y FROM c{n}
  LEFT JOIN (SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM p JOIN a{n} USING (r) GROUP BY c, i) USING (c, i)
)""")
    return ", ".join(out)


OP13 = f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), p AS MATERIALIZED (SELECT r, i, v[i] AS x FROM k, range(1, 65) t(i)
), c0 AS MATERIALIZED (
  SELECT c, i, v[i] AS y FROM (
    SELECT v, row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c FROM k), range(1, 65) t(i)
  WHERE c < 8
), {_rounds()}, digest AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c10 GROUP BY c
)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a10 JOIN k USING (r) JOIN digest USING (c)
"""
