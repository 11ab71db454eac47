"""DuckDB SQL of the operators that SQL can express, written from the definitions alone."""

from __future__ import annotations

from barledger.llm.divergence import _BINS, CLASSES, COMMON_WORDS, Limits

_L = Limits()
_WORD = r"[^\x20\x09-\x0D]+"


def _quoted(words) -> str:
    return ", ".join("'" + w + "'" for w in words)


_CLASS_ROWS = " UNION ALL ".join(
    f"SELECT r, 'c' AS kind, '{name}' AS bin, CAST({name} AS DOUBLE) AS k FROM a" for name in (*CLASSES, "space", "beyond", "plain")
)
_CLASS_COLUMNS = ", ".join(
    "length(regexp_replace(t, '" + "[^" + p[1:-1].replace("'", "''") + "]', '', 'g')) AS " + name for name, p in CLASSES.items()
)
_SUM = " + ".join((*CLASSES, "space", "beyond"))


def _round(number: int, extra: str) -> str:
    """References from texts that pass, then each text's distance to the nearest of them."""
    return f"""
ref{number} AS (
  SELECT lang, kind, bin, avg(p) AS q FROM share JOIN a USING (r)
  WHERE lang IN ({_quoted(COMMON_WORDS)}) AND n_words >= {_L.word_min_words} AND chars >= {_L.class_min_chars} AND NOT failed {extra}
  GROUP BY ALL
), js{number} AS (
  SELECT r, min(d) FILTER (WHERE kind = 'c') AS js_class, min(d) FILTER (WHERE kind = 'w') AS js_word FROM (
    SELECT s.r, s.kind, f.lang, sqrt(greatest(sum(
      CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS d
    FROM share s JOIN ref{number} f USING (kind, bin) GROUP BY ALL)
  GROUP BY r
), odd{number} AS (
  SELECT r, js_class, js_word, coalesce(chars >= {_L.class_min_chars} AND lang IN (SELECT lang FROM ref{number}) AND js_class > {_L.class_distance}, false)
    OR coalesce(n_words >= {_L.word_min_words} AND lang IN (SELECT lang FROM ref{number}) AND js_word > {_L.word_distance}, false) AS odd
  FROM a LEFT JOIN js{number} USING (r)
)"""


OP1 = rf"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents
), x AS (
  SELECT *, regexp_extract_all(t, '{_WORD}') AS ws, [y FOR y IN string_split(t, chr(10)) IF regexp_matches(y, '{_WORD}')] AS lines FROM w
), g AS (
  SELECT r, i, array_to_string(ws[i:i + 7], chr(1)) AS k FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM x)
), rep AS (
  SELECT r, count(DISTINCT i + j) AS n_repeat FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM g), range(8) o(j)
  WHERE n > 1 GROUP BY r
), a AS (
  SELECT *, n_repeat_words * 100 > {_L.repeat_percent} * n_words OR n_words < {_L.min_words} AS failed,
    greatest(chars - ({_SUM}), 0) AS plain
  FROM (SELECT r, doc_id, lang, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(t) AS chars,
      length(t) - length(array_to_string(ws, '')) AS space, strlen(t) - length(t) AS beyond,
      len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words, {_CLASS_COLUMNS}
    FROM x LEFT JOIN rep USING (r))
), bin AS (SELECT unnest([{_quoted(_BINS)}, '']) AS bin
), common AS (
  SELECT r, CASE WHEN b IN ({_quoted(_BINS)}) THEN b ELSE '' END AS bin, count(*) AS k
  FROM (SELECT r, rtrim(lower(unnest(ws)), '.,;:!?') AS b FROM x) GROUP BY ALL
), kinds AS (
  {_CLASS_ROWS}
  UNION ALL SELECT a.r, 'w', bin.bin, CAST(coalesce(k, 0) AS DOUBLE) FROM a CROSS JOIN bin LEFT JOIN common c ON c.r = a.r AND c.bin = bin.bin
), share AS (
  SELECT r, kind, bin, k / greatest(sum(k) OVER (PARTITION BY r, kind), 1) AS p FROM kinds
), {_round(1, "")}, {_round(2, "AND r IN (SELECT r FROM odd1 WHERE NOT odd)")}
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(symbol AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, failed AS base_failed,
  NOT (failed OR odd) AS kept, round(js_class, 6) AS js_class, round(js_word, 6) AS js_word
FROM a JOIN odd2 USING (r)
"""

OP2 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents
), s AS (
  SELECT r, i, md5(array_slice(b, i + 1, i + 400)) AS k FROM (SELECT r, b, unnest(range(0, octet_length(b) - 399)) AS i FROM d)
), hit AS (
  SELECT r, i FROM s QUALIFY count(*) OVER (PARTITION BY k) > 1
), run AS (
  SELECT r, i, sum(CASE WHEN i > e THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS g
  FROM (SELECT r, i, coalesce(lag(i) OVER (PARTITION BY r ORDER BY i) + 400, -1) AS e FROM hit)
), span AS (
  SELECT r, min(i) AS a, max(i) + 400 AS z FROM run GROUP BY r, g
), cut AS (
  SELECT r, 0 AS n, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS f, a AS u FROM span
  UNION ALL SELECT d.r, 1, coalesce(max(z), 0), octet_length(any_value(b)) FROM d LEFT JOIN span USING (r) GROUP BY d.r
), kept AS (
  SELECT r, coalesce(string_agg(hex(array_slice(b, f + 1, u)), '' ORDER BY f), '') AS h FROM cut JOIN d USING (r) WHERE u > f GROUP BY r
), n AS (SELECT r, sum(z - a) AS removed, count(*) AS spans FROM span GROUP BY r)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(h, ''))) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN kept USING (r)
"""

OP7 = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT r, array_to_string(ws[i:i + 4], chr(1)) AS k
  FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0)
), n AS (SELECT r, count(*) AS size FROM s GROUP BY r
), pair AS (
  SELECT x.r AS a, y.r AS b, count(*) AS shared FROM s x JOIN s y ON x.k = y.k AND x.r < y.r GROUP BY ALL
), link AS (
  SELECT a, b FROM pair JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * shared >= 75 * (na.size + nb.size - shared)
), both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
  SELECT r AS a, r AS b FROM d UNION SELECT reach.a, w.b FROM reach JOIN both_ways w ON w.a = reach.b
), root AS (SELECT reach.a AS r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY reach.a)
SELECT doc_id, CAST(coalesce(size, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN root USING (r) LEFT JOIN n USING (r)
"""
