"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

#: The rules of ``quality_rules.RULES`` over counts that SQL makes on its own.
QUALITY_RULES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
grams AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, range(8) AS t(k) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{_WORD}') GROUP BY r),
counted AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(l.dup, 0) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words, coalesce(l.n, 0) AS n_lines,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stuttered,
         len(regexp_extract_all(text, '!!( |\n|$)')) AS n_shouted
  FROM d LEFT JOIN lines l USING (r) LEFT JOIN covered c USING (r)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 10 * n_stuttered > 3 * n_words OR 10 * n_shouted > 3 * n_words
            OR (n_lines >= 5 AND 2 * n_dup_lines > n_lines)
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM judged"""


#: Sources share all words by weight, stopping at three times their own size: sources stand by the words per weight at
#: which they stop, and the level is the first one at which the next source doesn't stop.
SOURCE_MIX = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [1.0, 2.0, 3.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source),
stops AS (
  SELECT *, 3.0 * source_size AS cap, row_number() OVER (ORDER BY 3.0 * source_size / w, source NULLS LAST) AS k FROM s),
levels AS (
  SELECT k, cap, w, sum(cap) OVER (ORDER BY k) - cap AS held, sum(w) OVER (ORDER BY k DESC) AS rest,
         sum(source_size) OVER () AS total FROM stops),
level AS (
  SELECT (total - held)::DOUBLE AS words, rest::DOUBLE AS weight FROM levels
  WHERE cap > w * (total - held) / rest ORDER BY k LIMIT 1),
t AS (
  SELECT source, source_size, coalesce(least(3.0 * source_size, w * words / weight), 0.0)::DOUBLE AS target,
         ('0x' || substr(md5('mix-1:' || coalesce(source, '')), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS u
  FROM s LEFT JOIN level ON true),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.u, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS FIRST)::DOUBLE AS n
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (least(floor(n * rate + u) - floor((n - 1) * rate + u), 3) * size)::BIGINT AS taken FROM r"""


def vector_codes(parts: int, entries: int, rounds: int, scale: int) -> str:
    """Lloyd rounds written out, each a whole scan of all entries (for vectors whose length the parts divide)."""
    book = f"""book0 AS MATERIALIZED (
  SELECT p, rank - 1 AS e, i, x FROM v JOIN (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rank FROM d) USING (r)
  WHERE rank <= {entries})"""
    steps = [book]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
  SELECT r, p, e, gap FROM (SELECT v.r, v.p, b.e, sum((v.x - b.x) * (v.x - b.x))::BIGINT AS gap FROM v JOIN book{k} b USING (p, i) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY gap, e) = 1)""")
        if k < rounds:
            steps.append(f"""book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, b.i, CASE WHEN m.n IS NULL THEN b.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END::BIGINT AS x
  FROM book{k} b LEFT JOIN (SELECT p, e, i, sum(x) AS s, count(*) AS n FROM v JOIN near{k} USING (r, p) GROUP BY ALL) m USING (p, e, i))""")
    return f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (
  SELECT r, (j // (n // {parts}))::BIGINT AS p, j % (n // {parts}) AS i, floor({scale} * x::DOUBLE)::BIGINT AS x
  FROM (SELECT r, len(embedding) AS n, unnest(embedding) AS x, unnest(range(len(embedding))) AS j FROM d)),
{(","+chr(10)).join(steps)},
coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(gap)::BIGINT AS error FROM near{rounds} GROUP BY r),
books AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) AS digest FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, digest AS codebooks_sha256
FROM d JOIN coded USING (r), books"""
