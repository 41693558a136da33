"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

_COLLOCATIONS = r"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), placed AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), spans AS (
  SELECT lang, w, i, unnest([1, 2, 3]) AS length FROM placed
), grams AS (
  SELECT lang, length, array_to_string(w[i:i + length - 1], ' ') AS phrase FROM spans WHERE i + length - 1 <= len(w)
), counts AS (
  SELECT lang, length, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE length = 1 GROUP BY lang
), cand AS (
  SELECT lang, length, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE length > 1 AND f >= 10
), cuts AS (
  SELECT lang, length, phrase, a, w, unnest(range(1, length)) AS k FROM cand
), scored AS (
  SELECT c.lang, c.length, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
    (1000000::HUGEINT * c.a::HUGEINT * c.a::HUGEINT // (x.f::HUGEINT * y.f::HUGEINT))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_pairs AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM cand WHERE length = 3
), longer AS (
  SELECT lang, phrase, max(a) AS m FROM inner_pairs GROUP BY ALL
), kept AS (
  SELECT s.lang, s.phrase, s.a, s.l, s.r, s.score FROM lowest s
  LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase WHERE g.m IS NULL OR 100 * g.m < 50 * s.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {"op11_collocations": _COLLOCATIONS}
