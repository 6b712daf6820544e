"""Reference SQL of the recursive splitter, for DuckDB: the rule stated by borders instead of by recursion over strings."""

from __future__ import annotations

from loomtext.operators.chunking import SEPARATORS

#: The white space that is stripped from chunks.
BLANKS = (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)


def _text(s: str) -> str:
    return " || ".join(f"chr({ord(c)})" if c < " " else f"'{c}'" for c in s) or "''"


def chunks_sql(docs: str, size: int, overlap: int) -> str:
    """doc_id, chunk_idx, chunk of `docs`, a query of (doc_id, language, text) with unique ids; null is plain text.

    `seg` holds what is cut with the separators from `level` on: the whole text, then every piece that is too long for
    a chunk. Neighbouring pieces that are short enough form a run. For each of its borders, `ends` is the border
    where a chunk from there ends, and `follows` the one where the chunk starts that follows an end. The empty separator makes windows.
    """
    lists = ", ".join(f"('{k}', [{', '.join(map(_text, v))}])" for k, v in SEPARATORS.items())
    blanks = " || ".join(f"chr({c})" for c in BLANKS)
    long = f"length(parts[i]) + CASE WHEN i > 1 THEN length(sep) ELSE 0 END >= {size}"
    return f"""
WITH RECURSIVE lists(name, seps) AS (VALUES {lists}),
doc AS (
  SELECT doc_id, text, coalesce(l.seps, (SELECT seps FROM lists WHERE name = 'text')) AS seps
  FROM ({docs}) d LEFT JOIN lists l ON l.name = d.language WHERE text <> ''
), seg AS (
  SELECT doc_id, 0::BIGINT AS start, text, 1 AS level, seps FROM doc
  UNION ALL
  SELECT doc_id, CASE WHEN NOT cut THEN start
      ELSE start + CASE WHEN i = 1 THEN 0 ELSE list_sum(list_transform(parts[1:i - 1], lambda p: length(p))) + (i - 2) * length(sep) END END::BIGINT,
    CASE WHEN cut AND i > 1 THEN sep || parts[i] ELSE parts[i] END, level + 1, seps
  FROM (
    SELECT *, unnest(CASE WHEN cut THEN list_filter(range(1, len(parts) + 1), lambda i: {long}) ELSE [1] END) AS i
    FROM (
      SELECT *, contains(text, sep) AS cut, CASE WHEN contains(text, sep) THEN string_split(text, sep) ELSE [text] END AS parts
      FROM (SELECT *, seps[level] AS sep FROM seg WHERE seps[level] <> '')))
), piece AS (
  SELECT doc_id, start, level, unnest(lens) AS n, generate_subscripts(lens, 1) AS i FROM (
    SELECT doc_id, start, level, list_transform(string_split(text, seps[level]), lambda p, i: length(p) + CASE WHEN i > 1 THEN length(seps[level]) ELSE 0 END) AS lens
    FROM seg WHERE seps[level] <> '' AND contains(text, seps[level]))
), placed AS (
  SELECT *, start + sum(n) OVER w - n AS place, sum((n >= {size})::INT) OVER w AS run
  FROM piece WHERE n > 0 WINDOW w AS (PARTITION BY doc_id, start, level ORDER BY i)
), borders AS (
  SELECT doc_id, start, level, run, x, row_number() OVER w AS no, least({overlap}, {size} - lead(x) OVER w + x) AS back FROM (
    SELECT doc_id, start, level, run, unnest(list_append(list(place::BIGINT ORDER BY i), max(place + n)::BIGINT)) AS x
    FROM placed WHERE n < {size} GROUP BY doc_id, start, level, run)
  WINDOW w AS (PARTITION BY doc_id, start, level, run ORDER BY x)
), runs AS (
  SELECT doc_id, start, level, run, list(x ORDER BY no) AS borders, list(ends ORDER BY no) AS ends, list(follows ORDER BY no) AS follows FROM (
    SELECT *, max(no) OVER (w RANGE BETWEEN CURRENT ROW AND {size} FOLLOWING) AS ends,
      min(no) OVER (w RANGE BETWEEN coalesce(back, 0) PRECEDING AND CURRENT ROW) AS follows
    FROM borders WINDOW w AS (PARTITION BY doc_id, start, level, run ORDER BY x))
  GROUP BY doc_id, start, level, run
), packed AS (
  SELECT doc_id, borders, ends, follows, 1::BIGINT AS no FROM runs
  UNION ALL SELECT doc_id, borders, ends, follows, follows[ends[no]] FROM packed WHERE ends[no] < len(borders)
), spans AS (
  SELECT doc_id, borders[no] AS s, borders[ends[no]] AS e FROM packed
  UNION ALL
  SELECT doc_id, s, least(s + {size}, start + n) FROM (
    SELECT doc_id, start, n, unnest(range(start, start + 1 + greatest(n - {size}, 0) + {size - overlap - 1}, {size - overlap})) AS s
    FROM (SELECT doc_id, start, length(text) AS n FROM seg WHERE seps[level] = ''))
), made AS (
  SELECT doc_id, s, trim(substr(text, (s + 1)::INT, (e - s)::INT), {blanks}) AS chunk FROM spans JOIN doc USING (doc_id)
)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS chunk_idx, chunk FROM made WHERE chunk <> ''"""
