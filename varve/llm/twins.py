"""SQL twins of the queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SOLID = r"[^\x20\x09-\x0D]+"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(pattern: str, lowered: bool) -> str:
    text = "coalesce(text, '')"
    if lowered:
        text = f"translate({text}, '{_UPPER}', '{_UPPER.lower()}')"
    return f"regexp_extract_all({text}, '{pattern}')"


_DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {_words(_LETTERS, True)} AS w FROM documents),
items AS (
  SELECT item_id, w, least(13, len(w)) AS size
  FROM (SELECT item_id, {_words(_LETTERS, True)} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM items)),
grams AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM items) WHERE len(w) >= size)),
hits AS (SELECT doc_id, i, size, item_id FROM grams JOIN windows USING (size, g)),
places AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS p FROM hits),
hit AS (SELECT doc_id, count(*) AS n FROM places GROUP BY doc_id),
owners AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(owners.n, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN owners USING (doc_id)"""

_WORD_REPEATS = f"""
WITH docs AS (SELECT doc_id, {_words(_SOLID, False)} AS w FROM documents),
starts AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS g
  FROM (SELECT *, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)),
repeats AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY g) AS earliest FROM starts) WHERE earliest < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs),
marked AS (
  SELECT doc_id, word, i, coalesce(max(CASE WHEN r.i IS NOT NULL THEN 1 END)
    OVER (PARTITION BY doc_id ORDER BY i ROWS 49 PRECEDING), 0) AS gone
  FROM words LEFT JOIN repeats r USING (doc_id, i)),
kept AS (
  SELECT doc_id, sum(gone) AS removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS rest FROM marked GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(rest, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""

_SIMILAR = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_words(_SOLID, True)} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS met
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y
  WHERE 100 * met >= 75 * (sx.n + sy.n - met)),
reach AS (SELECT doc_id, doc_id AS other FROM docs UNION SELECT r.doc_id, y FROM reach r JOIN links ON r.other = x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)"""

_BYTE_REPEATS = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
bytes AS (SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS b,
  CASE WHEN 2 * i + 200 <= length(h) THEN md5(substr(h, 2 * i + 1, 200)) END AS g
  FROM (SELECT *, unnest(range(length(h) // 2)) AS i FROM docs)),
ranked AS (SELECT doc_id, i, b, g IS NOT NULL AND row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1 AS again FROM bytes),
marked AS (SELECT doc_id, i, b, max(CAST(again AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i ROWS 99 PRECEDING) AS gone FROM ranked),
runs AS (SELECT *, gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), 0) = 0 AS opens FROM marked),
kept AS (
  SELECT doc_id, sum(gone) AS removed, count(*) FILTER (opens) AS spans, string_agg(b, '' ORDER BY i) FILTER (gone = 0) AS rest
  FROM runs GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(rest, ''))) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""

_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_RANKED = f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, t AS w, CAST(len(t) AS HUGEINT) AS n
  FROM (SELECT doc_id, {_words(_TERMS, True)} AS t FROM documents)),
sums AS (SELECT CAST(count(*) AS HUGEINT) AS total, sum(n) AS words FROM docs WHERE n > 0),
postings AS (SELECT d, term, CAST(count(*) AS HUGEINT) AS tf FROM (SELECT d, unnest(w) AS term FROM docs) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * total + 2 AS DOUBLE) / (2 * count(*) + 1))) AS HUGEINT) AS weight
  FROM postings, sums GROUP BY term, total),
asked AS (
  SELECT item, item_id, term, count(*) AS times
  FROM (SELECT row_number() OVER () AS item, item_id, unnest({_words(_TERMS, True)}) AS term FROM benchmark) GROUP BY ALL),
scores AS (
  SELECT item, item_id, doc_id, d, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * total) // words)))) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN docs USING (d), sums GROUP BY ALL HAVING score > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id, d) AS place FROM scores)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE place <= 20"""

_NEAREST = """
WITH raw AS (
  SELECT vec_id, len(embedding) AS width, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
  FROM embeddings WHERE vec_id IS NOT NULL),
parts AS (
  SELECT vec_id, width, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x
  FROM raw ANTI JOIN (SELECT vec_id FROM raw WHERE x IS NULL OR NOT isfinite(x)) USING (vec_id)),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.width = c.width AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scores)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5"""

ORACLES = {
    "op1_decontamination": _DECONTAMINATION,
    "op4_substring_dedup": _WORD_REPEATS,
    "op6_jaccard_join": _SIMILAR,
    "op7_suffix_dedup": _BYTE_REPEATS,
    "op12_lexical_search": _RANKED,
    "op13_topk_search": _NEAREST,
}
