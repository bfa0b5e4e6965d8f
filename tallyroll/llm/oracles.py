"""SQL (DuckDB) for the queries of this package that SQL can express."""

from __future__ import annotations

from tallyroll.llm.quality_rules import BUCKETS, PRIOR, THRESHOLD

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: crc32 by its table; `t` is a list of 256 numbers.
_CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_concat([n], range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS n)))"""


def _crc(text: str) -> str:
    return f"""xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
      list_transform(range(octet_length(encode({text}))),
        lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""


QUALITY_RULES = f"""
WITH {_CRC_TABLE},
words AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
again AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
    FROM windows JOIN (SELECT doc_id, g FROM windows GROUP BY ALL HAVING count(*) > 1) USING (doc_id, g))
  GROUP BY doc_id),
base AS (
  SELECT doc_id, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
    coalesce(again.n, 0) AS n_repeat_words
  FROM words LEFT JOIN again USING (doc_id)),
grams AS (
  SELECT doc_id, g, count(*) AS n FROM (
    SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g
    FROM words)
  GROUP BY ALL),
buckets AS (SELECT g, {_crc("g")} % {BUCKETS} AS bucket FROM (SELECT DISTINCT g FROM grams), crc_table),
trusted AS (
  SELECT arg_min(doc_id, (h, doc_id)) AS doc_id FROM (
    SELECT doc_id, {_crc("doc_id::VARCHAR")} AS h FROM labels, crc_table WHERE quality = 1 AND doc_id IS NOT NULL)
  GROUP BY h % 16384),
counts AS (
  SELECT bucket, sum(n) AS raw, coalesce(sum(n) FILTER (doc_id IN (FROM trusted)), 0) AS target
  FROM grams JOIN buckets USING (g) GROUP BY bucket),
totals AS (SELECT sum(raw) AS raws, sum(target) AS targets FROM counts),
weights AS (
  SELECT bucket, CASE WHEN targets > 0 THEN round(ln((target + {PRIOR}) /
    (raw::DOUBLE * targets::DOUBLE / raws::DOUBLE + {PRIOR})) * 1e6)::BIGINT ELSE 0 END AS weight FROM counts, totals),
scores AS (
  SELECT doc_id, sum(n * weight) AS total FROM grams JOIN buckets USING (g) JOIN weights USING (bucket) GROUP BY doc_id),
judged AS (
  SELECT doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN floor(total::DOUBLE / (2 * n_words - 1))::BIGINT END AS score
  FROM base LEFT JOIN scores USING (doc_id))
SELECT *, NOT base_failed AND coalesce(score, 0) >= {THRESHOLD} AS kept FROM judged
"""

JACCARD = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(s) AS n FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN sizes p ON p.doc_id = x.doc_id JOIN sizes q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 90 * (p.n + q.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, n AS n_shingles, min(b) AS component_id FROM sizes JOIN reach ON a = doc_id GROUP BY doc_id, n
"""

REPEATS = """
WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
windows AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(n - 49)) AS p FROM texts)),
gone AS (
  SELECT doc_id, p FROM windows JOIN (SELECT s, min(doc_id) AS least FROM windows GROUP BY s) USING (s) WHERE least < doc_id),
bytes AS (
  SELECT b.doc_id, b.p, b.hex, max(CASE WHEN g.p IS NULL THEN 0 ELSE 1 END) OVER (
    PARTITION BY b.doc_id ORDER BY b.p ROWS 49 PRECEDING) AS covered
  FROM (SELECT doc_id, p, substr(h, 2 * p + 1, 2) AS hex FROM (
    SELECT doc_id, h, unnest(range(n)) AS p FROM texts WHERE doc_id IN (SELECT doc_id FROM gone))) b
  LEFT JOIN gone g ON g.doc_id = b.doc_id AND g.p = b.p),
marked AS (SELECT *, lag(covered, 1, 0) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM bytes),
kept AS (
  SELECT doc_id, sum(covered) AS n_removed, count(*) FILTER (covered = 1 AND before = 0) AS n_spans,
    coalesce(string_agg(hex, '' ORDER BY p) FILTER (covered = 0), '') AS rest
  FROM marked GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""

ORACLES = {
    "op3_quality_rules": QUALITY_RULES,
    "op5_jaccard": JACCARD,
    "op6_repeats": REPEATS,
}
