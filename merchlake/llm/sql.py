"""SQL twins of the queries, for DuckDB."""

from __future__ import annotations

from merchlake.llm.licences import COPYRIGHT_LINE, KNOWN, SEPARATORS, SPELLINGS
from merchlake.llm.rules import BITS, CURRENT, RULES


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

# The checksum is carried from byte to byte with the table of the reflected polynomial.
SHARDS = """
WITH crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)),
                          lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS n))
), sized AS (
  SELECT doc_id, coalesce(strlen(text), 0) + 8 AS size,
         xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                                                   lambda h: ('0x' || h)::BIGINT)),
           lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8))) AS text_crc32
  FROM documents, crc_table
), summed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING) AS upto,
         sum(size) OVER () AS total
  FROM sized
), cut AS (
  SELECT *, least(23, ((2 * upto - size) * 24 // (2 * total)))::INTEGER AS shard FROM summed
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
       NULL::INTEGER AS grown_shard
FROM cut
"""


def canonical(text: str) -> str:
    """Twin of licences.canonical."""
    words = f"regexp_replace(regexp_replace(lower({text}), {quoted(COPYRIGHT_LINE)}, ' ', 'g'), {quoted(SEPARATORS)}, '  ', 'g')"
    for pattern, spelling in SPELLINGS:
        groups = spelling.replace("\\2", "\\3").replace("\\1", "\\2")
        last = 2 + pattern.count("(")
        words = f"regexp_replace({words}, {quoted(f'(^| ){pattern}( |$)')}, {quoted(f'{chr(92)}1{groups}{chr(92)}{last}')}, 'g')"
    return f"trim(regexp_replace({words}, ' +', ' ', 'g'))"


LICENCES = f"""
WITH known AS (
  SELECT digest, min(licence_id) AS licence_id FROM (
    SELECT licence_id, sha256({canonical("text")}) AS digest
    FROM (VALUES {", ".join(f"({quoted(i)}, {quoted(t)})" for i, t in KNOWN)}) k(licence_id, text))
  GROUP BY digest
), lines AS (
  SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)
), hits AS (
  SELECT doc_id, array_to_string(list_sort(list_distinct(list(licence_id))), ',') AS notice_ids, count(*) AS n
  FROM lines JOIN known ON sha256({canonical("line")}) = digest GROUP BY doc_id
)
SELECT d.doc_id, k.licence_id,
       coalesce(h.notice_ids, '') AS notice_ids, coalesce(h.n, 0)::BIGINT AS n_notice_lines
FROM documents d
LEFT JOIN known k ON k.digest = sha256({canonical("coalesce(d.text, '')")})
LEFT JOIN hits h ON h.doc_id = d.doc_id
"""


WARC = r"""
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS payload, coalesce(url, '') AS url,
         regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)', ['host', 'rest']) AS u
  FROM pages
), keyed AS (
  SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest,
         CASE WHEN u.host = '' AND u.rest = '' THEN lower(url) ELSE
           array_to_string(list_reverse(string_split(
             regexp_replace(regexp_replace(regexp_replace(lower(u.host), '^.*@', ''), ':[0-9]+$', ''), '^www\.', ''), '.')), ',')
           || ')' || CASE WHEN u.rest = '' THEN '/' ELSE lower(u.rest) END END AS urlkey
  FROM sized
), judged AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM keyed
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to,
       urlkey, row_number() OVER (ORDER BY urlkey, page_id) - 1 AS position,
       row_number() OVER (PARTITION BY urlkey ORDER BY page_id) AS capture
FROM judged
"""


_WORD = "[^\\x20\\x09-\\x0D]"
_CASES = " + ".join(f"CASE WHEN {failure} THEN {1 << i} ELSE 0 END" for i, (_, failure) in enumerate(RULES))

RULE_LEDGER = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS w
  FROM documents
), windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS c FROM windows), (VALUES (0), (1), (2)) v(k)
  WHERE c > 1 GROUP BY r
), lines AS (
  SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS again
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_WORD}') GROUP BY r
), measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(l.again, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         coalesce(l.n, 0)::BIGINT AS n_lines, (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::BIGINT AS n_capitals
  FROM d LEFT JOIN covered c USING (r) LEFT JOIN lines l USING (r)
)
SELECT *, ({_CASES})::BIGINT AS failed_bits, '{CURRENT.version}' AS policy,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, ({_CASES}) & {sum(BITS[n] for n in CURRENT.hard)} = 0 AS kept
FROM measured
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
         list_sum(list_transform(list_zip(a.w, c.w), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
