"""The SQL, for DuckDB, of the queries that SQL can express."""

from swipeledger.llm import license_scan

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_QUALITY = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents
), cut AS (
  SELECT k, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM texts
), lines AS (
  SELECT *, row_number() OVER (PARTITION BY k, line ORDER BY pos) > 1 AS again,
         length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS symbols,
         length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
  FROM (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM cut)
  WHERE len(w) > 0
), judged AS (
  SELECT *,
    again
    OR NOT regexp_matches(w[-1], '[.!?…"''”’»)\]:;。]$')
    OR symbols > 0.1 * len(w)
    OR len(list_filter(w, lambda x: x = '|' OR x = '>')) >= 2
    OR len(string_split(line, '!!')) - 1 > 0.3 * len(w)
    OR (NOT regexp_matches(line, '[a-z]') AND length(regexp_replace(line, '[^A-Z]', '', 'g')) >= 10)
    OR (len(w) >= 10 AND len(list_distinct(w)) < 0.3 * len(w))
    OR regexp_matches(line, '(?i)all rights reserved|cookie policy|privacy policy|terms of use|terms of service|released under the|licensed under|javascript|lorem ipsum|click here|read more|sign up|log in|subscribe to|share this|skip to content|back to top')
      AS fails
  FROM lines
), by_text AS (
  SELECT k, count(*) AS n_lines, count(*) FILTER (again) AS n_dup_lines, count(*) FILTER (fails) AS n_removed_lines,
         coalesce(sum(chars) FILTER (NOT fails), 0) AS chars_left
  FROM judged GROUP BY k
), windows AS (
  SELECT k, pos, count(*) OVER (PARTITION BY k, a, b, c) > 1 AS again
  FROM (SELECT k, pos, words[pos] AS a, words[pos + 1] AS b, words[pos + 2] AS c
        FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS pos FROM texts WHERE len(words) > 2))
), inside AS (
  SELECT k, count(DISTINCT pos + shift) AS n
  FROM windows, (VALUES (0), (1), (2)) AS s(shift) WHERE again GROUP BY k
), counted AS (
  SELECT doc_id, len(words) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_removed_lines, 0) AS n_removed_lines,
         CAST(coalesce(chars_left, 0) AS BIGINT) AS chars_left
  FROM texts LEFT JOIN by_text USING (k) LEFT JOIN inside USING (k)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * chars_left >= 70 * word_chars AS kept
FROM counted
"""

_PERSPECTIVES = """
WITH turns AS (
  SELECT conv_id, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS seq
  FROM conversations
), people AS (
  SELECT DISTINCT conv_id, speaker AS me FROM turns WHERE speaker <> 'system'
), said AS (
  SELECT t.conv_id, me, t.speaker, seq, seq // 256 AS part,
         '<|im_start|>' || CASE WHEN t.speaker = 'system' THEN 'system' WHEN t.speaker = me THEN 'assistant'
                                ELSE 'user name=' || t.speaker END || chr(10) AS head,
         t.text || '<|im_end|>' || chr(10) AS body
  FROM turns t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), placed AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, me, part ORDER BY seq) AS upto FROM said
), parts AS (
  SELECT conv_id, me AS speaker, part, count(*) AS n_turns, string_agg(head || body, '' ORDER BY seq) AS dialogue,
         coalesce(string_agg(CAST(upto - length(body) AS BIGINT) || '-' || CAST(upto AS BIGINT), ' ' ORDER BY seq)
                  FILTER (speaker = me), '') AS masks
  FROM placed GROUP BY conv_id, me, part
)
SELECT *, CAST(coalesce(sum(length(dialogue)) OVER (PARTITION BY conv_id, speaker ORDER BY part
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
FROM parts
"""

_HARD_NEGATIVES = """
WITH taking_part AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         CAST(list_sum(list_transform(list_zip(a.vec, r.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM taking_part a JOIN taking_part r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 10
"""


def _license_scan() -> str:
    """The templates stand in the SQL; hits of notices are grouped by diagonal as the operator states it."""
    rows = ", ".join(
        f"({n}, '{t.label}', {str(t.phrase).lower()}, {str(t.base).lower()}, string_split('{t.text}', ' '))"
        for n, t in enumerate([*license_scan.BASE, *license_scan.FURTHER])
    )
    return rf"""
WITH templates(template, label, phrase, base, tw) AS (VALUES {rows}),
texts AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), tokens AS (
  SELECT k, words, unnest(range(1, len(words) + 1)) AS pos FROM texts
), phrases AS (
  SELECT k, label, base, pos - 1 AS first, 1.0::DOUBLE AS share
  FROM tokens JOIN templates ON phrase AND words[pos] = tw[1] AND words[pos:pos + len(tw) - 1] = tw
), grams AS (
  SELECT template, label, len(tw) AS size, place, tw[place + 1:place + 4] AS gram
  FROM (SELECT *, unnest(range(0, len(tw) - 3)) AS place FROM templates WHERE NOT phrase)
), hits AS (
  SELECT DISTINCT k, template, label, size, place, pos - 1 AS spot
  FROM tokens JOIN grams ON words[pos] = gram[1] AND words[pos:pos + 3] = gram
), islands AS (
  SELECT *, sum(begins) OVER (PARTITION BY k, template ORDER BY diagonal RANGE UNBOUNDED PRECEDING) AS island
  FROM (SELECT *, spot - place AS diagonal,
               CASE WHEN coalesce(spot - place - lag(spot - place) OVER (PARTITION BY k, template ORDER BY spot - place, place) > 4, true) THEN 1 ELSE 0 END AS begins
        FROM hits)
), notices AS (
  SELECT k, label, false AS base, min(spot) AS first, share FROM (
    SELECT k, template, label, island, size, spot, max(spot + 4) OVER i - min(spot) OVER i AS length FROM islands WINDOW i AS (PARTITION BY k, template, island)
  ) JOIN (
    SELECT k, template, island, count(DISTINCT place + shift) / any_value(size) AS share
    FROM islands, (VALUES (0), (1), (2), (3)) AS s(shift) GROUP BY k, template, island
  ) USING (k, template, island)
  WHERE share >= 0.6 AND length <= 1.5 * size
  GROUP BY k, template, label, island, share
), found AS (
  SELECT k, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
         coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score, count(*) AS n_spans
  FROM (SELECT * FROM phrases UNION ALL SELECT * FROM notices) GROUP BY k
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score, coalesce(n_spans, 0) AS n_spans
FROM texts LEFT JOIN found USING (k)
"""


ORACLE = {
    "op2_line_quality": _QUALITY,
    "op7_perspectives": _PERSPECTIVES,
    "op11_hard_negatives": _HARD_NEGATIVES,
    "op12_license_scan": _license_scan(),
}
