"""The quality rules in SQL, over the same words, hashes and whole millionths."""

from __future__ import annotations

from tidemark.llm.rules import (
    BUCKETS, FACTORS, LEAST_WORDS, MOST_REPEATED, PAIR, PRIME, SMOOTH, THRESHOLD, UNIT)

_WORD = r"[^\x20\x09-\x0D]"

RULES = rf"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), trusted AS (
    SELECT doc_id FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL
    GROUP BY doc_id HAVING min(quality) = 1 AND max(quality) = 1
), listed AS MATERIALIZED (
    SELECT r, doc_id, regexp_extract_all(text, '{_WORD}+') AS words FROM docs
), words AS MATERIALIZED (
    SELECT r, generate_subscripts(words, 1) AS i, unnest(words) AS word FROM listed
), bytes AS (
    SELECT word, hex(encode(word)) AS digits FROM (SELECT DISTINCT word FROM words)
), hashes AS MATERIALIZED (
    SELECT word, list_sum(list_transform(range(0, length(digits) // 2), lambda i:
        (('0x' || substr(digits, 2 * i + 1, 2))::BIGINT + 1) * ({FACTORS.tolist()}::BIGINT[])[(i % {len(FACTORS)}) + 1]
    ))::BIGINT % {PRIME} AS h FROM bytes
), placed AS MATERIALIZED (
    SELECT r, i, word, h, lead(h) OVER (PARTITION BY r ORDER BY i) AS next_h,
        lead(word, 1) OVER (PARTITION BY r ORDER BY i) AS second, lead(word, 2) OVER (PARTITION BY r ORDER BY i) AS third
    FROM words JOIN hashes USING (word)
), grams AS MATERIALIZED (
    SELECT r, h % {BUCKETS} AS bucket FROM placed
    UNION ALL SELECT r, (h * {PAIR} + next_h) % {BUCKETS} FROM placed WHERE next_h IS NOT NULL
), counted AS (
    SELECT bucket, count(*) AS n, count(*) FILTER (doc_id IN (SELECT doc_id FROM trusted)) AS n_trusted
    FROM grams JOIN docs USING (r) GROUP BY bucket
), totals AS (
    SELECT sum(n_trusted)::DOUBLE / sum(n)::DOUBLE AS share FROM counted
), ratios AS MATERIALIZED (
    SELECT bucket, CASE WHEN share > 0 THEN
        floor(ln((n_trusted + {SMOOTH} * share) / (share * (n + {SMOOTH}))) * {UNIT} + 0.5)::BIGINT ELSE 0 END AS ratio
    FROM counted, totals
), scored AS (
    SELECT r, sum(ratio)::BIGINT AS total, count(*) AS n_grams FROM grams JOIN ratios USING (bucket) GROUP BY r
), windows AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, word, second, third) AS times FROM placed WHERE third IS NOT NULL
), covered AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM windows, (VALUES (0), (1), (2)) AS v(k) WHERE times > 1 GROUP BY r
), lines AS (
    SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs
), repeated AS (
    SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE regexp_matches(line, '{_WORD}') GROUP BY r
), base AS (
    SELECT r, docs.doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        coalesce(total, 0) AS total, coalesce(n_grams, 0) AS n_grams
    FROM docs JOIN listed USING (r) LEFT JOIN repeated USING (r) LEFT JOIN covered USING (r) LEFT JOIN scored USING (r)
), judged AS (
    SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND total >= {int(round(THRESHOLD * UNIT))} * n_grams AS kept
FROM judged
"""
