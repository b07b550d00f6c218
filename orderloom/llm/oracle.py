"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from orderloom.llm import decontaminate, line_quality
from orderloom.llm.common import LOWER, UPPER, WORD

SPACE = r"[\x20\x09-\x0D]"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


LINE_QUALITY = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT doc_id, text, regexp_extract_all(text, '{WORD}') AS w FROM texts
), windows AS (
  SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)
), often AS (
  SELECT doc_id, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM often)
  GROUP BY doc_id
), lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS no, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM texts)
), full_lines AS (
  SELECT doc_id, no, line, regexp_extract_all(line, '{WORD}') AS w,
    translate(line, '{UPPER}', '{LOWER}') AS low
  FROM lines
), ruled AS (
  SELECT doc_id, no, line, w, len(w) AS n,
    regexp_matches(line, {_text(line_quality.ANY_MARK)}) AS marked,
    len(w) > 0 AND NOT (
      3 * len(regexp_extract_all(line, {_text(line_quality.SYMBOL_RUN)})) >= len(w)
      OR 4 * len([x for x in w if regexp_full_match(x, {_text(line_quality.SEPARATOR_WORD)})]) >= len(w)
      OR (len(w) <= 40 AND (regexp_full_match(low, {_text(line_quality.MENU_LINE)})
        OR regexp_matches(low, {_text(line_quality.BOILERPLATE)})))) AS prose
  FROM full_lines
), blocks AS (
  SELECT *, prose AND (marked OR n >= 4) AS in_block,
    sum(CASE WHEN prose AND (marked OR n >= 4) THEN 0 ELSE 1 END)
      OVER (PARTITION BY doc_id ORDER BY no) AS block,
    length(array_to_string(w, ' ')) AS size,
    regexp_matches(line, {_text(line_quality.MARK_AT_END)}) AS ended
  FROM ruled
), nexts AS (
  SELECT doc_id, no, block, marked, ended, size, lead(w[1]) OVER (PARTITION BY doc_id, block ORDER BY no) AS after,
    max(size) OVER (PARTITION BY doc_id, block) AS width,
    count(*) OVER (PARTITION BY doc_id, block) - 1 AS breaks
  FROM blocks WHERE in_block
), widths AS (
  SELECT *, count(*) FILTER (size + 1 + length(after) > width) OVER (PARTITION BY doc_id, block) AS n_full,
    regexp_extract(after, '[\p{{L}}\p{{N}}]') AS start
  FROM nexts
), links AS (
  SELECT doc_id, no, block, marked, after IS NOT NULL AND NOT ended AND (
      (size + 1 + length(after) > width AND n_full >= greatest(3, breaks / 2))
      OR (start != '' AND NOT regexp_matches(start, '[\p{{Lu}}\x{{2160}}-\x{{216F}}]'))) AS goes_on
  FROM widths
), begins AS (
  SELECT *, NOT lag(goes_on, 1, false) OVER (PARTITION BY doc_id, block ORDER BY no) AS new FROM links
), chains AS (
  SELECT *, count(*) FILTER (new) OVER (PARTITION BY doc_id, block ORDER BY no) AS chain FROM begins
), saved AS (
  SELECT doc_id, no, bool_or(marked) OVER (PARTITION BY doc_id, block, chain) AS stays FROM chains
), judged AS (
  SELECT doc_id, line, list_sum([length(x) for x in w]) AS chars,
    row_number() OVER (PARTITION BY doc_id, line ORDER BY no) > 1 AS dup,
    NOT coalesce(stays, marked AND prose) AS fails
  FROM ruled LEFT JOIN saved USING (doc_id, no) WHERE n > 0
), per_doc AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (fails) AS n_lines_removed,
    count(*) FILTER (dup) AS n_dup_lines, coalesce(sum(chars) FILTER (fails), 0) AS lost_chars
  FROM judged GROUP BY doc_id
), counts AS (
  SELECT doc_id, len(w) AS n_words,
    coalesce(list_sum([length(x) for x in w]), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_lines_removed, 0) AS n_lines_removed,
    coalesce(lost_chars, 0)::BIGINT AS lost_chars
  FROM words LEFT JOIN per_doc USING (doc_id) LEFT JOIN repeats USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost_chars <= 0.5 * word_chars AS kept
FROM counts
"""


DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
    '{decontaminate.WORD}'), []) AS w
  FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
    '{decontaminate.WORD}') AS w
  FROM benchmark
), items AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, w[i : i + least(len(w), 10) - 1] AS win
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), windows AS (
  SELECT doc_id, n, i, w[i : i + n - 1] AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
    FROM d, (SELECT DISTINCT n FROM items) WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, i, n, item FROM windows JOIN items USING (n, win)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, list_sort(list(DISTINCT item)) AS names
  FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(array_to_string(names, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

URL_RULES = f"""
WITH parsed AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3)
    ELSE '' END AS rest
  FROM pages
), pages_ AS (
  SELECT page_id, row_number() OVER () AS no,
    translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM parsed
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
)
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(verdict, 'allow') AS verdict
FROM pages_ LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
  AND starts_with(path, rule_path)
QUALIFY row_number() OVER (PARTITION BY no ORDER BY length(rule_host || rule_path) DESC) = 1
"""

ARC_TO_WARC = """
WITH pages_ AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), ranked AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM pages_
), typed AS (
  SELECT *, payload_bytes >= 1000 AND top IS NOT NULL AND (page_id IS NULL OR page_id < top) AS again
  FROM ranked
)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN top END AS refers_to
FROM typed
"""

SQL: dict[str, str] = {
    "op4_url_cascade": URL_RULES,
    "op2_line_quality": LINE_QUALITY,
    "op7_decontamination": DECONTAMINATION,
    "op8_arc_to_warc": ARC_TO_WARC,
}
