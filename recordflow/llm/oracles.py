"""DuckDB SQL for the queries that SQL can express."""

_LINES = r"""
lines AS (
  SELECT r, pos, line, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')) AS bare
  FROM (SELECT r, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos
        FROM (SELECT r, string_split(t, chr(10)) AS l FROM d))),
counted AS (
  SELECT *, lower(bare) AS low,
    CASE WHEN bare = '' THEN 0 ELSE length(bare) - length(replace(bare, ' ', '')) + 1 END AS n,
    length(bare) - length(translate(bare, '|»›•·', '')) AS seps,
    len(regexp_extract_all(bare, '[#*$%&|<>]|!!+')) AS marks,
    length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars
  FROM lines),
ruled AS (
  SELECT *, CASE
    WHEN bare = '' THEN NULL
    WHEN seps >= 2 AND seps * 4 >= n THEN 'navigation'
    WHEN n <= 3 AND regexp_matches(low, '^(home|menu|login|log in|sign in|sign up|register|search|next|previous|back|top|contact|about us|sitemap|share|print|read more)\W*$') THEN 'navigation'
    WHEN marks > n * 0.3::DOUBLE OR (upper(bare) = bare AND low <> bare AND n >= 3) THEN 'punctuation'
    WHEN n >= 8 AND NOT regexp_matches(right(bare, 8), '[.!?…:;。！？]["''”’»)\]]*$') THEN 'punctuation'
    WHEN regexp_matches(low, 'all rights reserved|cookie policy|privacy policy|terms of use|terms of service|enable javascript|use of cookies|lorem ipsum|subscribe to our newsletter|click here|powered by|alle rechte vorbehalten|tous droits réservés|todos los derechos reservados') THEN 'boilerplate'
    END AS rule
  FROM counted),
byline AS (
  SELECT r,
    count(*) FILTER (chars > 0) - count(DISTINCT line) FILTER (chars > 0) AS n_dup_lines,
    coalesce(sum(chars) FILTER (rule = 'punctuation'), 0)::BIGINT AS lost_punctuation,
    coalesce(sum(chars) FILTER (rule = 'navigation'), 0)::BIGINT AS lost_navigation,
    coalesce(sum(chars) FILTER (rule = 'boilerplate'), 0)::BIGINT AS lost_boilerplate
  FROM ruled GROUP BY r)
"""

ORACLES = {
    "op1_quality_rules": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
{_LINES},
w AS (
  SELECT r, unnest(l) AS w, unnest(range(1, len(l) + 1)) AS i
  FROM (SELECT r, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l FROM d)),
win AS (
  SELECT r, i, w AS a, lead(w) OVER p AS b, lead(w, 2) OVER p AS c FROM w WINDOW p AS (PARTITION BY r ORDER BY i)),
found AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS k FROM win WHERE c IS NOT NULL) WHERE k > 1),
rep AS (
  SELECT r, count(DISTINCT i + o) AS n FROM found, (SELECT unnest([0, 1, 2]) AS o) GROUP BY r),
words AS (SELECT r, count(*) AS n, sum(length(w)) AS chars FROM w GROUP BY r),
f AS (
  SELECT d.doc_id, coalesce(words.n, 0) AS n_words, coalesce(words.chars, 0)::BIGINT AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, b.n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words, b.lost_punctuation, b.lost_navigation, b.lost_boilerplate
  FROM d JOIN byline b USING (r) LEFT JOIN words USING (r) LEFT JOIN rep USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND lost_punctuation + lost_navigation + lost_boilerplate <= word_chars * 0.5::DOUBLE AS kept
FROM f
""",
}
