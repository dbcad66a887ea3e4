"""The same results in DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

from .quality_rules import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

#: Verdict of the quality rules for each row of the view {docs}.
QUALITY_OF = r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM {docs}
), windows AS (
    SELECT doc_id, unnest(range(1, greatest(len(ws) - 3, 1))) AS i, ws FROM texts
), found AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i:i + 4]) AS n FROM windows
), repeats AS (
    SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM found, range(5) AS r(j) WHERE n > 1 GROUP BY doc_id
), lines AS (
    SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM texts
), counts AS (
    SELECT t.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        (length(t.t) - length(regexp_replace(t.t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        len(list_filter(ws, lambda x: x IN ({stop})))::BIGINT AS n_stop_words
    FROM texts t JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)
), judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND n_words <= 1000000 AND word_chars / n_words BETWEEN 2 AND 12 AND n_symbols / n_words <= 0.1
        AND (n_words < 30 OR n_stop_words / n_words >= 0.02)
        AND (n_lines = 0 OR n_dup_lines / n_lines <= 0.4) AS kept
FROM judged
"""

QUALITY = QUALITY_OF.replace("{docs}", "documents").replace("{stop}", _STOP)

#: Phrases by plain counting of all word sequences and all cuts.
COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), places AS (
    SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM split
), grams AS (
    SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, m, count(*) AS f
    FROM places, range(1, 6) AS r(m) WHERE i + m - 1 <= len(ws) GROUP BY ALL
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE m = 1 GROUP BY lang
), candidates AS (
    SELECT lang, phrase, m, f AS a FROM grams WHERE m > 1 AND f >= 100
), inside AS (
    SELECT DISTINCT c.lang, array_to_string(list_slice(string_split(c.phrase, ' '), b, b + k - 1), ' ') AS phrase, c.a AS longer
    FROM candidates c, range(2, 5) AS s(k), range(1, 5) AS t(b) WHERE k < c.m AND b + k - 1 <= c.m
), kept AS (
    SELECT * FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.longer >= 100 * c.a)
), cuts AS (
    SELECT lang, phrase, a, k, array_to_string(list_slice(string_split(phrase, ' '), 1, k), ' ') AS first,
        array_to_string(list_slice(string_split(phrase, ' '), k + 1, m), ' ') AS rest
    FROM kept, range(1, 5) AS r(k) WHERE k < m
), scored AS (
    SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, n, (1000::HUGEINT * c.a * n // (x.f::HUGEINT * y.f))::BIGINT AS score,
        row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY 1000::HUGEINT * c.a * n // (x.f::HUGEINT * y.f), k) AS nth
    FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = c.first AND x.m = k
        JOIN grams y ON y.lang = c.lang AND y.phrase = c.rest AND y.m = len(string_split(c.phrase, ' ')) - k JOIN totals t ON t.lang = c.lang
), ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM scored WHERE nth = 1
)
SELECT * FROM ranked WHERE rank <= 2000
"""
