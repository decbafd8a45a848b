"""Answers of the SQL-expressible operators, in DuckDB's SQL."""

from __future__ import annotations

from estatelens.llm.distribution_rules import (
    CLASS_DISTANCE,
    CLASS_WORDS,
    COMMON_DISTANCE,
    COMMON_WORDS,
    LEAST_TEXTS,
    LISTED_WORDS,
)
from estatelens.llm.secret_scan import FURTHER_RULES

_SOURCES = """
    SELECT doc_id, source, coalesce(text, '') AS text, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS draw,
           md5(coalesce(text, '')) AS text_draw,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
    FROM documents
"""

#: Targets by sharing again and again: each round stops the sources whose share is over their stop.
OP9_MIXING = rf"""
WITH RECURSIVE sized AS ({_SOURCES}),
per_source AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place
    FROM sized GROUP BY source
),
weighted AS (
    SELECT *, CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2 * source_size AS stop FROM per_source
),
whole AS (SELECT sum(source_size) * 150 AS hundredths FROM per_source),
rounds(n, place, stopped) AS (
    SELECT 0, place, FALSE FROM weighted
    UNION ALL
    SELECT r.n + 1, r.place,
           r.stopped OR (h.hundredths - sum(CASE WHEN r.stopped THEN w.stop ELSE 0 END) OVER () * 100)
               / (sum(CASE WHEN r.stopped THEN 0 ELSE w.weight END) OVER () * 100) * w.weight >= w.stop
    FROM rounds r JOIN weighted w USING (place) CROSS JOIN whole h
    WHERE r.n < (SELECT count(*) FROM weighted)
),
settled AS (
    SELECT r.place, r.stopped FROM rounds r WHERE r.n = (SELECT max(n) FROM rounds)
),
targets AS (
    SELECT w.source, w.place, w.source_size,
           CASE WHEN s.stopped THEN CAST(w.stop AS DOUBLE)
                ELSE (h.hundredths - sum(CASE WHEN s.stopped THEN w.stop ELSE 0 END) OVER () * 100)
                    / (sum(CASE WHEN s.stopped THEN 0 ELSE w.weight END) OVER () * 100) * w.weight END AS target
    FROM weighted w JOIN settled s USING (place) CROSS JOIN whole h
),
placed AS (
    SELECT d.*, t.source_size, t.target, t.place,
           coalesce(sum(d.size) OVER (
               PARTITION BY t.place ORDER BY d.draw, d.doc_id, d.text_draw, d.size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
),
counted AS (
    SELECT *, CASE WHEN size = 0 THEN 0 ELSE least(2, CAST(floor(target / source_size) AS BIGINT)
        + CASE WHEN ahead * 2 + size <= (target - floor(target / source_size) * source_size) * 2 THEN 1 ELSE 0 END
        ) END AS copies,
        CASE place % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 1.0 END AS a,
        CASE place % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 3.0 ELSE 1.0 END AS b,
        least(ahead / target, 1.0) AS share
    FROM placed
)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken,
       CASE WHEN copies > 0 THEN CAST(round(2 * (share * (CAST(a AS DOUBLE) + CAST(b AS DOUBLE)) / 2)
           / (CAST(a AS DOUBLE) + sqrt(greatest(CAST(a AS DOUBLE) * CAST(a AS DOUBLE)
              + 2 * (CAST(b AS DOUBLE) - CAST(a AS DOUBLE))
              * (share * (CAST(a AS DOUBLE) + CAST(b AS DOUBLE)) / 2), 0.0))), 9) AS DOUBLE) END AS first_position
FROM counted
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6_CONTAMINATION = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS words FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(10, len(words)) AS length, list_slice(words, pos, pos + least(10, len(words)) - 1) AS window_words
    FROM (SELECT *, unnest(generate_series(1, len(words) - least(10, len(words)) + 1)) AS pos FROM items WHERE len(words) > 0)
),
lengths AS (SELECT DISTINCT length FROM windows),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
places AS (
    SELECT r, words, length, unnest(generate_series(1, len(words) - length + 1)) AS pos
    FROM docs CROSS JOIN lengths WHERE len(words) >= length
),
hits AS (
    SELECT p.r, p.pos, p.length, w.item_id
    FROM (SELECT r, pos, length, list_slice(words, pos, pos + length - 1) AS window_words FROM places) p
    JOIN windows w USING (length, window_words)
),
hit_words AS (SELECT r, count(*) AS n FROM (
    SELECT DISTINCT r, unnest(generate_series(pos, pos + length - 1)) AS word FROM hits) GROUP BY r),
hit_items AS (
    SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT r, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(w.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n, 0) AS BIGINT) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(w.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words w USING (r) LEFT JOIN hit_items i USING (r)
"""



def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: Histograms as rows (text, kind, bin, count), references as their sums by language, distances as sums over bins.
OP7_QUALITY_RULES = rf"""
WITH numbered AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, 'is ' || lang AS language,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
held AS (SELECT DISTINCT r, language, lower(unnest(words)) AS word FROM numbered WHERE language IS NOT NULL),
frequent AS (
    SELECT language, word, row_number() OVER (PARTITION BY language ORDER BY count(*) DESC, word) AS bin
    FROM held WHERE NOT regexp_matches(word, '[\x00-\x60\x7B-\x7F]')
    GROUP BY language, word HAVING count(*) >= {LEAST_TEXTS}
),
common_words AS (
    SELECT * FROM frequent
    WHERE bin <= {LISTED_WORDS} AND language IN (SELECT language FROM frequent WHERE bin = {LISTED_WORDS})
),
docs AS (
    SELECT r, doc_id, text, words,
           CASE WHEN language IN (SELECT language FROM common_words) THEN language ELSE 'others' END AS language
    FROM numbered
),
doc_words AS (
    SELECT r, language, unnest(words) AS word, unnest(generate_series(1, len(words))) AS pos FROM docs WHERE len(words) > 0
),
windows AS (
    SELECT r, pos, words[pos : pos + 4] AS shown
    FROM (SELECT r, words, unnest(generate_series(1, len(words) - 4)) AS pos FROM docs WHERE len(words) >= 5)
),
repeated AS (SELECT r, pos FROM (SELECT *, count(*) OVER (PARTITION BY r, shown) AS times FROM windows) WHERE times > 1),
repeat_words AS (
    SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(generate_series(pos, pos + 4)) AS word FROM repeated) GROUP BY r
),
filled_lines AS (
    SELECT r, line FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
dup_lines AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM filled_lines GROUP BY r),
measured AS (
    SELECT d.r, d.doc_id, d.language, length(d.text) AS size, len(d.words) AS n_words,
           length(array_to_string(d.words, '')) AS word_chars, coalesce(l.n, 0) AS n_dup_lines,
           coalesce(w.n, 0) AS n_repeat_words, len(regexp_extract_all(d.text, '[#*$%&|<>]')) AS n_symbols,
           len(regexp_extract_all(d.text, '[A-Z]')) AS n_upper, len(regexp_extract_all(d.text, '[0-9]')) AS n_digit,
           len(regexp_extract_all(d.text, '[!?]')) AS n_mark, len(regexp_extract_all(d.text, '[.,;:''"()-]')) AS n_stop
    FROM docs d LEFT JOIN dup_lines l USING (r) LEFT JOIN repeat_words w USING (r)
),
seen AS (
    SELECT d.r, c.bin, count(*) AS n
    FROM doc_words d JOIN common_words c ON c.language = d.language AND c.word = lower(d.word) GROUP BY d.r, c.bin
),
rest AS (
    SELECT m.r, m.n_words - coalesce(sum(s.n), 0) AS n FROM measured m LEFT JOIN seen s USING (r) GROUP BY m.r, m.n_words
),
histograms AS (
    SELECT r, language, 'class' AS kind,
           unnest(['space', 'symbol', 'upper', 'digit', 'mark', 'stop', 'letter']) AS bin,
           unnest([size - word_chars, n_symbols, n_upper, n_digit, n_mark, n_stop,
                   word_chars - n_symbols - n_upper - n_digit - n_mark - n_stop]) AS n
    FROM measured
    UNION ALL
    SELECT m.r, m.language, 'common', CAST(c.bin AS VARCHAR), coalesce(s.n, 0)
    FROM measured m JOIN common_words c USING (language) LEFT JOIN seen s ON s.r = m.r AND s.bin = c.bin
    UNION ALL
    SELECT m.r, m.language, 'common', 'rest', q.n FROM measured m JOIN rest q USING (r)
),
reference AS (SELECT language, kind, bin, CAST(sum(n) AS DOUBLE) AS n FROM histograms GROUP BY ALL),
shares AS (
    SELECT h.r, h.kind,
           coalesce(h.n / nullif(CAST(sum(h.n) OVER (PARTITION BY h.r, h.kind) AS DOUBLE), 0), 0) AS p,
           coalesce(f.n / nullif(sum(f.n) OVER (PARTITION BY h.r, h.kind), 0), 0) AS q
    FROM histograms h JOIN reference f USING (language, kind, bin)
),
distances AS (
    SELECT r, kind, sqrt(greatest(sum(
        CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
        + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS js
    FROM shares GROUP BY r, kind
),
judged AS (
    SELECT m.*, a.js AS class_js, b.js AS common_js,
           m.n_words < 10 OR 100 * m.n_repeat_words > 20 * m.n_words AS base_failed
    FROM measured m JOIN distances a ON a.r = m.r AND a.kind = 'class' JOIN distances b ON b.r = m.r AND b.kind = 'common'
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       round(class_js, 6) AS class_js, round(common_js, 6) AS common_js,
       NOT base_failed AND NOT (n_words >= {CLASS_WORDS} AND class_js > {CLASS_DISTANCE})
           AND NOT (n_words >= {COMMON_WORDS} AND common_js > {COMMON_DISTANCE}) AS kept
FROM judged
"""

#: The contract's kinds as ``kind, pattern, group, least``.
_SECRET_KINDS = [
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
]


def _secret_matches(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    shown = _quoted(pattern)
    return f"""
    SELECT r, {rank} AS place, '{kind}' AS kind, unnest(regexp_extract_all(text, {shown}, 0)) AS shown,
           unnest(regexp_extract_all(text, {shown}, {group})) AS checked, {least} AS least,
           unnest(list_slice(string_split_regex(text, {shown}), 1, -2)) AS gap,
           unnest(generate_series(1, len(regexp_extract_all(text, {shown}, 0)))) AS i
    FROM docs"""


_SECRET_MATCHES = " UNION ALL ".join(
    _secret_matches(rank, *rule) for rank, rule in enumerate([*_SECRET_KINDS, *[tuple(r) for r in FURTHER_RULES]])
)

#: A match starts after what lies between the matches before it and those matches themselves.
OP8_SECRETS = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({_SECRET_MATCHES}),
ended AS (
    SELECT *, sum(length(gap) + length(shown)) OVER (PARTITION BY r, place ORDER BY i ROWS UNBOUNDED PRECEDING) AS stop FROM found
),
spans AS (
    SELECT r, place, kind, stop - length(shown) AS start,
           kind || ':' || CAST(CAST(stop - length(shown) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(stop AS BIGINT) AS VARCHAR) AS span
    FROM ended WHERE length(checked) >= least
),
per_text AS (
    SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY start, place) AS spans,
           string_agg(span, ',' ORDER BY start, place) FILTER (place < 3) AS base
    FROM spans GROUP BY r
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN per_text USING (r)
"""

#: Cuts, forms and digests from the draws; the restored text is the text itself.
OP12_FILL_MIDDLE = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
           sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw
    FROM documents
),
drawn AS (
    SELECT *, CAST(len(units) AS BIGINT) AS n,
           list_transform(range(4), lambda i: CAST('0x' || substr(draw, CAST(8 * i + 1 AS BIGINT), 8) AS BIGINT)) AS h
    FROM docs
),
cut AS (
    SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50
                THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
),
parts AS (
    SELECT *, coalesce(array_to_string(units[1:low], ''), '') AS prefix,
           coalesce(array_to_string(units[low + 1:high], ''), '') AS middle,
           coalesce(array_to_string(units[high + 1:n], ''), '') AS suffix
    FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

#: CRC-32 by a table of 256 remainders, made from the polynomial; then counts by bucket, gains and ranks.
OP13_RESAMPLING = f"""
WITH remainders AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda v, bit: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) ORDER BY i) AS t
    FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))
),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
used AS (SELECT r, unnest(words) AS word FROM docs),
wanted AS (SELECT unnest(words) AS word FROM (SELECT {_WORDS} AS words FROM benchmark)),
vocabulary AS (SELECT word, hex(encode(word)) AS code FROM (SELECT word FROM used UNION SELECT word FROM wanted)),
hashed AS (
    SELECT word, CAST(xor(list_reduce(
               list_prepend(4294967295, list_transform(range(CAST(length(code) / 2 AS BIGINT)),
                   lambda k: CAST('0x' || substr(code, CAST(2 * k + 1 AS BIGINT), 2) AS BIGINT))),
               lambda c, byte: xor(c >> 8, t[CAST(xor(c, byte) & 255 AS BIGINT) + 1])), 4294967295) AS BIGINT) % 10000 AS bucket
    FROM vocabulary, remainders
),
source_counts AS (SELECT bucket, count(*) AS s FROM used JOIN hashed USING (word) GROUP BY bucket),
target_counts AS (SELECT bucket, count(*) AS t FROM wanted JOIN hashed USING (word) GROUP BY bucket),
gains AS (
    SELECT b.bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM used) + 10000)
               / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM wanted) + 10000)))) AS BIGINT) AS gain
    FROM (SELECT DISTINCT bucket FROM hashed) b LEFT JOIN source_counts USING (bucket) LEFT JOIN target_counts USING (bucket)
),
sums AS (
    SELECT r, count(*) AS n, sum(gain) AS total FROM used JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY r
),
scored AS (
    SELECT d.r, d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features,
           CAST(coalesce(floor(total::DOUBLE / n), 0) AS BIGINT) AS weight,
           CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8)
               AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS noise
    FROM docs d LEFT JOIN sums USING (r)
),
placed AS (
    SELECT r, row_number() OVER (ORDER BY weight + noise DESC, doc_id ASC NULLS LAST, n_features, weight) AS place,
           floor(count(*) OVER () * 10 / 100) AS drawn
    FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, weight + noise AS score,
       CASE WHEN place <= drawn THEN CAST(place AS BIGINT) END AS rank
FROM scored LEFT JOIN placed USING (r)
"""


def expected() -> dict[str, str]:
    return {
        "op6_contamination": OP6_CONTAMINATION,
        "op7_quality_rules": OP7_QUALITY_RULES,
        "op8_secrets": OP8_SECRETS,
        "op9_mixing": OP9_MIXING,
        "op12_fill_middle": OP12_FILL_MIDDLE,
        "op13_resampling": OP13_RESAMPLING,
    }
