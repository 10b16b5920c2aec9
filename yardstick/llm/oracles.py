"""DuckDB SQL for the operators that SQL can express (1, 2, 5 and 13).

The others have no SQL form and are tested against brute force: 3, 7 and 11 (trained
models), 4 (BPE merges), 6 (offsets of scanned units), 8 (JSON and UUIDs), 9
(recursive medians), 10 (non-overlapping matches with positions) and 12 (CRC-32).
"""

from __future__ import annotations

from .quality_rules import RULES, STOP_WORDS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE_WORD = r"[^\x20\x09-\x0D]+"
_ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _low(col: str) -> str:
    return f"translate(coalesce({col}, ''), '{_UPPER}', '{_LOWER}')"


DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_low('text')}, '{_ALNUM_WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_low('text')}, '{_ALNUM_WORD}') AS w FROM benchmark WHERE item_id IS NOT NULL),
p AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS t
      FROM b, unnest(range(1, greatest(1, len(w) - 9) + 1)) r(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM p),
g AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t FROM d, sizes, unnest(range(1, len(w) - n + 2)) r(i)),
o AS (SELECT g.doc_id, g.n, g.i, p.item_id FROM g JOIN p ON g.n = p.n AND g.t = p.t),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM o, unnest(range(i, i + n)) r(k) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM o) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""

_STOP = " ".join(
    f"WHEN lang = '{lang}' THEN len(list_filter(w, lambda x: list_contains([{', '.join(repr(s) for s in words)}], lower(x))))" for lang, words in STOP_WORDS.items()
)
_FAILED = ", ".join(f"CASE WHEN 100 * {m} {rel} {limit} * {denom} THEN '{name}' END" for name, m, rel, limit, denom in RULES)

QUALITY = rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_SPACE_WORD}') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_SPACE_WORD}')) AS l FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM d, unnest(range(1, len(w) - 3)) r(i)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM g) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT k) AS n FROM again, unnest(range(i, i + 5)) r(k) GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
             coalesce(rep.n, 0) AS n_repeat_words, coalesce(CASE {_STOP} END, 0) AS n_stop_words,
             CASE WHEN lang IN ({', '.join(repr(x) for x in STOP_WORDS)}) THEN len(w) ELSE 0 END AS n_ruled_words
      FROM d LEFT JOIN rep ON rep.doc_id = d.doc_id),
j AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, concat_ws(',', {_FAILED}) AS failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND failed = '' AS kept, failed
FROM j
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_low('text')}, '{_SPACE_WORD}') AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) > 1 THEN list_sort(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) ELSE w END AS s FROM d),
c AS MATERIALIZED (SELECT s, min(doc_id) AS rep, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY s),
u AS MATERIALIZED (SELECT rep, n, unnest(s) AS g FROM c),
e AS MATERIALIZED (SELECT a.rep AS x, b.rep AS y FROM u a JOIN u b ON a.g = b.g AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
      GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e2 AS MATERIALIZED (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(x, y) AS (SELECT rep, rep FROM c UNION SELECT r.x, e2.y FROM r JOIN e2 ON e2.x = r.y),
l AS (SELECT x, min(y) AS component FROM r GROUP BY x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(l.component, s.doc_id) AS component_id,
       coalesce(l.component, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN c ON c.s = s.s LEFT JOIN l ON l.x = c.rep
"""

FILTER_AUDIT = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part, regexp_extract_all(coalesce(text, ''), '{_SPACE_WORD}') AS w FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, concat(
        CASE WHEN len(w) < 50 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' END,
        CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' END,
        CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
        CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY t) THEN 'E' END) AS fails,
        coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
      FROM t LEFT JOIN l ON l.doc_id = t.doc_id),
m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
r AS (SELECT part, o, step, o[step] AS own, fails, n, good, toxic,
             list_min(list_transform(list_filter(string_split('A,B,C,D,E', ','), lambda x: contains(fails, x)), lambda x: strpos(o, x))) AS gone
      FROM m, orders, range(1, 6) s(step)),
g AS (SELECT part, o AS filter_order, step, own, sum(n) FILTER (gone IS NULL OR gone > step) AS kept, sum(n) FILTER (gone = step) AS removed,
             sum(n) FILTER (contains(fails, own) AND gone < step) AS redundant, sum(n) FILTER (fails = own) AS unique_fails,
             sum(good) FILTER (gone = step) AS good_lost, sum(toxic) FILTER (gone = step) AS toxic_lost
      FROM r GROUP BY part, o, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM g
"""

ORACLE = {
    "op1_decontaminate": DECONTAMINATE,
    "op2_quality_rules": QUALITY,
    "op5_minhash_dedup": NEAR_DUPLICATES,
    "op13_filter_audit": FILTER_AUDIT,
}
