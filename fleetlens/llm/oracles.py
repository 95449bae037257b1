"""SQL twins of the queries that SQL can express: plain statements of the results, without sketches, tries, automata or bit tables.

The fitted models, the quantised tries, the page extraction and the packing have none; they are tested against brute force.
"""

from __future__ import annotations

from fleetlens.llm import licenses
from fleetlens.llm.decontaminate import UNITS


def lower(column: str) -> str:
    """A-Z lower-cased; NULL is empty."""
    return f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


OP1 = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({lower("text")}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, list_sort(list_distinct(CASE
        WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [hash(array_to_string(w, ' '))]
        ELSE list_transform(range(1, len(w) - 1), lambda i: hash(w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END)) AS s
    FROM words
), first_of AS MATERIALIZED (
    SELECT doc_id, s, CASE WHEN len(s) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY s) END AS node FROM sets
), nodes AS MATERIALIZED (
    SELECT node, len(s) AS n, unnest(s) AS h FROM first_of WHERE doc_id = node
), links AS MATERIALIZED (
    SELECT a.node AS a, b.node AS b FROM nodes a JOIN nodes b ON a.h = b.h AND a.node < b.node AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    GROUP BY a.node, b.node HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), both_ways AS MATERIALIZED (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
    SELECT a, b FROM both_ways
    UNION
    SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a
), smallest AS (
    SELECT a AS node, min(b) AS low FROM reach GROUP BY a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(node, coalesce(low, node)) AS component_id,
       coalesce(doc_id = least(node, coalesce(low, node)), true) AS kept
FROM first_of LEFT JOIN smallest USING (node)
"""

OP3 = rf"""
WITH cut AS (
    SELECT page_id, {lower("regexp_extract(url, '://([^/?#]*)', 1)")} AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), ruled AS (
    SELECT *, CASE
        WHEN suffix(concat('.', host), '.example.org') AND prefix(path, '/en/1') THEN 'example.org/en/1'
        WHEN suffix(concat('.', host), '.example.org') AND prefix(path, '/es/') THEN 'example.org/es/'
        WHEN suffix(concat('.', host), '.org') AND prefix(path, '/') THEN 'org/'
        WHEN suffix(concat('.', host), '.com') AND prefix(path, '/fr/') THEN 'com/fr/'
        WHEN suffix(concat('.', host), '.com') AND prefix(path, '/de/') THEN 'com/de/' END AS rule
    FROM cut
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN list_has_any(string_split_regex(host, '[.-]'), ['casino', 'pills', 'spam']) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

def as_pattern(template: str) -> str:
    """A template as a pattern over words, each followed by one space; a replaceable region is any number of words that fit."""
    out = []
    for k, part in enumerate(licenses.MARK.split(template)):
        if k % 2 == 0:
            out += [f"{w} " for w in licenses.words_of(part) if w]
        elif part.endswith("Optional"):
            out.append("(" if part.startswith("begin") else ")?")
        else:
            fits = part.split('"')[1]
            out.append(f"({'[^ ]+' if fits == '.+' else fits} )+")
    return "".join(out)


LICENCES = {label: as_pattern(template) for label, template in licenses.TEMPLATES.items()}
BASE = {"gnu general public license ": "gpl", "apache license ": "apache", "cc by ": "cc-by", "mit license ": "mit"}

OP5 = rf"""
WITH words AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lower("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), places AS (
    SELECT r, w, unnest(list_filter(range(len(w)), lambda i: w[i + 1] IN (
        'gnu', 'apache', 'cc', 'mit', 'licensed', 'released', 'permission', 'redistribution', 'copyright'))) AS k FROM words
), heads AS (
    SELECT r, k, array_to_string(w[k + 1 : CASE WHEN w[k + 1] IN ('permission', 'redistribution', 'copyright') THEN len(w) ELSE k + 20 END], ' ') || ' ' AS head
    FROM places
), found AS (
    SELECT r, k, CASE {" ".join(f"WHEN prefix(head, '{p}') THEN '{label}'" for p, label in BASE.items())} END AS base,
           CASE {" ".join(f"WHEN regexp_matches(head, '^{p}') THEN '{label}'" for label, p in LICENCES.items())} END AS own
    FROM heads
), merged AS (
    SELECT r, count(base) AS n_base, min(k) FILTER (base IS NOT NULL) AS first_word, max(k) FILTER (base IS NOT NULL) AS last_word,
           list_sort(list_distinct(list(base))) AS bases, list_sort(list_distinct(list(base) || list(own))) AS every,
           list(k ORDER BY k) FILTER (own IS NOT NULL) AS starts
    FROM found GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(array_to_string(bases, ','), '') AS base_labels, coalesce(array_to_string(every, ','), '') AS labels,
       CAST(CASE WHEN starts IS NOT NULL THEN 1 WHEN n_base > 0 THEN 0.5 ELSE 0 END AS DOUBLE) AS score,
       CAST(coalesce(starts, []) AS BIGINT[]) AS template_words
FROM words LEFT JOIN merged USING (r)
"""

OP6 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), steps AS (
    SELECT *, lag(role, 1, 'start') OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
           CASE role WHEN 'system' THEN '### System: ' WHEN 'user' THEN '### User: ' WHEN 'assistant' THEN '### Assistant: '
                ELSE '### Role ' || regexp_replace(role, '(\\|###|</turn>)', '\\\1', 'g') || ': ' END AS header,
           regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g') AS escaped
    FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(header) + length(escaped) + length(' </turn>') + 1) AS BIGINT) AS formatted_chars,
       bool_and((before, role) IN (('start', 'system'), ('start', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user'))) AS valid
FROM steps GROUP BY conv_id
"""

OP7 = rf"""
WITH spaced AS (
    SELECT doc_id, NULL AS item_id, text FROM documents WHERE doc_id IS NOT NULL UNION ALL SELECT NULL, item_id, text FROM benchmark WHERE item_id IS NOT NULL
), texts AS (
    SELECT doc_id, item_id, regexp_extract_all(regexp_replace(text, '([\p{{Han}}\p{{Hiragana}}\p{{Katakana}}\p{{Thai}}\p{{Lao}}\p{{Khmer}}\p{{Myanmar}}])', ' \1 ', 'g'),
        '[\p{{L}}\p{{N}}]+') AS w FROM spaced WHERE text IS NOT NULL
), marked AS MATERIALIZED (
    SELECT doc_id, item_id, list_transform(w, lambda x: replace(lower(upper(x)), 'ß', 'ss')) AS w,
        list_transform(w, lambda x: CASE WHEN x >= '0' AND x < ':' THEN '#' WHEN lower(x) <> x THEN '@'
        WHEN x IN ({", ".join(f"'{u}'" for u in UNITS)}) THEN '%' ELSE x END) AS c
    FROM texts
), windows AS MATERIALIZED (
    SELECT doc_id, item_id, pos, w[pos + 1 : pos + 5] AS w, c[pos + 1 : pos + 5] AS c, array_to_string(c[pos + 1 : pos + 5], ' ') AS key, array_to_string(w[pos + 1 : pos + 5], ' ') AS said
    FROM (SELECT *, unnest(range(len(w) - 4)) AS pos FROM marked WHERE len(w) >= 5)
), items AS MATERIALIZED (
    SELECT item_id, pos, w, key, said FROM windows WHERE item_id IS NOT NULL AND len(list_filter(c, lambda x: x NOT IN ('#', '@', '%'))) > 0
), matched AS MATERIALIZED (
    SELECT d.doc_id, i.item_id, i.pos AS item_pos, d.pos - i.pos AS diagonal, d.c, d.w AS told, i.w AS asked
    FROM windows d JOIN items i ON d.key = i.key WHERE d.doc_id IS NOT NULL
), slots AS (
    SELECT doc_id, item_id, diagonal, asked[k] AS asked, told[k] AS told
    FROM (SELECT *, unnest(range(1, 6)) AS k FROM matched) WHERE c[k] IN ('#', '@', '%')
), torn AS (
    SELECT DISTINCT doc_id, item_id, diagonal FROM (
        SELECT doc_id, item_id, diagonal FROM slots GROUP BY doc_id, item_id, diagonal, asked HAVING count(DISTINCT told) > 1)
), verbatim AS (
    SELECT d.doc_id, i.item_id, i.pos AS item_pos FROM windows d JOIN items i ON d.said = i.said WHERE d.doc_id IS NOT NULL
), covered AS (
    SELECT doc_id, item_id, count(DISTINCT item_pos) AS n_matched
    FROM (SELECT doc_id, item_id, item_pos FROM matched ANTI JOIN torn USING (doc_id, item_id, diagonal) UNION ALL FROM verbatim) GROUP BY doc_id, item_id
), sizes AS (
    SELECT item_id, count(DISTINCT pos) AS n_windows FROM items GROUP BY item_id
), short AS (
    SELECT item_id, len(w) AS n, array_to_string(w, ' ') AS said FROM marked
    WHERE item_id IS NOT NULL AND len(w) BETWEEN 1 AND 4 AND len(list_filter(c, lambda x: x NOT IN ('#', '@', '%'))) > 0 AND item_id NOT IN (SELECT item_id FROM sizes)
), pieces AS (
    SELECT doc_id, n, array_to_string(w[pos + 1 : pos + n], ' ') AS said
    FROM (SELECT doc_id, n, w, unnest(range(len(w) - n + 1)) AS pos FROM marked, (SELECT DISTINCT n FROM short) WHERE doc_id IS NOT NULL AND len(w) >= n AND (n > 1 OR len(w) = 1))
)
SELECT doc_id, item_id, n_windows, n_matched, n_matched / n_windows AS share
FROM covered JOIN sizes USING (item_id) WHERE n_matched >= CAST(0.8 AS DOUBLE) * n_windows
UNION ALL SELECT DISTINCT doc_id, item_id, 1, 1, 1.0 FROM pieces JOIN short USING (n, said)
"""

# Every anchor against every row: the windows without blocks, strips and thresholds.
OP13 = """
WITH rows_in AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.vec, r.vec) AS BIGINT) AS score
  FROM rows_in a JOIN rows_in r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

ORACLES: dict[str, str] = {
    "op1_near_duplicates": OP1,
    "op3_url_filters": OP3,
    "op5_license_scans": OP5,
    "op6_chat_formatting": OP6,
    "op7_decontamination": OP7,
    "op13_hard_negatives": OP13,
}
