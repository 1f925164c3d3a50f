"""SQL (DuckDB) with the same rows as the queries that SQL can express."""

from __future__ import annotations

from tidelog.llm.mixing import SEED
from tidelog.llm.rules import STOP_WORDS
from tidelog.llm.urls import BIN_WIDTH, HELD_OUT_FOLDS, LAST_BIN, LOWER, ORDER, START, UPPER

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)

RULES_SQL = rf"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents
), l AS (
  SELECT *, list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS lines FROM t
), win AS (
  SELECT r, unnest(list_transform(range(1, len(w) - 6),
    lambda i: {{'i': i, 'words': array_to_string(list_slice(w, i, i + 7), ' ')}})) AS x
  FROM t WHERE len(w) >= 8
), rep AS (
  SELECT r, x.i AS i FROM (SELECT r, x, count(*) OVER (PARTITION BY r, x.words) AS n FROM win) WHERE n > 1
), cov AS (
  SELECT r, sum(least(8, i - before)) AS n
  FROM (SELECT r, i, coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), i - 8) AS before FROM rep) GROUP BY r
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    length(t) - length(replace(t, '!', '')) AS exclamations,
    len(list_filter(w, lambda x: lower(x) IN ({_STOPS}))) AS stops,
    len(lines) AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    len(list_filter(lines, lambda s: regexp_matches(s, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS ellipsis,
    len(list_filter(lines, lambda s: regexp_matches(s, '^[\x20\x09-\x0D]*[-*•]'))) AS bullets,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM l LEFT JOIN cov USING (r)
), b AS (
  SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND n_words <= 1000000
   AND word_chars / n_words BETWEEN 2.0 AND 15.0
   AND n_symbols / n_words <= 0.1
   AND exclamations / n_words <= 0.2
   AND stops / n_words >= 0.01
   AND n_dup_lines / n_lines <= 0.5
   AND ellipsis / n_lines <= 0.3
   AND bullets / n_lines <= 0.9) AS kept
FROM b
"""

MIX_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size,
    ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 3))::INT AS bin
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), w AS (
  SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM s
), o AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS total,
    sum(weight) OVER () AS weights,
    coalesce(sum(source_size * 2.0::DOUBLE) OVER before, 0) AS caps_before,
    coalesce(sum(weight) OVER before, 0) AS weights_before
  FROM w
  WINDOW before AS (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT *, (total - caps_before) * weight >= cap * (weights - weights_before) AS is_full FROM o
), t AS (
  SELECT source, source_size,
    CASE WHEN is_full THEN cap
      ELSE weight * ((total - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ())
                     / sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ()) END::DOUBLE AS target
  FROM f
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::INT AS whole FROM t
), bins AS (
  SELECT source, bin, sum(size) AS bin_size FROM sized GROUP BY source, bin
), cum AS (
  SELECT *, sum(bin_size) OVER (PARTITION BY source ORDER BY bin) - bin_size AS before FROM bins
), cut AS (
  SELECT p.source, max(CASE WHEN before + bin_size / 2 <= target - whole * source_size THEN bin END) AS last_bin
  FROM cum JOIN p ON cum.source IS NOT DISTINCT FROM p.source GROUP BY p.source
)
SELECT doc_id, size, p.source_size, p.target,
  (size * (whole + CASE WHEN bin <= last_bin THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized JOIN p ON sized.source IS NOT DISTINCT FROM p.source
JOIN cut ON sized.source IS NOT DISTINCT FROM cut.source
"""

LINES_SQL = rf"""
WITH p AS (
  SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents
), totals AS (
  SELECT source, count(*) AS total FROM p GROUP BY source
), c AS (
  SELECT source, line, count(*) AS pages
  FROM (SELECT DISTINCT r, source, unnest(lines) AS line FROM p)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY source, line
), bad AS (
  SELECT c.source, list(line) AS bad FROM c JOIN totals ON c.source IS NOT DISTINCT FROM totals.source
  WHERE pages >= 3 AND pages > total * 0.02::DOUBLE GROUP BY c.source
), k AS (
  SELECT p.*, list_filter(lines, lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS before,
    list_filter(lines, lambda s: NOT (regexp_matches(s, '[^\x20\x09-\x0D]')
                                      AND list_contains(coalesce(bad, []), s))) AS kept
  FROM p LEFT JOIN bad ON p.source IS NOT DISTINCT FROM bad.source
), a AS (
  SELECT *, list_filter(kept, lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS left_over FROM k
)
SELECT doc_id, source,
  CASE WHEN len(left_over) > 0 AND len(kept) < len(lines) THEN array_to_string(kept, chr(10)) ELSE text END AS text,
  coalesce(len(before), 0)::BIGINT AS n_lines,
  CASE WHEN len(left_over) > 0 THEN len(before) - len(left_over) ELSE 0 END::BIGINT AS n_dropped,
  coalesce(len(before) - len(left_over), 0)::BIGINT AS n_boilerplate
FROM a
"""

TOOLS_SQL = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, role, text, length(text) AS n, 'c' || conv_id || '-' AS prefix FROM conversations
), calls AS (
  SELECT conv_id, turn, prefix || turn AS call_id, n, text,
    CASE WHEN n % 11 = 0 THEN 'unknown' ELSE ['search', 'translate', 'note'][n % 3 + 1] END AS name,
    CASE WHEN n % 2 = 0 AND turn > 2 THEN prefix || (turn - 2) END AS needs
  FROM t WHERE role = 'assistant'
), links AS (
  SELECT c.conv_id, c.call_id, c.needs FROM calls c JOIN calls d ON c.conv_id = d.conv_id AND c.needs = d.call_id
), walk AS (
  SELECT conv_id, call_id, 0 AS level FROM calls
  UNION ALL
  SELECT l.conv_id, l.call_id, w.level + 1 FROM walk w JOIN links l ON w.conv_id = l.conv_id AND l.needs = w.call_id
), levels AS (
  SELECT conv_id, call_id, max(level)::INT AS level FROM walk GROUP BY conv_id, call_id
), results AS (
  SELECT conv_id, prefix || (turn - 1) AS call_id, text AS content FROM t WHERE role = 'user'
), asked AS (
  SELECT *,
    CASE name
      WHEN 'search' THEN CASE WHEN n % 7 = 0 THEN to_json({'limit': 'many', 'query': text})
                              ELSE to_json({'limit': n, 'query': text}) END
      WHEN 'translate' THEN CASE WHEN n % 5 = 0 THEN to_json({'text': text}) ELSE to_json({'text': text, 'to': 'en'}) END
      WHEN 'note' THEN to_json({'text': text, 'urgent': n % 2 = 0})
      ELSE to_json({'value': n}) END AS arguments
  FROM calls
), fields(name, field, kinds, required, place) AS (
  VALUES ('search', 'query', ['VARCHAR'], true, 1), ('search', 'limit', ['BIGINT', 'UBIGINT'], true, 2),
    ('translate', 'text', ['VARCHAR'], true, 1), ('translate', 'to', ['VARCHAR'], true, 2),
    ('note', 'text', ['VARCHAR'], true, 1), ('note', 'urgent', ['BOOLEAN'], false, 2)
), validated AS (
  SELECT a.conv_id, a.call_id, list(wrong ORDER BY place) FILTER (WHERE wrong IS NOT NULL) AS wrong
  FROM (SELECT a.conv_id, a.call_id, f.place,
          CASE WHEN json_type(a.arguments, '$.' || f.field) IS NULL THEN CASE WHEN f.required THEN 'missing:' || f.field END
               WHEN NOT list_contains(f.kinds, json_type(a.arguments, '$.' || f.field)) THEN 'type:' || f.field END AS wrong
        FROM asked a JOIN fields f ON f.name = a.name
        UNION ALL
        SELECT conv_id, call_id, 3, 'unexpected:' || k FROM (SELECT conv_id, call_id, name, unnest(json_keys(arguments)) AS k FROM asked) u
        WHERE name IN (SELECT name FROM fields) AND NOT EXISTS (SELECT 1 FROM fields f WHERE f.name = u.name AND f.field = k)) a
  GROUP BY ALL
), checked AS (
  SELECT c.*, level, r.content, r.call_id IS NOT NULL AS linked,
    CASE WHEN c.name IN (SELECT name FROM fields) THEN coalesce(v.wrong, []) ELSE ['unknown_tool'] END
    || CASE WHEN c.needs IS NOT NULL AND l.call_id IS NULL THEN ['missing_dependency'] ELSE [] END AS errors
  FROM asked c JOIN levels USING (conv_id, call_id)
  LEFT JOIN validated v ON c.conv_id = v.conv_id AND c.call_id = v.call_id
  LEFT JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
  LEFT JOIN links l ON c.conv_id = l.conv_id AND c.call_id = l.call_id
)
SELECT conv_id, turn, call_id, name, level, linked, len(errors) = 0 AS valid,
  array_to_string(errors, ',') AS errors,
  '{"arguments":' || arguments || ',"id":' || to_json(call_id) || ',"name":' || to_json(name)
    || ',"result":' || coalesce(to_json(content), 'null') || '}' AS message
FROM checked
"""

_PARTS = "'(?s)^.*?://([^/?#]*)([^?#]*)'"


def _fits(host: str, path: str) -> str:
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"


def _order(k: int) -> str:
    """Counts of the grams of ``k + 1`` characters, with those of their contexts (Witten-Bell)."""
    def probability(v: str) -> str:
        return f"""(CASE WHEN sum({v}) OVER c > 0
          THEN ({v} + count(*) FILTER (WHERE {v} > 0) OVER c * q{v}) / (sum({v}) OVER c + count(*) FILTER (WHERE {v} > 0) OVER c)
          ELSE q{v} END)::DOUBLE AS p{v}"""

    return f"""m{k} AS (
  SELECT gram, {probability('a')}, {probability('b')}
  FROM (SELECT g.*, s.pa AS qa, s.pb AS qb FROM n{k} g JOIN m{k - 1} s ON s.gram = g.gram[2:])
  WINDOW c AS (PARTITION BY gram[1:{k}])
)"""


_COUNTS = ", ".join(f"n{k} AS (SELECT gram[2:] AS gram, sum(a)::BIGINT AS a, sum(b)::BIGINT AS b FROM n{k + 1} GROUP BY 1)"
                    for k in reversed(range(ORDER)))

URLS_SQL = f"""
WITH p AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, {_PARTS}, 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, {_PARTS}, 2), '') AS path
  FROM pages
), r AS (
  SELECT *, CASE
      WHEN {_fits('example.org', '/en/1')} THEN 'example.org/en/1'
      WHEN {_fits('example.org', '/es/')} THEN 'example.org/es/'
      WHEN {_fits('com', '/de/')} THEN 'com/de/'
      WHEN {_fits('com', '/fr/')} THEN 'com/fr/'
      WHEN {_fits('org', '/')} THEN 'org/' END AS rule
  FROM p
), j AS (
  SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS label,
    ('0x' || substr(md5(coalesce(url, '')), 1, 7))::INT % {HELD_OUT_FOLDS} = 0 AS held_out
  FROM r
), u AS (
  SELECT url, '{START * ORDER}' || url AS marked FROM (SELECT DISTINCT url FROM j WHERE url <> '')
), g AS (
  SELECT url, unnest(list_transform(range(1, length(url) + 1), lambda i: substr(marked, i, {ORDER + 1}))) AS gram FROM u
), n{ORDER} AS (
  SELECT gram, count(*) FILTER (WHERE label = 'allow' AND NOT held_out) AS a,
    count(*) FILTER (WHERE label = 'block' AND NOT held_out) AS b
  FROM g JOIN j USING (url) GROUP BY gram
), {_COUNTS}, m0 AS (
  SELECT gram, (a + 1) / (sum(a) OVER () + count(*) OVER ())::DOUBLE AS pa,
    (b + 1) / (sum(b) OVER () + count(*) OVER ())::DOUBLE AS pb FROM n0
), {', '.join(_order(k) for k in range(1, ORDER + 1))}, s AS (
  SELECT url, sum(ln(pa) - ln(pb)) / count(*) AS score FROM g JOIN m{ORDER} USING (gram) GROUP BY url
), h AS (
  SELECT greatest(least(floor(score / {BIN_WIDTH}::DOUBLE), {LAST_BIN}), -{LAST_BIN})::INT AS bin,
    count(*) FILTER (WHERE label = 'allow') AS a, count(*) FILTER (WHERE label = 'block') AS b
  FROM s JOIN j USING (url) WHERE label IS NOT NULL AND held_out GROUP BY 1
), gain AS (
  SELECT k.bin, 1.0 - coalesce(sum(a) OVER below, 0) / greatest(sum(a) OVER (), 1)::DOUBLE
      + coalesce(sum(b) OVER below, 0) / greatest(sum(b) OVER (), 1)::DOUBLE AS gain,
    coalesce(sum(a) OVER (), 0) > 0 AND coalesce(sum(b) OVER (), 0) > 0 AS known
  FROM range(-{LAST_BIN}, {LAST_BIN} + 1) k(bin) LEFT JOIN h ON h.bin = k.bin
  WINDOW below AS (ORDER BY k.bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), cut AS (
  SELECT CASE WHEN bool_and(known) THEN (min(bin) + max(bin)) / 2 * {BIN_WIDTH}::DOUBLE ELSE 0 END AS threshold
  FROM gain WHERE gain = (SELECT max(gain) FROM gain)
)
SELECT page_id, host, path, rule,
  coalesce(label, CASE WHEN score >= (SELECT threshold FROM cut) THEN 'allow' ELSE 'block' END) AS verdict
FROM j LEFT JOIN s ON j.url = s.url
"""

TRIE_SQL = r"""
WITH codes AS (
  SELECT list_transform(range(256), lambda n: list_reduce(
    list_concat([n::BIGINT], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
      lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t), codes
), turns AS (
  SELECT i.conv_id, 0 AS kind, pos, role, text FROM ids i JOIN t ON t.conv_id = i.base WHERE pos <= h
  UNION ALL SELECT i.conv_id, 1, pos, role, text FROM ids i JOIN t USING (conv_id) WHERE pos > h
), whole AS (
  SELECT conv_id, coalesce(list({'role': role, 'text': text} ORDER BY kind, pos) FILTER (WHERE role IS NOT NULL), []) AS path
  FROM ids LEFT JOIN turns USING (conv_id) GROUP BY conv_id
), prefixes AS (
  SELECT conv_id, len(path) AS full_depth, d AS depth, path[1:d] AS path FROM whole, (SELECT unnest(range(0, 10000)) AS d)
  WHERE d <= len(path)
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE full_depth = depth) AS ends
  FROM prefixes GROUP BY path, depth
), families AS (
  SELECT p.*, u.conv_id AS parent_conv_id,
    (SELECT count(*) FROM nodes c WHERE c.depth = p.depth + 1 AND c.path[1:p.depth] = p.path) AS n_children
  FROM nodes p LEFT JOIN nodes u ON u.depth = p.depth - 1 AND u.path = p.path[1:p.depth - 1]
)
SELECT f.conv_id, f.depth, any_value(f.parent_conv_id) AS parent_conv_id, any_value(f.n_convs) AS n_convs,
  any_value(f.n_children)::BIGINT AS n_children, count(*) FILTER (WHERE v.n_children = 0) AS n_leaves,
  sum(CASE WHEN v.depth > 0 THEN (v.n_convs - 1) * strlen(v.path[v.depth].text) ELSE 0 END)::BIGINT AS saved_tokens,
  sha256(coalesce(any_value(f.ends), '')) AS ends_sha256
FROM families f JOIN families v ON v.depth >= f.depth AND v.path[1:f.depth] = f.path
GROUP BY f.conv_id, f.depth, f.path
"""

NEGATIVES_SQL = r"""
WITH e AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_sum(list_transform(range(1, len(a.c) + 1), lambda i: a.c[i] * b.c[i]))::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INT AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

ORACLE: dict[str, str] = {
    "op3_line_dedup": LINES_SQL,
    "op5_tool_calls": TOOLS_SQL,
    "op6_url_filter": URLS_SQL,
    "op7_quality_rules": RULES_SQL,
    "op8_mixing": MIX_SQL,
    "op12_prefix_trie": TRIE_SQL,
    "op13_hard_negatives": NEGATIVES_SQL,
}
