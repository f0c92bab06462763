"""DuckDB twins of the queries of this package that SQL can express."""

from __future__ import annotations

from .quality_rules import STOP_WORDS

_STOPS = ", ".join("'" + w + "'" for w in dict.fromkeys(STOP_WORDS))
_WORD = r"[^\x20\x09-\x0D]+"

OP6 = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls
  FROM documents),
grams AS (
  SELECT doc_id, unnest(range(1, len(ws) - 1)) AS p, ws FROM t WHERE len(ws) >= 3),
keyed AS (
  SELECT doc_id, p, ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] AS g FROM grams),
twice AS (
  SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM keyed) WHERE c > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p + d) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS d) GROUP BY doc_id),
m AS (
  SELECT t.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         len(ls) AS n_lines,
         length(text) - length(replace(text, '!', '')) AS n_exclamations,
         len(list_filter(ws, lambda w: regexp_matches(w, '\pL'))) AS n_letter_words,
         len(list_filter(ws, lambda w: list_contains([{_STOPS}], lower(w)))) AS n_stop_words
  FROM t LEFT JOIN covered USING (doc_id)),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    concat_ws(',',
      CASE WHEN word_chars / nullif(n_words, 0) < 2.0 OR word_chars / nullif(n_words, 0) > 20.0 THEN 'word_length' END,
      CASE WHEN n_symbols / nullif(n_words, 0) > 0.25 THEN 'symbols' END,
      CASE WHEN n_exclamations / nullif(n_words, 0) > 0.5 THEN 'exclamations' END,
      CASE WHEN n_letter_words / nullif(n_words, 0) < 0.6 THEN 'letters' END,
      CASE WHEN n_stop_words / nullif(n_words, 0) < 0.005 THEN 'stop_words' END,
      CASE WHEN n_dup_lines / nullif(n_lines, 0) > 0.5 THEN 'repeated_lines' END) AS failed_rules
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM f
"""

OP3 = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p:p + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS p FROM t WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 85 * (na.n + nb.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT a AS id, b AS other FROM both_ways
  UNION
  SELECT r.id, l.b FROM reach r JOIN both_ways l ON l.a = r.other),
least AS (SELECT id, min(other) AS m FROM reach GROUP BY id)
SELECT t.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       least(t.doc_id, coalesce(m, t.doc_id)) AS component_id,
       t.doc_id <= coalesce(m, t.doc_id) AS kept
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.id = t.doc_id
"""

OP4 = """
WITH b AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
p AS (
  SELECT doc_id, unnest(range(0, greatest(length(h) // 2 - 99, 0))) AS i, h FROM b),
k AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS w FROM p),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS n FROM k)
  WHERE n > 1),
runs AS (
  SELECT doc_id, min(i) AS s, max(i) + 100 AS e
  FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS g
        FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END
                     AS fresh FROM later))
  GROUP BY doc_id, g),
gaps AS (
  SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before FROM runs),
cut AS (
  SELECT g.doc_id, count(*) AS n_spans, sum(e - s) AS n_removed,
         string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s)
           || substr(any_value(h), 2 * max(e) + 1) AS kept
  FROM gaps g JOIN b USING (doc_id) GROUP BY g.doc_id)
SELECT b.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM b LEFT JOIN cut USING (doc_id)
"""

OP11 = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

_FIELD = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# CRC-32 of the decimal id, bit by bit
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)),
  CAST(4294967295 AS BIGINT))"""

OP12 = f"""
WITH RECURSIVE l AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
               CASE WHEN {_CRC} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS claim
        FROM documents)),
t(tree, level, idx, h, n) AS (
  SELECT coalesce('=' || lang, ''), 0, pos, leaf, n FROM l
  UNION ALL
  SELECT tree, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (n + 1) // 2
  FROM t WHERE n > 1 GROUP BY tree, level, idx // 2, n),
r AS (
  SELECT tree, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS n
  FROM t WHERE n = 1),
u(level, idx, h, n) AS (
  SELECT 0, place, subroot, n FROM r
  UNION ALL
  SELECT level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (n + 1) // 2
  FROM u WHERE n > 1 GROUP BY level, idx // 2, n),
steps AS (
  SELECT l.pos AS pos, l.lang AS lang, 0 AS part, t.level, CASE WHEN s.h IS NULL THEN 'N' WHEN t.idx % 2 = 1 THEN 'L' || s.h
         ELSE 'R' || s.h END AS step
  FROM l JOIN t ON t.tree = coalesce('=' || l.lang, '') AND t.idx = l.pos >> t.level AND t.n > 1
  LEFT JOIN t s ON s.tree = t.tree AND s.level = t.level AND s.idx = xor(t.idx, 1)
  UNION ALL
  SELECT l.pos, l.lang, 1, u.level, CASE WHEN s.h IS NULL THEN 'N' WHEN u.idx % 2 = 1 THEN 'L' || s.h ELSE 'R' || s.h END
  FROM l JOIN r ON r.tree = coalesce('=' || l.lang, '') JOIN u ON u.idx = r.place >> u.level AND u.n > 1
  LEFT JOIN u s ON s.level = u.level AND s.idx = xor(u.idx, 1)),
p AS (SELECT pos, lang, list(step ORDER BY part, level) AS path FROM steps GROUP BY pos, lang),
f AS (
  SELECT l.doc_id, l.leaf, r.subroot, (SELECT h FROM u WHERE n = 1) AS root,
         sha256(array_to_string(list_transform(coalesce(path, []), lambda x: x[2:]), '')) AS proof_sha256,
         list_reduce(list_prepend(l.claim, coalesce(path, [])), lambda h, x: sha256(
           CASE x[1] WHEN 'L' THEN x[2:] || h WHEN 'R' THEN h || x[2:] ELSE h END)) AS folded_root
  FROM l JOIN r ON r.tree = coalesce('=' || l.lang, '')
  LEFT JOIN p ON p.pos = l.pos AND p.lang IS NOT DISTINCT FROM l.lang)
SELECT *, folded_root = root AS verified FROM f
"""

OP13 = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
r(id, seen) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.id, l.b FROM r JOIN l ON l.a = r.seen),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, min(seen) AS component_id, vec_id = min(seen) AS kept
FROM r JOIN embeddings ON id = vec_id LEFT JOIN n USING (vec_id) GROUP BY vec_id, n
"""

ORACLES = {"op4_prefix_free_parsing": OP4, "op3_odd_sketches": OP3, "op6_quality_rules": OP6,
           "op11_hard_negatives": OP11, "op12_octopus_manifest": OP12,
           "op13_spherical_caps": OP13}
