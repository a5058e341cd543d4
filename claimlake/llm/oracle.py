"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = f"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, h AS text_sha256
FROM d WINDOW g AS (PARTITION BY h)
"""

OP2 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
"""

_LINE = f"trim(translate(l, '{_UPPER}', '{_LOWER}'), ' ' || chr(9) || chr(13))"

OP7 = f"""
WITH l AS (SELECT doc_id, source, {_LINE} AS k FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS l FROM documents)),
b AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT source) >= 10),
d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines, (SELECT coalesce(list(k), []) FROM b) AS gone FROM documents),
c AS (SELECT doc_id, lines, list_filter(lines, lambda l: NOT list_contains(gone, {_LINE})) AS rest FROM d)
SELECT doc_id, CAST(len(lines) AS INTEGER) AS n_lines, CAST(len(lines) - len(rest) AS INTEGER) AS n_removed,
       sha256(array_to_string(rest, chr(10))) AS text_sha256 FROM c
"""

OP6 = r"""
WITH d AS (
  SELECT doc_id, source, length(text) AS chars,
         CAST(coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
k AS (
  SELECT *, -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) + 0.5) / 281474976710656.0)
            / CASE WHEN chars / CAST(greatest(size, 1) AS DOUBLE) BETWEEN 2.0 AND 12.0 THEN 1.0 ELSE 0.25 END AS key FROM d),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3.0 * CAST(sum(size) AS DOUBLE) AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w
  FROM d GROUP BY source),
f AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
         sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM s),
v AS (SELECT max(left_over / open) AS level FROM f WHERE left_over / open * w <= cap),
g AS (
  SELECT source, source_size, least(cap, coalesce(level * w, cap)) AS target,
         CASE WHEN source_size > 0 THEN floor(least(cap, coalesce(level * w, cap)) / source_size) ELSE 0 END AS epochs FROM f, v),
r AS (
  SELECT k.doc_id, k.size, g.source_size, g.target, g.epochs, g.target - g.epochs * g.source_size AS rest,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS UNBOUNDED PRECEDING) AS up_to
  FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN rest > 0 AND up_to - size / 2.0 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r
"""

OP11 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT id, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
l AS (SELECT lang, count(*) AS v, CAST(sum(total) AS BIGINT) AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
cell AS (
  SELECT g.lang, g.source, kept.term, kept.total, coalesce(c.n, 0) AS n FROM g JOIN kept ON g.lang = kept.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
s AS (SELECT lang, source, CAST(sum(n) AS BIGINT) AS n FROM cell GROUP BY lang, source),
p AS (
  SELECT cell.lang, cell.source, cell.term, cell.n, 1 + (1000000000 * (cell.n + 2)) // (s.n + 2 * l.v) AS p,
         1 + (1000000000 * (cell.total + 2)) // (l.n + 2 * l.v) AS q
  FROM cell JOIN s ON s.lang = cell.lang AND s.source = cell.source JOIN l ON l.lang = cell.lang),
x AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term GROUP BY a.lang, a.source, b.source),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r)
SELECT * FROM o WHERE part = 'pair' OR rank <= 10
"""

_TEST_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TEST_WORDS} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_TEST_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, s, s + 9), ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
gram AS (
  SELECT r, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS gram
  FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM win))),
m AS (SELECT r, s, gram.n, item FROM gram JOIN win ON gram.n = win.n AND gram.gram = win.gram),
h AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS place FROM (SELECT DISTINCT r, s, n FROM m)) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON h.r = d.r LEFT JOIN t ON t.r = d.r
"""

OP13 = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
f AS (
  SELECT doc_id, part, CASE WHEN len(w) < 100 THEN 16 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 8 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 2 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 1 ELSE 0 END AS mask FROM d),
m AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, mask),
b AS (SELECT * FROM (VALUES ('A', 16), ('B', 8), ('C', 4), ('D', 2), ('E', 1)) AS v(name, bit)),
o AS (
  SELECT b1.name || b2.name || b3.name || b4.name || b5.name AS filter_order, [b1.bit, b2.bit, b3.bit, b4.bit, b5.bit] AS bits
  FROM b b1, b b2, b b3, b b4, b b5 WHERE b1.bit | b2.bit | b3.bit | b4.bit | b5.bit = 31),
s AS (
  SELECT filter_order, step, bits[step] AS own, CAST(coalesce(list_sum(list_slice(bits, 1, step - 1)), 0) AS INTEGER) AS before
  FROM o, (SELECT unnest(range(1, 6)) AS step)),
a AS (
  SELECT part, filter_order, step, own, sum(CASE WHEN mask & (before | own) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before <> 0 AND mask & own <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM m, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM a
"""

ORACLE = {"op1_exact_dedup": OP1, "op2_topk_search": OP2, "op6_mixing": OP6, "op7_line_dedup": OP7,
          "op11_source_divergence": OP11, "op12_decontamination": OP12, "op13_filter_audit": OP13}
