"""DuckDB SQL twins of the queries that SQL can express, each derived from the query's contract."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLE["op2_ngram_jaccard"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_SPACED}') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS sh FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (sh) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (
  SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 85 * (x.n + y.n - c)
), r(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id
)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.c) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

ORACLE["op3_low_discrepancy_mix"] = f"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{_SPACED}')), 0) AS BIGINT) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS words, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + CAST(1 AS DOUBLE) AS w FROM d GROUP BY source
), o AS (
  SELECT *, 3 * words / w AS r, sum(words) OVER () AS t, sum(w) OVER () AS ws,
    coalesce(sum(3 * words) OVER (ORDER BY 3 * words / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s0,
    coalesce(sum(w) OVER (ORDER BY 3 * words / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w0 FROM s
), l AS (SELECT CAST(t - s0 AS DOUBLE) / (ws - w0) AS level FROM o WHERE CAST(t - s0 AS DOUBLE) / (ws - w0) <= r ORDER BY r, source LIMIT 1
), g AS (
  SELECT source, words, CAST(CASE WHEN 3 * words < level * w THEN 3 * words ELSE level * w END AS DOUBLE) AS target FROM s, l
), e AS (
  SELECT *, least(CAST(floor(target + 0.5) AS BIGINT), 3 * words) AS goal FROM g
), c AS (
  SELECT d.*, words, target, goal, list_sum([CAST(16 ** (6 - i) AS BIGINT) * (instr('0123456789abcdef', k[i:i]) - 1) FOR i IN range(1, 7)]) % 512 AS cell
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
), b AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY cell, k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c
)
SELECT doc_id, size, words AS source_size, round(target, 6) AS target,
  CAST(CASE WHEN words = 0 THEN 0 ELSE (goal // words) * size + greatest(0, least(size, goal % words - before)) END AS BIGINT) AS taken
FROM b
"""

_URL = """
WITH u AS (
  SELECT page_id, url, instr(url, '://') AS mark FROM pages
), h AS (
  SELECT page_id, url, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM u
), p AS (
  SELECT page_id, url, {lower} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    list_sort([x FOR x IN string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&')
      IF x <> '' AND NOT regexp_matches(x, '(?i)^(utm_[a-z]+|ref|fbclid|gclid)=')]) AS q FROM h
), c AS (
  SELECT page_id, host, path, CASE WHEN url IS NOT NULL THEN regexp_replace(host, '^(www|m|mobile|amp)\\.', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END END AS canonical FROM p
), listed AS (
  SELECT DISTINCT canonical FROM c WHERE canonical IS NOT NULL AND regexp_matches(host, '(^|\\.)(spam-farm|cheap-pills|ththan|therha)\\.')
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM c
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN listed.canonical IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM r LEFT JOIN listed USING (canonical)
"""
ORACLE["op4_url_bloom_filter"] = _URL.replace("{lower}", _LOWER.format("regexp_extract(rest, '^[^/?#]*')"))

ORACLE["op7_reply_tree_chat"] = r"""
WITH a AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), b AS (
  SELECT conv_id, turn, role AS r0, text AS t0, coalesce(role, '') AS role, coalesce(text, '') AS text FROM a
), c AS (
  SELECT *, replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\e'), ':', '\c') AS er,
    replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\e') AS et FROM b
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('### ' || er || ': ' || et || ' </turn>') + 1) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

ORACLE["op9_benchmark_decontamination"] = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM documents
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, unnest([array_to_string(w[k:k + least(len(w), 10) - 1], ' ') FOR k IN range(1, len(w) - least(len(w), 10) + 2)]) AS win
  FROM i WHERE len(w) > 0
), ms AS (SELECT DISTINCT m FROM win
), occ AS (
  SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS k, unnest([array_to_string(w[k:k + m - 1], ' ') FOR k IN range(1, len(w) - m + 2)]) AS win
  FROM d, ms WHERE len(w) >= m
), hit AS (SELECT doc_id, k, occ.m, item_id FROM occ JOIN win USING (m, win)
), words AS (
  SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + m)) AS x FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE["op10_pq_near_vectors"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
), f AS (
  SELECT vec_id, x, sqrt(list_sum([y * y FOR y IN x])) AS n FROM v
  WHERE len(x) > 0 AND len([y FOR y IN x IF y IS NULL OR isnan(y) OR isinf(y)]) = 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM f a JOIN f b ON a.vec_id <> b.vec_id AND a.n > 0 AND b.n > 0
  WHERE list_dot_product(a.x, b.x) / (a.n * b.n) >= 0.95
), r(vec_id, c) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.vec_id
), k AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT r.vec_id, coalesce(max(k.n), 0) AS n_links, min(r.c) AS component_id, r.vec_id = min(r.c) AS kept
FROM r LEFT JOIN k ON k.vec_id = r.vec_id GROUP BY r.vec_id
"""

ORACLE["op13_filter_interactions"] = f"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, part, text, regexp_extract_all(text, '{_SPACED}') AS w FROM t
), g AS (SELECT text, min(doc_id) AS first FROM t GROUP BY text
), q AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
    len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
    100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 5 * length(w.text),
    regexp_matches(w.text, '[#$%&*|]'), coalesce(w.doc_id > g.first, false)] AS fails
  FROM w JOIN g ON g.text = w.text LEFT JOIN q ON q.doc_id = w.doc_id
), l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 3, 4, 5]) AS i
), o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS line
  FROM l a JOIN l b ON b.i <> a.i JOIN l c ON c.i NOT IN (a.i, b.i) JOIN l d ON d.i NOT IN (a.i, b.i, c.i) JOIN l e ON e.i NOT IN (a.i, b.i, c.i, d.i)
), s AS (SELECT filter_order, line, CAST(step AS INTEGER) AS step, line[step] AS i FROM o, range(1, 6) r(step)
), c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails
), m AS (
  SELECT c.*, s.*, len([j FOR j IN line[1:step - 1] IF fails[j]]) > 0 AS earlier, fails[s.i] AS now,
    fails[s.i] AND len([j FOR j IN line IF fails[j]]) = 1 AS alone FROM c, s
), r AS (
  SELECT part, filter_order, step, any_value(i) AS i, sum(n) FILTER (NOT earlier AND NOT now) AS kept, sum(n) FILTER (NOT earlier AND now) AS removed,
    sum(n) FILTER (earlier AND now) AS redundant, sum(n) FILTER (alone) AS unique_fails,
    sum(good) FILTER (NOT earlier AND now) AS good_lost, sum(toxic) FILTER (NOT earlier AND now) AS toxic_lost
  FROM m GROUP BY part, filter_order, step
)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, i) AS BIGINT) AS shapley
FROM r
"""
