"""DuckDB SQL for the registered queries of this package that SQL can express."""

ORACLES: dict[str, str] = {
    "op1_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(md5(text), '') AS h,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INTEGER]::BIGINT AS weight
  FROM d GROUP BY source),
r AS (
  SELECT *, sum(source_size) OVER () AS everything,
    coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_size,
    sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM s),
l AS (
  SELECT min_by((1.5::DOUBLE * everything::DOUBLE - 2.0::DOUBLE * full_size::DOUBLE) / open_weight::DOUBLE, source_size / weight) AS level
  FROM r
  WHERE (1.5::DOUBLE * everything::DOUBLE - 2.0::DOUBLE * full_size::DOUBLE) / open_weight::DOUBLE * weight <= 2.0::DOUBLE * source_size),
t AS (
  SELECT source, source_size,
    CASE WHEN weight * level > 2.0::DOUBLE * source_size THEN 2.0::DOUBLE * source_size ELSE weight * level END AS target
  FROM s, l),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size, d.h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
  (CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * size
    + greatest(0, least(size, budget - CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * source_size - before)))::BIGINT AS taken
FROM p
""",
    "op2_ngram_jaccard": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS t
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 3 THEN [array_to_string(t, ' ')]
    ELSE list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]) END) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (
  SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 90 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id) m USING (doc_id)
""",
    "op5_substring_dedup": r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS t FROM documents),
s AS (
  SELECT doc_id, i, md5(array_to_string(t[i + 1 : i + 20], ' ')) AS h
  FROM (SELECT doc_id, t, unnest(range(0, len(t) - 19)) AS i FROM w)),
e AS (SELECT doc_id, i, min((doc_id, i)) OVER (PARTITION BY h) < (doc_id, i) AS again FROM s),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM e WHERE again),
k AS (
  SELECT w.doc_id, count(*) AS n_words, count(c.i) AS n_removed,
    string_agg(p.word, ' ' ORDER BY p.i) FILTER (WHERE c.i IS NULL) AS kept
  FROM w, (SELECT doc_id, unnest(t) AS word, unnest(range(0, len(t))) AS i FROM w) p
  LEFT JOIN c ON c.doc_id = p.doc_id AND c.i = p.i
  WHERE w.doc_id = p.doc_id GROUP BY w.doc_id)
SELECT w.doc_id, coalesce(k.n_words, 0)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
""",
    "op9_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: coalesce(z[1] * z[2], 0)))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM p QUALIFY rank <= 5
""",
    "op11_filter_audit": r"""
WITH l AS (SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id),
w AS (
  SELECT d.doc_id, coalesce(d.text, '') AS text, coalesce(d.lang, '') AS part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
    regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents d LEFT JOIN l ON l.doc_id = d.doc_id),
m AS (
  SELECT part, good, toxic, (
      (len(words) < 200)::INTEGER + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INTEGER
      + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INTEGER
      + 8 * regexp_matches(text, '[#$%&*|]')::INTEGER
      + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INTEGER) AS mask
  FROM w),
c AS (SELECT part, good, toxic, mask, count(*) AS n FROM m GROUP BY ALL),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS f(letter, bit)),
o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5),
s AS (
  SELECT filter_order, k::INTEGER AS step, f.bit,
    (SELECT coalesce(sum(g.bit), 0) FROM f g WHERE position(g.letter IN filter_order) < k)::INTEGER AS before
  FROM o, range(1, 6) r(k), f WHERE substr(filter_order, k::INTEGER, 1) = f.letter)
SELECT part, filter_order, step,
  coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before > 0), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
  coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before = 0 AND good = 1), 0)::BIGINT AS good_lost,
  coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before = 0 AND toxic = 1), 0)::BIGINT AS toxic_lost,
  coalesce(sum(n * (120 // greatest(bit_count(mask), 1))) FILTER (mask & bit > 0), 0)::BIGINT AS shapley
FROM c, s GROUP BY part, filter_order, step
""",
    "op12_turn_repair": r"""
WITH RECURSIVE z AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations),
h AS (  -- CRC-32 bit by bit, low bit first
  SELECT key, list_reduce(
    [4294967295::BIGINT] || list_transform(range(1, length(key) + 1), lambda i: ascii(substr(key, i::INTEGER, 1))::BIGINT),
    lambda crc, byte: list_reduce([xor(crc, byte)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
      lambda c, ignored: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS crc
  FROM (SELECT DISTINCT key FROM z)),
k AS (SELECT z.*, xor(crc, 4294967295::BIGINT) % 20 AS kind FROM z JOIN h USING (key)),
d AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM k),
n AS (
  SELECT *, row_number() OVER w AS i, left(role, 1) AS initial, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last,
    lag(left(role, 1)) OVER w AS before, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
r AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM n),
l AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id),
b AS (  -- least cost and audit from row i on, by what is expected: a start, u behind s, a, u
  SELECT conv_id, n AS i, [{'c': 0, 'a': ''}, {'c': 6, 'a': 'II'}, {'c': 3, 'a': 'I'}, {'c': 0, 'a': ''}] AS q FROM l
  UNION ALL
  SELECT conv_id, i - 1,
    [list_min([{'c': w[1].c, 'a': w[1].a}, {'c': w[3].c + 3, 'a': 'I' || w[3].a}, {'c': w[4].c + 6, 'a': 'II' || w[4].a}]),
     list_min([{'c': w[2].c, 'a': w[2].a}, {'c': w[3].c + 3, 'a': 'I' || w[3].a}, {'c': w[4].c + 6, 'a': 'II' || w[4].a}]),
     list_min([{'c': w[3].c, 'a': w[3].a}, {'c': w[4].c + 3, 'a': 'I' || w[4].a}]),
     list_min([{'c': w[4].c, 'a': w[4].a}, {'c': w[3].c + 3, 'a': 'I' || w[3].a}])]
  FROM (
    SELECT b.conv_id, b.i, list_transform([0, 1, 2, 3], lambda p:
      list_min([{'c': q[p + 1].c + 4, 'a': 'D' || q[p + 1].a}] || CASE WHEN fault IN ('blank', 'duplicate') THEN [] ELSE
        [{'c': x + 3 * (initial <> CASE p WHEN 2 THEN 'a' ELSE 'u' END)::INTEGER + q[CASE p WHEN 2 THEN 4 ELSE 3 END].c,
          'a': CASE WHEN initial <> CASE p WHEN 2 THEN 'a' ELSE 'u' END THEN 'R' ELSE 'K' END || q[CASE p WHEN 2 THEN 4 ELSE 3 END].a}]
        || CASE WHEN p = 0 AND initial = 's' THEN [{'c': x + q[2].c, 'a': 'K' || q[2].a}] ELSE [] END END)) AS w
    FROM b JOIN (SELECT *, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS x FROM r) AS r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i)),
a AS (SELECT conv_id, q[1].c AS cost, q[1].a AS audit FROM b WHERE i = 0),
t AS (  -- the audit followed: place in it, line, role expected
  SELECT conv_id, audit, 1 AS place, 1::BIGINT AS line, 'b' AS expected, ''::VARCHAR AS out, 0 AS lines FROM a
  UNION ALL
  SELECT t.conv_id, audit, place + 1, line + (e <> 'I')::INTEGER,
    CASE WHEN e = 'D' THEN expected WHEN e = 'K' AND expected = 'b' AND initial = 's' THEN 'u' WHEN expected = 'a' THEN 'u' ELSE 'a' END,
    CASE WHEN e = 'D' THEN out ELSE out || CASE WHEN lines > 0 THEN chr(10) ELSE '' END
      || CASE WHEN e = 'K' THEN role WHEN expected = 'a' THEN 'assistant' ELSE 'user' END || ':' || CASE e WHEN 'I' THEN '' ELSE r.text END END,
    lines + (e <> 'D')::INTEGER
  FROM (SELECT *, substr(audit, place, 1) AS e FROM t WHERE place <= length(audit)) AS t
  LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM t.conv_id AND r.i = t.line)
SELECT o.conv_id, coalesce(l.gaps, 0)::BIGINT AS gaps, coalesce(l.blank, 0)::BIGINT AS blank, coalesce(l.duplicate, 0)::BIGINT AS duplicate,
  coalesce(l.truncated, 0)::BIGINT AS truncated, coalesce(l.illegal, 0)::BIGINT AS illegal, coalesce(t.lines * 0 + a.cost, 0)::BIGINT AS cost,
  coalesce(a.audit, '') AS audit, sha256(coalesce(t.out, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o
LEFT JOIN l ON l.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM o.conv_id AND t.place = length(t.audit) + 1
""",
    "op13_decontamination": r"""
WITH i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS t
  FROM benchmark WHERE text IS NOT NULL),
w AS (
  SELECT DISTINCT item_id, least(10, len(t)) AS n, unnest(list_transform(range(1, greatest(len(t) - 9, 1) + 1), lambda p: array_to_string(t[p:p + 9], ' '))) AS run
  FROM i WHERE len(t) > 0),
d AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS t
  FROM documents),
g AS (
  SELECT row, n, unnest(range(1, len(t) - n + 2)) AS p, unnest(list_transform(range(1, len(t) - n + 2), lambda p: array_to_string(t[p:p + n - 1], ' '))) AS run
  FROM d, (SELECT DISTINCT n FROM w) WHERE len(t) >= n),
m AS (SELECT g.row, g.n, g.p, w.item_id FROM g JOIN w ON g.n = w.n AND g.run = w.run),
h AS (SELECT row, count(DISTINCT word) AS n_hit FROM (SELECT row, unnest(range(p, p + n)) AS word FROM m) GROUP BY row),
j AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM m WHERE item_id IS NOT NULL) GROUP BY row)
SELECT doc_id, len(t)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (row) LEFT JOIN j USING (row)
""",
}
