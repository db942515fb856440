"""DuckDB SQL for the registered queries, written independently of the Spark expressions.

The chunk fold is a list reduction over whole texts; retrieval counts tokens per hashed slot and joins
on the slots.
"""

from __future__ import annotations

MAX_SIZE, WIDER_SIZE, MIN_SIZE = 120, 160, 40
DIM = 256

LINES = """
lines AS (
  SELECT doc_id, source || '/' || doc_id || '.txt' AS path,
         unnest(string_split(text, chr(10))) AS content,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents),
typed AS (
  SELECT *, CASE WHEN (length(content) - length(replace(content, ' | ', ''))) / 3 >= 2 THEN 'table'
                 WHEN pos = 0 AND length(content) <= 200 THEN 'title'
                 WHEN regexp_matches(content, '^#{1,6} ') OR length(content) <= 60 THEN 'section_header'
                 ELSE 'text' END AS type
  FROM lines),
els AS (
  SELECT doc_id, path, pos, type, content,
         CASE type WHEN 'table' THEN '[TABLE] ' || content WHEN 'title' THEN '[TITLE] ' || content
                   WHEN 'section_header' THEN '[SECTION_HEADER] ' || content ELSE content END AS text
  FROM typed),
sized AS (
  SELECT *, CASE WHEN regexp_matches(text, '^[\\s\\x{a0}]*$') THEN 0 ELSE length(text) // 4 END AS size
  FROM els)"""


def _shut(keep: str, small: str) -> str:
    """List of finished chunks after the running one is closed."""
    chunk = "{{'content': s.cur, 'section': s.section, 'chunk_type': '{}'}}"
    return f"""CASE WHEN s.n = 0 THEN s.done
      WHEN s.size >= {MIN_SIZE} THEN list_append(s.done, {chunk.format(keep)})
      WHEN s.done[-1].chunk_type IN ('section_based','size_limited','final','small_section','merged')
      THEN list_append(s.done[:-2], {{'content': s.done[-1].content || chr(10) || chr(10) || s.cur,
                                      'section': s.done[-1].section, 'chunk_type': 'merged'}})
      ELSE list_append(s.done, {chunk.format(small)}) END"""


def fold(name: str, max_size: int) -> str:
    """CTEs ``name``: one row per chunk of every document."""
    opened = "'n': 1, 'cur': e.text, 'size': e.size"
    return f"""
{name}_done AS (
  SELECT doc_id, path, list_reduce(
    list({{'kind': type, 'text': text, 'content': content, 'size': size}} ORDER BY pos)
      || [{{'kind': '(end)', 'text': '', 'content': '', 'size': 0::BIGINT}}],
    lambda s, e: CASE
      WHEN e.kind = '(end)' THEN
        {{'done': {_shut('final', 'small_final')}, 'n': 0, 'cur': '', 'size': 0::BIGINT, 'section': ''}}
      WHEN e.kind IN ('title', 'section_header') THEN
        {{'done': {_shut('section_based', 'small_section')}, {opened},
          'section': replace(e.text, '[' || upper(e.kind) || '] ', '')}}
      WHEN s.size + e.size > {max_size} AND s.n > 0 AND e.kind <> 'table' THEN
        {{'done': {_shut('size_limited', 'small_size')}, {opened}, 'section': s.section}}
      ELSE
        {{'done': s.done, 'n': s.n + 1,
          'cur': CASE WHEN s.n = 0 THEN e.text ELSE s.cur || chr(10) || chr(10) || e.text END,
          'size': s.size + e.size, 'section': s.section}} END,
    {{'done': []::STRUCT(content VARCHAR, section VARCHAR, chunk_type VARCHAR)[], 'n': 0, 'cur': '',
      'size': 0::BIGINT, 'section': 'Introduction'}}).done AS done
  FROM sized GROUP BY doc_id, path),
{name}_rows AS (
  SELECT doc_id, path, unnest(done) AS c, unnest(range(len(done))) AS chunk_pos FROM {name}_done),
{name} AS MATERIALIZED (
  SELECT doc_id, path, chunk_pos, md5(c.content) AS chunk_id, c.content AS chunk_content,
         c.section AS chunk_section, c.chunk_type AS chunk_type
  FROM {name}_rows)"""


CHUNKS = f"WITH {LINES}, {fold('chunk', MAX_SIZE)}"
BOTH = f"{CHUNKS}, {fold('wide', WIDER_SIZE)}"


def keyed(name: str, rows: str) -> str:
    return f"""
{name} AS MATERIALIZED (
  SELECT * FROM {rows} QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY path, chunk_pos) = 1)"""


def words(text: str) -> str:
    return f"list_filter(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"


def slots(name: str, rows: str, key: str, text: str) -> str:
    """CTEs with the token count per hashed slot and the vector norm of every row."""
    return f"""
{name}_words AS (SELECT {key} AS id, unnest({words(text)}) AS t FROM {rows}),
{name}_slots AS MATERIALIZED (
  SELECT id, ('0x' || substr(md5(t), 1, 8))::BIGINT % {DIM} AS slot, count(*) AS c
  FROM {name}_words GROUP BY ALL),
{name}_norm AS (SELECT id, sqrt(sum(c * c)) AS norm FROM {name}_slots GROUP BY id)"""


def hits(name: str, asked: str, k: int) -> str:
    """CTE ``name``: id, chunk_id, score, rank of the best k chunks for the slots CTE ``asked``."""
    return f"""
{name}_dots AS (
  SELECT q.id, v.id AS chunk_id, sum(q.c * v.c) AS dot
  FROM {asked}_slots q JOIN held_slots v USING (slot) GROUP BY ALL),
{name} AS MATERIALIZED (
  SELECT id, chunk_id, round(dot / (qn.norm * vn.norm), 6) AS score,
         row_number() OVER (PARTITION BY id ORDER BY round(dot / (qn.norm * vn.norm), 6) DESC, chunk_id) AS rank
  FROM {name}_dots JOIN {asked}_norm qn USING (id) JOIN held_norm vn ON vn.id = chunk_id
  WHERE round(dot / (qn.norm * vn.norm), 6) > 0
  QUALIFY rank <= {k})"""


REVISED = f"""WITH revised AS (
  SELECT * REPLACE (CASE WHEN doc_id % 5 = 0 THEN text || chr(10) || 'Revised in this version.' ELSE text END AS text)
  FROM documents WHERE doc_id % 7 <> 0),
{LINES.replace('FROM documents)', 'FROM revised)')}, {fold('chunk', MAX_SIZE)}"""

EXACT = """v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
s AS (SELECT a.vec_id, b.vec_id AS hit_vec_id, round(list_cosine_similarity(a.e, b.e), 6) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id)"""


NEAREST = """
SELECT vec_id, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, hit_vec_id)::BIGINT AS rank, hit_vec_id, score
FROM s QUALIFY rank <= 5"""


def kept_cells(areas: int, cells: int) -> str:
    """CTE ``found``: the best five of the cells that each vector visits."""
    near = "row_number() OVER (PARTITION BY {} ORDER BY list_cosine_similarity({}) DESC, {})"
    return f"""{EXACT},
p AS (  -- pivots, from three quarters of the vectors; the first of them are areas
  SELECT e, row_number() OVER (ORDER BY md5(vec_id::VARCHAR), vec_id) - 1 AS num, ceil(sqrt(count(*) OVER ())) AS n
  FROM v WHERE vec_id % 4 <> 0 QUALIFY num < n),
a AS (SELECT num AS area, e FROM p WHERE num < ceil(sqrt(n))),
c AS (SELECT p.num AS cell, p.e, a.area FROM p, a QUALIFY {near.format('p.num', 'p.e, a.e', 'a.area')} = 1),
used AS (SELECT * FROM a WHERE area IN (SELECT area FROM c)),
of_area AS (SELECT v.vec_id, v.e, used.area FROM v, used QUALIFY {near.format('v.vec_id', 'v.e, used.e', 'used.area')} = 1),
of_cell AS (
  SELECT o.vec_id, c.cell FROM of_area o JOIN c ON c.area = o.area WHERE o.vec_id % 10 <> 3
  QUALIFY {near.format('o.vec_id', 'o.e, c.e', 'c.cell')} = 1),
near_area AS (SELECT v.vec_id, v.e, used.area FROM v, used QUALIFY {near.format('v.vec_id', 'v.e, used.e', 'used.area')} <= {areas}),
visit AS (
  SELECT o.vec_id, c.cell FROM near_area o JOIN c ON c.area = o.area QUALIFY {near.format('o.vec_id', 'o.e, c.e', 'c.cell')} <= {cells}),
found AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.vec_id ORDER BY score DESC, hit_vec_id) AS rank
  FROM s JOIN of_cell h ON h.vec_id = s.hit_vec_id JOIN visit q ON q.vec_id = s.vec_id AND q.cell = h.cell QUALIFY rank <= 5)"""


INDEX = f"{CHUNKS}, {keyed('idx', 'chunk')}, {slots('held', 'idx', 'chunk_id', 'chunk_content')}"

PLACE = "chunk_id, path, chunk_pos, chunk_section, chunk_type"


def _placed(rows: str) -> str:
    return f"SELECT {PLACE}, len({words('chunk_content')})::BIGINT AS n_tokens FROM {rows}"


PAIRS_OF = """
pairs AS (
  SELECT conv_id, turn, text AS question, next_text AS response FROM (
    SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text, lead(turn, 2) OVER w AS followed
    FROM {messages} m WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND text <> '' AND next_role = 'assistant' AND next_text <> '' AND followed IS NOT NULL"""

PAIRS = f"""{PAIRS_OF.format(messages='conversations')}),
recent AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 2),
nested AS (
  SELECT c.conv_id, count(r.turn)::BIGINT AS n_pairs,
         coalesce(string_agg('Q: ' || question || chr(10) || 'A: ' || response, chr(10) ORDER BY r.turn), '') AS history
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN recent r USING (conv_id) GROUP BY c.conv_id)"""

QUESTION = """
asked AS (SELECT conv_id, arg_max(text, turn) AS question FROM conversations GROUP BY conv_id)"""

FALLBACK = (
    "I''m sorry, I don''t have enough information to answer your question. "
    "Please ask the user to provide more details or ask a different question."
)

CONVERSATION_HITS = f"""{INDEX}, {QUESTION}, {PAIRS}, {slots('q', 'asked', 'conv_id', 'question')}, {hits('hit', 'q', 5)},
ctx AS (
  SELECT id AS conv_id, string_agg(chunk_content, chr(10) || chr(10) ORDER BY rank) AS context,
         arg_min(chunk_content, rank) AS top
  FROM hit JOIN idx USING (chunk_id) GROUP BY id)"""

EXAMPLES = f"""{PAIRS},
qa AS (SELECT conv_id || ':' || turn AS example_id, question, response AS expected FROM pairs),
placed AS (SELECT *, (row_number() OVER (ORDER BY md5('0:' || example_id)) - 1)::BIGINT AS position,
                  count(*) OVER () AS total FROM qa),
split AS (SELECT *, CASE WHEN position < floor(total * CAST(0.7 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM placed)"""


def runs(examples: str) -> str:
    """CTEs ``run`` (program, example_id, question, expected, response), ``judged`` and ``f1``."""
    return f"""{INDEX}, {EXAMPLES}, {slots('q', examples, 'example_id', 'question')}, {hits('hit', 'q', 5)},
ctx AS (
  SELECT id AS example_id, string_agg(chunk_content, chr(10) || chr(10) ORDER BY rank) AS everything,
         arg_min(chunk_content, rank) AS top
  FROM hit JOIN idx USING (chunk_id) GROUP BY id),
made AS (
  SELECT 'leading_sentence' AS program, e.*, regexp_extract(top, '^[^.!?\\n]*[.!?]?') AS r FROM {examples} e LEFT JOIN ctx USING (example_id)
  UNION ALL SELECT 'top_passage', e.*, top FROM {examples} e LEFT JOIN ctx USING (example_id)
  UNION ALL SELECT 'all_passages', e.*, everything FROM {examples} e LEFT JOIN ctx USING (example_id)),
run AS MATERIALIZED (
  SELECT program, example_id, question, expected,
         CASE WHEN r IS NULL OR trim(r, ' ' || chr(9) || chr(10) || chr(13)) = '' THEN '{FALLBACK}' ELSE r END AS response
  FROM made),
judged AS (
  SELECT program, example_id,
         len(list_distinct({words('expected')})) AS want,
         len(list_intersect(list_distinct({words('expected')}), list_distinct({words('response')}))) AS found
  FROM run),
scored AS (
  SELECT program, example_id, CASE WHEN found >= want * CAST(0.3 AS DOUBLE) THEN 1 ELSE 0 END AS score,
         found || ' of ' || want || ' expected tokens found' AS feedback FROM judged),
bag AS (
  SELECT program, example_id, t, sum(a) AS a, sum(b) AS b FROM (
    SELECT program, example_id, unnest({words('response')}) AS t, 1 AS a, 0 AS b FROM run
    UNION ALL SELECT program, example_id, unnest({words('expected')}), 0, 1 FROM run) GROUP BY ALL),
sums AS (
  SELECT r.program, r.example_id, coalesce(sum(least(a, b)), 0)::DOUBLE AS n, coalesce(sum(a), 0)::DOUBLE AS a, coalesce(sum(b), 0)::DOUBLE AS b
  FROM run r LEFT JOIN bag USING (program, example_id) GROUP BY ALL),
f1 AS (
  SELECT program, example_id, round(CASE WHEN a > 0 THEN n / a ELSE 0 END, 6) AS precision,
         round(CASE WHEN b > 0 THEN n / b ELSE 0 END, 6) AS recall,
         round(CASE WHEN n > 0 THEN 2 * n / (a + b) ELSE 0 END, 6) AS f1 FROM sums),
grid AS (
  SELECT program, example_id, 'judge_correctness' AS metric_name, score::DOUBLE AS score FROM scored
  UNION ALL SELECT program, example_id, 'token_f1', f1 FROM f1),
means AS (
  SELECT program, metric_name, round(avg(score), 6) AS accuracy, count(*)::BIGINT AS n_examples FROM grid GROUP BY ALL)"""


TESTED = runs("(SELECT * FROM split WHERE split = 'test')")

LABEL_RUNS = """
WITH board AS (
  SELECT lang, source AS program, round(avg(quality), 6) AS accuracy, count(*)::BIGINT AS n_examples,
         CAST(regexp_extract(source, '[0-9]+$') AS BIGINT) AS position, lang || '-' || source AS run_id,
         'quality_' || source AS metric_name
  FROM labels JOIN documents USING (doc_id) GROUP BY lang, source),
ranked AS (
  SELECT *, row_number() OVER w AS rank, coalesce(lead(accuracy) OVER w, 0.0) AS runner_up_accuracy
  FROM board WINDOW w AS (PARTITION BY lang ORDER BY accuracy DESC, position))"""

REGISTRY = """
registry AS (
  SELECT DISTINCT 'retriever_' || lang AS model, a.alias AS alias, a.version AS version
  FROM documents, (VALUES ('champion', 1), ('challenger', 2)) a(alias, version)),
gate AS (
  SELECT 'retriever_' || lang AS model, avg(quality) AS champion, avg(1 - toxic) AS challenger
  FROM labels JOIN documents USING (doc_id) GROUP BY lang),
promoted AS (
  SELECT r.model, r.alias,
         CASE WHEN r.alias = 'champion' AND round(g.challenger, 6) > round(g.champion, 6) THEN 2 ELSE r.version END::BIGINT AS version
  FROM registry r LEFT JOIN gate g USING (model))"""

_TAGS = "h1|h2|h3|h4|h5|h6|p|li|table|figure|nav|footer|div|script|style"
_CLEAN = "regexp_replace(html, '(?s)<!--.*?-->', '', 'g')"
for _tag in ("nav", "footer", "script", "style"):
    _CLEAN = f"regexp_replace({_CLEAN}, '(?is)<{_tag}[ \\t\\r\\n>].*?</{_tag}[ \\t\\r\\n]*>', ' ', 'g')"

ORACLES: dict[str, str] = {
    "text_elements": f"WITH {LINES} SELECT doc_id, pos::BIGINT AS pos, type, content FROM els",
    "html_elements": f"""
WITH pages_clean AS (SELECT page_id, {_CLEAN} AS html FROM pages),
blocks AS (
  SELECT page_id, unnest(string_split(regexp_replace(html,
           '(?i)<({_TAGS})([ \\t\\r\\n>])', chr(1) || '<\\1\\2', 'g'), chr(1))) AS block,
         generate_subscripts(string_split(regexp_replace(html,
           '(?i)<({_TAGS})([ \\t\\r\\n>])', chr(1) || '<\\1\\2', 'g'), chr(1)), 1) AS place
  FROM pages_clean),
kept AS (
  SELECT page_id, place, lower(regexp_extract(block, '^<([a-zA-Z0-9]+)', 1)) AS tag,
         trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(block, '<[^>]*>', ' ', 'g'),
           '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \\t\\r\\n]+', ' ', 'g')) AS content
  FROM blocks WHERE regexp_matches(block, '(?i)^<(h[1-6]|p|li|div|table|figure)[ \\t\\r\\n>]'))
SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY place) - 1)::BIGINT AS pos,
       CASE WHEN tag = 'h1' THEN 'title' WHEN tag LIKE 'h%' THEN 'section_header' WHEN tag IN ('p', 'li', 'div') THEN 'text' ELSE tag END AS type,
       content
FROM kept WHERE content <> ''""",
    "normalize_elements": """
WITH parts AS (
  SELECT conv_id, turn, CASE WHEN role = 'system' THEN [text] ELSE string_split(text, chr(10)) END AS items FROM conversations)
SELECT conv_id, turn, unnest(range(len(items)))::BIGINT AS pos, 'text' AS kind, unnest(items) AS text FROM parts""",
    "element_text": f"WITH {LINES} SELECT doc_id, pos::BIGINT AS pos, type AS kind, text FROM els",
    "section_breaks": f"WITH {LINES} SELECT doc_id, pos::BIGINT AS pos, type AS kind FROM els WHERE type IN ('title', 'section_header')",
    "element_sections": f"""WITH {LINES}
SELECT doc_id, pos::BIGINT AS pos, coalesce(last_value(
         CASE WHEN type IN ('title', 'section_header') THEN replace(text, '[' || upper(type) || '] ', '') END IGNORE NULLS)
       OVER (PARTITION BY doc_id ORDER BY pos), 'Introduction') AS section
FROM els""",
    "token_counts": f"WITH {LINES} SELECT doc_id, pos::BIGINT AS pos, size::BIGINT AS size FROM sized",
    "chunks": f"{CHUNKS} SELECT doc_id, path, chunk_pos, chunk_id, chunk_content, chunk_section, chunk_type FROM chunk",
    "json_chunks": f"{CHUNKS} SELECT doc_id, chunk_pos, chunk_id, chunk_section, chunk_type FROM chunk",
    "chunk_ids": f"{CHUNKS} SELECT chunk_id, count(*)::BIGINT AS n_chunks FROM chunk GROUP BY chunk_id",
    "chunk_type_stats": f"""{CHUNKS}
SELECT coalesce(chunk_type, '(all)') AS chunk_type, count(*)::BIGINT AS n_chunks, min(length(chunk_content)) AS min_chars,
       max(length(chunk_content)) AS max_chars, sum(length(chunk_content))::BIGINT AS sum_chars
FROM chunk GROUP BY ROLLUP (chunk_type)""",
    "atomic_overflow": f"""{CHUNKS}
SELECT doc_id, chunk_pos, chunk_type, length(chunk_content) // 4 AS size FROM chunk
WHERE length(chunk_content) // 4 > {MAX_SIZE}
  AND len(list_filter(string_split(chunk_content, chr(10) || chr(10)), lambda p: starts_with(p, '[TABLE] '))) > 0""",
    "docs_without_chunks": f"""{CHUNKS},
counted AS (
  SELECT d.source, CASE WHEN d.doc_id % 41 IN (7, 8) THEN 0 ELSE count(c.doc_id) END AS n
  FROM documents d LEFT JOIN chunk c USING (doc_id) GROUP BY d.doc_id, d.source, d.lang)
SELECT source, count(*)::BIGINT AS n_docs, count(*) FILTER (n = 0)::BIGINT AS n_without_chunks, sum(n)::BIGINT AS n_chunks
FROM counted GROUP BY source""",
    "variant_paths": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       json_extract(props, '$.document.elements') IS NULL AS elements_missing, json_extract(props, '$.k')::VARCHAR AS k_json
FROM events""",
    "file_name": "SELECT page_id, regexp_extract(url, '([^/]+)$', 1) AS file_name FROM pages",
    "expectation_report": f"""{CHUNKS}
SELECT 'valid_content' AS rule, count(*) FILTER (lang = 'de' AND doc_id % 41 NOT IN (7, 8))::BIGINT AS passed,
       count(*) FILTER (lang <> 'de' OR doc_id % 41 IN (7, 8))::BIGINT AS failed FROM documents
UNION ALL SELECT 'valid_path', count(*) FILTER (NOT url LIKE '%/')::BIGINT, count(*) FILTER (url LIKE '%/')::BIGINT FROM pages
UNION ALL SELECT 'valid_chunk', count(chunk_content)::BIGINT, (count(*) - count(chunk_content))::BIGINT FROM chunk
UNION ALL SELECT 'valid_chunk_id', count(chunk_id)::BIGINT, (count(*) - count(chunk_id))::BIGINT FROM chunk""",
    "topk_cosine": f"WITH {EXACT} {NEAREST}",
    "topk_cells": f"WITH {EXACT} {NEAREST}",
    "ann_topk": f"WITH {kept_cells(8, 28)} SELECT vec_id, rank::BIGINT AS rank, hit_vec_id, score FROM found",
    "ann_recall": f"""WITH {kept_cells(8, 28)},
best AS (
  SELECT vec_id, hit_vec_id, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, hit_vec_id) AS rank
  FROM s WHERE hit_vec_id % 10 <> 3 QUALIFY rank <= 5)
SELECT count(*) AS n_exact, count(f.vec_id) AS n_found, count(f.vec_id) / count(*) AS recall
FROM best b LEFT JOIN found f ON f.vec_id = b.vec_id AND f.hit_vec_id = b.hit_vec_id""",
    "embed_chunks": f"""{INDEX}
SELECT i.chunk_id, {DIM}::BIGINT AS dim, count(slot)::BIGINT AS n_filled, coalesce(sum(c), 0)::BIGINT AS n_tokens,
       coalesce(sum(c * slot), 0)::BIGINT AS checksum
FROM idx i LEFT JOIN held_slots ON id = i.chunk_id GROUP BY i.chunk_id""",
    "index_snapshot": f"{CHUNKS}, {keyed('idx', 'chunk')} {_placed('idx')}",
    "index_stats": f"""{CHUNKS}
SELECT count(DISTINCT chunk_id)::BIGINT AS n_rows, count(DISTINCT chunk_id)::BIGINT AS n_keys, {DIM}::BIGINT AS min_dim, {DIM}::BIGINT AS max_dim
FROM chunk""",
    "chunk_changes": f"""{BOTH}, {keyed('old', 'chunk')}, {keyed('new', 'wide')}
SELECT coalesce(o.chunk_id, n.chunk_id) AS chunk_id,
       CASE WHEN o.chunk_id IS NULL THEN 'insert' WHEN n.chunk_id IS NULL THEN 'delete' ELSE 'update' END AS change
FROM old o FULL JOIN new n ON o.chunk_id = n.chunk_id
WHERE o.chunk_id IS NULL OR n.chunk_id IS NULL
   OR (o.path, o.chunk_pos, o.chunk_section, o.chunk_type) IS DISTINCT FROM (n.path, n.chunk_pos, n.chunk_section, n.chunk_type)""",
    "index_sync": f"WITH {LINES}, {fold('wide', WIDER_SIZE)}, {keyed('new', 'wide')} {_placed('new')}",
    "rerank_topk": f"""{INDEX}, {slots('q', 'benchmark', 'item_id', 'text')}, {hits('hit', 'q', 12)},
overlap AS (
  SELECT id AS item_id, rank AS first_rank, chunk_id, score,
         round(len(list_intersect(list_distinct({words('text')}), list_distinct({words('chunk_content')})))
               / len(list_distinct({words('text')})), 6) AS rerank_score
  FROM hit JOIN idx USING (chunk_id) JOIN benchmark ON item_id = id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY rerank_score DESC, score DESC, chunk_id) AS rank,
       first_rank, chunk_id, rerank_score, score
FROM overlap QUALIFY rank <= 3""",
    "rerank_late": f"""{INDEX}, {slots('q', 'benchmark', 'item_id', 'text')}, {hits('hit', 'q', 12)},
asked AS (SELECT item_id, unnest(list_distinct({words('text')})) AS word FROM benchmark),
held AS (SELECT chunk_id, unnest(list_distinct({words('chunk_content')})) AS word FROM idx WHERE chunk_id IN (SELECT chunk_id FROM hit)),
letters AS MATERIALIZED (
  SELECT word, list_transform(range(32), lambda d: len(list_filter(string_split(word, ''), lambda c: unicode(c) % 32 = d))::DOUBLE) AS v
  FROM (SELECT word FROM asked UNION SELECT word FROM held)),
sims AS (
  SELECT h.id AS item_id, h.chunk_id, a.word, max(list_cosine_similarity(x.v, y.v)) AS best
  FROM hit h JOIN asked a ON a.item_id = h.id JOIN held p USING (chunk_id) JOIN letters x ON x.word = a.word JOIN letters y ON y.word = p.word
  GROUP BY ALL),
late AS (
  SELECT s.item_id, h.rank AS first_rank, s.chunk_id, h.score, round(avg(best), 6) AS rerank_score
  FROM sims s JOIN hit h ON h.id = s.item_id AND h.chunk_id = s.chunk_id GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY rerank_score DESC, score DESC, chunk_id) AS rank,
       first_rank, chunk_id, rerank_score, score
FROM late QUALIFY rank <= 3""",
    "format_hits": f"""{INDEX},
asked AS (SELECT conv_id, CASE WHEN conv_id % 10 = 0 THEN ' ' ELSE arg_max(text, turn) END AS question FROM conversations GROUP BY conv_id),
{slots('q', 'asked', 'conv_id', 'question')}, {hits('hit', 'q', 3)},
told AS (
  SELECT id, string_agg('Result ' || rank || ':' || chr(10) || '  Content: ' || chunk_content || chr(10) || '  Source: ' || path
                        || chr(10) || '  Chunk ID: ' || chunk_id, chr(10) || chr(10) ORDER BY rank) AS t
  FROM hit JOIN idx USING (chunk_id) GROUP BY id)
SELECT conv_id, CASE WHEN trim(question) = '' THEN 'Error: Empty query provided'
                     ELSE coalesce(t, 'No results found for the query.') END AS result
FROM asked LEFT JOIN told ON id = conv_id""",
    "stream_chunks": f"""{CHUNKS}
SELECT path, regexp_extract(path, '[^/]+$') AS file_name, chunk_pos, chunk_id, chunk_section, chunk_type FROM chunk""",
    "stream_index": f"{CHUNKS}, {keyed('idx', 'chunk')} {_placed('idx')}",
    "stream_versions": f"{REVISED}, {keyed('idx', 'chunk')} {_placed('idx')}",
    "ingest_files": """
WITH lines AS (SELECT unnest(string_split(html, chr(10))) AS line FROM pages)
SELECT length(line) AS n_chars, md5(line) AS line_md5 FROM lines WHERE line <> ''""",
    "layout_stats": f"{CHUNKS} SELECT count(*)::BIGINT AS n_rows, 0::BIGINT AS overlaps FROM chunk",
    "history_pairs": f"WITH {PAIRS} SELECT * FROM pairs",
    "history_gapped": f"WITH {PAIRS_OF.format(messages='(SELECT conv_id, 2 * turn AS turn, role, text FROM conversations WHERE (conv_id + turn) % 5 <> 0)')}) SELECT * FROM pairs",
    "stream_history": f"""WITH {PAIRS_OF.format(messages='conversations')})
SELECT *, coalesce(lag(question) OVER (PARTITION BY conv_id ORDER BY turn) || chr(10), '') || question AS asked FROM pairs""",
    "history_recent": f"WITH {PAIRS} SELECT * FROM recent",
    "history_nested": f"WITH {PAIRS} SELECT * FROM nested",
    "current_question": f"WITH {QUESTION} SELECT * FROM asked",
    "plain_questions": "SELECT item_id, text AS question, 0::BIGINT AS n_pairs FROM benchmark",
    "validate_requests": """
WITH last AS (
  SELECT conv_id, count(*)::BIGINT AS n, CASE WHEN conv_id % 5 = 0 THEN ' ' ELSE arg_max(text, turn) END AS q FROM conversations GROUP BY conv_id)
SELECT d.doc_id AS conv_id, coalesce(n, 0)::BIGINT AS n_messages,
       CASE WHEN n IS NULL THEN 'no_messages' WHEN trim(q, ' ' || chr(9) || chr(10) || chr(13)) = '' THEN 'empty' ELSE 'ok' END AS status,
       CASE WHEN n IS NULL THEN 'Messages list cannot be empty'
            WHEN trim(q, ' ' || chr(9) || chr(10) || chr(13)) = '' THEN 'I received an empty message. Could you please rephrase your question?' END AS reply
FROM documents d LEFT JOIN last ON d.doc_id = conv_id""",
    "rag_context": f"{CONVERSATION_HITS} SELECT conv_id, context FROM ctx",
    "rag_inputs": f"""{CONVERSATION_HITS}
SELECT conv_id, question, coalesce(context, '') AS context, history FROM asked LEFT JOIN ctx USING (conv_id) JOIN nested USING (conv_id)""",
    "rag_answers": f"{CONVERSATION_HITS} SELECT conv_id, coalesce(top, '{FALLBACK}') AS response FROM asked LEFT JOIN ctx USING (conv_id)",
    "coerce_response": "SELECT event_id, event_type || ' ' || user_id AS response FROM events",
    "qa_examples": f"WITH {EXAMPLES} SELECT example_id, question, expected AS response, question AS first_message FROM qa",
    "split_full": f"WITH {EXAMPLES} SELECT example_id, position, split FROM split",
    "split_test_mode": f"""WITH {EXAMPLES}
SELECT example_id, position, CASE WHEN position < 3 THEN 'train' ELSE 'test' END AS split FROM placed WHERE position < 6""",
    "judge_score": f"{runs('qa')} SELECT program, example_id, score::BIGINT AS score, feedback FROM scored",
    "token_f1": f"{runs('qa')} SELECT * FROM f1",
    "mean_accuracy": f"{runs('qa')} SELECT * FROM means",
    "eval_grid": f"{TESTED} SELECT program, example_id, metric_name, score FROM grid",
    "baseline_gain": f"""{TESTED}
SELECT a.metric_name, a.accuracy, s.accuracy AS baseline_small_accuracy, l.accuracy AS baseline_large_accuracy,
       round(a.accuracy - s.accuracy, 6) AS improvement_over_small, round(a.accuracy - l.accuracy, 6) AS improvement_over_large
FROM means a JOIN means s USING (metric_name) JOIN means l USING (metric_name)
WHERE a.program = 'all_passages' AND s.program = 'leading_sentence' AND l.program = 'top_passage'""",
    "champion_challenger": f"""{TESTED}
SELECT c.metric_name, c.accuracy AS champion_accuracy, h.accuracy AS challenger_accuracy,
       CASE WHEN h.accuracy > c.accuracy THEN 'challenger' ELSE 'champion' END AS winner
FROM means c JOIN means h USING (metric_name) WHERE c.program = 'top_passage' AND h.program = 'all_passages'""",
    "demo_select": f"""{runs("(SELECT * FROM split WHERE split = 'train')")},
passing AS (
  SELECT program, 'bootstrapped' AS kind, row_number() OVER (PARTITION BY program ORDER BY position) AS rank, example_id
  FROM scored JOIN split USING (example_id) WHERE score >= 1 QUALIFY rank <= 2)
SELECT * FROM passing
UNION ALL SELECT DISTINCT program, 'labelled', position + 1, split.example_id FROM scored, split WHERE position < 2""",
    "leaderboard": f"""{LABEL_RUNS}
SELECT lang, program, accuracy, n_examples, rank, runner_up_accuracy, rank = 1 AS is_winner,
       round(accuracy - runner_up_accuracy, 6) AS gain FROM ranked""",
    "leaderboard_summary": f"""{LABEL_RUNS}
SELECT lang, arg_min(program, rank) AS winner, arg_min(run_id, rank) AS best_run_id, max(accuracy) AS best_accuracy,
       arg_min(runner_up_accuracy, rank) AS runner_up_accuracy,
       round(max(accuracy) - arg_min(runner_up_accuracy, rank), 6) AS accuracy_improvement, count(*)::BIGINT AS num_models_compared,
       string_agg(metric_name, ',' ORDER BY position) AS metrics_compared, string_agg(run_id, ',' ORDER BY position) AS all_run_ids
FROM ranked GROUP BY lang""",
    "run_metrics": f"""{LABEL_RUNS}
SELECT run_id, 'metric' AS kind, 'accuracy' AS key, accuracy::VARCHAR AS value FROM board
UNION ALL SELECT run_id, 'param', 'n_examples', n_examples::VARCHAR FROM board
UNION ALL SELECT run_id, 'param', 'metric_name', metric_name FROM board
UNION ALL SELECT run_id, 'tag', 'lang', lang FROM board""",
    "promote_alias": f"WITH {REGISTRY} SELECT * FROM promoted",
    "alias_lookup": f"WITH {REGISTRY} SELECT * FROM promoted WHERE alias = 'champion'",
    "register_best": f"""{LABEL_RUNS}, {REGISTRY}
SELECT model, alias, CASE WHEN alias = 'challenger' AND model IN (SELECT 'retriever_' || lang FROM ranked) THEN 3 ELSE version END::BIGINT AS version
FROM registry""",
    "version_tags": f"""{LABEL_RUNS}, {REGISTRY},
best AS (SELECT 'retriever_' || lang AS model, lang, program FROM ranked WHERE rank = 1),
next AS (SELECT model, max(version) + 1 AS version FROM registry GROUP BY model)
SELECT model, version::BIGINT AS version, 'training_run_id' AS key, lang || '-' || program AS value FROM best JOIN next USING (model)
UNION ALL SELECT model, version::BIGINT, 'experiment_group', lang FROM best JOIN next USING (model)""",
}
