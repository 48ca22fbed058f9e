"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

OP5 = """
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

# Escaped length: one more character for each control string, backslashes in it or not.
OP2 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), m AS (
  SELECT *,
    len(regexp_extract_all(text, '<\\*(\|im_start\|>|\|im_end\|>|s>|/s>)|\[\\*(INST\]|/INST\])')) AS marks,
    length(role) + length(replace(replace(role, chr(92), 'xx'), chr(10), 'xx')) - length(role)
      + len(regexp_extract_all(role, '<(\|im_start\|>|\|im_end\|>|s>|/s>)|\[(INST\]|/INST\])')) AS role_chars
  FROM t
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(12 + role_chars + 1 + length(text) + marks + 10 + 1) AS BIGINT) AS formatted_chars
FROM m
GROUP BY conv_id
"""


# The pages' markup has one shape, which expressions can undo: the article between its
# tags, blocks at p and h1 tags, other tags gone, references decoded (ampersand last).
OP6 = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS body FROM pages
), b AS (
  SELECT page_id, url,
         list_filter(list_transform(regexp_split_to_array(regexp_replace(body, '(?s)<!--.*?-->', '', 'g'), '</?(p|h1|article)>'),
           lambda x: trim(regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace(regexp_replace(
                  regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '</?[a-z][^>]*>', '', 'g'),
                  '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#x27;', chr(39)), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks
  FROM a
)
SELECT page_id, url, coalesce(array_to_string(blocks, chr(10) || chr(10)), '') AS text,
       length(coalesce(array_to_string(blocks, chr(10) || chr(10)), '')) AS n_chars
FROM b
"""


def mix_ctes(docs: str, sweeps: int = 6) -> str:
    """CTEs that end in ``mixed`` (all columns of ``docs`` and the draw), written as window
    sums over the cells; the fixed values are those of the query."""
    steps = []
    for k in range(3 * sweeps):
        m = ("source", "lang", "topic")[k % 3]
        steps.append(f"""w{k + 1} AS (
  SELECT k_source, k_lang, k_topic, tokens, g_source, g_lang, g_topic, mass,
         w * coalesce(g_{m} / nullif(sum(w) OVER (PARTITION BY k_{m}), 0), 1) AS w FROM w{k})""")
    return f"""
t AS (
  SELECT *, CASE WHEN contains(text, 'Licensed under') THEN 'license' WHEN contains(text, ' | ') THEN 'table'
                 WHEN contains(text, '!!') THEN 'shout' WHEN contains(text, '***') OR contains(text, '%%%') THEN 'symbols'
                 ELSE 'prose' END AS topic,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens,
         coalesce('=' || source, 'null') AS k_source, coalesce('=' || lang, 'null') AS k_lang
  FROM {docs}
), c AS (
  SELECT k_source, k_lang, '=' || topic AS k_topic, sum(n_tokens)::BIGINT AS tokens FROM t GROUP BY ALL
), gs AS (
  SELECT k_source, pow(sum(tokens)::DOUBLE, 0.5) AS g FROM c GROUP BY 1 HAVING sum(tokens) > 0
), gl AS (
  SELECT k_lang, CASE k_lang WHEN '=en' THEN 0.4::DOUBLE ELSE 0.2::DOUBLE END AS g FROM c GROUP BY 1 HAVING sum(tokens) > 0
), gt AS (
  SELECT k_topic, CASE k_topic WHEN '=prose' THEN 0.85::DOUBLE WHEN '=license' THEN 0.1::DOUBLE
                  WHEN '=table' THEN 0.02::DOUBLE WHEN '=symbols' THEN 0.02::DOUBLE ELSE 0.01::DOUBLE END AS g
  FROM c GROUP BY 1 HAVING sum(tokens) > 0
), w0 AS (
  SELECT c.*, mass,
         gs.g / (SELECT sum(g) FROM gs) * mass AS g_source, gl.g / (SELECT sum(g) FROM gl) * mass AS g_lang,
         gt.g / (SELECT sum(g) FROM gt) * mass AS g_topic, tokens::DOUBLE AS w
  FROM c CROSS JOIN (SELECT sum(tokens)::DOUBLE AS mass FROM c) LEFT JOIN gs USING (k_source) LEFT JOIN gl USING (k_lang) LEFT JOIN gt USING (k_topic)
), {", ".join(steps)}, mixed AS (
  SELECT t.*, f.factor, least(1.0::DOUBLE, 0.5::DOUBLE * f.factor) AS p,
         ('0x' || substr(md5(coalesce('=' || doc_id, 'null') || '#4'), 1, 12))::BIGINT::DOUBLE / 281474976710656 < least(1.0::DOUBLE, 0.5::DOUBLE * f.factor) AS sampled
  FROM t JOIN (SELECT k_source, k_lang, k_topic, CASE WHEN tokens > 0 THEN w / tokens ELSE 1.0 END AS factor FROM w{3 * sweeps}) f
    ON t.k_source = f.k_source AND t.k_lang = f.k_lang AND '=' || t.topic = f.k_topic
)"""


OP4 = f"""
WITH {mix_ctes("documents")}
SELECT doc_id, source, lang, topic, n_tokens, round(factor, 6) AS factor, round(p, 6) AS p,
       round(factor / p, 6) AS weight, sampled
FROM mixed
"""

# Brute force: one distance for each pair of a query and a row.
OP9 = """
WITH c AS (
  SELECT DISTINCT vec_id AS id,
         list_aggregate(list_transform(embedding, lambda x, i: CASE WHEN x > 0 THEN 1::UBIGINT << (i - 1) ELSE 0::UBIGINT END), 'bit_or') AS code
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
), d AS (
  SELECT q.id AS query_id, r.id AS vec_id, bit_count(xor(q.code, r.code))::BIGINT AS distance
  FROM c q JOIN c r ON q.id % 20 = 0 AND (q.id <> r.id OR q.code <> r.code)
)
SELECT query_id, rank, vec_id, distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)
WHERE rank <= 10
"""

# Brute force: the score of each anchor with each row (sums of integers below 2**53).
OP11 = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.n AS an, a.id AS anchor_id, b.n AS bn, b.id, a.label = b.label AS same,
         list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.id % 100 = 0
), p AS (
  SELECT an, anchor_id, bn, id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY an ORDER BY score DESC, id) AS k
  FROM s WHERE same AND an <> bn
), g AS (
  SELECT p.anchor_id, positive_id, s.id AS negative_id, positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.an, p.bn ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON p.an = s.an AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
  WHERE p.k <= 5
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM g WHERE rank <= 5
"""

# Prefixes as strings of turn hashes; a subtree is all nodes whose string begins so. The
# CRC-32 goes bit by bit: -1 stands for one shift.
OP12 = """
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, x) - 1 AS pos,
         md5(length(r) || ':' || r || x) AS tid, strlen(x) AS bytes
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)
), v AS (
  SELECT c, c - c % 5 AS donor,
         xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(c::VARCHAR, ''),
               lambda y: [ascii(y)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda a, y: CASE WHEN y >= 0 THEN xor(a, y) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END),
           4294967295::BIGINT) % 9 AS h
  FROM (SELECT DISTINCT c FROM t)
), r AS (
  SELECT c, pos, tid, bytes FROM t JOIN v USING (c) WHERE pos >= h
  UNION ALL
  SELECT v.c, t.pos, t.tid, t.bytes FROM v JOIN t ON t.c = v.donor AND t.pos < v.h
), p AS (
  SELECT c, row_number() OVER w AS depth, string_agg(tid, '') OVER w AS key, bytes FROM r WINDOW w AS (PARTITION BY c ORDER BY pos)
  UNION ALL
  SELECT c, 0, '', 0 FROM v
), n AS (
  SELECT depth, key, left(key, length(key) - 32) AS up, min(c) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM p GROUP BY depth, key
), k AS (
  SELECT up AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY up
), f AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (key)
), s AS (
  SELECT a.key, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.bytes)::BIGINT AS saved_tokens
  FROM f a JOIN f b ON starts_with(b.key, a.key) GROUP BY a.key
), e AS (
  SELECT key, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends
  FROM (SELECT c, max(depth) AS depth FROM p GROUP BY c) JOIN p USING (c, depth) GROUP BY key
)
SELECT f.conv_id, f.depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens,
       coalesce(e.ends, sha256('')) AS ends_sha256
FROM f JOIN s USING (key) LEFT JOIN e USING (key) LEFT JOIN n u ON f.depth > 0 AND u.key = f.up
"""

ORACLE = {
    "op12_prefix_trie": OP12,
    "op11_hard_negatives": OP11,
    "op9_hamming_topk": OP9,
    "op6_html_extract": OP6,
    "op4_source_mix": OP4,
    "op2_chat_format": OP2,
    "op5_exact_dedup": OP5,
}
