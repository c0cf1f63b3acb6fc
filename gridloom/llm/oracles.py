"""DuckDB SQL for the operators' queries that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vec, c.vec)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

_ESCAPED = "replace(replace(replace(replace(replace({0}, '~', '~0'), '<', '~1'), '>', '~2'), '[', '~3'), ']', '~4')"

CHAT = f"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')}) + 8) AS formatted
  FROM r GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  formatted::BIGINT AS formatted_chars FROM g
"""

_HOST = r"translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{0}', '{1}')".format(UPPER, LOWER)
_FITS = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"

URLS = f"""
WITH u AS (
  SELECT page_id, {_HOST} AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), r AS (
  SELECT page_id, host, path, CASE
    WHEN {_FITS.format('example.net', '/en/')} THEN 'example.net/en/'
    WHEN {_FITS.format('example.com', '/de/')} THEN 'example.com/de/'
    WHEN {_FITS.format('org', '/fr/')} THEN 'org/fr/'
    WHEN {_FITS.format('net', '/')} THEN 'net/' END AS rule FROM u
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""

_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{0}', '{1}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')".format(UPPER, LOWER)

CONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
s AS (SELECT item_id, w, least(len(w), 13) AS m, unnest(range(len(w) - least(len(w), 13) + 1)) AS i FROM b WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, m, array_to_string(w[i + 1:i + m], ' ') AS g FROM s),
places AS (SELECT row, w, m, unnest(range(len(w) - m + 1)) AS i FROM d, (SELECT DISTINCT m FROM wins) WHERE len(w) >= m),
grams AS (SELECT row, i, m, array_to_string(w[i + 1:i + m], ' ') AS g FROM places),
hits AS (SELECT row, i, grams.m, item_id FROM grams JOIN wins USING (m, g)),
spots AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT row, i, m FROM hits)) GROUP BY row),
items AS (SELECT row, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT row, item_id::VARCHAR AS item_id FROM hits) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN spots USING (row) LEFT JOIN items USING (row)
"""

# The checksum of the text byte by byte, as SQL has no function for it; its table is made by the rule of the polynomial.
_CRC_TABLE = """SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))"""
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295)"""

SHARDS = f"""
WITH tab AS ({_CRC_TABLE}), d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, source, strlen(t)::BIGINT + 1 AS size, ({_CRC})::BIGINT AS crc FROM d, tab),
h AS (SELECT *, md5('7|' || coalesce(doc_id::VARCHAR, '') || '|' || crc) AS h FROM s),
r AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST, crc, size) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY source) AS frac FROM h),
p AS (SELECT *, row_number() OVER (ORDER BY frac, source NULLS FIRST, h, doc_id NULLS FIRST, crc, size) - 1 AS pos, count(*) OVER () AS n FROM r)
SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, (pos * 16 // n)::INTEGER AS shard,
  (pos - ((pos * 16 // n) * n + 15) // 16)::BIGINT AS slot, NULL::INTEGER AS grown_shard FROM p
"""

ORACLES = {"op6_shards": SHARDS, "op1_topk": TOPK, "op2_chat": CHAT, "op7_urls": URLS, "op10_decontaminate": CONTAMINATION}
