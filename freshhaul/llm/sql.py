"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), r AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER g AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER g = 1 AS kept
  FROM d
  WINDOW g AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM r
"""

# The same blocks, shards and seeds as freshhaul.llm.mixing, written as one statement.
MIX = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::INT]::BIGINT AS weight, 3 * source_size AS most FROM s
), l AS (
  SELECT *,
    sum(source_size) OVER () - coalesce(sum(most) OVER b, 0) AS words_left,
    sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS weight_left
  FROM w
  WINDOW b AS (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT *, most::HUGEINT * weight_left <= words_left::HUGEINT * weight AS is_full FROM l
), t AS (
  SELECT source, rank, source_size,
    CASE WHEN is_full THEN most::DOUBLE
         ELSE (weight * max(words_left) FILTER (NOT is_full) OVER ())::DOUBLE
              / (max(weight_left) FILTER (NOT is_full) OVER ())::DOUBLE END AS target,
    floor(sum(source_size) OVER () / 16 + 0.5)::BIGINT AS seats
  FROM f
), a AS (
  SELECT *, sum(target) OVER () AS votes,
         sum(CASE WHEN target > 0 THEN 1 ELSE 0 END) OVER () / 2.0::DOUBLE AS slack
  FROM t
), b AS (
  SELECT *,
    CASE WHEN target > 0 AND seats > slack
         THEN floor(target * (seats - slack) / votes + 0.5) ELSE 0 END::BIGINT AS sure,
    CASE WHEN target > 0 THEN floor(target * (seats + slack) / votes + 1.5) ELSE 0 END::BIGINT AS may
  FROM a
), c AS (
  SELECT rank, target / (2 * (sure + p) - 1)::DOUBLE AS quotient
  FROM b, unnest(generate_series(1, may - sure)) AS u(p)
), c1 AS (
  SELECT rank, row_number() OVER (ORDER BY quotient DESC, rank) AS place FROM c
), q AS (
  SELECT source, rank, source_size, target, sure
    + (SELECT count(*) FROM c1 WHERE c1.rank = b.rank
         AND place <= (SELECT any_value(seats) - sum(sure) FROM b)) AS quota
  FROM b
), p AS (
  SELECT d.doc_id, d.size, q.rank, q.source_size, q.target, q.quota,
         md5('mix-1|' || coalesce(doc_id::VARCHAR, '')) AS draw,
         ceil(q.source_size / 1048576)::BIGINT AS shards
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
), p1 AS (
  SELECT *, CASE WHEN size > 0 THEN ('0x' || draw[1:8])::BIGINT % greatest(shards, 1) END AS shard
  FROM p
), h AS (
  SELECT rank, shard, quota AS seats, sum(size)::BIGINT AS shard_size
  FROM p1 WHERE size > 0 GROUP BY ALL
), h1 AS (
  SELECT *, sum(shard_size::DOUBLE) OVER (PARTITION BY rank) AS votes,
         count(*) OVER (PARTITION BY rank) / 2.0::DOUBLE AS slack
  FROM h
), h2 AS (
  SELECT *,
    CASE WHEN seats > slack
         THEN floor(shard_size::DOUBLE * (seats - slack) / votes + 0.5) ELSE 0 END::BIGINT AS sure,
    floor(shard_size::DOUBLE * (seats + slack) / votes + 1.5)::BIGINT AS may
  FROM h1
), h3 AS (
  SELECT rank, shard, shard_size::DOUBLE / (2 * (sure + p) - 1)::DOUBLE AS quotient
  FROM h2, unnest(generate_series(1, may - sure)) AS u(p)
), h4 AS (
  SELECT rank, shard, row_number() OVER (PARTITION BY rank ORDER BY quotient DESC, shard) AS place
  FROM h3
), h5 AS (
  SELECT h2.*, ceil(shard_size / 16)::BIGINT AS blocks,
    sum(sure) OVER (PARTITION BY rank) AS all_sure
  FROM h2
), h6 AS (
  SELECT rank, shard, shard_size, blocks,
    least(16 * (sure + (SELECT count(*) FROM h4 WHERE h4.rank = h5.rank AND h4.shard = h5.shard
                    AND place <= h5.seats - h5.all_sure)), 3 * shard_size)::BIGINT AS words,
    ('0x' || md5('mix-1|' || rank || '|' || shard)[1:8])::BIGINT % blocks AS "first"
  FROM h5
), e AS (
  SELECT p1.*, sum(size) OVER (PARTITION BY rank, shard ORDER BY draw, doc_id, size
                               ROWS UNBOUNDED PRECEDING)::BIGINT AS ends
  FROM p1 WHERE size > 0
), x AS (
  SELECT e.doc_id, e.size, e.source_size, e.target, e.ends - e.size AS starts,
         words // shard_size AS rounds,
         floor((words % shard_size) / 16 + 0.5)::BIGINT AS more, "first", blocks
  FROM e JOIN h6 USING (rank, shard)
)
SELECT doc_id, size, source_size, target,
  (rounds * size
   + greatest(least(16 * least("first" + more, blocks) - starts, size)
              - greatest(16 * "first" - starts, 0), 0)
   + greatest(least(16 * greatest("first" + more - blocks, 0) - starts, size), 0))::BIGINT AS taken
FROM x
UNION ALL
SELECT doc_id, size, source_size, target, 0 FROM p1 WHERE size = 0
"""

# Words inside eight-word windows that occur twice are those that the maximal repeats of
# eight words or more cover; a longest repeat over both limits shows as a window one word
# longer that occurs twice.
REPETITION = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         row_number() OVER () AS r
  FROM documents
), n AS (
  SELECT *, len(w)::BIGINT AS n_words, greatest(51, len(w) * 20 // 100 + 1) AS too_long,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), w8 AS (
  SELECT r, p, list_slice(w, p, p + 7) AS g FROM n, unnest(generate_series(1, n_words - 7)) u(p)
), twice AS (
  SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS c FROM w8) WHERE c > 1
), covered AS (
  SELECT r, count(DISTINCT p + k) AS n_repeat_words
  FROM twice, unnest(generate_series(0, 7)) v(k) GROUP BY r
), overlong AS (
  SELECT DISTINCT r FROM (
    SELECT r, list_slice(w, p, p + too_long - 1) AS g
    FROM n JOIN covered USING (r), unnest(generate_series(1, n_words - too_long + 1)) u(p)
  ) GROUP BY r, g HAVING count(*) > 1
), m AS (
  SELECT n.*, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, overlong.r IS NOT NULL AS too_much
  FROM n LEFT JOIN covered USING (r) LEFT JOIN overlong USING (r)
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words,
       length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
       len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
       (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
       n_repeat_words, base_failed,
       NOT base_failed AND NOT too_much AND 100 * n_repeat_words <= 25 * n_words AS kept
FROM b
"""

LINE_DEDUP = """
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d
), k AS MATERIALIZED (
  SELECT r, i, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), often AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10
), s AS (
  SELECT r, string_agg(line, chr(10) ORDER BY i) AS kept, count(*) AS n
  FROM k WHERE key NOT IN (FROM often) GROUP BY r
)
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n, 0))::BIGINT AS n_dropped,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (r)
"""

# The CRC-32 of a decimal number, bit by bit.
_CRC = """
xor(list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda s, b: list_reduce(
    list_prepend(xor(s, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda t, z: xor(t >> 1, (t & 1) * 3988292384::BIGINT))
), 4294967295::BIGINT)
"""

CONVERSATION_TRIE = rf"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (
           PARTITION BY conv_id
           ORDER BY turn NULLS FIRST, coalesce(role, ''),
             sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
         ) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base, {_CRC} % 4 AS h FROM t
), r AS (
  SELECT c.conv_id, 0 AS side, b.place, b.role, b.text
  FROM c JOIN t AS b ON b.conv_id = c.base AND b.place <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.place, o.role, o.text FROM c JOIN t AS o ON o.conv_id = c.conv_id AND o.place > c.h
), l AS (
  SELECT c.conv_id,
         coalesce(list({{'role': role, 'text': text}} ORDER BY side, place) FILTER (role IS NOT NULL), []) AS turns
  FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id
), p AS (
  SELECT conv_id, d AS depth, turns[1:d] AS node, len(turns) = d AS ends
  FROM l, unnest(range(0, len(turns) + 1)) AS u(d)
), n AS MATERIALIZED (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY node, depth
), k AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1
), w AS MATERIALIZED (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children,
         CASE WHEN depth = 0 THEN 0 ELSE
           (n_convs - 1) * len(regexp_extract_all(n.node[depth].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM n LEFT JOIN k ON k.node = n.node
), s AS (
  SELECT node[1:d] AS node, sum(saved)::BIGINT AS saved_tokens,
         count(*) FILTER (n_children = 0) AS n_leaves
  FROM w, unnest(range(0, depth + 1)) AS u(d) GROUP BY 1
)
SELECT w.conv_id, w.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, w.n_convs, w.n_children::BIGINT AS n_children,
       s.n_leaves, s.saved_tokens, w.ends_sha256
FROM w JOIN s ON s.node = w.node
LEFT JOIN n AS q ON w.depth > 0 AND q.node = w.node[1:w.depth - 1]
"""
