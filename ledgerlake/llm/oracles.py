"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP8 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(doc_id::VARCHAR, '-') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM d GROUP BY source
), c AS (
  SELECT *, 3 * source_size AS cap,
         row_number() OVER (ORDER BY 3 * source_size / w, source NULLS LAST) AS k
  FROM s
), t AS (
  SELECT *, ((SELECT sum(source_size) FROM c) - coalesce((SELECT sum(b.cap) FROM c b WHERE b.k < c.k), 0))
          / ((SELECT sum(w) FROM c) - coalesce((SELECT sum(b.w) FROM c b WHERE b.k < c.k), 0)) AS share
  FROM c
), l AS (
  SELECT *, (SELECT share FROM t WHERE share * w <= cap ORDER BY k LIMIT 1) AS level FROM t
), g AS (
  SELECT source, source_size, least(cap::DOUBLE, level * w) AS target,
         ('0x' || substr(md5('42:' || coalesce('=' || source, '')), 1, 4))::INT / 65536.0::DOUBLE AS u
  FROM l
), r AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.u,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.key)::DOUBLE AS k
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (floor(u + rate * k) - floor(u + rate * (k - 1))))::BIGINT AS taken
FROM r
"""

OP1 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, text IS NULL AS no_text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]', false), (-7, 1, 'assistant', '</s>[INST] ok [/INST]', false)
), e AS (
  SELECT *, regexp_replace(replace(text, '\', '\\'), '(<\|im_start\|>|<\|im_sep\|>|<\|im_end\|>|</?s>|\[/?INST\]|<</?SYS>>)', '?\1', 'g') AS marked_text,
         regexp_replace(replace(role, '\', '\\'), '(<\|im_start\|>|<\|im_sep\|>|<\|im_end\|>|</?s>|\[/?INST\]|<</?SYS>>)', '?\1', 'g') AS marked_role
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, no_text DESC, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, no_text DESC, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|><|im_sep|><|im_end|>') + length(marked_role) + length(marked_text))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

OP9 = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages
), f AS (
  SELECT h, min(page_id) AS first FROM p GROUP BY h
)
SELECT p.page_id, n::BIGINT AS payload_bytes,
       array_to_string([
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((('0x' || substr(p.h, (5 * (i // 4) + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31), 1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM p.page_id THEN first END AS refers_to
FROM p JOIN f ON p.h = f.h
"""

#: CRC-32 by its table, which follows from the polynomial; near words by the place of the edit.
OP11 = r"""
WITH t AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS tbl
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents
), r AS (
  SELECT id, run, count(*) AS times FROM runs WHERE length(run) >= 6 GROUP BY ALL
), b AS (
  SELECT run, times, hex(encode(id || ':' || run)) AS h FROM r
), c AS (
  SELECT run, times, xor(list_reduce([4294967295] || list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
                     lambda a, x: xor(a // 256, tbl[xor(a, x) % 256 + 1])), 4294967295) AS crc
  FROM b, t
), s AS (
  SELECT CASE WHEN crc % 199 = 0 THEN substr(run, 1, (crc % length(run))::INT) || substr(run, (crc % length(run))::INT + 2) ELSE run END AS word, times FROM c
), v AS (
  SELECT word, sum(times)::BIGINT AS n FROM s WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), d AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM v
), cut AS (
  SELECT word, n, pos, substr(word, 1, pos - 1) || substr(word, pos + 1) AS rest FROM d
), pairs AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.pos = b.pos AND a.word <> b.word
  UNION
  SELECT DISTINCT a.word, v.word, v.n FROM cut a JOIN v ON a.rest = v.word
  UNION
  SELECT DISTINCT v.word, a.word, a.n FROM cut a JOIN v ON a.rest = v.word
), near AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS best, max(m) AS m FROM pairs GROUP BY word
), f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * v.n THEN best END AS form, CASE WHEN m >= 5 * v.n THEN m END AS form_n
  FROM v LEFT JOIN near USING (word)
), chain AS (
  WITH RECURSIVE up AS (
    SELECT word, form AS pos FROM f WHERE form IS NOT NULL
    UNION ALL
    SELECT up.word, f.form FROM up JOIN f ON f.word = up.pos WHERE f.form IS NOT NULL
  )
  SELECT up.word, up.pos AS root FROM up JOIN f ON f.word = up.pos WHERE f.form IS NULL
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, coalesce(chain.root, f.word) AS root FROM f LEFT JOIN chain USING (word)
"""

ORACLES: dict[str, str] = {"op1_chat_format": OP1, "op8_source_mix": OP8, "op9_warc_round_trip": OP9, "op11_spelling_variants": OP11}
