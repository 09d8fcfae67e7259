"""DuckDB SQL for the text queries that SQL can express."""

from __future__ import annotations

from .rules import STOP_WORDS

ORACLE: dict[str, str] = {}

# the template's control strings, as in chat.CONTROLS, are 6 + 6 + 7 code points a turn
ORACLE["op3_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, i, CASE WHEN i = 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) t(i)
), sized AS (
    SELECT *, 19 + length(regexp_replace(role, '(<turn>|<text>|</turn>)', '\\\1', 'g'))
              + length(regexp_replace(text, '(<turn>|<text>|</turn>)', '\\\1', 'g')) AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

_STOPS = ", ".join("'" + w + "'" for w in STOP_WORDS)

ORACLE["op10_quality_rules"] = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), parts AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM docs
), windows AS (
    SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
    FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM parts)
), repeated AS (
    SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, w) AS c FROM windows) WHERE c >= 2
), covered AS (
    SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY rid
), m AS (
    SELECT doc_id, len(words) AS n_words,
           length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n, 0) AS n_repeat_words,
           length(text) - length(regexp_replace(text, '\p{{L}}', '', 'g')) AS n_letters,
           length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS n_capitals,
           len(list_intersect(list_distinct(words), [{_STOPS}])) AS n_stop_words,
           len(lines) AS n_lines,
           len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\t]*[•*-]'))) AS n_bullet_lines,
           len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\t\r]*$'))) AS n_ellipsis_lines
    FROM parts LEFT JOIN covered USING (rid)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           concat_ws(',',
               CASE WHEN n_words NOT BETWEEN 50 AND 100000 THEN 'word_count' END,
               CASE WHEN 100 * word_chars NOT BETWEEN 250 * n_words AND 1200 * n_words THEN 'word_length' END,
               CASE WHEN 100 * n_symbols > 25 * n_words THEN 'symbols' END,
               CASE WHEN 100 * n_letters < 60 * word_chars THEN 'letters' END,
               CASE WHEN 100 * n_capitals > 30 * n_letters THEN 'capitals' END,
               CASE WHEN n_stop_words < 2 THEN 'stop_words' END,
               CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 'repeated_words' END,
               CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 'duplicate_lines' END,
               CASE WHEN 100 * n_bullet_lines > 90 * n_lines THEN 'bullet_lines' END,
               CASE WHEN 100 * n_ellipsis_lines > 30 * n_lines THEN 'ellipsis_lines' END) AS failed_rules
    FROM m
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM judged
"""

ORACLE["op7_warc_bundles"] = r"""
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM p
), g AS (
    SELECT *, min(page_id) OVER (PARTITION BY hex) AS first, count(*) OVER (PARTITION BY hex) AS n FROM d
), b AS (
    -- base32 of 20 bytes: four groups of 5 bytes (10 hex digits) give 8 letters each
    SELECT page_id, payload_bytes, first, n,
           array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((CAST('0x' || substr(hex, 1 + 10 * (k // 8), 10) AS UBIGINT) >> (35 - 5 * (k % 8))) & 31)::INT, 1)
               for k in range(32)], '') AS payload_digest
    FROM g
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN n > 1 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n > 1 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM b
"""

ORACLE["op13_filter_audit"] = r"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), cells AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
           + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS pattern
    FROM docs LEFT JOIN marks USING (doc_id)
), counted AS (
    SELECT part, pattern, count(*) AS n, sum(good) AS g, sum(toxic) AS t FROM cells GROUP BY ALL
), f AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
      AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
    SELECT filter_order, step, f.bit AS here,
           CAST((SELECT coalesce(sum(p.bit), 0) FROM f p WHERE position(p.x IN filter_order) < step) AS BIGINT) AS earlier
    FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders) JOIN f ON f.x = filter_order[step]
), made AS (
    SELECT part, filter_order, step, here,
           coalesce(sum(n) FILTER (pattern & (earlier | here) = 0), 0) AS kept,
           coalesce(sum(n) FILTER (pattern & earlier = 0 AND pattern & here <> 0), 0) AS removed,
           coalesce(sum(n) FILTER (pattern & earlier <> 0 AND pattern & here <> 0), 0) AS redundant,
           coalesce(sum(n) FILTER (pattern = here), 0) AS unique_fails,
           coalesce(sum(g) FILTER (pattern & earlier = 0 AND pattern & here <> 0), 0) AS good_lost,
           coalesce(sum(t) FILTER (pattern & earlier = 0 AND pattern & here <> 0), 0) AS toxic_lost
    FROM counted, steps GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, here) AS BIGINT) AS shapley
FROM made
"""

# blocks of 20 ids begin at the multiples of 20, also below zero; the check sum is computed bit by bit
ORACLE["op11_prefix_trie"] = r"""
WITH named AS (
    SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS sym,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
    FROM conversations WHERE conv_id IS NOT NULL
), t AS (
    SELECT conv_id, sym, w, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sym) AS pos FROM named
), c AS (
    SELECT conv_id, conv_id - (conv_id % 20 + 20) % 20 AS base,
           xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
               flatten([[(ascii(x) >> b) & 1 for b in range(8)] for x in string_split(conv_id::VARCHAR, '')])::BIGINT[]),
               lambda s, b: xor(s >> 1, 3988292384 * (xor(s, b) & 1)))) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM t)
), rebuilt AS (
    SELECT conv_id, 1 AS o, pos, sym, w FROM t JOIN c USING (conv_id) WHERE conv_id = base OR pos > h
    UNION ALL
    SELECT c.conv_id, 0, pos, sym, w FROM c JOIN t ON t.conv_id = c.base WHERE c.conv_id <> c.base AND pos <= h
), paths AS (
    SELECT conv_id, 0 AS depth, '' AS key, 0 AS w FROM c
    UNION ALL
    SELECT conv_id, row_number() OVER turns, string_agg(sym, '') OVER turns, w
    FROM rebuilt WINDOW turns AS (PARTITION BY conv_id ORDER BY o, pos)
), nodes AS (
    SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(w) AS saved FROM paths GROUP BY key, depth
), children AS (
    SELECT left(key, length(key) - 32) AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), whole AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (key)
), below AS (
    SELECT left(key, 32 * i) AS key, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
    FROM (SELECT *, unnest(range(0, depth + 1)) AS i FROM whole) GROUP BY 1
), ended AS (
    SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
    FROM (SELECT conv_id, max_by(key, depth) AS key FROM paths GROUP BY conv_id) GROUP BY key
)
SELECT w.conv_id, CAST(w.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(w.n_convs AS BIGINT) AS n_convs,
       CAST(w.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM whole w JOIN below USING (key) LEFT JOIN ended USING (key)
LEFT JOIN nodes p ON w.depth > 0 AND p.key = left(w.key, length(w.key) - 32)
"""
