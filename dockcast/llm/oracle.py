"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

SQL = {
    "op2_decontamination": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
i AS (SELECT item_id, ws, least(len(ws), 10) AS w FROM b WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item_id, w, ws[s : s + w - 1] AS win FROM (SELECT item_id, ws, w, unnest(range(1, len(ws) - w + 2)) AS s FROM i)),
dw AS (SELECT r, w, s, ws[s : s + w - 1] AS win FROM (
         SELECT r, ws, w, unnest(range(1, len(ws) - w + 2)) AS s FROM d, (SELECT DISTINCT w FROM i) WHERE len(ws) >= w)),
h AS (SELECT r, s, dw.w, item_id FROM dw JOIN iw ON dw.w = iw.w AND dw.win = iw.win),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + w)) AS p FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS items
      FROM (SELECT DISTINCT r, item_id::VARCHAR AS k FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)""",
    "op5_mixing": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
             ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(31) || coalesce(text, '')), 1, 15))::BIGINT AS h
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER o, 0))::DOUBLE / sum(weight) OVER p AS level FROM w
      WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             p AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
t AS (SELECT source, source_size, least(weight * max(level) OVER (), (3 * source_size)::DOUBLE) AS target FROM l),
q AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size)::BIGINT, 3) ELSE 1 END AS whole FROM t),
b AS (SELECT *, greatest(target - whole * source_size, 0.0) AS budget FROM q),
n AS (SELECT d.*, whole, source_size, target, budget, sum(size) OVER (PARTITION BY d.source ORDER BY h, r) AS upto
      FROM (SELECT doc_id, size, h, r, source FROM d) d JOIN b ON d.source IS NOT DISTINCT FROM b.source),
e AS (SELECT *, coalesce(min(CASE WHEN upto >= budget THEN upto END) OVER p, max(upto) OVER p) AS edge FROM n WINDOW p AS (PARTITION BY source)),
f AS (SELECT *, row_number() OVER (PARTITION BY source, upto = edge ORDER BY h, r) AS k FROM e)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN source_size > 0 AND (upto < edge
            OR upto = edge AND k = 1 AND abs(upto - budget) < abs(upto - size - budget)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM f""",
    "op9_chat": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, 0 AS k FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]', 0 UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]', 0),
e AS (SELECT *, lag(role) OVER o IS DISTINCT FROM role AS opens,
        length(regexp_replace(text, '(\\*)(</?s>|\[/?INST\])', '\1\1\\\2', 'g')) AS n,
        length(regexp_replace(role, '(\\*)(</?s>|\[/?INST\])', '\1\1\\\2', 'g')) AS m
      FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
g AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
        sum(n + CASE WHEN opens THEN m + 17 ELSE 9 END) AS formatted_chars
      FROM e GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars::BIGINT AS formatted_chars FROM g""",
    "op11_lexical_search": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
q AS (SELECT i, item_id, term, count(*) AS often FROM b GROUP BY i, item_id, term),
s AS (SELECT count(*)::BIGINT AS nd, sum(len(ws))::BIGINT AS nw FROM d WHERE len(ws) > 0),
p AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ws) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
      FROM (SELECT term, count(*)::BIGINT AS df FROM p GROUP BY term), s),
c AS (SELECT i, item_id, r, sum(often * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(ws) * nd) // nw)))) AS score
      FROM p JOIN d USING (r) JOIN w USING (term) JOIN q USING (term), s GROUP BY i, item_id, r),
k AS (SELECT i, item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM c JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score FROM k WHERE rank <= 20""",
}
