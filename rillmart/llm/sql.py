"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

_MIX = rf"""
WITH d AS (
    SELECT doc_id, source, CAST({_WORDS} AS BIGINT) AS size,
           md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS h,
           md5(coalesce(text, '')) AS t
    FROM documents),
s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w
    FROM d GROUP BY source),
o AS (
    SELECT *, sum(source_size) OVER () AS b, sum(w) OVER () AS all_w,
           sum(3 * source_size) OVER f - 3 * source_size AS cut, sum(w) OVER f - w AS cut_w
    FROM s WINDOW f AS (ORDER BY source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
p AS (SELECT *, (b - cut)::DOUBLE * w / (all_w - cut_w) > 3 * source_size AS capped FROM o),
q AS (
    SELECT *, coalesce(sum(3 * source_size) FILTER (capped) OVER (), 0) AS c,
           all_w - coalesce(sum(w) FILTER (capped) OVER (), 0) AS free_w
    FROM p),
g AS (
    SELECT source, source_size,
           CASE WHEN capped THEN (3 * source_size)::DOUBLE ELSE (b - c)::DOUBLE * w / free_w END AS target
    FROM q),
m AS (
    SELECT *, CAST(floor(target) AS BIGINT) AS words, CAST(ceil(floor(target) / 1024) AS BIGINT) AS quota,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src, count(*) OVER () AS n_src
    FROM g),
k AS (
    SELECT *, CAST(sum(quota) OVER () AS BIGINT) AS slots,
           CAST(sum(quota) OVER (ORDER BY src ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
    FROM m),
-- slot i has the golden-ratio point i * 1327217885 / 2^31, less its whole part
i AS (
    SELECT i AS slot, ((i % 2147483648) * 1327217885 % 2147483648) / 2147483648::DOUBLE AS point
    FROM (SELECT unnest(range((SELECT coalesce(max(slots), 0) FROM k))) AS i)),
j AS (
    SELECT slot, k.src, row_number() OVER (PARTITION BY k.src ORDER BY slot) - 1 AS rank
    FROM i JOIN k ON point < upto::DOUBLE / slots AND point >= (upto - quota)::DOUBLE / slots),
a AS (
    SELECT src, rank, slot FROM j JOIN k USING (src) WHERE rank < quota
    UNION ALL
    SELECT src, rank, slots + rank * n_src + src
    FROM (SELECT *, unnest(range((SELECT count(*) FROM j WHERE j.src = k.src), quota)) AS rank FROM k)),
x AS (
    SELECT d.doc_id, d.size, k.source_size, k.target, k.words, k.src,
           (sum(d.size) OVER v - d.size)::BIGINT AS pos, row_number() OVER v AS place
    FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source
    WINDOW v AS (PARTITION BY k.src ORDER BY h, doc_id NULLS FIRST, size, t ROWS UNBOUNDED PRECEDING)),
-- up to three passes over a source; the words of a pass, and the blocks they lie in
e AS (
    SELECT *, epoch * source_size + pos AS b, least(epoch * source_size + pos + size, words) AS z
    FROM x, (SELECT unnest(range(3)) AS epoch)),
f AS (SELECT *, unnest(CASE WHEN z > b THEN range(b // 1024, (z - 1) // 1024 + 1) ELSE [NULL] END) AS rank FROM e)
SELECT doc_id, size, source_size, target,
       CAST(coalesce(sum(least(z, (f.rank + 1) * 1024) - greatest(b, f.rank * 1024))
                     FILTER (slot IS NOT NULL), 0) AS BIGINT) AS taken,
       min(slot) AS first_slot, max(slot) AS last_slot, count(slot) AS n_slots
FROM f LEFT JOIN a ON a.src = f.src AND a.rank = f.rank
GROUP BY f.src, place, doc_id, size, source_size, target
"""

# the template: <turn ROLE>\nTEXT</turn>\n, with a backslash before each backslash and before
# each "<" that begins a control string (in roles: before each backslash, "<" and ">")
_CHAT = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM (SELECT conv_id, turn, role, text FROM conversations
          UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
          UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')),
f AS (
    SELECT *, row_number() OVER w AS pos,
           length('<turn ' || regexp_replace(role, '([\\<>])', '\\\1', 'g') || '>' || chr(10)
                  || regexp_replace(replace(text, '\', '\\'), '<(/?turn)', '\\<\1', 'g') || '</turn>' || chr(10)) AS n
    FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
c AS (
    SELECT *, sum(n) OVER w AS upto, pos = max(pos) OVER (PARTITION BY conv_id) AS is_last
    FROM f WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING))
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR is_last) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

_TOPK = r"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.e, d.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

_URLS = r"""
WITH p AS (
    SELECT page_id, url,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages),
r(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                            ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (
    SELECT DISTINCT host, path, h || p AS rule, verdict
    FROM (SELECT DISTINCT host, path FROM p) u
    JOIN r ON (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.p)),
b AS (SELECT host, path, rule, verdict FROM m
      QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC, rule DESC) = 1)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM p LEFT JOIN b ON p.host = b.host AND p.path = b.path
"""

# rounds of the codes are unrolled: each assigns, then averages
_CODES_HEAD = r"""
WITH RECURSIVE e AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (
    SELECT vec_id, label, p, x[p * len(x) // 4 + 1:(p + 1) * len(x) // 4] AS c
    FROM e, range(4) r(p)),
b0 AS (
    SELECT p, rank - 1 AS e, c
    FROM (SELECT p, c, row_number() OVER (PARTITION BY p ORDER BY vec_id) AS rank FROM v) WHERE rank <= 256)
"""

_CODES_ROUND = r""",
a{0} AS MATERIALIZED (
    SELECT v.vec_id, v.label, v.p, v.c, min([d, e]) AS best
    FROM (SELECT v.vec_id, v.label, v.p, v.c, b.e,
                 CAST(list_sum(list_transform(list_zip(v.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
          FROM v JOIN b{0} b ON v.p = b.p) v
    GROUP BY ALL)"""

_CODES_MOVE = r""",
m{0} AS (
    SELECT p, best[2] AS e, i, CAST(floor(CAST(sum(c[i]) AS DOUBLE) / count(*)) AS BIGINT) AS mean
    FROM a{1}, range(1, 1 + (SELECT max(len(c)) FROM v)) r(i) GROUP BY ALL),
b{0} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(m.c, b.c) AS c
    FROM b{1} b LEFT JOIN (SELECT p, e, list(mean ORDER BY i) AS c FROM m{0} GROUP BY ALL) m ON b.p = m.p AND b.e = m.e)"""

_CODES_TAIL = r""",
c AS (
    SELECT vec_id, label, lower(string_agg(lpad(hex(best[2]), 2, '0'), '' ORDER BY p)) AS code,
           CAST(sum(best[1]) AS BIGINT) AS error
    FROM a4 GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b4) AS codebooks_sha256
FROM c
"""

_CODES = _CODES_HEAD.replace("RECURSIVE ", "") + _CODES_ROUND.format(0) + "".join(
    _CODES_MOVE.format(i, i - 1) + _CODES_ROUND.format(i) for i in range(1, 5)
) + _CODES_TAIL

# bytes as pairs of hex digits: the 100 bytes at byte i are 200 digits
_SUFFIXES = r"""
WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY md5(substr(h, 2 * (i - base) + 1, 200)) ORDER BY doc_id, i) > 1 AS again
    FROM (SELECT doc_id, base + unnest(range(least(100, n - 99 - base))) AS i, base, substr(h, 2 * base + 1, 398) AS h
          FROM (SELECT doc_id, h, n, unnest(range(0, n - 99, 100)) AS base FROM d WHERE n >= 100))),
s AS (
    SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM w WHERE again),
g AS (
    SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 100 THEN 1 ELSE 0 END)
                      OVER (PARTITION BY doc_id ORDER BY i) AS span FROM s),
r AS (SELECT doc_id, span, min(i) AS a, max(i) + 100 AS b FROM g GROUP BY ALL),
k AS (
    SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM r
    UNION ALL SELECT d.doc_id, coalesce(m.b, 0), n FROM d LEFT JOIN (SELECT doc_id, max(b) AS b FROM r GROUP BY 1) m ON d.doc_id = m.doc_id),
t AS (
    SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS kept
    FROM k JOIN d USING (doc_id) GROUP BY 1)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(n - length(kept) // 2 AS BIGINT) AS n_removed,
       CAST((SELECT count(*) FROM r WHERE r.doc_id = d.doc_id) AS BIGINT) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM d JOIN t USING (doc_id)
"""

# a checksum is the xor of one number per byte, which depends on the byte and how many follow it,
# and of one number per length: what the register's first value leaves after so many bytes
_RESAMPLE = r"""
WITH RECURSIVE z AS (
    SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS crc
    FROM range(256) r(b)),
d AS (
    SELECT 's' AS side, row_number() OVER () AS i, doc_id, text FROM documents
    UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark),
w AS (
    SELECT side, i, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, len(w) AS size
    FROM d),
f AS (
    SELECT side, i, unnest([a, a || ' ' || b, a || ' ' || b || ' ' || c]) AS f
    FROM (SELECT side, i, a, lead(a) OVER v AS b, lead(a, 2) OVER v AS c
          FROM (SELECT side, i, unnest(w) AS a, unnest(range(len(w))) AS k FROM w)
          WINDOW v AS (PARTITION BY side, i ORDER BY k))),
q AS MATERIALIZED (
    SELECT f, hex(encode(f)) AS x, octet_length(encode(f)) AS size FROM (SELECT DISTINCT f FROM f WHERE f IS NOT NULL)),
most AS MATERIALIZED (SELECT coalesce(max(size), 0) AS size FROM q),
bytes AS (
    SELECT 0 AS after, b, crc[b + 1] AS c FROM z, range(256) r(b)
    UNION ALL SELECT after + 1, b, xor(c >> 8, crc[(c & 255) + 1]) FROM bytes, z, most WHERE after + 1 < most.size),
sizes AS (
    SELECT 0 AS size, 4294967295 AS c
    UNION ALL SELECT s.size + 1, xor(c >> 8, crc[(c & 255) + 1]) FROM sizes s, z, most WHERE s.size < most.size),
u AS (
    SELECT y.f, xor(xor(bit_xor(bytes.c), any_value(sizes.c)), 4294967295) % 10000 AS bucket
    FROM (SELECT f, size, size - 1 - k AS after, CAST('0x' || substr(x, 2 * k + 1, 2) AS INT) AS b
          FROM (SELECT f, x, size, CAST(unnest(range(size)) AS INT) AS k FROM q)) y
    JOIN bytes ON bytes.after = y.after AND bytes.b = y.b JOIN sizes ON sizes.size = y.size
    GROUP BY y.f),
n AS (SELECT side, i, bucket, count(*) AS n FROM f JOIN u USING (f) GROUP BY ALL),
c AS (
    SELECT b.b AS bucket, coalesce(sum(n) FILTER (side = 's'), 0) AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t
    FROM range(10000) b(b) LEFT JOIN n ON n.bucket = b.b GROUP BY b.b),
g AS (
    SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(sum(s) OVER () + 10000 AS DOUBLE)
                                        / (CAST(s + 1 AS DOUBLE) * CAST(sum(t) OVER () + 10000 AS DOUBLE)))) AS BIGINT) AS gain
    FROM c),
x AS (
    SELECT w.doc_id, w.size >= 20 AS fit, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_features,
           CAST(coalesce(sum(n * gain), 0) AS BIGINT) AS weight,
           CAST('0x' || substr(sha256('42:' || coalesce(CAST(w.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
    FROM w LEFT JOIN n ON n.side = w.side AND n.i = w.i LEFT JOIN g USING (bucket)
    WHERE w.side = 's' GROUP BY w.doc_id, w.i, w.size),
y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM x),
r AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id NULLS LAST) AS place FROM y)
SELECT doc_id, n_features, weight, score,
       CASE WHEN fit AND place <= 5 * (SELECT count(*) FROM x WHERE fit) // 100 THEN place END AS rank
FROM r
"""

ORACLES = {
    "op3_prefix_target_expansion": _CHAT,
    "op5_mixing_schedule": _MIX,
    "op8_block_pruning": _TOPK,
    "op10_url_filter": _URLS,
    "op11_hilbert_codes": _CODES,
    "op12_suffix_dedup": _SUFFIXES,
    "op13_importance_resampling": _RESAMPLE,
}
