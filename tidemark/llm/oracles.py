"""SQL for DuckDB that gives the rows of the queries which SQL can express."""

from __future__ import annotations

from tidemark.llm import chat

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

TOP_PRODUCTS = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
    SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id AND len(a.q) = len(b.q))
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM pairs
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

NEAR_COPIES = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, {_WORDS.format(text=
        "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
    FROM documents),
sh AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s
    FROM w, unnest(range(1, greatest(len(ws) - 2, 2))) AS t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
ends AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, root) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT e.y, r.root FROM reach r JOIN ends e ON e.x = r.doc_id),
lowest AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN lowest USING (doc_id) LEFT JOIN n ON n.doc_id = d.doc_id
"""

REPEATED_WINDOWS = f"""
WITH w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS s
    FROM w, unnest(range(1, len(ws) - 33)) AS t(i) WHERE len(ws) >= 35),
repeated AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
covered AS (
    SELECT DISTINCT doc_id, i + k AS p FROM windows JOIN repeated USING (s), unnest(range(35)) AS r(k)),
placed AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
    FROM placed ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

SOURCE_DIVERGENCE = r"""
WITH d AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
    FROM documents),
kept AS (
    SELECT lang, t FROM (SELECT lang, unnest(list_distinct(ws)) AS t FROM d) GROUP BY ALL HAVING count(*) >= 30),
c AS (
    SELECT lang, source, t, CAST(count(*) AS HUGEINT) AS n
    FROM (SELECT lang, source, unnest(ws) AS t FROM d) JOIN kept USING (lang, t) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (
    SELECT lang, source, coalesce(any_value(total), 0) AS total FROM d
    LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source) GROUP BY ALL),
p AS (
    SELECT g.lang, g.source, k.t, coalesce(c.n, 0) AS n, 1 + 1000000000 * (coalesce(c.n, 0) + 5) // (g.total + 5 * v.v) AS p
    FROM g JOIN v USING (lang) JOIN kept k ON k.lang = g.lang
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.t = k.t),
q AS (
    SELECT lang, t, 1 + 1000000000 * (sum(n) + 5) // (any_value(total) + 5 * any_value(v)) AS q
    FROM c JOIN v USING (lang) JOIN (SELECT lang, sum(n) AS total FROM c GROUP BY lang) USING (lang) GROUP BY lang, t),
f AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(any_value(s.value), 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT x.lang, x.source AS one, y.source AS two, sum(abs(x.p - y.p)) AS value
        FROM p x JOIN p y ON x.lang = y.lang AND x.t = y.t GROUP BY ALL) s
    ON s.lang = a.lang AND s.one = a.source AND s.two = b.source GROUP BY ALL
    UNION ALL
    SELECT lang, source, 'term', t, p - q FROM p JOIN q USING (lang, t) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER w AS INTEGER) AS rank FROM f
WINDOW w AS (PARTITION BY lang, source, part ORDER BY value DESC, item)
QUALIFY part = 'pair' OR row_number() OVER w <= 50
"""

RESAMPLING = r"""
WITH steps AS (
    SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i:
        xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), b)) AS crc),
texts AS (
    SELECT 'd' AS part, row_number() OVER () AS row, doc_id, text FROM documents
    UNION ALL SELECT 'b', row_number() OVER (), item_id, text FROM benchmark),
w AS (
    SELECT part, row, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM texts),
f AS (
    SELECT part, row, unnest(ws || list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS feature
    FROM w),
hashed AS (
    SELECT feature, CAST(xor(list_reduce(list_transform(range(octet_length(encode(feature))), lambda i:
        CAST(('0x' || hex(encode(feature))[2 * i + 1:2 * i + 2]) AS BIGINT)), lambda c, x:
        xor(c >> 8, crc[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS INTEGER) AS bucket
    FROM (SELECT DISTINCT feature FROM f), steps),
placed AS (SELECT part, row, bucket FROM f JOIN hashed USING (feature)),
counted AS (
    SELECT bucket, CAST(count(*) FILTER (part = 'd') AS DOUBLE) AS s, CAST(count(*) FILTER (part = 'b') AS DOUBLE) AS t
    FROM placed GROUP BY bucket),
sums AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counted),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000)))) AS BIGINT) AS gain
    FROM counted, sums),
weights AS (
    SELECT row, count(*) AS n_features, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight
    FROM placed JOIN gains USING (bucket) WHERE part = 'd' GROUP BY row),
scored AS (
    SELECT doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
            (CAST('0x' || sha256('7:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
    FROM w LEFT JOIN weights USING (row) WHERE part = 'd'),
placed_scores AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
        25 * count(*) OVER (PARTITION BY n_words >= 20) // 100 AS drawn
    FROM scored)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
    CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank, CAST(n_words AS BIGINT) AS n_words
FROM placed_scores
"""

ORACLES = {
    "op1_maximal_conversations": chat.SQL,
    "op2_impact_ordered_topk": TOP_PRODUCTS,
    "op3_superminhash_groups": NEAR_COPIES,
    "op4_repeated_windows": REPEATED_WINDOWS,
    "op11_iceberg_prefix_divergence": SOURCE_DIVERGENCE,
    "op12_regex_split_resampling": RESAMPLING,
}
