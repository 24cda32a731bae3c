"""Independent SQL for the registered queries, over the same tables."""

from __future__ import annotations

_EV = """ev AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(floor(value) AS BIGINT) AS price,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""
_ORD = """ord AS (
  SELECT event_id AS order_id, CAST(k AS BIGINT) AS product_id, user_id AS customer_id, ts
  FROM ev WHERE event_type = 'purchase')"""
_PRD = """prd AS (
  SELECT event_id AS seq, ts, CAST(k AS BIGINT) AS product_id, p_name AS product_name,
         CAST(price AS INTEGER) AS sale_price, event_type = 'signup' AS alive
  FROM ev LEFT JOIN part ON p_partkey = k WHERE event_type IN ('signup', 'error'))"""
_CUS = """cus AS (
  SELECT event_id AS seq, ts, user_id AS customer_id, c_name || '#' || CAST(event_id AS VARCHAR) AS customer_name
  FROM ev LEFT JOIN customer ON c_custkey = user_id WHERE event_type = 'click')"""
_ENT = """ent AS (
  SELECT event_id AS seq, ts, user_id, k AS product_id, price, CAST(hour(ts) AS INTEGER) AS hh, event_type,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS kind
  FROM ev)"""
_PAST = "TIMESTAMP '2024-01-15 00:00:00'"
_LATEST_PRD = """latest_prd AS (
  SELECT product_id, product_name, sale_price FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY seq DESC) AS rn FROM prd) t
  WHERE rn = 1 AND alive)"""
_LATEST_CUS = """latest_cus AS (
  SELECT customer_id, arg_max(customer_name, seq) AS customer_name, max(seq) AS seq FROM cus GROUP BY customer_id)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join((_EV, *parts)) + "\n"


def _lookup(retries: int, cut: str = "microsecond") -> str:
    """Attempts joined with validity intervals; the first hit by attempt."""
    return f"""spans AS (
  SELECT *, date_trunc('{cut}', ts) AS vf,
         lead(date_trunc('{cut}', ts)) OVER (PARTITION BY product_id ORDER BY ts, seq) AS vt FROM prd),
tries AS (
  SELECT o.*, a.attempt, date_trunc('{cut}', o.ts) + a.attempt * INTERVAL 6 HOUR AS at
  FROM ord o, (SELECT CAST(unnest(range(0, {retries + 1})) AS INTEGER) AS attempt) a),
hits AS (
  SELECT t.order_id, t.attempt, s.product_name, s.sale_price,
         row_number() OVER (PARTITION BY t.order_id ORDER BY t.attempt) AS rn
  FROM tries t JOIN spans s
    ON s.product_id = t.product_id AND s.alive AND s.vf <= t.at AND (s.vt IS NULL OR s.vt > t.at)),
found AS (
  SELECT o.*, h.attempt, h.product_name, h.sale_price
  FROM ord o LEFT JOIN (SELECT * FROM hits WHERE rn = 1) h ON h.order_id = o.order_id)"""


def _entity_state(where: str = "TRUE", name: str = "state") -> str:
    return f"""{name} AS (
  SELECT user_id, product_id, price, hh, event_type FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS rn FROM ent WHERE {where}) t
  WHERE rn = 1 AND kind <> 'd')"""


_HISTORY = """hist AS (
  SELECT *, lag(product_id) OVER w AS o_product_id, lag(price) OVER w AS o_price, lag(hh) OVER w AS o_hh,
         lag(kind) OVER w AS o_kind
  FROM {source} WINDOW w AS (PARTITION BY user_id ORDER BY seq))"""

_SIGNED = """signed AS (
  SELECT ts, product_id, hh, price, 1 AS sign FROM hist WHERE kind <> 'd' AND (coalesce(o_kind, 'd') = 'd'
      OR (product_id, price, hh) IS DISTINCT FROM (o_product_id, o_price, o_hh))
  UNION ALL
  SELECT ts, o_product_id, o_hh, -o_price, -1 FROM hist WHERE coalesce(o_kind, 'd') <> 'd' AND (kind = 'd'
      OR (product_id, price, hh) IS DISTINCT FROM (o_product_id, o_price, o_hh)))"""

_SHARD = """bounds AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM ev),
arrived AS (
  SELECT ev.*, CAST((epoch_us(ts) - lo) * 3 // (hi - lo + 1) AS INTEGER)
         + CASE WHEN {late} THEN 1 ELSE 0 END AS shard
  FROM ev, bounds),
marks AS (
  SELECT s.shard, (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 5 SECOND FROM arrived a WHERE a.shard < s.shard) AS mark
  FROM (SELECT DISTINCT shard FROM arrived) s),
final AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 5 SECOND AS mark FROM arrived),
hourly AS (
  SELECT date_trunc('hour', ts) AS hour_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS hour_end,
         event_type, price, marks.mark
  FROM arrived JOIN marks USING (shard)),
full_totals AS (
  SELECT hour_start, event_type, CAST(sum(price) AS BIGINT) AS total, count(*) AS n
  FROM hourly, final WHERE hour_end <= final.mark GROUP BY ALL),
stream_totals AS (
  SELECT hour_start, event_type, CAST(sum(price) AS BIGINT) AS total, count(*) AS n
  FROM hourly, final WHERE hour_end <= final.mark AND (hourly.mark IS NULL OR hour_end > hourly.mark) GROUP BY ALL)"""

_SALES = """sales AS (
  SELECT product_id, CAST(hour(ts) AS BIGINT) AS hh, CAST(sum(sale_price) AS BIGINT) AS sales
  FROM found GROUP BY ALL)"""
_BATCH_SALES = """batch_sales AS (
  SELECT o.product_id, CAST(hour(o.ts) AS BIGINT) AS hh, CAST(sum(p.sale_price) AS BIGINT) AS sales
  FROM ord o LEFT JOIN latest_prd p USING (product_id) GROUP BY ALL)"""

_ENRICHED = """
SELECT f.order_id, f.product_id, f.customer_id, f.ts AS purchase_timestamp, f.product_name, f.sale_price, c.customer_name
FROM found f LEFT JOIN latest_cus c ON c.customer_id = f.customer_id"""


def all_oracles() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["cdc_decode"] = _with(_PRD) + """
SELECT CASE WHEN alive THEN '+I' ELSE '-D' END AS op, date_trunc('millisecond', ts) AS commit_ts, seq,
       product_id, product_name, sale_price FROM prd"""
    sql["cdc_route_counts"] = """
SELECT CASE event_type WHEN 'purchase' THEN 'orders' WHEN 'click' THEN 'customers' WHEN 'view' THEN 'page_views'
       ELSE 'products' END AS source_table, count(*) AS n FROM events GROUP BY 1"""
    sql["cdc_quarantine"] = _with("""whole AS (
  SELECT CASE event_type WHEN 'purchase' THEN 'orders' WHEN 'click' THEN 'customers' WHEN 'view' THEN 'page_views'
         ELSE 'products' END AS "table", CASE event_type WHEN 'view' THEN 'unknown table' ELSE 'taken' END AS outcome
  FROM ev
  UNION ALL
  SELECT CASE event_id % 10 WHEN 1 THEN 'suppliers' WHEN 5 THEN NULL ELSE 'customers' END,
         CASE event_id % 10 WHEN 0 THEN 'null key' WHEN 1 THEN 'unknown table' WHEN 2 THEN 'no position'
              WHEN 3 THEN 'no old image' WHEN 4 THEN 'unknown operation' WHEN 5 THEN 'malformed' ELSE 'taken' END
  FROM ev WHERE event_type = 'click')""") + """
SELECT "table", outcome, count(*) AS n FROM whole GROUP BY ALL"""
    sql["cdc_route_orders"] = _with(_ORD) + """
SELECT '+I' AS op, order_id AS seq, order_id, product_id, customer_id, ts AS purchase_timestamp,
       strftime(ts, '%Y-%m-%d') AS dd, CAST(hour(ts) AS INTEGER) AS hh FROM ord"""
    sql["cdc_route_products"] = _with(_PRD) + """
SELECT CASE WHEN alive THEN '+I' ELSE '-D' END AS op, seq, date_trunc('millisecond', ts) AS commit_ts,
       product_id, product_name, sale_price FROM prd"""
    sql["cdc_route_customers"] = _with(_CUS) + "SELECT '+I' AS op, seq, customer_id, customer_name FROM cus"
    sql["cdc_route_refused"] = _with("""whole AS (
  SELECT CASE event_type WHEN 'purchase' THEN 'orders' WHEN 'click' THEN 'customers' WHEN 'view' THEN NULL
         ELSE 'products' END AS routed, CASE event_type WHEN 'view' THEN 'unknown table' END AS reason
  FROM ev
  UNION ALL
  SELECT CASE WHEN event_id % 10 > 5 THEN 'customers' END,
         CASE event_id % 10 WHEN 0 THEN 'null key' WHEN 1 THEN 'unknown table' WHEN 2 THEN 'no position'
              WHEN 3 THEN 'no old image' WHEN 4 THEN 'unknown operation' WHEN 5 THEN 'malformed' END
  FROM ev WHERE event_type = 'click')""") + """
SELECT routed, reason, count(*) AS n FROM whole GROUP BY ALL"""
    sql["cdc_row_kinds"] = _with(_ENT, _HISTORY.format(source="ent"), """
life AS (SELECT *, kind <> 'd' AS alive, coalesce(o_kind <> 'd', FALSE) AS o_alive FROM hist)""") + """
SELECT CASE WHEN o_alive THEN '+U' ELSE '+I' END AS op, seq, user_id, product_id, price, hh FROM life WHERE alive
UNION ALL SELECT CASE WHEN alive THEN '-U' ELSE '-D' END, seq, user_id, o_product_id, o_price, o_hh FROM life WHERE o_alive"""
    sql["state_latest"] = _with(_ENT, _entity_state()) + "SELECT * FROM state"
    sql["state_followed"] = sql["state_latest"]
    sql["changes_passthrough"] = _with(_ORD) + """
SELECT '+I' AS op, order_id AS seq, order_id, product_id, customer_id, date_trunc('millisecond', ts) AS ts,
       strftime(ts, '%Y-%m-%d') AS dd, CAST(hour(ts) AS INTEGER) AS hh FROM ord"""
    sql["time_travel_latest"] = _with(_ENT, _entity_state(f"ts <= {_PAST}")) + (
        "SELECT user_id, product_id, price, hh FROM state"
    )
    signed = _with(_ENT, _HISTORY.format(source="ent"), _SIGNED)
    totals = """
SELECT product_id, hh, CAST(sum(price) AS BIGINT) AS price, CAST(sum(sign) AS BIGINT) AS live_rows
FROM signed {where} GROUP BY product_id, hh"""
    sql["time_travel_sum"] = signed + totals.format(where=f"WHERE ts <= {_PAST}")
    sql["bootstrap_snapshot"] = "SELECT c_custkey, c_name, c_mktsegment FROM customer"
    sql["inline_rows"] = """
SELECT label, count(*) AS n FROM events
JOIN (VALUES ('purchase', 'order'), ('signup', 'product'), ('click', 'customer')) v(event_type, label) USING (event_type)
GROUP BY label"""
    sql["merge_latest"] = _with(_ENT, _entity_state()) + "SELECT user_id, product_id, price, hh FROM state"
    sql["merge_latest_late"] = sql["merge_latest"]
    sql["merge_latest_partition_move"] = _with(_ENT, _entity_state(), """
last_ts AS (SELECT user_id, max(ts) AS ts FROM ent GROUP BY user_id)""") + """
SELECT user_id, product_id, price, strftime(ts, '%Y-%m-%d') AS dd, hh FROM state JOIN last_ts USING (user_id)"""
    sql["merge_partial_update"] = _with(_ENT) + """
SELECT user_id, arg_max(price, seq) FILTER (WHERE event_type = 'purchase') AS price,
       arg_max(event_type, seq) AS event_type FROM ent WHERE kind <> 'd' GROUP BY user_id"""
    sql["merge_partial_late"] = sql["merge_partial_update"]
    sql["merge_ignore_delete"] = _with(_ENT) + """
SELECT user_id, product_id, price, hh, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS rn FROM ent WHERE kind <> 'd') t WHERE rn = 1"""
    sql["merge_partial_two_writers"] = _with(_ORD, _CUS, _LATEST_CUS, """
latest_ord AS (SELECT customer_id, arg_max(product_id, order_id) AS product_id FROM ord GROUP BY customer_id)""") + """
SELECT coalesce(o.customer_id, c.customer_id) AS customer_id, o.product_id, c.customer_name
FROM latest_ord o FULL JOIN latest_cus c ON c.customer_id = o.customer_id"""
    sql["merge_sum_retract"] = signed + totals.format(where="")
    sql["merge_sum_live"] = _with(_ENT, _entity_state()) + """
SELECT product_id, hh, CAST(sum(price) AS BIGINT) AS price, count(*) AS live_rows FROM state GROUP BY product_id, hh"""
    by_key = "FROM state GROUP BY product_id, hh"
    sql["merge_min_retract"] = _with(_ENT, _entity_state()) + f"""
SELECT product_id, hh, min(price) AS lowest, max(price) AS highest, CAST(sum(price) AS BIGINT) AS total,
       count(*) AS live_rows {by_key}"""
    sql["merge_avg_retract"] = _with(_ENT, _entity_state()) + f"""
SELECT product_id, hh, CAST(sum(price) AS DOUBLE) / count(price) AS average, count(*) AS live_rows {by_key}"""
    sql["state_history"] = _with(_ENT, """
spans AS (
  SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY seq) AS until FROM ent)""") + """
SELECT user_id, product_id, price, hh, ts AS valid_from, until AS valid_to
FROM spans WHERE kind <> 'd' AND (until IS NULL OR ts < until)"""
    sql["state_diff"] = _with(
        _ENT, _entity_state(f"ts <= {_PAST}", "a"), _entity_state("TRUE", "b"), """
sides AS (
  SELECT coalesce(a.user_id, b.user_id) AS user_id, a.user_id IS NOT NULL AS in_a, b.user_id IS NOT NULL AS in_b,
         a.product_id AS ap, a.price AS ac, a.hh AS ah, b.product_id AS bp, b.price AS bc, b.hh AS bh
  FROM a FULL JOIN b ON a.user_id = b.user_id
  WHERE NOT (a.user_id IS NOT NULL AND b.user_id IS NOT NULL
             AND (a.product_id, a.price, a.hh) IS NOT DISTINCT FROM (b.product_id, b.price, b.hh)))""") + """
SELECT CASE WHEN in_b THEN '-U' ELSE '-D' END AS op, user_id, ap AS product_id, ac AS price, ah AS hh FROM sides WHERE in_a
UNION ALL
SELECT CASE WHEN in_a THEN '+U' ELSE '+I' END, user_id, bp, bc, bh FROM sides WHERE in_b"""
    sql["changelog_lag"] = _with(_ENT, _HISTORY.format(source="ent"), """
steps AS (
  SELECT *, kind <> 'd' AS alive, coalesce(o_kind <> 'd', FALSE) AS o_alive,
         (product_id, price, hh) IS DISTINCT FROM (o_product_id, o_price, o_hh) AS differs FROM hist)""") + """
SELECT CASE WHEN o_alive THEN '+U' ELSE '+I' END AS op, user_id, seq, product_id, price, hh
FROM steps WHERE alive AND (NOT o_alive OR differs)
UNION ALL
SELECT CASE WHEN alive THEN '-U' ELSE '-D' END, user_id, seq, o_product_id, o_price, o_hh
FROM steps WHERE o_alive AND (NOT alive OR differs)"""
    sql["partition_counts"] = _with(_ORD) + """
SELECT strftime(ts, '%Y-%m-%d') AS dd, CAST(hour(ts) AS INTEGER) AS hh, count(*) AS n FROM ord GROUP BY ALL"""
    sql["insert_subset"] = _with(_ORD) + """
SELECT order_id, CAST(NULL AS BIGINT) AS product_id, customer_id, CAST(NULL AS VARCHAR) AS product_name,
       CAST(NULL AS INTEGER) AS sale_price, CAST(NULL AS VARCHAR) AS customer_name FROM ord"""
    enriched = """
SELECT o.order_id, o.product_id, o.customer_id, p.product_name, p.sale_price, {name} AS customer_name
FROM ord o LEFT JOIN latest_prd p USING (product_id) LEFT JOIN latest_cus c ON c.customer_id = o.customer_id"""
    current = _with(_ORD, _PRD, _CUS, _LATEST_PRD, _LATEST_CUS)
    sql["repair_overwrite"] = current + enriched.format(name="CAST(NULL AS VARCHAR)")
    sql["enriched_recompute_names"] = current + enriched.format(name="c.customer_name")
    sql["output_append"] = _with(_ORD) + "SELECT order_id, product_id FROM ord"
    sql["multi_insert_union"] = """
SELECT event_id AS id, 'Hi' AS data FROM events WHERE event_type = 'purchase'
UNION ALL SELECT event_id, 'Hello' FROM events WHERE event_type = 'click'"""
    sql["multi_sink_counts"] = _with() + """
SELECT event_type AS sink, count(*) AS n, CAST(sum(price) AS BIGINT) AS price FROM ev
WHERE event_type IN ('purchase', 'signup', 'click') GROUP BY event_type"""
    sql["ods_orders_projection"] = _with(_ORD) + """
SELECT order_id, product_id, customer_id, ts AS purchase_timestamp, strftime(ts, '%Y-%m-%d') AS dd,
       CAST(hour(ts) AS INTEGER) AS hh, date_trunc('millisecond', ts) AS ts FROM ord"""
    sql["cast_types"] = """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour_int, CAST(hour(ts) AS BIGINT) AS hour_bigint,
       date_trunc('millisecond', ts) AS ts_millis, CAST(NULL AS VARCHAR) AS nothing,
       CAST(event_id AS VARCHAR) AS id_text FROM events"""
    sql["limit_exists"] = """
SELECT 'has events' AS test, EXISTS (SELECT 1 FROM events) AS answer
UNION ALL SELECT 'has negative values', EXISTS (SELECT 1 FROM events WHERE value < 0)
UNION ALL SELECT 'has orders', EXISTS (SELECT 1 FROM orders)"""
    sql["variable_scalar"] = _with("var AS (SELECT max(price) AS a FROM ev)") + """
SELECT event_id, 'a => ' || CAST(a AS VARCHAR) AS b FROM ev, var WHERE price * 2 > a"""
    sql["observe_counts"] = _with() + """
SELECT t.*, s.* FROM (SELECT event_type, count(*) AS type_n FROM ev GROUP BY event_type) t,
  (SELECT count(*) AS n, CAST(sum(price) AS BIGINT) AS price, max(event_id) AS "last" FROM ev) s"""
    sql["lookup_as_of"] = _with(_ORD, _PRD, _lookup(0)) + (
        "SELECT order_id, product_id, product_name, sale_price FROM found"
    )
    sql["lookup_retry"] = _with(_ORD, _PRD, _lookup(3)) + (
        "SELECT order_id, product_id, product_name, sale_price, attempt FROM found"
    )
    sql["lookup_duplicates"] = _with(_ORD, _PRD, _lookup(3)) + """
SELECT product_id, ts AS commit_ts, product_name, sale_price FROM found, range(2)"""
    sql["lookup_nulls"] = _with(_ORD, _PRD, _lookup(3)) + """
SELECT product_id, ts AS commit_ts, CASE side WHEN 0 THEN order_id END AS left_id,
       CASE side WHEN 1 THEN order_id END AS right_id, product_name, sale_price
FROM found, range(2) AS sides(side)"""
    sql["join_current"] = _with(_ORD, _CUS, _LATEST_CUS) + """
SELECT order_id, product_id, customer_id, customer_name FROM ord JOIN latest_cus USING (customer_id)"""
    sql["changelog_join"] = _with(_ORD, _CUS, """
pairs AS (
  SELECT o.order_id, greatest(o.order_id, c.seq) AS seq, c.seq AS cseq, c.customer_name
  FROM ord o JOIN cus c USING (customer_id))""", """
ranked AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY cseq DESC) AS rn FROM pairs)""") + """
SELECT order_id, seq, customer_name FROM ranked WHERE rn = 1"""
    sql["join_changes"] = _with(_ORD, _CUS, f"""
old_names AS (SELECT customer_id, arg_max(customer_name, seq) AS customer_name FROM cus WHERE ts <= {_PAST} GROUP BY 1),
new_names AS (SELECT customer_id, arg_max(customer_name, seq) AS customer_name FROM cus GROUP BY 1),
a AS (SELECT o.*, n.customer_name FROM ord o JOIN old_names n USING (customer_id) WHERE o.ts <= {_PAST}),
b AS (SELECT o.*, n.customer_name FROM ord o JOIN new_names n USING (customer_id)),
sides AS (
  SELECT a.order_id AS ai, a.product_id AS ap, a.customer_id AS ac, a.customer_name AS an,
         b.order_id AS bi, b.product_id AS bp, b.customer_id AS bc, b.customer_name AS bn
  FROM a FULL JOIN b ON a.order_id = b.order_id WHERE a.customer_name IS DISTINCT FROM b.customer_name)""") + """
SELECT CASE WHEN bi IS NULL THEN '-D' ELSE '-U' END AS op, ai AS order_id, ap AS product_id, ac AS customer_id,
       an AS customer_name FROM sides WHERE ai IS NOT NULL
UNION ALL SELECT CASE WHEN ai IS NULL THEN '+I' ELSE '+U' END, bi, bp, bc, bn FROM sides WHERE bi IS NOT NULL"""
    state = "SELECT customer_id AS order_id, arg_max(product_id, order_id) AS product_id FROM ord {where} GROUP BY 1"
    alive = """SELECT product_id, product_name, sale_price FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY seq DESC) AS rn FROM prd {where}) t
  WHERE rn = 1 AND alive"""
    sides = [
        f"{name} AS (SELECT o.*, p.product_name, p.sale_price FROM ({state.format(where=where)}) o"
        f" JOIN ({alive.format(where=where)}) p USING (product_id))"
        for name, where in (("a", f"WHERE ts <= {_PAST}"), ("b", ""))
    ]
    sql["join_changes_moves"] = _with(_ORD, _PRD, *sides, """
sides AS (
  SELECT a.order_id AS ai, a.product_id AS ap, a.product_name AS an, a.sale_price AS ac,
         b.order_id AS bi, b.product_id AS bp, b.product_name AS bn, b.sale_price AS bc
  FROM a FULL JOIN b ON a.order_id = b.order_id
  WHERE (a.order_id, a.product_id, a.product_name, a.sale_price)
        IS DISTINCT FROM (b.order_id, b.product_id, b.product_name, b.sale_price))""") + """
SELECT CASE WHEN bi IS NULL THEN '-D' ELSE '-U' END AS op, ai AS order_id, ap AS product_id, an AS product_name,
       ac AS sale_price FROM sides WHERE ai IS NOT NULL
UNION ALL SELECT CASE WHEN ai IS NULL THEN '+I' ELSE '+U' END, bi, bp, bn, bc FROM sides WHERE bi IS NOT NULL"""
    sql["join_left_batch"] = """
SELECT o_orderkey, o_custkey, l_linenumber, l_partkey, p_name, p_retailprice
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey"""
    sql["hourly_sales_batch"] = _with(_ORD, _PRD, _LATEST_PRD, _BATCH_SALES) + "SELECT * FROM batch_sales"
    sql["hourly_sales_retail"] = _with(_ORD) + """
SELECT product_id, CAST(hour(ts) AS BIGINT) AS hh,
       CAST(sum(CAST(p_retailprice AS DECIMAL(15, 2))) AS DOUBLE) AS sales
FROM ord LEFT JOIN part ON p_partkey = product_id GROUP BY ALL"""
    sql["customer_total_of_one"] = _with(_ORD, _PRD, _LATEST_PRD) + """
SELECT customer_id, CAST(sum(sale_price) AS BIGINT) AS sales FROM ord LEFT JOIN latest_prd USING (product_id)
WHERE customer_id = (SELECT min(customer_id) FROM ord) GROUP BY customer_id"""
    sql["hourly_sales_as_of"] = _with(_ORD, _PRD, _LATEST_PRD) + f"""
SELECT o.product_id, CAST(hour(o.ts) AS BIGINT) AS hh, CAST(sum(p.sale_price) AS BIGINT) AS sales
FROM ord o LEFT JOIN latest_prd p USING (product_id) WHERE o.ts <= {_PAST} GROUP BY ALL"""
    past = _PRD.replace("IN ('signup', 'error'))", f"IN ('signup', 'error') AND ts <= {_PAST})")
    bounded = _lookup(3).replace("s.vf <= t.at", f"s.vf <= t.at AND (t.attempt = 0 OR t.at <= {_PAST})")
    sql["customer_total_as_of"] = _with(_ORD, past, bounded) + f"""
SELECT customer_id, CAST(sum(sale_price) AS BIGINT) AS sales FROM found WHERE ts <= {_PAST} GROUP BY customer_id"""
    sql["stream_tumbling"] = _with(_SHARD.format(late="FALSE")) + "SELECT * FROM full_totals"
    sql["stream_commit_interval"] = sql["stream_tumbling"]
    late = _with(_SHARD.format(late="k % 10 = 3"))
    sql["late_gap"] = late + """
SELECT f.hour_start, f.event_type, s.total AS streamed, f.total AS recomputed
FROM full_totals f LEFT JOIN stream_totals s ON s.hour_start = f.hour_start AND s.event_type = f.event_type
WHERE s.total IS DISTINCT FROM f.total OR s.hour_start IS NULL"""
    sql["repair_closed_hours"] = late + "SELECT * FROM full_totals"
    exact = _with(_ORD, _PRD, _CUS, _LATEST_CUS, _lookup(3))
    millis = _with(_ORD, _PRD, _CUS, _LATEST_CUS, _lookup(3, "millisecond"))
    sql["layered_dwd"] = millis + _ENRICHED
    sql["layered_late"] = sql["layered_dwd"]
    sql["enriched_feed"] = sql["layered_dwd"]
    sql["layered_dws"] = millis.rstrip() + ",\n" + _SALES + "\nSELECT * FROM sales"
    moved = """moved AS (
  SELECT f.customer_id AS order_id, arg_max(f.product_id, f.order_id) AS product_id, f.customer_id,
         max(f.ts) AS purchase_timestamp,
         arg_max(f.product_name, f.order_id) FILTER (WHERE f.attempt IS NOT NULL) AS product_name,
         arg_max(f.sale_price, f.order_id) FILTER (WHERE f.attempt IS NOT NULL) AS sale_price
  FROM found f GROUP BY f.customer_id),
named AS (SELECT m.*, c.customer_name FROM moved m LEFT JOIN latest_cus c ON c.customer_id = m.customer_id)"""
    sql["layered_reorders_dwd"] = millis.rstrip() + ",\n" + moved + "\nSELECT * FROM named"
    sql["layered_orders"] = millis.rstrip() + ",\n" + moved + """
SELECT order_id, product_id, customer_id, purchase_timestamp, strftime(purchase_timestamp, '%Y-%m-%d') AS dd,
       CAST(hour(purchase_timestamp) AS INTEGER) AS hh FROM moved"""
    sql["layered_reorders_dws"] = millis.rstrip() + ",\n" + moved + """
SELECT product_id, CAST(hour(purchase_timestamp) AS BIGINT) AS hh, CAST(sum(sale_price) AS BIGINT) AS sales,
       count(*) AS live_rows FROM named GROUP BY ALL"""
    sql["enriched_orders_batch"] = exact + _ENRICHED
    sql["product_sales_by_hour"] = exact.rstrip() + ",\n" + _SALES + "\nSELECT * FROM sales"
    sql["stream_vs_batch_gap"] = millis.rstrip() + ",\n" + ",\n".join((_SALES, _LATEST_PRD, _BATCH_SALES)) + """
SELECT coalesce(s.product_id, b.product_id) AS product_id, coalesce(s.hh, b.hh) AS hh,
       s.sales AS streamed, b.sales AS recomputed
FROM sales s FULL JOIN batch_sales b ON s.product_id = b.product_id AND s.hh = b.hh
WHERE s.sales IS DISTINCT FROM b.sales OR s.product_id IS NULL OR b.product_id IS NULL"""
    return sql
