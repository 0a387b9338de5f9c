"""Independent SQL for the catalog's queries, over the same benchmark tables.

``CTES`` restate the test-table views in plain SQL; a query names those it needs.
"""

from __future__ import annotations

import re

CTES = {
    "page_log": """
        SELECT event_id AS seq, (epoch_us(ts) // 1000) AS ts, 'mid_' || CAST(user_id AS VARCHAR) AS mid,
               CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS uid,
               'v' || CAST(user_id % 3 AS VARCHAR) AS vc, 'ch' || CAST(user_id % 4 AS VARCHAR) AS ch,
               CAST(user_id % 25 AS VARCHAR) AS ar,
               CASE WHEN event_id % 2 = 0 THEN '1' ELSE '0' END AS is_new,
               CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail'
                    WHEN 'signup' THEN 'register' WHEN 'purchase' THEN 'trade' ELSE 'search' END AS page_id,
               CASE event_id % 3 WHEN 1 THEN 'login' WHEN 2 THEN 'home' END AS last_page_id,
               CAST(floor(value * 1000) AS BIGINT) AS during_time,
               strftime(ts, '%Y-%m-%d') AS dt, props, event_type,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
        FROM events""",
    "log": """
        SELECT *, event_type = 'signup' AS is_start FROM page_log
        WHERE seq % 50 NOT IN (7, 8, 9)""",
    "uv": """
        SELECT * FROM page_log WHERE last_page_id IS NULL
        QUALIFY row_number() OVER (PARTITION BY mid, dt ORDER BY ts, seq) = 1""",
    "uj": """
        SELECT * FROM (
            SELECT *, lead(ts) OVER w AS next_ts, lead(seq) OVER w AS next_seq,
                   lead(last_page_id) OVER w AS next_last
            FROM page_log WINDOW w AS (PARTITION BY mid ORDER BY ts, seq))
        WHERE last_page_id IS NULL
          AND (next_seq IS NULL OR next_last IS NULL OR next_ts - ts >= 21600000)""",
    "order_changes": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id, o_custkey % 25 AS province_id,
               CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount, o_orderdate AS created,
               'insert' AS type, '1001' AS order_status, NULL AS old_status,
               (epoch_us(o_orderdate) // 1000) // 1000 AS ts, NULL AS operate_time
        FROM orders
        UNION ALL
        SELECT o_orderkey, o_custkey, o_custkey % 25, CAST(o_totalprice AS DECIMAL(16,2)), o_orderdate,
               'update', CASE WHEN o_orderstatus = 'P' THEN '1002' WHEN o_orderkey % 2 = 0 THEN '1003'
                              ELSE '1005' END,
               CASE WHEN o_orderkey % 5 <> 0 THEN '1001' END,
               (epoch_us(o_orderdate) // 1000) // 1000 + 86400,
               strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S')
        FROM orders WHERE o_orderstatus IN ('P', 'F')""",
    "details": """
        SELECT l_orderkey * 10 + l_linenumber AS detail_id, l_orderkey AS order_id, l_partkey AS sku_id,
               CAST(l_extendedprice AS DECIMAL(16,2)) AS price, CAST(l_quantity AS BIGINT) AS num,
               l_suppkey AS source_id, l_linenumber % 5 + 1 AS source_code,
               CASE WHEN l_discount >= 0.05 THEN CAST(l_discount AS DECIMAL(16,2)) END AS activity_amount,
               CASE WHEN l_tax >= 0.04 THEN CAST(l_tax AS DECIMAL(16,2)) END AS coupon_amount,
               strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
               (epoch_us(l_shipdate) // 1000) // 1000 AS od_ts
        FROM lineitem""",
    "act": """
        SELECT DISTINCT l_orderkey * 10 + l_linenumber AS detail_id,
               CAST((l_orderkey * 10 + l_linenumber) % 7 AS VARCHAR) AS activity_id,
               CAST((l_orderkey * 10 + l_linenumber) % 3 AS VARCHAR) AS activity_rule_id
        FROM lineitem WHERE l_discount >= 0.05""",
    "cou": """
        SELECT DISTINCT l_orderkey * 10 + l_linenumber AS detail_id,
               CAST((l_orderkey * 10 + l_linenumber) % 11 AS VARCHAR) AS coupon_id,
               CAST((l_orderkey * 10 + l_linenumber) % 13 AS VARCHAR) AS coupon_use_id
        FROM lineitem WHERE l_tax >= 0.04""",
    "dic": """
        SELECT DISTINCT substr(o_orderpriority, 1, 1) AS dic_code, substr(o_orderpriority, 3) AS dic_name
        FROM orders WHERE o_orderpriority <> '5-LOW'""",
    "wide": """
        SELECT CAST(d.detail_id AS VARCHAR) AS id, CAST(d.order_id AS VARCHAR) AS order_id,
               CAST(d.sku_id AS VARCHAR) AS sku_id, 'sku-' || CAST(d.sku_id AS VARCHAR) AS sku_name,
               CAST(d.price AS VARCHAR) AS order_price, CAST(d.num AS VARCHAR) AS sku_num,
               d.create_time, dic.dic_name AS source_type, CAST(d.source_id AS VARCHAR) AS source_id,
               CAST(d.price AS VARCHAR) AS split_total_amount,
               CAST(d.activity_amount AS VARCHAR) AS split_activity_amount,
               CAST(d.coupon_amount AS VARCHAR) AS split_coupon_amount,
               CAST(CAST(d.price * d.num AS DECIMAL(33,4)) AS VARCHAR) AS split_original_amount,
               d.od_ts, o.order_status, CAST(o.user_id AS VARCHAR) AS user_id, o.operate_time,
               CAST(o.province_id AS VARCHAR) AS province_id, o.type, o.old_status, o.ts AS oi_ts,
               a.activity_id, a.activity_rule_id, c.coupon_id, c.coupon_use_id
        FROM details d
        JOIN dic ON dic.dic_code = CAST(d.source_code AS VARCHAR)
        JOIN order_changes o ON o.order_id = d.order_id
        LEFT JOIN act a ON a.detail_id = d.detail_id
        LEFT JOIN cou c ON c.detail_id = d.detail_id""",
    "order_detail": """
        SELECT * EXCLUDE (type, old_status) FROM wide WHERE type = 'insert'
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY od_ts DESC, oi_ts DESC, sku_id, source_id,
            order_price, sku_num, split_activity_amount NULLS LAST, split_coupon_amount NULLS LAST,
            source_type) = 1""",
    "refund_info": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_suppkey AS user_id, l_orderkey AS order_id,
               l_partkey AS sku_id, CAST(l_linenumber % 5 + 1 AS VARCHAR) AS refund_type,
               CAST(l_quantity AS BIGINT) AS refund_num,
               CAST(l_extendedprice AS DECIMAL(16,2)) AS refund_amount,
               CAST(l_suppkey % 5 + 1 AS VARCHAR) AS reason_type, l_linestatus AS reason_txt,
               l_shipdate, (epoch_us(l_shipdate) // 1000) // 1000 AS ts, l_linestatus, l_suppkey
        FROM lineitem WHERE l_returnflag = 'R'""",
    "refund_wide": """
        SELECT CAST(r.id AS VARCHAR) AS id, CAST(r.user_id AS VARCHAR) AS user_id,
               CAST(r.order_id AS VARCHAR) AS order_id, CAST(r.sku_id AS VARCHAR) AS sku_id,
               CAST(o.province_id AS VARCHAR) AS province_id,
               strftime(r.l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
               r.refund_type AS refund_type_code, t.dic_name AS refund_type_name,
               r.reason_type AS refund_reason_type_code, s.dic_name AS refund_reason_type_name,
               r.reason_txt AS refund_reason_txt, CAST(r.refund_num AS VARCHAR) AS refund_num,
               CAST(r.refund_amount AS VARCHAR) AS refund_amount, r.ts
        FROM refund_info r
        JOIN order_changes o ON o.order_id = r.order_id AND o.type = 'update'
             AND o.order_status = '1005' AND o.old_status IS NOT NULL
        JOIN dic t ON t.dic_code = r.refund_type
        JOIN dic s ON s.dic_code = r.reason_type""",
    "cart": """
        SELECT *, CASE WHEN type = 'insert' THEN num ELSE num - old_num END AS added FROM (
            SELECT event_id, user_id, ts AS cart_at, (epoch_us(ts) // 1000) // 1000 AS ts, event_type, value, props,
                   CASE WHEN event_id % 4 = 0 THEN 'insert' ELSE 'update' END AS type,
                   CAST(floor(value) AS BIGINT) AS num,
                   CASE WHEN event_id % 4 <> 0 AND event_id % 5 <> 0
                        THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS old_num,
                   CAST(event_id % 5 + 1 AS VARCHAR) AS source_code
            FROM events)
        WHERE type = 'insert' OR num - old_num > 0""",
    "coupon": """
        SELECT event_id, user_id, ts AS cart_at, (epoch_us(ts) // 1000) // 1000 AS ts,
               CASE WHEN event_id % 4 = 0 THEN 'insert' ELSE 'update' END AS type,
               CASE WHEN event_id % 2 = 0 THEN '1402' ELSE '1403' END AS status,
               CASE WHEN event_id % 4 <> 0 AND event_id % 5 <> 0 THEN '1401' END AS old_status,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS at_text
        FROM events WHERE event_type = 'purchase'""",
    "province": "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation WHERE n_nationkey <> 24",
    "sku": """
        SELECT CAST(p.p_partkey AS VARCHAR) AS sku_id, p.p_type AS spu_id, lower(p.p_type) AS spu_name,
               p.p_brand AS trademark_id,
               CASE WHEN p.p_brand <> 'Brand#1' THEN 'TM ' || p.p_brand END AS trademark_name,
               CAST(p.p_size AS VARCHAR) AS category3_id, s.s_name AS category3_name,
               CAST(s.s_nationkey AS VARCHAR) AS category2_id, n.n_name AS category2_name,
               CAST(n.n_regionkey AS VARCHAR) AS category1_id, r.r_name AS category1_name
        FROM part p LEFT JOIN supplier s ON s.s_suppkey = p.p_size
        LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey AND n.n_nationkey <> 24
        LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "search": """
        SELECT doc_id, text, 1704067200000 + doc_id * 60000 AS ts FROM documents
        WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0 AND text IS NOT NULL""",
    "words": r"""
        SELECT ts, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS keyword FROM search""",
    "cust_feed": """
        SELECT c_custkey AS id, 1 AS v, 'c' AS op, c_name, c_acctbal AS b FROM customer
        UNION ALL SELECT c_custkey, 2, 'u', c_name, c_acctbal + 100 FROM customer WHERE c_custkey % 3 = 0
        UNION ALL SELECT c_custkey, 3, 'd', c_name, NULL FROM customer WHERE c_custkey % 5 = 0""",
    "dim_rows": """
        SELECT 'dim_sku_info' AS sink_table, CAST(p_partkey AS VARCHAR) AS pk, 'insert' AS type, 1 AS ts,
               p_name AS sku_name, NULL AS name, '' AS weight, 4 AS entries FROM part
        UNION ALL SELECT 'dim_sku_info', CAST(p_partkey AS VARCHAR), 'update', 2, upper(p_name), NULL, '', 4
        FROM part WHERE p_partkey % 3 = 0
        UNION ALL SELECT 'dim_sku_info', CAST(p_partkey AS VARCHAR), 'delete', 3, p_name, NULL, '', 4
        FROM part WHERE p_partkey % 10 = 0
        UNION ALL SELECT 'dim_base_category3', CAST(s_suppkey AS VARCHAR), 'bootstrap-insert', 1, NULL, s_name,
               NULL, 2 FROM supplier""",
}


def bounds(ms: str, width_s: int = 3600) -> str:
    """``stt`` and ``edt`` of the tumbling window around epoch milliseconds."""
    us = f"(({ms}) // {width_s * 1000}) * CAST({width_s * 1_000_000} AS BIGINT)"
    fmt = "'%Y-%m-%d %H:%M:%S'"
    return (
        f"strftime(make_timestamp({us}), {fmt}) AS stt, "
        f"strftime(make_timestamp({us} + {width_s * 1_000_000}), {fmt}) AS edt"
    )


def _with(body: str) -> str:
    """Prefix a query with the CTEs it uses, directly or through others, in order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(body)
    order: list[str] = []

    def place(name: str) -> None:
        for other in CTES:
            if other != name and other in needed and other not in order:
                if re.search(rf"(FROM|JOIN)\s+{other}\b", CTES[name]):
                    place(other)
        if name not in order:
            order.append(name)

    for name in CTES:
        if name in needed:
            place(name)
    ctes = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in order)
    body = body.strip()
    if not ctes:
        return body
    if body.startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


_DETAIL_OUT = (
    "id, order_id, sku_id, sku_name, order_price, sku_num, create_time, source_type, source_id, "
    "split_total_amount, split_activity_amount, split_coupon_amount, split_original_amount, od_ts, "
    "order_status, user_id, operate_time, province_id, oi_ts, activity_id, activity_rule_id, "
    "coupon_id, coupon_use_id"
)


def _user_window(rows: str, unique: str, new: str) -> str:
    """Per-window counts of users' first rows of a day and of ever; rows: user_id, ms."""
    return f"""
    SELECT {bounds("ms")}, count(*) AS {unique},
           CAST(sum(CASE WHEN is_first THEN 1 ELSE 0 END) AS BIGINT) AS {new}
    FROM (
        SELECT ms, row_number() OVER (PARTITION BY user_id ORDER BY ms) = 1 AS is_first FROM (
            SELECT user_id, min(ms) AS ms FROM ({rows}) GROUP BY user_id, ms // 86400000))
    GROUP BY 1, 2"""


_PAID = """
    SELECT d.*, dic.dic_name AS payment_type,
           strftime(p.o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS pay_time,
           (epoch_us(p.o_orderdate + INTERVAL 1 DAY) // 1000) AS pay_ms
    FROM orders p
    JOIN dic ON dic.dic_code = substr(p.o_orderpriority, 1, 1)
    JOIN {detail} d ON d.order_id = CAST(p.o_orderkey AS VARCHAR)
    WHERE p.o_orderstatus = 'P' AND p.o_orderkey % 3 <> 0"""

_STAMP = """CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 100 AS VARCHAR)
             ELSE lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') END"""

SQL = {
    # scans and sinks
    "scan_changelog": """
        SELECT event_id AS seq, 'coupon_use' AS "table", type, ts, status AS coupon_status, old_status,
               CAST(NULL AS VARCHAR) AS missing
        FROM coupon WHERE event_id % 50 NOT IN (7, 8, 9)""",
    "upsert_latest": """
        SELECT CAST(order_id AS VARCHAR) AS id, order_status, CAST(total_amount AS VARCHAR) AS total_amount, ts
        FROM order_changes
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY ts DESC, order_status) = 1""",
    "cdc_current_state": """
        SELECT CAST(id AS VARCHAR) AS id, c_name AS name, CAST(b AS DECIMAL(16,2)) AS balance FROM (
            SELECT * FROM cust_feed QUALIFY row_number() OVER (PARTITION BY id ORDER BY v DESC) = 1)
        WHERE op <> 'd'""",
    "dim_upsert": """
        SELECT sink_table, pk, type, sku_name, name, weight, CAST(NULL AS VARCHAR) AS price FROM dim_rows
        QUALIFY row_number() OVER (PARTITION BY sink_table, pk ORDER BY ts DESC) = 1""",
    "dim_filter": """
        SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS sku_name, p_type AS spu_id, p_brand AS tm_id,
               CAST(p_size AS VARCHAR) AS category3_id
        FROM part WHERE p_brand = 'Brand#2' AND p_type = 'ECONOMY'""",
    # projections, filters, splits
    "json_extract": """
        SELECT seq, mid, CASE WHEN NOT is_start THEN during_time END AS during_time,
               CASE WHEN is_start THEN k END AS loading_time,
               CASE WHEN k % 3 > 0 THEN CAST(k % 3 AS INTEGER) END AS n_actions, ts,
               CASE WHEN event_type = 'error' THEN CAST(k AS VARCHAR) END AS error_code
        FROM log""",
    "dirty_split": """
        SELECT event_id AS seq, CASE WHEN event_id % 50 IN (7, 8, 9) THEN 'dirty' ELSE 'good' END AS kind,
               CASE event_id % 50 WHEN 7 THEN 40 WHEN 9 THEN 0
                    WHEN 8 THEN CAST(len('{"ts":}') + len(CAST((epoch_us(ts) // 1000) AS VARCHAR))
                        + CASE WHEN event_type = 'signup'
                               THEN len('"start":{"entry":"icon","loading_time":""},') + len(k)
                               ELSE len('"page":{"page_id":"","item":"","item_type":"sku_id","during_time":},')
                                    + CASE WHEN event_id % 3 = 1 THEN len('"last_page_id":"login",')
                                           WHEN event_id % 3 = 2 THEN len('"last_page_id":"home",') ELSE 0 END
                                    + len(props) + 2
                                    + len(CAST(CAST(floor(value * 1000) AS BIGINT) AS VARCHAR))
                                    + len(CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail'
                                          WHEN 'purchase' THEN 'trade' ELSE 'search' END) END
                        + CASE kk % 3 WHEN 1 THEN len('"actions":[{"action_id":"action_id1"}],')
                               WHEN 2 THEN len('"actions":[{"action_id":"action_id1"},{"action_id":"action_id2"}],')
                               ELSE 0 END
                        + CASE kk % 4 WHEN 1 THEN len('"displays":[{"item":"item1"}],')
                               WHEN 2 THEN len('"displays":[{"item":"item1"},{"item":"item2"}],')
                               WHEN 3 THEN len('"displays":[{"item":"item1"},{"item":"item2"},{"item":"item3"}],')
                               ELSE 0 END
                        + CASE WHEN event_type = 'error' THEN len('"err":{"error_code":""},') + len(k) ELSE 0 END
                        AS INTEGER) END AS size
        FROM (SELECT *, json_extract_string(props, '$.k') AS k,
                     CAST(json_extract_string(props, '$.k') AS BIGINT) AS kk FROM events)""",
    "map_project": """
        SELECT CAST(p_partkey AS VARCHAR) AS id,
               CASE WHEN type = 'update' THEN upper(p_name) ELSE p_name END AS sku_name,
               CAST(CAST(p_retailprice AS DECIMAL(16,2)) AS VARCHAR) AS price,
               CAST(NULL AS VARCHAR) AS absent, type
        FROM part, (VALUES ('insert', 1), ('update', 3), ('delete', 10)) v(type, n)
        WHERE p_partkey % n = 0""",
    "filter_change_type": """
        SELECT type, order_status, count(*) AS n, count(old_status) AS moved
        FROM order_changes GROUP BY type, order_status""",
    "status_transition": """
        SELECT CAST(order_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, ts FROM order_changes
        WHERE type = 'update' AND order_status = '1005' AND old_status IS NOT NULL""",
    "cart_delta": """
        SELECT CAST(event_id AS VARCHAR) AS id, CAST(num AS VARCHAR) AS sku_num, type,
               CAST(added AS VARCHAR) AS added FROM cart""",
    "config_prune": """
        SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS sku_name, CAST(NULL AS VARCHAR) AS price,
               CAST(3 AS INTEGER) AS kept FROM part""",
    "not_null_filter": """
        SELECT seq, uid, last_page_id FROM page_log WHERE uid IS NOT NULL AND last_page_id IS NOT NULL""",
    "unnest_actions": """
        SELECT seq, 'action_id' || CAST(i AS VARCHAR) AS action_id, mid, page_id, ts
        FROM (SELECT *, unnest(range(1, k % 3 + 1)) AS i FROM log WHERE NOT is_start)""",
    "unnest_displays": """
        SELECT seq, 'item' || CAST(i AS VARCHAR) AS item, mid, ts
        FROM (SELECT *, unnest(range(1, k % 4 + 1)) AS i FROM log WHERE NOT is_start)""",
    "split_pages": """
        SELECT seq, ts, mid, uid, vc, ch, ar, is_new, page_id, props AS item, 'sku_id' AS item_type,
               last_page_id, during_time FROM log WHERE NOT is_start""",
    "split_starts": """
        SELECT seq, mid, 'icon' AS entry, CAST(k AS VARCHAR) AS loading_time, ts FROM log WHERE is_start""",
    "split_errors": """
        SELECT seq, CAST(k AS VARCHAR) AS error_code FROM log WHERE event_type = 'error'""",
    "base_log": """
        SELECT topic, is_new, count(*) AS n, CAST(sum(seq) AS BIGINT) AS seq_sum FROM (
            SELECT CASE WHEN is_start THEN 'dwd_traffic_start_log' ELSE 'dwd_traffic_page_log' END AS topic,
                   fixed AS is_new, seq FROM fixed_log
            UNION ALL SELECT 'dwd_traffic_action_log', fixed, seq
            FROM (SELECT *, unnest(range(1, k % 3 + 1)) FROM fixed_log WHERE NOT is_start)
            UNION ALL SELECT 'dwd_traffic_display_log', fixed, seq
            FROM (SELECT *, unnest(range(1, k % 4 + 1)) FROM fixed_log WHERE NOT is_start)
            UNION ALL SELECT 'dwd_traffic_error_log', NULL, seq FROM fixed_log WHERE event_type = 'error'
            UNION ALL SELECT 'dirty', NULL, event_id FROM events WHERE event_id % 50 IN (7, 8, 9))
        GROUP BY topic, is_new""",
    # joins
    "join_inner": """
        SELECT CAST(d.detail_id AS VARCHAR) AS id, CAST(d.order_id AS VARCHAR) AS order_id,
               CAST(CAST(d.price * d.num AS DECIMAL(33,4)) AS VARCHAR) AS split_original_amount,
               CAST(o.user_id AS VARCHAR) AS user_id, o.order_status
        FROM details d JOIN order_changes o ON o.order_id = d.order_id""",
    "join_composite": """
        SELECT CAST(p.id AS VARCHAR) AS id, CAST(p.order_id AS VARCHAR) AS order_id,
               CAST(p.sku_id AS VARCHAR) AS sku_id, CAST(r.refund_num AS VARCHAR) AS refund_num
        FROM refund_info p JOIN refund_info r ON r.order_id = p.order_id AND r.sku_id = p.sku_id
        WHERE p.l_linestatus = 'F'""",
    "join_left": """
        SELECT CAST(d.detail_id AS VARCHAR) AS id, CAST(d.order_id AS VARCHAR) AS order_id, d.od_ts,
               a.activity_id, a.activity_rule_id
        FROM details d LEFT JOIN act a ON a.detail_id = d.detail_id""",
    "join_within_interval": """
        SELECT CAST(d.detail_id AS VARCHAR) AS id, CAST(d.order_id AS VARCHAR) AS order_id, d.od_ts,
               o.order_status, o.ts AS oi_ts
        FROM details d JOIN order_changes o ON o.order_id = d.order_id
        WHERE abs(d.od_ts - o.ts) <= 30 * 86400""",
    "lookup_as_of": """
        WITH versions AS (
            SELECT dic_code, dic_name, CAST(0 AS BIGINT) AS since, CAST(-1 AS BIGINT) AS seq FROM dic
            UNION ALL
            SELECT CAST(user_id % 5 + 1 AS VARCHAR), CASE WHEN event_id % 70 <> 0 THEN 'name-' || CAST(event_id AS VARCHAR) END,
                   (epoch_us(ts) // 1000) // 1000, event_id
            FROM events WHERE event_id % 10 = 0),
        single AS (SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY dic_code, since ORDER BY seq DESC) = 1)
        SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, CAST(added AS VARCHAR) AS sku_num,
               v.dic_name, ts
        FROM cart ASOF JOIN single v ON cart.source_code = v.dic_code AND cart.ts >= v.since
        WHERE v.dic_name IS NOT NULL""",
    "lookup_inner": """
        SELECT CAST(e.event_id AS VARCHAR) AS id, dic_code AS source_type, dic_name
        FROM events e JOIN dic ON dic_code = CAST(e.event_id % 5 + 1 AS VARCHAR)""",
    "lookup_twice": """
        SELECT CAST(r.id AS VARCHAR) AS id, CAST(r.sku_id AS VARCHAR) AS sku_id, r.refund_type,
               r.reason_type AS refund_reason_type, t.dic_name AS type_name, s.dic_name AS reason_name
        FROM refund_info r JOIN dic t ON t.dic_code = r.refund_type JOIN dic s ON s.dic_code = r.reason_type""",
    "config_join": """
        SELECT sink_table, type, count(*) AS n, CAST(sum(entries) AS BIGINT) AS entries
        FROM dim_rows GROUP BY sink_table, type""",
    "dim_left": """
        SELECT CAST(o.order_id AS VARCHAR) AS id, CAST(o.province_id AS VARCHAR) AS province_id,
               p.name AS province_name
        FROM order_changes o LEFT JOIN province p ON p.id = CAST(o.province_id AS VARCHAR)
        WHERE o.type = 'insert'""",
    "dim_snowflake": """
        SELECT d.sku_id, d.n, s.* EXCLUDE (sku_id) FROM (
            SELECT CAST(sku_id AS VARCHAR) AS sku_id, count(*) AS n FROM details GROUP BY 1) d
        LEFT JOIN sku s ON s.sku_id = d.sku_id""",
    # aggregations
    "window_keyed_sum": f"""
        SELECT {bounds("ts")}, ch, page_id, min(vc) AS vc, CAST(sum(during_time) AS BIGINT) AS dur_sum
        FROM page_log GROUP BY 1, 2, ch, page_id""",
    "window_global_sum": f"""
        SELECT {bounds("ts")}, count(*) AS pv_ct, CAST(sum(during_time) AS BIGINT) AS dur_sum
        FROM page_log GROUP BY 1, 2""",
    "keyword_window_count": f"""
        SELECT {bounds("ts", 86400)}, keyword, 'SEARCH' AS source, count(*) AS keyword_count
        FROM words GROUP BY 1, 2, keyword""",
    "window_count_distinct": f"""
        SELECT {bounds("ts")}, page_id, count(DISTINCT mid) AS visitors FROM page_log GROUP BY 1, 2, page_id""",
    "union_measures": """
        SELECT vc, ch, CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(sv) AS BIGINT) AS sv_ct,
               CAST(sum(pv) AS BIGINT) AS pv_ct, CAST(sum(dur) AS BIGINT) AS dur_sum,
               CAST(sum(uj) AS BIGINT) AS uj_ct
        FROM (SELECT vc, ch, 0 AS uv, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS sv, 1 AS pv,
                     during_time AS dur, 0 AS uj FROM page_log
              UNION ALL SELECT vc, ch, 1, 0, 0, 0, 0 FROM uv
              UNION ALL SELECT vc, ch, 0, 0, 0, 0, 1 FROM uj)
        GROUP BY vc, ch""",
    # scalar functions
    "amount_math": """
        SELECT CAST(detail_id AS VARCHAR) AS id, CAST(sku_id AS VARCHAR) AS sku_id,
               CAST(CAST(price * num AS DECIMAL(33,4)) AS VARCHAR) AS original,
               CAST(price - coalesce(activity_amount, 0) - coalesce(coupon_amount, 0) AS DECIMAL(16,2)) AS net,
               num * 1000 AS milli, sku_id AS sku_number
        FROM details""",
    "epoch_conversions": """
        SELECT event_id, (epoch_us(ts) // 1000) AS ms, strftime(ts, '%Y-%m-%d') AS day,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS full_text,
               (epoch_us(date_trunc('day', ts)) // 1000) AS midnight_ms,
               (epoch_us(date_trunc('second', ts)) // 1000) AS second_ms
        FROM events""",
    "keyword_tokens": r"""
        SELECT keyword, count(*) AS n FROM (
            SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS keyword FROM documents)
        GROUP BY keyword""",
    # histories
    "new_visitor_fix": """
        SELECT seq, mid, CASE WHEN is_new = '1' AND first_day <> dt THEN '0' ELSE is_new END AS is_new FROM (
            SELECT *, first_value(CASE WHEN is_new = '1' THEN dt
                ELSE strftime(CAST(dt AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d') END)
                OVER (PARTITION BY mid ORDER BY ts, seq) AS first_day FROM page_log)""",
    "unique_visitors": "SELECT mid, dt, seq, ts, vc, ch, page_id FROM uv",
    "user_jump": "SELECT mid, seq, ts, page_id, ch FROM uj",
    "order_user_flags": """
        SELECT user_id, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS dt, ts,
               CAST(1 AS BIGINT) AS unique_user,
               CAST(CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts) = 1 THEN 1 ELSE 0 END AS BIGINT)
                   AS new_user
        FROM (SELECT o_custkey AS user_id, min((epoch_us(o_orderdate) // 1000)) AS ts FROM orders
              GROUP BY o_custkey, CAST(o_orderdate AS DATE))""",
    "login_backflow": """
        SELECT uid, dt, ts, CAST(1 AS BIGINT) AS uu,
               CAST(CASE WHEN ts - (epoch_us(CAST(last_dt AS TIMESTAMP)) // 1000) > 86400000 THEN 1 ELSE 0 END AS BIGINT) AS back
        FROM (SELECT *, lag(dt) OVER (PARTITION BY uid ORDER BY ts) AS last_dt FROM (
                SELECT uid, dt, min(ts) AS ts FROM page_log
                WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login')
                GROUP BY uid, dt))""",
    "cart_unique_users": """
        SELECT CAST(user_id AS VARCHAR) AS user_id, strftime(cart_at, '%Y-%m-%d') AS dt, min(ts) * 1000 AS ts
        FROM cart JOIN dic ON dic_code = source_code GROUP BY 1, 2""",
    "dedup_latest": """
        SELECT CAST(detail_id AS VARCHAR) AS id, od_ts, CAST(sku_id AS VARCHAR) AS sku_id,
               CAST(price AS VARCHAR) AS order_price, CAST(num AS VARCHAR) AS sku_num
        FROM details
        QUALIFY row_number() OVER (PARTITION BY detail_id ORDER BY od_ts DESC, CAST(sku_id AS VARCHAR),
            CAST(source_id AS VARCHAR), CAST(price AS VARCHAR), CAST(num AS VARCHAR),
            CAST(activity_amount AS VARCHAR) NULLS LAST, CAST(coupon_amount AS VARCHAR) NULLS LAST) = 1""",
    "latest_by_row_ts": f"""
        SELECT event_id, user_id, '2022-08-26 07:47:55.' || {_STAMP} || 'Z' AS row_op_ts FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id
            ORDER BY CAST('0.' || {_STAMP} AS DECIMAL(9,6)) DESC, event_id) = 1""",
    # fact jobs
    "dwd_interaction_comment": """
        SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
               json_extract_string(props, '$.k') AS sku_id, CAST(event_id AS VARCHAR) AS order_id,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time, dic_code AS appraise_code,
               (epoch_us(ts) // 1000) // 1000 AS ts, dic_name AS appraise_name
        FROM events JOIN dic ON dic_code = CAST(event_id % 5 + 1 AS VARCHAR)
        WHERE event_type = 'click' AND event_id % 2 = 0""",
    "dwd_interaction_favor_add": """
        SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
               json_extract_string(props, '$.k') AS sku_id,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time, (epoch_us(ts) // 1000) // 1000 AS ts
        FROM events WHERE event_type = 'view' AND event_id % 2 = 0""",
    "dwd_tool_coupon_get": """
        SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id % 9 AS VARCHAR) AS coupon_id,
               CAST(user_id AS VARCHAR) AS user_id, at_text AS get_time, ts FROM coupon WHERE type = 'insert'""",
    "dwd_tool_coupon_order": """
        SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id % 9 AS VARCHAR) AS coupon_id,
               CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS order_id,
               at_text AS order_time, ts
        FROM coupon WHERE type = 'update' AND status = '1402' AND old_status = '1401'""",
    "dwd_tool_coupon_pay": """
        SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id % 9 AS VARCHAR) AS coupon_id,
               CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS order_id,
               at_text AS payment_time, ts
        FROM coupon WHERE type = 'update' AND event_id % 3 = 0""",
    "dwd_user_register": """
        SELECT CAST(user_id AS VARCHAR) AS user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time,
               (epoch_us(ts) // 1000) // 1000 AS ts
        FROM events WHERE event_type = 'signup' AND event_id % 2 = 0""",
    "dwd_trade_cart_add": """
        SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
               json_extract_string(props, '$.k') AS sku_id,
               CAST(CAST(value AS DECIMAL(16,2)) AS VARCHAR) AS cart_price, CAST(added AS VARCHAR) AS sku_num,
               event_type AS sku_name, '1' AS is_checked, strftime(cart_at, '%Y-%m-%d %H:%M:%S') AS create_time,
               strftime(cart_at, '%Y-%m-%d %H:%M:%S') AS operate_time, '0' AS is_ordered,
               CAST(NULL AS VARCHAR) AS order_time, CAST(user_id AS VARCHAR) AS source_id, ts, dic_name
        FROM cart JOIN dic ON dic_code = source_code""",
    "order_wide": f"SELECT {_DETAIL_OUT}, type, old_status FROM wide",
    "dwd_trade_order_detail": f"SELECT {_DETAIL_OUT} FROM order_detail",
    "dwd_trade_cancel_detail": f"""
        SELECT {_DETAIL_OUT} FROM wide WHERE type = 'update' AND order_status = '1003'
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY od_ts DESC, oi_ts DESC, sku_id, source_id,
            order_price, sku_num, split_activity_amount NULLS LAST, split_coupon_amount NULLS LAST,
            source_type) = 1""",
    "dwd_trade_pay_detail_suc": f"SELECT {_DETAIL_OUT}, payment_type, pay_time FROM ({_PAID.format(detail='order_detail')})",
    "dwd_trade_order_refund": "SELECT * FROM refund_wide",
    "dwd_trade_refund_pay_suc": """
        SELECT CAST(p.id AS VARCHAR) AS id, CAST(o.user_id AS VARCHAR) AS user_id,
               CAST(p.order_id AS VARCHAR) AS order_id, CAST(p.sku_id AS VARCHAR) AS sku_id,
               CAST(o.province_id AS VARCHAR) AS province_id, p.refund_type AS payment_type_code,
               dic_name AS payment_type_name,
               strftime(p.l_shipdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS callback_time,
               CAST(r.refund_num AS VARCHAR) AS refund_num, CAST(p.refund_amount AS VARCHAR) AS refund_amount,
               p.ts + 86400 AS ts
        FROM refund_info p
        JOIN refund_info r ON r.order_id = p.order_id AND r.sku_id = p.sku_id
        JOIN order_changes o ON o.order_id = p.order_id AND o.type = 'update'
        JOIN dic ON dic_code = p.refund_type
        WHERE p.l_linestatus = 'F' AND p.l_suppkey % 3 <> 0""",
    # marts
    "dws_traffic_page_view": f"""
        SELECT {bounds("ts")}, vc, ch, ar, is_new, CAST(sum(uv) AS BIGINT) AS uv_ct,
               CAST(sum(sv) AS BIGINT) AS sv_ct, CAST(sum(pv) AS BIGINT) AS pv_ct,
               CAST(sum(dur) AS BIGINT) AS dur_sum, CAST(sum(uj) AS BIGINT) AS uj_ct
        FROM (SELECT ts, vc, ch, ar, is_new, 0 AS uv, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS sv,
                     1 AS pv, during_time AS dur, 0 AS uj FROM page_log
              UNION ALL SELECT ts, vc, ch, ar, is_new, 1, 0, 0, 0, 0 FROM uv
              UNION ALL SELECT ts, vc, ch, ar, is_new, 0, 0, 0, 0, 1 FROM uj)
        GROUP BY 1, 2, vc, ch, ar, is_new""",
    "dws_keyword": f"""
        SELECT {bounds("ts")}, keyword, 'SEARCH' AS source, count(*) AS keyword_count
        FROM words GROUP BY 1, 2, keyword""",
    "dws_home_detail_uv": f"""
        SELECT {bounds("ts")}, count(*) FILTER (page_id = 'home') AS home_uv_ct,
               count(*) FILTER (page_id = 'good_detail') AS good_detail_uv_ct
        FROM (SELECT page_id, min(ts) AS ts FROM page_log WHERE page_id IN ('home', 'good_detail')
              GROUP BY mid, page_id, dt)
        GROUP BY 1, 2""",
    "dws_user_login": f"""
        SELECT {bounds("ts")},
               count(*) FILTER (ts - (epoch_us(CAST(last_dt AS TIMESTAMP)) // 1000) > 86400000) AS back_ct,
               count(*) AS uu_ct
        FROM (SELECT *, lag(dt) OVER (PARTITION BY uid ORDER BY ts) AS last_dt FROM (
                SELECT uid, dt, min(ts) AS ts FROM page_log
                WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login')
                GROUP BY uid, dt))
        GROUP BY 1, 2""",
    "dws_user_register": f"""
        SELECT {bounds("(epoch_us(ts) // 1000)")}, count(*) AS register_ct
        FROM events WHERE event_type = 'signup' AND event_id % 2 = 0 GROUP BY 1, 2""",
    "dws_cart_uu": f"""
        SELECT {bounds("ts * 1000")}, count(*) AS cart_add_uu_ct FROM (
            SELECT min(ts) AS ts FROM cart JOIN dic ON dic_code = source_code
            GROUP BY user_id, CAST(cart_at AS DATE))
        GROUP BY 1, 2""",
    "dws_order_users": _user_window(
        "SELECT user_id, od_ts * 1000 AS ms FROM wide WHERE type = 'insert'",
        "order_unique_user_count",
        "order_new_user_count",
    ),
    "dws_payment_users": _user_window(
        "SELECT user_id, pay_ms AS ms FROM ("
        + _PAID.format(detail="(SELECT * FROM wide WHERE type = 'insert')")
        + ")",
        "payment_suc_unique_user_count",
        "payment_suc_new_user_count",
    ),
    "dws_province_order": f"""
        SELECT stt, edt, w.province_id, p.name AS province_name, order_count, order_amount FROM (
            SELECT {bounds("ts * 1000")}, CAST(province_id AS VARCHAR) AS province_id,
                   count(*) AS order_count, CAST(sum(total_amount) AS DECIMAL(16,2)) AS order_amount
            FROM order_changes WHERE type = 'insert' GROUP BY 1, 2, 3) w
        LEFT JOIN province p ON p.id = w.province_id""",
    "dws_sku_order": f"""
        SELECT w.*, s.* EXCLUDE (sku_id) FROM (
            SELECT {bounds("od_ts * 1000")}, sku_id, min(sku_name) AS sku_name,
                   CAST(sum(CAST(split_original_amount AS DECIMAL(20,4))) AS DECIMAL(16,2)) AS original_amount,
                   CAST(sum(coalesce(CAST(split_activity_amount AS DECIMAL(16,2)), 0)) AS DECIMAL(16,2)) AS activity_amount,
                   CAST(sum(coalesce(CAST(split_coupon_amount AS DECIMAL(16,2)), 0)) AS DECIMAL(16,2)) AS coupon_amount,
                   CAST(sum(CAST(split_total_amount AS DECIMAL(16,2))) AS DECIMAL(16,2)) AS order_amount
            FROM order_detail GROUP BY 1, 2, sku_id) w
        LEFT JOIN sku s ON s.sku_id = w.sku_id""",
    "dws_refund": f"""
        SELECT w.*, c.* EXCLUDE (category3_id), t.trademark_name FROM (
            SELECT {bounds("r.ts * 1000", 30 * 86400)}, r.user_id, s.trademark_id, s.category3_id,
                   count(DISTINCT r.order_id) AS refund_count
            FROM refund_wide r LEFT JOIN sku s ON s.sku_id = r.sku_id GROUP BY 1, 2, 3, 4, 5) w
        LEFT JOIN (SELECT DISTINCT trademark_id, trademark_name FROM sku) t ON t.trademark_id = w.trademark_id
        LEFT JOIN (SELECT DISTINCT category3_id, category3_name, category2_id, category2_name, category1_id,
                          category1_name FROM sku) c ON c.category3_id = w.category3_id""",
}

SQL |= {
    # stream faces: what the watermark has closed or decided when the input ends
    "stream_window_append": f"""
        SELECT stt, edt, ch, dur_sum FROM (
            SELECT {bounds("ts")}, ch, CAST(sum(during_time) AS BIGINT) AS dur_sum,
                   (min(ts) // 3600000 + 1) * 3600000 AS closes
            FROM page_log GROUP BY 1, 2, ch)
        WHERE closes <= (SELECT max(ts) - 2000 FROM page_log)""",
    "stream_window_lateness": f"""
        SELECT stt, edt, ch, pv_ct, dur_sum FROM (
            SELECT {bounds("ts")}, ch, count(*) AS pv_ct, CAST(sum(during_time) AS BIGINT) AS dur_sum,
                   (min(ts) // 3600000 + 1) * 3600000 AS closes
            FROM page_log GROUP BY 1, 2, ch)
        WHERE closes <= (SELECT max(ts) - 2000 FROM page_log)""",
    "stream_window_count_distinct": f"""
        SELECT stt, edt, page_id, visitors FROM (
            SELECT {bounds("ts")}, page_id, count(DISTINCT mid) AS visitors,
                   (min(ts) // 3600000 + 1) * 3600000 AS closes
            FROM page_log GROUP BY 1, 2, page_id)
        WHERE closes <= (SELECT max(ts) - 2000 FROM page_log)""",
    "stream_new_visitor_fix": SQL["new_visitor_fix"],
    "stream_unique_visitors": "SELECT mid, seq, ts, vc, ch, page_id FROM uv",
    "stream_order_user_flags": SQL["order_user_flags"],
    "stream_login_backflow": SQL["login_backflow"],
    "stream_user_jump": """
        SELECT mid, seq, ts, page_id, ch FROM uj
        WHERE least(coalesce(next_ts, ts + 21600000), ts + 21600000)
              <= (SELECT max(ts) - 2000 FROM page_log)""",
    "stream_dedup_latest": """
        SELECT CAST(sku_id AS VARCHAR) AS sku_id, max(od_ts) AS od_ts FROM details GROUP BY sku_id
        HAVING min(od_ts) + 5 <= (SELECT max(od_ts) FROM details) - 2""",
    "stream_order_revisions": """
        WITH a AS (SELECT o_orderkey * 10 + 1 AS detail_id, CAST(o_orderkey % 7 AS VARCHAR) AS activity_id,
                     epoch_us(o_orderdate) // 1000000 AS ts FROM orders WHERE o_orderkey % 2 = 0),
        c AS (SELECT o_orderkey * 10 + 1 AS detail_id, CAST(o_orderkey % 11 AS VARCHAR) AS coupon_id,
                     epoch_us(o_orderdate) // 1000000 AS ts FROM orders WHERE o_orderkey % 3 = 0)
        SELECT CAST(d.detail_id AS VARCHAR) AS id, CAST(d.order_id AS VARCHAR) AS order_id, o.order_status,
               CAST(d.source_code AS VARCHAR) AS source_type, d.od_ts, o.ts AS oi_ts,
               max(a.activity_id) AS activity_id, max(c.coupon_id) AS coupon_id
        FROM details d JOIN order_changes o ON o.order_id = d.order_id AND abs(o.ts - d.od_ts) <= 30 * 86400
        LEFT JOIN a ON a.detail_id = d.detail_id AND abs(a.ts - d.od_ts) <= 30 * 86400
        LEFT JOIN c ON c.detail_id = d.detail_id AND abs(c.ts - d.od_ts) <= 30 * 86400
        GROUP BY ALL""",
    "stream_order_wide": """
        WITH d AS (
            SELECT details.*, dic_name FROM details JOIN dic ON dic_code = CAST(source_code AS VARCHAR)),
        a AS (SELECT o_orderkey * 10 + 1 AS detail_id, CAST(o_orderkey % 7 AS VARCHAR) AS activity_id,
                     epoch_us(o_orderdate) // 1000000 AS ts FROM orders WHERE o_orderkey % 2 = 0),
        c AS (SELECT o_orderkey * 10 + 1 AS detail_id, CAST(o_orderkey % 11 AS VARCHAR) AS coupon_id,
                     epoch_us(o_orderdate) // 1000000 AS ts FROM orders WHERE o_orderkey % 3 = 0),
        wm AS (SELECT least((SELECT max(od_ts) FROM d), (SELECT max(ts) FROM order_changes),
                            (SELECT max(ts) FROM a), (SELECT max(ts) FROM c)) - 86400 AS w)
        SELECT CAST(d.detail_id AS VARCHAR) AS id, CAST(d.order_id AS VARCHAR) AS order_id, o.order_status,
               d.dic_name AS source_type, d.od_ts, o.ts AS oi_ts, a.activity_id, c.coupon_id
        FROM d JOIN order_changes o ON o.order_id = d.order_id AND abs(o.ts - d.od_ts) <= 30 * 86400
        CROSS JOIN wm
        LEFT JOIN a ON a.detail_id = d.detail_id AND abs(a.ts - d.od_ts) <= 30 * 86400
        LEFT JOIN c ON c.detail_id = d.detail_id AND abs(c.ts - d.od_ts) <= 30 * 86400
        WHERE (a.detail_id IS NOT NULL OR d.od_ts < w - 60 * 86400)
          AND (c.detail_id IS NOT NULL OR d.od_ts < w - 90 * 86400)""",
}

CTES["fixed_log"] = """
    SELECT *, CASE WHEN is_new = '1' AND first_day <> dt THEN '0' ELSE is_new END AS fixed FROM (
        SELECT *, first_value(CASE WHEN is_new = '1' THEN dt
            ELSE strftime(CAST(dt AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d') END)
            OVER (PARTITION BY mid ORDER BY ts, seq) AS first_day FROM log)"""


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in SQL.items()}
