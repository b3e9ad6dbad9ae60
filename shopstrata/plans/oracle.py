"""The same results in ANSI SQL, for checking every query on the same parquet tables."""

from __future__ import annotations


def _ratio(numerator: str, denominator: str, scale: int) -> str:
    """Quotient of two amounts rounded half up, in whole numbers, so that no binary fraction gets in."""
    unit = "0." + "0" * (scale - 1) + "1"
    top = f"CAST(({numerator}) * 100 AS HUGEINT)"
    bottom = f"CAST(({denominator}) * 100 AS HUGEINT)"
    rounded = f"(2 * {top} * {10 ** scale} + {bottom}) // (2 * {bottom})"
    return (
        f"CAST(CASE WHEN {bottom} = 0 THEN 0 ELSE CAST({rounded} AS DECIMAL(18,0)) * {unit} END AS DECIMAL(16,{scale}))"
    )


def _metric(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(18,2))"


def _count(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


_PAYMENT = """
    SELECT o_orderkey AS id, o_orderkey AS order_id, o_custkey AS user_id, o_orderpriority AS payment_type,
           CAST(o_totalprice AS DECIMAL(16,2)) AS payment_amount, o_orderstatus AS payment_status,
           o_orderdate AS create_time, CAST(o_orderdate AS DATE) AS dt
    FROM orders"""
_LINE = """
    SELECT l_orderkey AS order_id, l_linenumber, l_partkey AS sku_id,
           CAST(l_extendedprice AS DECIMAL(16,2)) AS order_price, CAST(l_quantity AS BIGINT) AS sku_num,
           CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_quantity AS BIGINT) AS amount,
           l_shipdate AS create_time, CAST(l_shipdate AS DATE) AS dt
    FROM lineitem"""
_REFUND = """
    SELECT l_orderkey AS order_id, l_partkey AS sku_id, CAST(l_extendedprice AS DECIMAL(16,2)) AS refund_amount,
           l_shipdate AS create_time, CAST(l_shipdate AS DATE) AS dt
    FROM lineitem WHERE l_returnflag = 'R'"""
_PURCHASE = """
    SELECT event_id AS id, user_id, CAST(value AS DECIMAL(16,2)) AS payment_amount, ts AS create_time
    FROM events WHERE event_type = 'purchase'"""
_ROLES = f"WITH payment AS ({_PAYMENT}), line AS ({_LINE}), refund AS ({_REFUND}), purchase AS ({_PURCHASE})"

_TRAFFIC_DAY = f"""
    SELECT CAST(ts AS DATE) AS metric_date, 'browse_pv' AS metric_name, 'ALL' AS dimension_key,
           {_metric('COUNT(*)')} AS metric_value
    FROM events WHERE event_type = 'view' GROUP BY 1
    UNION ALL
    SELECT CAST(ts AS DATE), 'day_uv', 'ALL', {_metric('COUNT(DISTINCT user_id)')}
    FROM events WHERE event_type = 'view' GROUP BY 1"""
_TRAFFIC_MINUTE = f"""
    SELECT CAST(ts AS DATE) AS metric_date, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS window_start,
           'browse_pv' AS metric_name, 'ALL' AS dimension_key, {_metric('COUNT(*)')} AS metric_value
    FROM events WHERE event_type = 'view' GROUP BY 1, 2
    UNION ALL
    SELECT CAST(ts AS DATE), CAST(date_trunc('minute', ts) AS TIMESTAMP), 'browse_uv', 'ALL',
           {_metric('COUNT(DISTINCT user_id)')}
    FROM events WHERE event_type = 'view' GROUP BY 1, 2"""
_TRADE_MINUTE = f"""
    SELECT CAST(create_time AS DATE) AS metric_date,
           CAST(date_trunc('minute', create_time) AS TIMESTAMP) AS window_start,
           'gmv' AS metric_name, 'ALL' AS dimension_key, {_metric('SUM(payment_amount)')} AS metric_value
    FROM purchase GROUP BY 1, 2
    UNION ALL
    SELECT CAST(create_time AS DATE), CAST(date_trunc('minute', create_time) AS TIMESTAMP), 'payment_order_count',
           'ALL', {_metric('COUNT(DISTINCT id)')}
    FROM purchase GROUP BY 1, 2"""


def _closed(minutes: str, source: str, time: str) -> str:
    watermark = f"(SELECT date_trunc('milliseconds', MAX({time})) FROM {source}) - INTERVAL 5 SECOND"
    return f"SELECT * FROM ({minutes}) m WHERE window_start + INTERVAL 1 MINUTE <= {watermark}"


def _payment_day(source: str) -> str:
    return f"""
    SELECT dt AS metric_date, 'gmv' AS metric_name, 'ALL' AS dimension_key,
           {_metric('SUM(payment_amount)')} AS metric_value FROM {source} WHERE payment_status = 'F' GROUP BY dt
    UNION ALL
    SELECT dt, 'payment_order_count', 'ALL', {_metric('COUNT(DISTINCT order_id)')}
    FROM {source} WHERE payment_status = 'F' GROUP BY dt
    UNION ALL
    SELECT dt, 'payment_user_count', 'ALL', {_metric('COUNT(DISTINCT user_id)')}
    FROM {source} WHERE payment_status = 'F' GROUP BY dt"""


_REFUND_DAY = f"""
    SELECT dt AS metric_date, 'refund_amount' AS metric_name, 'ALL' AS dimension_key,
           {_metric('SUM(refund_amount)')} AS metric_value FROM refund GROUP BY dt"""
_ORDER_DAY = f"""
    SELECT dt AS metric_date, 'order_gmv' AS metric_name, 'ALL' AS dimension_key,
           {_metric('SUM(amount)')} AS metric_value FROM line GROUP BY dt
    UNION ALL
    SELECT dt, 'order_count', 'ALL', {_metric('COUNT(DISTINCT order_id)')} FROM line GROUP BY dt
    UNION ALL
    SELECT dt, 'order_detail_count', 'ALL', {_metric('COUNT(*)')} FROM line GROUP BY dt"""
_TRADE_DAY = f"{_payment_day('payment')} UNION ALL {_REFUND_DAY} UNION ALL {_ORDER_DAY}"
_GMV_NATION = f"""
    SELECT p.dt AS metric_date, 'gmv_province' AS metric_name, n_name AS dimension_key,
           {_metric('SUM(payment_amount)')} AS metric_value
    FROM payment p JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE payment_status = 'F' GROUP BY p.dt, n_name"""
_AMOUNT_CATEGORY = f"""
    SELECT l.dt AS metric_date, 'order_amount_category' AS metric_name, p_type AS dimension_key,
           {_metric('SUM(amount)')} AS metric_value
    FROM line l JOIN part ON sku_id = p_partkey GROUP BY l.dt, p_type"""
_CHANGED = """
    SELECT id, order_id, user_id, payment_amount, 'F' AS payment_status, create_time + INTERVAL 1 DAY AS create_time,
           CAST(create_time + INTERVAL 1 DAY AS DATE) AS dt
    FROM payment WHERE payment_status = 'P'
    UNION ALL
    SELECT id, order_id, user_id, payment_amount, payment_status, create_time, dt
    FROM payment WHERE payment_status <> 'P' AND NOT (payment_status = 'F' AND payment_type = '5-LOW')"""

_ACTION = (
    "CASE event_type WHEN 'signup' THEN 'launch' WHEN 'view' THEN 'browse' WHEN 'purchase' THEN 'pay' ELSE event_type END"
)
_ITEM = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_TEXT = "strftime(ts, '%Y-%m-%d %H:%M:%S')"

_FLAT = f"""
    SELECT user_id AS uid, 'app' AS platform, CAST(NULL AS BIGINT) AS province_id, event_type AS page_id,
           {_ACTION} AS action_id, {_ITEM} AS item, {_TEXT} AS ts, CAST(event_id AS VARCHAR) AS event_id,
           epoch_us(ts - INTERVAL 8 HOUR) // 1000 AS event_time_ms, strftime(ts, '%Y-%m-%d') AS biz_date,
           'Asia/Shanghai' AS source_timezone
    FROM events"""


def _pick(order: str) -> str:
    columns = (
        "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
        "l_returnflag, l_linestatus, l_shipdate"
    )
    directed = ", ".join(f"{name} {order}" for name in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"))
    return f"""
    SELECT {columns} FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {directed}) AS rn FROM lineitem
    ) ranked WHERE rn = 1"""


def _orphans(name: str, child: str, key: str, parent: str, primary: str, where: str = "TRUE") -> str:
    return (
        f"SELECT '{name}' AS check_name, COUNT(*) AS bad_count FROM {child} c "
        f"LEFT JOIN {parent} p ON c.{key} = p.{primary} WHERE p.{primary} IS NULL AND {where}"
    )


def _hits(name: str, left: str, key: str, right: str, other: str) -> str:
    return f"SELECT '{name}' AS check_item, COUNT(*) AS hits FROM {left} l JOIN {right} r ON l.{key} = r.{other}"


def _order_check(name: str, arrival: str, time: str) -> str:
    return f"""
    SELECT '{name}' AS table_name, COUNT(*) AS rows_checked,
           COUNT(*) FILTER (WHERE t < previous) AS steps_back, COUNT(*) FILTER (WHERE t < latest) AS behind
    FROM (SELECT {time} AS t, LAG({time}) OVER (ORDER BY {arrival}) AS previous,
                 MAX({time}) OVER (ORDER BY {arrival} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest
          FROM {name}) s"""


def _sentinel(name: str, source: str, seq: str) -> str:
    return f"""
    SELECT '{name}' AS table_name, COUNT(*) AS row_count, CAST(MIN({seq}) AS BIGINT) AS min_seq,
           CASE WHEN COUNT(*) = 0 THEN 'empty' WHEN MIN({seq}) > 0 THEN 'truncated' ELSE 'ok' END AS state
    FROM {source}"""


_KEYS = {
    "region": "r_regionkey",
    "nation": "n_nationkey",
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey, l_linenumber",
    "events": "event_id",
}


def _union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


def _completeness(name: str) -> str:
    return f"""
    SELECT '{name}' AS table_name, COUNT(*) AS row_count, COUNT(DISTINCT ({_KEYS[name]})) AS key_count,
           COUNT(*) = COUNT(DISTINCT ({_KEYS[name]})) AS ok FROM {name}"""


def _recent(days: str) -> str:
    return f"""
    SELECT metric_date, metric_name, dimension_key, metric_value FROM ({days}) d
    WHERE metric_date >= (SELECT MAX(metric_date) FROM ({days}) m) - INTERVAL 3 DAY"""


ORACLE: dict[str, str] = {
    "dedup_keep_earliest": _pick("ASC"),
    "latest_per_key": _pick("DESC"),
    "flatten_event_json": _FLAT,
    "payment_detail": """
        SELECT id, id AS order_id, user_id, 'card' AS payment_type, md5(CAST(id AS VARCHAR)) AS trade_no,
               payment_amount, payment_status,
               CAST(date_trunc('milliseconds', create_time) AS TIMESTAMP) AS create_time,
               CAST(date_trunc('milliseconds', create_time + INTERVAL 1500 MILLISECOND) AS TIMESTAMP) AS callback_time
        FROM (SELECT event_id AS id, user_id, CAST(value AS DECIMAL(16,2)) AS payment_amount, event_type AS payment_status,
                     ts AS create_time FROM events) p""",
    "refund_detail": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_suppkey AS user_id, l_orderkey AS order_id, l_partkey AS sku_id,
               CAST(l_extendedprice AS DECIMAL(16,2)) AS refund_amount, l_returnflag AS refund_status,
               l_shipdate AS create_time FROM lineitem""",
    "order_detail": f"""
        {_ROLES} SELECT order_id * 10 + l_linenumber AS id, order_id, sku_id,
               'sku ' || CAST(sku_id AS VARCHAR) AS sku_name, order_price, sku_num, create_time FROM line""",
    "copy_manifest_check": _union(
        *[f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, COUNT(*) AS expected, 0 AS bad_files, TRUE AS ok FROM {name}" for name in _KEYS]
    ),
    "late_rows_stream": """
        WITH batches AS (SELECT event_id % 3 AS batch_id, ts FROM events),
        latest AS (SELECT batch_id, MAX(ts) AS latest, COUNT(*) AS n_rows FROM batches GROUP BY batch_id),
        marks AS (SELECT batch_id, MAX(latest) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM latest)
        SELECT batch_id, n_rows, latest,
               COUNT(*) FILTER (date_trunc('minute', ts) + INTERVAL 1 MINUTE <= mark - INTERVAL 5 SECOND) AS late_rows
        FROM batches JOIN latest USING (batch_id) JOIN marks USING (batch_id) GROUP BY batch_id, n_rows, latest""",
    "publish_stream": f"""
        {_ROLES}, counted AS (
            SELECT dt, SUM(payment_amount) FILTER (WHERE user_id % 100 <> 0) AS a2, COUNT(DISTINCT id) FILTER (WHERE user_id % 100 <> 0) AS b2,
                   COUNT(DISTINCT user_id) FILTER (WHERE user_id % 100 <> 0) AS c2,
                   SUM(payment_amount) AS a1, COUNT(DISTINCT id) AS b1, COUNT(DISTINCT user_id) AS c1
            FROM (SELECT event_id AS id, user_id, CAST(value AS DECIMAL(16,2)) AS payment_amount, CAST(ts AS DATE) AS dt
                  FROM events WHERE event_type = 'purchase') e GROUP BY dt
        )
        SELECT dt AS metric_date, 'gmv' AS metric_name, 'ALL' AS dimension_key, {_metric('a2')} AS metric_value, a1 <> a2 AS rewritten FROM counted WHERE b2 > 0
        UNION ALL SELECT dt, 'payment_order_count', 'ALL', {_metric('b2')}, b1 <> b2 FROM counted WHERE b2 > 0
        UNION ALL SELECT dt, 'payment_user_count', 'ALL', {_metric('c2')}, c1 <> c2 FROM counted WHERE b2 > 0""",
    "upsert_partial_log": f"""
        WITH p AS ({_PAYMENT})
        SELECT id, CASE payment_status WHEN 'F' THEN 'F' ELSE 'PAID' END AS payment_status,
               CAST(payment_amount + CASE payment_status WHEN 'F' THEN 0 ELSE 1 END AS DECIMAL(16,2)) AS payment_amount,
               CASE payment_status WHEN 'F' THEN create_time WHEN 'O' THEN create_time + INTERVAL 1 DAY ELSE create_time + INTERVAL 2 DAY END AS create_time
        FROM p WHERE payment_status IN ('F', 'O', 'P')""",
    "published_cards": f"""
        WITH bought AS (
            SELECT user_id, event_id, CAST(value AS DECIMAL(16,2)) AS amount, CAST(ts AS DATE) AS dt FROM events WHERE event_type = 'purchase'
        ), days AS (
            SELECT dt AS metric_date, 'gmv' AS metric_name, {_metric('SUM(amount)')} AS metric_value FROM bought GROUP BY 1
            UNION ALL SELECT dt, 'payment_order_count', {_metric('COUNT(DISTINCT event_id)')} FROM bought GROUP BY 1
            UNION ALL SELECT dt, 'payment_user_count', {_metric('COUNT(DISTINCT user_id)')} FROM bought GROUP BY 1
            UNION ALL SELECT metric_date, metric_name, metric_value FROM ({_TRAFFIC_DAY}) t
        )
        SELECT metric_name, metric_date, CAST(metric_value AS DECIMAL(20,2)) AS metric_value FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY metric_name ORDER BY metric_date DESC) AS rn FROM days
        ) r WHERE rn = 1""",
    "sequence_gaps": """
        SELECT lost_from, lost_to, lost_to - lost_from + 1 AS lost FROM (
            SELECT coalesce(LAG(event_id) OVER (ORDER BY event_id), -1) + 1 AS lost_from, event_id - 1 AS lost_to
            FROM events WHERE event_type = 'purchase'
        ) g WHERE lost_to >= lost_from""",
    "uv_from_minutes": f"""
        SELECT CAST(ts AS DATE) AS metric_date, 'day_uv' AS metric_name, 'ALL' AS dimension_key,
               {_metric('COUNT(DISTINCT user_id)')} AS metric_value
        FROM events WHERE event_type = 'view' GROUP BY 1""",
    "flow_funnel_stages": f"""
        WITH days AS (
            SELECT CAST(ts AS DATE) AS dt, COUNT(DISTINCT user_id) FILTER (WHERE event_type = 'signup') AS a,
                   COUNT(DISTINCT user_id) FILTER (WHERE event_type = 'view') AS b,
                   COUNT(DISTINCT user_id) FILTER (WHERE event_type = 'click') AS c,
                   COUNT(DISTINCT user_id) FILTER (WHERE event_type = 'error') AS k,
                   COUNT(DISTINCT user_id) FILTER (WHERE event_type = 'purchase') AS o,
                   COUNT(DISTINCT user_id) FILTER (WHERE event_type = 'purchase' AND event_id % 2 = 0) AS p
            FROM events GROUP BY 1
        )
        SELECT dt, a AS launch_users, b AS browse_users, c AS click_users, k AS add_cart_users, o AS order_users, p AS pay_users,
               {_ratio('c', 'b', 4)} AS click_rate, {_ratio('k', 'c', 4)} AS add_cart_rate, {_ratio('o', 'k', 4)} AS order_rate,
               {_ratio('p', 'o', 4)} AS pay_rate
        FROM days""",
    "gmv_province_stream": f"{_ROLES} {_GMV_NATION}",
    "order_amount_category_stream": f"""
        SELECT CAST(l_shipdate AS DATE) AS metric_date, 'order_amount_category' AS metric_name, p_type AS dimension_key,
               {_metric("SUM(CAST(l_extendedprice AS DECIMAL(16,2)) * (CAST(l_quantity AS BIGINT) + CASE l_linenumber WHEN 1 THEN 1 ELSE 0 END))")} AS metric_value
        FROM ({_pick('ASC')}) line JOIN part ON p_partkey = l_partkey WHERE l_linenumber <> 6 GROUP BY 1, 3""",
    "payment_log_stream": f"""
        WITH p AS ({_PAYMENT})
        SELECT id, order_id, user_id, payment_type, md5(CAST(id AS VARCHAR)) AS trade_no, payment_amount,
               CASE payment_status WHEN 'P' THEN 'F' ELSE payment_status END AS payment_status,
               CASE payment_status WHEN 'P' THEN create_time + INTERVAL 1 DAY ELSE create_time END AS create_time,
               create_time + INTERVAL 1500 MILLISECOND AS callback_time
        FROM p WHERE NOT (payment_status = 'F' AND payment_type = '5-LOW')""",
    "refund_log_stream": f"""
        SELECT l_orderkey * 10 + l_linenumber AS id, l_suppkey AS user_id, l_orderkey AS order_id, l_partkey AS sku_id,
               CAST(l_extendedprice AS DECIMAL(16,2)) AS refund_amount, 'R' AS refund_status, l_shipdate AS create_time
        FROM ({_pick('ASC')}) line WHERE l_returnflag IN ('A', 'R')""",
    "order_log_stream": f"""
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id, 'sku ' || CAST(l_partkey AS VARCHAR) AS sku_name,
               CAST(CAST(l_extendedprice AS DECIMAL(16,2)) + CASE l_linenumber WHEN 6 THEN 1 ELSE 0 END AS DECIMAL(16,2)) AS order_price,
               CAST(CAST(l_quantity AS BIGINT) + CASE l_linenumber WHEN 1 THEN 1 ELSE 0 END AS BIGINT) AS sku_num, l_shipdate AS create_time
        FROM ({_pick('ASC')}) line""",
    "narrow_scan": """
        SELECT user_id AS uid, event_type AS action_id, strftime(ts, '%Y-%m-%d') AS biz_date,
               CAST(event_id AS VARCHAR) AS event_id FROM events""",
    "source_count": "SELECT COUNT(*) AS row_count FROM orders",
    "json_round_trip": f"""
        {_ROLES} SELECT 'u' AS op, id AS seq, id, order_id, user_id, payment_type, payment_amount, payment_status,
               create_time FROM payment""",
    "event_id_md5": f"""
        SELECT CAST(event_id AS VARCHAR) AS seq,
               md5(strftime(ts, '%Y-%m-%d') || '|' || CAST(event_id AS VARCHAR) || '|' || CAST(user_id AS VARCHAR)
                   || '|' || {_TEXT} || '|' || {_ACTION} || '|' || event_type || '|'
                   || CASE WHEN event_type IN ('signup', 'view') THEN 'None'
                           ELSE COALESCE(CAST({_ITEM} AS VARCHAR), 'None') END) AS event_id
        FROM events""",
    "normalize_event_time": """
        SELECT event_id, epoch_us(ts - INTERVAL 8 HOUR) // 1000 AS local_event_time_ms, CAST(ts AS DATE) AS local_biz_date,
               epoch_us(ts) // 1000 AS utc_event_time_ms, CAST(ts + INTERVAL 8 HOUR AS DATE) AS utc_biz_date
        FROM events""",
    "resequence_events": f"""
        SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice,
               ROW_NUMBER() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber) AS position
        FROM ({_pick('DESC')}) latest""",
    "traffic_day": _TRAFFIC_DAY,
    "traffic_minute_pv_uv": _TRAFFIC_MINUTE,
    "trade_day": f"{_ROLES} {_TRADE_DAY}",
    "trade_minute_gmv": f"{_ROLES} {_TRADE_MINUTE}",
    "gmv_by_nation": f"{_ROLES} {_GMV_NATION}",
    "order_amount_by_category": f"{_ROLES} {_AMOUNT_CATEGORY}",
    "traffic_minute_stream": _closed(_TRAFFIC_MINUTE, "events", "ts"),
    "trade_minute_stream": f"{_ROLES} {_closed(_TRADE_MINUTE, 'purchase', 'create_time')}",
    "ttl_dedup": _FLAT,
    "traffic_detail_stream": _FLAT,
    "traffic_minute_chain_stream": _closed(_TRAFFIC_MINUTE, "events", "ts"),
    "trade_minute_chain_stream": f"""
        WITH purchase AS (
            SELECT event_id AS id, CAST(value AS DECIMAL(16,2)) AS payment_amount, ts AS create_time
            FROM events WHERE event_type IN ('purchase', 'click')
        ) {_closed(_TRADE_MINUTE, 'events', 'ts')}""",
    "trade_day_stream": f"""
        WITH payment AS (
            SELECT event_id AS order_id, user_id, CAST(value AS DECIMAL(16,2)) AS payment_amount, 'F' AS payment_status,
                   CAST(CASE event_type WHEN 'click' THEN ts + INTERVAL 1 DAY ELSE ts END AS DATE) AS dt
            FROM events WHERE event_type IN ('purchase', 'click')
        ) {_payment_day('payment')}""",
    "default_dimension": f"""
        {_ROLES} SELECT dt AS metric_date, 'placed_orders' AS metric_name,
               CASE WHEN payment_type = '4-NOT SPECIFIED' THEN 'ALL' ELSE payment_type END AS dimension_key,
               {_metric('COUNT(*)')} AS metric_value FROM payment GROUP BY 1, 2, 3""",
    "apply_changes": f"""
        {_ROLES} SELECT id, order_id, user_id, payment_amount, payment_status, create_time FROM ({_CHANGED}) c""",
    "changed_payment_day": f"{_ROLES}, changed AS ({_CHANGED}) {_payment_day('changed')}",
    "upsert_partial_columns": f"""
        {_ROLES} SELECT id, CASE WHEN payment_status = 'F' THEN 'F' ELSE 'PAID' END AS payment_status,
               CAST(CASE WHEN payment_status = 'F' THEN payment_amount ELSE payment_amount + 1 END AS DECIMAL(16,2))
                   AS payment_amount,
               CASE WHEN payment_status = 'P' THEN create_time + INTERVAL 1 DAY ELSE create_time END AS create_time
        FROM payment""",
    "keyed_update": f"""
        {_ROLES} SELECT p.id, p.user_id,
               CASE WHEN r.order_id IS NULL THEN p.payment_status ELSE 'REFUNDED' END AS payment_status,
               COALESCE(r.operate_time, p.create_time) AS operate_time
        FROM payment p
        LEFT JOIN (SELECT order_id, MAX(create_time) AS operate_time FROM refund GROUP BY order_id) r
          ON p.id = r.order_id""",
    "publish_result": f"{_ROLES} {_TRADE_MINUTE}",
    "row_count_audit": _union(
        *[f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {name}" for name in _KEYS]
    ),
    "manifest_check": "SELECT table_name, row_count, key_count AS expected, ok FROM ("
    + _union(*[_completeness(name) for name in _KEYS])
    + ") c",
    "orphan_audit": _union(
        _orphans("order_without_user", "orders", "o_custkey", "customer", "c_custkey"),
        _orphans("user_without_province", "customer", "c_nationkey", "nation", "n_nationkey"),
        _orphans("detail_without_order", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        _orphans("detail_without_sku", "lineitem", "l_partkey", "part", "p_partkey"),
        _orphans("refund_without_order", "lineitem", "l_orderkey", "orders", "o_orderkey", "l_returnflag = 'R'"),
        _orphans(
            "detail_without_payment",
            "lineitem",
            "l_orderkey",
            "(SELECT * FROM orders WHERE o_orderstatus = 'F')",
            "o_orderkey",
        ),
    ),
    "status_distribution": f"""
        {_ROLES} SELECT payment_status AS order_status, COUNT(*) AS order_count,
               {_metric('SUM(payment_amount)')} AS total_amount FROM payment GROUP BY 1""",
    "paid_day_baseline": f"""
        {_ROLES} SELECT dt AS pay_date, COUNT(*) AS paid_order_count, {_metric('SUM(payment_amount)')} AS gmv
        FROM payment WHERE payment_status = 'F' GROUP BY dt""",
    "refund_day_baseline": f"""
        {_ROLES} SELECT dt AS refund_date, COUNT(*) AS refund_count,
               {_metric('SUM(refund_amount)')} AS refund_amount FROM refund GROUP BY dt""",
    "watermark_range": _union(
        "SELECT 'orders' AS table_name, MIN(o_orderdate) AS min_time, MAX(o_orderdate) AS max_time FROM orders",
        "SELECT 'lineitem', MIN(l_shipdate), MAX(l_shipdate) FROM lineitem",
        "SELECT 'events', MIN(ts), MAX(ts) FROM events",
    ),
    "empty_source_sentinel": _union(
        _sentinel("orders", "orders", "o_orderkey"),
        _sentinel("cancelled_orders", "orders WHERE o_orderstatus = 'C'", "o_orderkey"),
        _sentinel("lineitem", "lineitem", "l_linenumber"),
        _sentinel("events", "events", "event_id"),
    ),
    "join_hit_counts": _union(
        _hits("user_hit_province", "customer", "c_nationkey", "nation", "n_nationkey"),
        _hits("detail_hit_sku", "lineitem", "l_partkey", "part", "p_partkey"),
        _hits("sku_hit_category", "part", "p_type", "(SELECT DISTINCT p_type AS id FROM part)", "id"),
        _hits("payment_hit_user", "orders", "o_custkey", "customer", "c_custkey"),
        _hits("order_hit_detail", "orders", "o_orderkey", "lineitem", "l_orderkey"),
    ),
    "rollup_equality": f"""
        {_ROLES}, parts AS (
            SELECT metric_date, metric_name, SUM(metric_value) AS parts
            FROM ({_GMV_NATION} UNION ALL {_AMOUNT_CATEGORY}) b GROUP BY 1, 2
        ), anchors AS (
            SELECT metric_date,
                   CASE metric_name WHEN 'gmv' THEN 'gmv_province' ELSE 'order_amount_category' END AS metric_name,
                   metric_value AS anchor
            FROM ({_payment_day('payment')} UNION ALL {_ORDER_DAY}) a WHERE metric_name IN ('gmv', 'order_gmv')
        )
        SELECT metric_date, metric_name, {_metric('parts')} AS parts, {_metric('anchor')} AS anchor,
               parts IS NOT DISTINCT FROM anchor AS ok
        FROM parts FULL JOIN anchors USING (metric_date, metric_name)""",
    "minute_vs_day_gap": f"""
        WITH days AS ({_TRAFFIC_DAY}), closed AS ({_closed(_TRAFFIC_MINUTE, 'events', 'ts')}), sums AS (
            SELECT metric_date, SUM(metric_value) AS s FROM closed WHERE metric_name = 'browse_pv' GROUP BY 1
        )
        SELECT d.metric_date, {_metric('COALESCE(s, 0)')} AS minute_sum, metric_value AS day_value,
               {_metric('metric_value - COALESCE(s, 0)')} AS tail_gap
        FROM days d LEFT JOIN sums ON d.metric_date = sums.metric_date WHERE metric_name = 'browse_pv'""",
    "uv_le_pv": f"""
        WITH w AS (
            SELECT metric_date, window_start, MAX(metric_value) FILTER (WHERE metric_name = 'browse_pv') AS pv,
                   MAX(metric_value) FILTER (WHERE metric_name = 'browse_uv') AS uv
            FROM ({_TRAFFIC_MINUTE}) m GROUP BY 1, 2
        )
        SELECT metric_date, COUNT(*) AS windows, {_metric('SUM(pv)')} AS pv_sum, {_metric('SUM(uv)')} AS uv_sum,
               COUNT(*) FILTER (WHERE uv > pv) AS violations
        FROM w GROUP BY 1""",
    "recon_batch_stream": f"""
        WITH batch AS ({_TRAFFIC_MINUTE}), streamed AS ({_closed(_TRAFFIC_MINUTE, 'events', 'ts')})
        SELECT b.metric_date, b.window_start, b.metric_name, b.dimension_key, b.metric_value AS left_value,
               s.metric_value AS right_value, 'extra' AS status
        FROM batch b LEFT JOIN streamed s
          ON b.metric_date = s.metric_date AND b.window_start = s.window_start AND b.metric_name = s.metric_name
        WHERE s.metric_name IS NULL""",
    "monotone_time_check": _union(
        _order_check("events", "event_id", "ts"), _order_check("orders", "o_orderkey", "o_orderdate")
    ),
    "key_completeness": _union(*[_completeness(name) for name in ("events", "orders", "lineitem")]),
    "replay_hash": f"""
        {_ROLES}, hashed AS (
            SELECT md5(concat_ws(chr(31), CAST(id AS VARCHAR), CAST(order_id AS VARCHAR), CAST(user_id AS VARCHAR),
                   CAST(payment_amount AS VARCHAR), payment_status,
                   CAST(CAST(create_time AS TIMESTAMP) AS VARCHAR))) AS digest
            FROM payment
        )
        SELECT run, COUNT(*) AS row_count,
               CAST(SUM(CAST('0x' || substr(digest, 1, 16) AS UBIGINT)) AS DECIMAL(38,0)) AS content_hash,
               CAST(SUM(CAST('0x' || substr(digest, 17, 16) AS UBIGINT)) AS DECIMAL(38,0)) AS content_hash_low
        FROM hashed, (VALUES (1), (2)) runs(run) GROUP BY run""",
    "gmv_day": f"""
        {_ROLES}, days AS (
            SELECT dt, SUM(payment_amount) AS gmv, COUNT(DISTINCT order_id) AS n, COUNT(DISTINCT user_id) AS u
            FROM payment WHERE payment_status = 'F' GROUP BY dt
        )
        SELECT dt, CAST(gmv AS DECIMAL(16,2)) AS gmv_amount, n AS payment_order_count, u AS payment_user_count,
               {_ratio('gmv', 'n', 2)} AS avg_payment_amount
        FROM days""",
    "trade_refund": f"""
        {_ROLES}, g AS (SELECT dt, SUM(payment_amount) AS gmv FROM payment WHERE payment_status = 'F' GROUP BY dt),
        r AS (SELECT dt, SUM(refund_amount) AS back FROM refund GROUP BY dt), days AS (
            SELECT dt, COALESCE(gmv, 0) AS gmv, COALESCE(back, 0) AS back FROM g FULL JOIN r USING (dt)
        )
        SELECT dt, CAST(gmv AS DECIMAL(16,2)) AS gmv_amount, CAST(back AS DECIMAL(16,2)) AS refund_amount,
               {_ratio('back', 'gmv', 4)} AS refund_rate
        FROM days""",
    "sku_topn": f"""
        {_ROLES}, sold AS (
            SELECT dt, sku_id, COUNT(DISTINCT order_id) AS order_count, SUM(sku_num) AS qty, SUM(amount) AS amount
            FROM line GROUP BY dt, sku_id
        ), ranked AS (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY dt ORDER BY amount DESC, sku_id) AS sku_rank FROM sold
        ), back AS (SELECT dt, sku_id, SUM(refund_amount) AS refund FROM refund GROUP BY dt, sku_id)
        SELECT k.dt, sku_rank, k.sku_id, p_name AS sku_name, p_type AS category_id, p_type AS category_name,
               order_count, {_count('qty')} AS order_sku_num, CAST(amount AS DECIMAL(16,2)) AS order_amount,
               CAST(COALESCE(refund, 0) AS DECIMAL(16,2)) AS refund_amount
        FROM ranked k LEFT JOIN part ON k.sku_id = p_partkey LEFT JOIN back b ON k.dt = b.dt AND k.sku_id = b.sku_id
        WHERE sku_rank <= 10""",
    "area_stats": f"""
        {_ROLES}, spent AS (
            SELECT dt, c_nationkey AS nk, COUNT(DISTINCT user_id) AS users, SUM(payment_amount) AS paid
            FROM payment JOIN customer ON user_id = c_custkey WHERE payment_status = 'F' GROUP BY 1, 2
        ), back AS (
            SELECT r.dt, c_nationkey AS nk, SUM(refund_amount) AS refund
            FROM refund r JOIN orders ON order_id = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
        ), areas AS (
            SELECT dt, nk, COALESCE(users, 0) AS users, COALESCE(paid, 0) AS paid, COALESCE(refund, 0) AS refund
            FROM spent FULL JOIN back USING (dt, nk)
        )
        SELECT dt, CAST(nk AS BIGINT) AS province_id, n_name AS province_name, {_count('users')} AS payment_user_count,
               CAST(paid AS DECIMAL(16,2)) AS payment_amount, CAST(refund AS DECIMAL(16,2)) AS refund_amount,
               {_ratio('refund', 'paid', 4)} AS refund_rate
        FROM areas JOIN nation ON nk = n_nationkey""",
    "user_stats": f"""
        {_ROLES}, per_user AS (
            SELECT dt, user_id, COUNT(DISTINCT order_id) AS orders, SUM(payment_amount) AS paid
            FROM payment WHERE payment_status = 'F' GROUP BY 1, 2
        ), spent AS (
            SELECT dt, COUNT(*) AS users, COUNT(*) FILTER (WHERE orders >= 2) AS repeats, SUM(paid) AS paid
            FROM per_user GROUP BY 1
        ), back AS (SELECT dt, SUM(refund_amount) AS refund FROM refund GROUP BY 1), days AS (
            SELECT dt, COALESCE(users, 0) AS users, COALESCE(repeats, 0) AS repeats, COALESCE(paid, 0) AS paid,
                   COALESCE(refund, 0) AS refund
            FROM spent FULL JOIN back USING (dt)
        )
        SELECT dt, {_count('users')} AS payment_user_count, {_count('repeats')} AS repeat_payment_user_count,
               {_ratio('repeats', 'users', 4)} AS repeat_payment_rate, CAST(paid AS DECIMAL(16,2)) AS payment_amount,
               CAST(refund AS DECIMAL(16,2)) AS refund_amount
        FROM days""",
    "flow_funnel": f"""
        WITH days AS (
            SELECT CAST(ts AS DATE) AS dt, COUNT(DISTINCT user_id) FILTER (WHERE event_type = 'signup') AS a,
                   COUNT(DISTINCT user_id) FILTER (WHERE event_type = 'view') AS b,
                   COUNT(DISTINCT user_id) FILTER (WHERE event_type = 'click') AS c,
                   COUNT(DISTINCT user_id) FILTER (WHERE event_type = 'purchase') AS p
            FROM events GROUP BY 1
        )
        SELECT dt, a AS launch_users, b AS browse_users, c AS click_users, p AS pay_users,
               {_ratio('c', 'b', 4)} AS click_rate, {_ratio('p', 'c', 4)} AS pay_rate
        FROM days""",
    "user_retention": f"""
        WITH active AS (SELECT DISTINCT CAST(ts AS DATE) AS dt, user_id FROM events),
        starts AS (SELECT dt, COUNT(*) AS users FROM active GROUP BY dt),
        steps AS (SELECT CAST(unnest(generate_series(1, 7)) AS INTEGER) AS n),
        kept AS (
            SELECT a.dt, CAST(b.dt - a.dt AS INTEGER) AS n, COUNT(*) AS retained
            FROM active a JOIN active b ON a.user_id = b.user_id AND b.dt > a.dt AND b.dt <= a.dt + 7 GROUP BY 1, 2
        )
        SELECT s.dt AS start_dt, users AS start_users, CAST(s.dt + t.n AS DATE) AS retention_dt,
               CAST(t.n AS BIGINT) AS retention_n, COALESCE(retained, 0) AS retained_users,
               {_ratio('COALESCE(retained, 0)', 'users', 4)} AS retention_rate
        FROM starts s JOIN steps t ON s.dt + t.n <= (SELECT MAX(dt) FROM active)
        LEFT JOIN kept k ON k.dt = s.dt AND k.n = t.n""",
    "latest_cards": f"""
        {_ROLES}, days AS ({_TRADE_DAY} UNION ALL {_TRAFFIC_DAY})
        SELECT metric_name, metric_date, CAST(metric_value AS DECIMAL(20,2)) AS metric_value FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY metric_name ORDER BY metric_date DESC) AS rn FROM days
        ) r WHERE rn = 1 AND metric_name IN ('gmv', 'payment_order_count', 'payment_user_count', 'browse_pv', 'day_uv')""",
    "refund_total": f"""
        {_ROLES} SELECT CAST(SUM(metric_value) AS DECIMAL(20,2)) AS refunds FROM ({_REFUND_DAY}) r""",
    "minute_series_utc": f"""
        {_ROLES}, minutes AS ({_TRAFFIC_MINUTE} UNION ALL {_TRADE_MINUTE})
        SELECT window_start - INTERVAL 8 HOUR AS time,
               CAST(MAX(metric_value) FILTER (WHERE metric_name = 'browse_pv') AS DOUBLE) AS browse_pv,
               CAST(MAX(metric_value) FILTER (WHERE metric_name = 'browse_uv') AS DOUBLE) AS browse_uv,
               CAST(MAX(metric_value) FILTER (WHERE metric_name = 'gmv') AS DOUBLE) AS gmv
        FROM minutes WHERE metric_name IN ('browse_pv', 'browse_uv', 'gmv') GROUP BY 1 ORDER BY 1""",
    "minute_series_range": f"""
        {_ROLES}, minutes AS ({_TRAFFIC_MINUTE} UNION ALL {_TRADE_MINUTE})
        SELECT window_start - INTERVAL 8 HOUR AS time,
               CAST(MAX(metric_value) FILTER (WHERE metric_name = 'browse_pv') AS DOUBLE) AS browse_pv,
               CAST(MAX(metric_value) FILTER (WHERE metric_name = 'browse_uv') AS DOUBLE) AS browse_uv,
               CAST(MAX(metric_value) FILTER (WHERE metric_name = 'gmv') AS DOUBLE) AS gmv
        FROM minutes
        WHERE metric_name IN ('browse_pv', 'browse_uv', 'gmv')
          AND window_start BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 12:30:00'
        GROUP BY 1 ORDER BY 1""",
    "detail_last_3_days": f"""
        {_ROLES} {_recent(_union(_TRADE_DAY, _GMV_NATION, _AMOUNT_CATEGORY))} UNION ALL {_recent(_TRAFFIC_DAY)}
        ORDER BY metric_date DESC, metric_name, dimension_key""",
    "province_breakdown": f"""
        {_ROLES} SELECT p.dt AS metric_date, n_name AS dimension_key, {_metric('SUM(payment_amount)')} AS metric_value,
               COUNT(DISTINCT order_id) AS pay_orders
        FROM payment p JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
        WHERE payment_status = 'F' GROUP BY p.dt, n_name ORDER BY 3 DESC, 1, 2""",
    "category_breakdown": f"""
        {_ROLES} SELECT l.dt AS metric_date, p_type AS dimension_key, {_metric('SUM(amount)')} AS metric_value,
               COUNT(*) AS detail_rows
        FROM line l JOIN part ON sku_id = p_partkey GROUP BY l.dt, p_type ORDER BY 3 DESC, 1, 2""",
}

ORACLE["stored_replay_hash"] = ORACLE["replay_hash"]
ORACLE["ordered_replay_stream"] = ORACLE["trade_minute_stream"]
ORACLE["watermark_dedup_stream"] = ORACLE["ttl_dedup"]
