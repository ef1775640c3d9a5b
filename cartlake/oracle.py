"""DuckDB SQL with the expected result of each registered query."""

from __future__ import annotations

from cartlake.catalogue import AS_OF, RUN_ID
from cartlake.config import GOLD_MODELS, SILVER_MODELS
from cartlake.plans.declared_checks import CHECKS
from cartlake.plans.medallion import BUILD_JOB

_EVENTS = """
line AS (
    SELECT l_orderkey, l_linenumber, max(l_partkey) AS pk, max(l_suppkey) AS sk,
           max(l_extendedprice) AS price, max(l_tax) AS tax, max(l_shipdate) AS shipped
    FROM lineitem GROUP BY l_orderkey, l_linenumber
),
items AS (
    SELECT l_orderkey, max(shipped) AS sh,
           '[' || string_agg(
               replace('{~product_id~: ~' || pk || '~, ~product_category_name~: '
               || CASE WHEN pk % 10 = 0 THEN 'null' ELSE '~' || p_type || '~' END
               || ', ~price~: ' || CASE WHEN l_orderkey % 97 = 0 THEN '0.0' ELSE CAST(price AS VARCHAR) END
               || ', ~freight_value~: ' || CAST(round(tax * 100) AS INTEGER) || '.25'
               || ', ~seller_id~: ~' || sk || '~, ~seller_city~: ~' || n_name
               || '~, ~seller_state~: ~n' || s_nationkey || '~, ~seller_zip_code~: ~'
               || lpad(CAST(sk AS VARCHAR), 5, '0') || '~, ~seller_latitude~: -' || s_nationkey
               || '.5, ~seller_longitude~: ' || s_nationkey || '.25'
               || CASE WHEN pk % 9 = 0 THEN '' ELSE ', ~product_weight_g~: ' || p_size END
               || '}', '~', chr(39)), ', ' ORDER BY l_linenumber) || ']' AS items
    FROM line
    JOIN part ON p_partkey = pk
    JOIN supplier ON s_suppkey = sk
    JOIN nation ON n_nationkey = s_nationkey
    GROUP BY l_orderkey
),
told AS (
    SELECT o_orderkey AS k, o_custkey AS u, o_orderstatus AS os, o_totalprice AS total,
           o_orderdate AS od, f.items, f.sh,
           's' || o_orderkey AS session_id,
           CASE o_orderkey % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' WHEN 2 THEN 'tablet' END
               AS metadata_device,
           CASE o_orderkey % 3 WHEN 0 THEN 'android' WHEN 1 THEN 'ios' END AS metadata_os,
           'cu' || o_orderkey AS customer_id,
           CASE WHEN o_custkey % 30 <> 0 THEN ' ' || cx.n_name || ' ' END AS customer_city,
           CASE WHEN o_custkey % 35 <> 0 THEN ' n' || c_nationkey END AS customer_state,
           CASE WHEN o_orderkey % 40 <> 0
               THEN lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') END AS customer_zip_code,
           CASE WHEN o_custkey % 25 <> 0 THEN '-' || c_nationkey || '.5' END AS customer_latitude,
           CASE WHEN o_custkey % 25 <> 0 THEN c_nationkey || '.75' END AS customer_longitude,
           CAST(o_orderdate + INTERVAL 60 DAY AS VARCHAR) AS estimated_delivery_date
    FROM orders
    LEFT JOIN items f ON l_orderkey = o_orderkey
    JOIN customer ON c_custkey = o_custkey
    JOIN nation cx ON cx.n_nationkey = c_nationkey
),
told_events AS (
    SELECT told.*, 'c' || k AS event_id, 'order.created' AS event_type, od AS moment,
           CAST(u AS VARCHAR) AS user_id, 'created' AS order_status,
           coalesce(items, '[]') AS payload_items,
           CAST(NULL AS VARCHAR) AS payload_payments, CAST(NULL AS VARCHAR) AS payload_review,
           CAST(NULL AS VARCHAR) AS actual_delivery_date
    FROM told
    UNION ALL
    SELECT told.*, 'p' || k, 'payment.processed', od + INTERVAL 1 HOUR, CAST(u AS VARCHAR),
           'approved', NULL,
           replace('[{~payment_type~: ~' || CASE k % 4 WHEN 0 THEN ' Credit_Card '
               WHEN 1 THEN ' boleto ' WHEN 2 THEN ' debit_card ' ELSE ' pix ' END
               || '~, ~payment_installments~: ' || (k % 10 + 1) || ', ~payment_value~: '
               || CASE WHEN k % 13 = 0 THEN '0.0' ELSE CAST(total AS VARCHAR) END
               || '}' || CASE WHEN k % 6 = 0 THEN ', {~payment_type~: ~ Gift_Card~, ~payment_value~: 5.5}' ELSE '' END
               || ']', '~', chr(39)), NULL, NULL
    FROM told WHERE k % 11 <> 0
    UNION ALL
    SELECT told.*, 'q' || k, 'payment.processed', od + INTERVAL 2 HOUR, CAST(u AS VARCHAR),
           'approved', NULL,
           replace('[{~payment_type~: ~voucher~, ~payment_value~: 10.5}]', '~', chr(39)), NULL, NULL
    FROM told WHERE k % 5 = 0
    UNION ALL
    SELECT told.*, 'd' || k, 'order.delivered', sh,
           CASE WHEN k % 50 = 7 THEN '' ELSE CAST(u AS VARCHAR) END,
           CASE WHEN k % 17 = 0 THEN '' ELSE ' Delivered ' END, NULL, NULL, NULL,
           CASE WHEN os = 'P' THEN '' ELSE CAST(sh AS VARCHAR) END
    FROM told WHERE sh IS NOT NULL
    UNION ALL
    SELECT told.*, 'r' || k, 'order.reviewed', sh + INTERVAL 1 DAY, CAST(u AS VARCHAR), NULL,
           NULL, NULL,
           replace('{~review_id~: ~rv' || k || '~, ~review_score~: ' || (k % 7)
               || ', ~review_comment_title~: ~ t' || k || ' ~, ~review_comment_message~: '
               || CASE WHEN k % 21 = 0 THEN '~it~s late~' WHEN k % 2 = 0 THEN 'null'
                  ELSE '~ok ~' END || '}', '~', chr(39)), NULL
    FROM told WHERE sh IS NOT NULL AND k % 3 = 0
),
raw AS (
    SELECT event_id, event_type,
           replace(CAST(moment AS VARCHAR), ' ', 'T') || '+00:00' AS timestamp,
           user_id, session_id, CAST(k AS VARCHAR) AS order_id, order_status, payload_items,
           payload_payments, payload_review, metadata_device, metadata_os, customer_id,
           customer_city, customer_state, customer_zip_code, customer_latitude,
           customer_longitude, estimated_delivery_date, actual_delivery_date, moment
    FROM told_events
)"""


def _json(column: str, path: str, key: str) -> str:
    return f"json_extract_string({column}, '{path}.{key}')"


def _item(key: str) -> str:
    return _json("j", "$[0]", key)


def _valid(payload: str) -> str:
    fixed = f"replace({payload}, chr(39), chr(34))"
    return f"CASE WHEN json_valid({fixed}) THEN {fixed} END AS j"


_SILVER = {
    "stg_customers": """
    SELECT user_id, customer_id, coalesce(trim(customer_city), 'unknown') AS customer_city,
           coalesce(upper(trim(customer_state)), 'un') AS customer_state,
           coalesce(customer_zip_code, '00000') AS customer_zip_code,
           coalesce(CAST(customer_latitude AS DOUBLE), 0) AS customer_latitude,
           coalesce(CAST(customer_longitude AS DOUBLE), 0) AS customer_longitude
    FROM raw
    WHERE length(user_id) > 0 AND length(customer_id) > 0
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY timestamp DESC, event_id DESC) = 1""",
    "stg_order_items": f"""
    SELECT *, round(product_price + freight_value, 2) AS total_item_cost
    FROM (
        SELECT order_id, user_id, {_item('product_id')} AS product_id,
               coalesce({_item('product_category_name')}, 'unassigned') AS product_category_name,
               CAST({_item('price')} AS DOUBLE) AS product_price,
               CAST({_item('freight_value')} AS DOUBLE) AS freight_value,
               {_item('seller_id')} AS seller_id, {_item('seller_city')} AS seller_city,
               upper({_item('seller_state')}) AS seller_state,
               CAST({_item('seller_latitude')} AS DOUBLE) AS seller_latitude,
               CAST({_item('seller_longitude')} AS DOUBLE) AS seller_longitude,
               {_item('seller_zip_code')} AS seller_zip_code,
               coalesce(CAST({_item('product_weight_g')} AS DOUBLE), 0) AS product_weight_g,
               moment AS created_at
        FROM (SELECT *, {_valid('payload_items')} FROM raw WHERE event_type = 'order.created')
    ) WHERE product_price > 0 AND freight_value >= 0""",
    "stg_order_payments": f"""
    SELECT * FROM (
        SELECT order_id,
               coalesce(lower(trim({_item('payment_type')})), 'not_defined') AS payment_type,
               coalesce(CAST({_item('payment_installments')} AS INTEGER), 1)
                   AS payment_installments,
               CAST({_item('payment_value')} AS DOUBLE) AS payment_value, moment AS approved_at
        FROM (SELECT *, {_valid('payload_payments')} FROM raw
              WHERE event_type = 'payment.processed')
    ) WHERE payment_value > 0""",
    "stg_order_reviews": f"""
    SELECT * FROM (
        SELECT order_id, {_json('j', '$', 'review_id')} AS review_id,
               CAST({_json('j', '$', 'review_score')} AS INTEGER) AS review_score,
               trim({_json('j', '$', 'review_comment_title')}) AS review_comment_title,
               trim({_json('j', '$', 'review_comment_message')}) AS review_comment_message,
               moment AS reviewed_at
        FROM (SELECT *, {_valid('payload_review')} FROM raw WHERE event_type = 'order.reviewed')
    ) WHERE review_score IN (1, 2, 3, 4, 5)""",
    "stg_order_status_history": """
    SELECT order_id, lower(trim(order_status)) AS order_status, event_type,
           coalesce(metadata_device, 'unknown') AS metadata_device,
           coalesce(metadata_os, 'unknown') AS metadata_os, moment AS status_updated_at,
           CAST(TRY_CAST(estimated_delivery_date AS TIMESTAMP) AS DATE) AS estimated_delivery_date,
           TRY_CAST(actual_delivery_date AS TIMESTAMP) AS actual_delivery_date
    FROM raw WHERE length(order_id) > 0 AND length(order_status) > 0""",
}



def _entries(payload: str, event_type: str, fields: str, body: str) -> str:
    """`body` over one row per entry of a payload array, `i` being its place."""
    return f"""
    SELECT {body}
    FROM (SELECT *, json_extract(j, '$[' || i || ']') AS e FROM (
        SELECT *, unnest(range(CAST(json_array_length(j) AS BIGINT))) AS i
        FROM (SELECT *, {_valid(payload)} FROM raw WHERE event_type = '{event_type}')))
    WHERE {fields}"""


def _field(key: str) -> str:
    return _json("e", "$", key)


_SILVER_LINES = {
    "order_lines": _entries(
        "payload_items", "order.created",
        f"CAST({_field('price')} AS DOUBLE) > 0 AND CAST({_field('freight_value')} AS DOUBLE) >= 0",
        f"""order_id, CAST(i AS INTEGER) AS line, user_id, {_field('product_id')} AS product_id,
               coalesce({_field('product_category_name')}, 'unassigned') AS product_category_name,
               CAST({_field('price')} AS DOUBLE) AS product_price,
               CAST({_field('freight_value')} AS DOUBLE) AS freight_value,
               {_field('seller_id')} AS seller_id, {_field('seller_city')} AS seller_city,
               upper({_field('seller_state')}) AS seller_state,
               CAST({_field('seller_latitude')} AS DOUBLE) AS seller_latitude,
               CAST({_field('seller_longitude')} AS DOUBLE) AS seller_longitude,
               {_field('seller_zip_code')} AS seller_zip_code,
               coalesce(CAST({_field('product_weight_g')} AS DOUBLE), 0) AS product_weight_g,
               moment AS created_at,
               round(CAST({_field('price')} AS DOUBLE) + CAST({_field('freight_value')} AS DOUBLE), 2) AS total_item_cost""",
    ),
    "payment_entries": _entries(
        "payload_payments", "payment.processed", f"CAST({_field('payment_value')} AS DOUBLE) > 0",
        f"""order_id, event_id, CAST(i AS INTEGER) AS entry,
               coalesce(lower(trim({_field('payment_type')})), 'not_defined') AS payment_type,
               coalesce(CAST({_field('payment_installments')} AS INTEGER), 1) AS payment_installments,
               CAST({_field('payment_value')} AS DOUBLE) AS payment_value, moment AS approved_at""",
    ),
}

_GOLD = {
    "payments_agg": """
    SELECT order_id, max(payment_type) AS payment_type, sum(payment_value) AS total_payment_value,
           max(payment_installments) AS payment_installments
    FROM stg_order_payments GROUP BY ALL""",
    "delivery_dates": """
    SELECT order_id, max(status_updated_at) AS latest_update,
           max(estimated_delivery_date) AS estimated_delivery_date,
           max(actual_delivery_date) AS actual_delivery_date
    FROM stg_order_status_history GROUP BY ALL""",
    "dim_categories": """
    SELECT upper(md5(category_name)) AS category_key, category_name
    FROM (SELECT product_category_name AS category_name FROM stg_order_items GROUP BY 1)
    WHERE category_name IS NOT NULL""",
    "dim_customers": """
    SELECT customer_id, user_id AS customer_unique_id, customer_zip_code AS zip_code
    FROM stg_customers""",
    "dim_geography": """
    SELECT customer_zip_code AS zip_code, customer_city AS city, customer_state AS state,
           customer_latitude AS latitude, customer_longitude AS longitude
    FROM stg_customers GROUP BY ALL""",
    "dim_order_attributes": """
    SELECT order_id, order_status, metadata_device AS purchase_device,
           metadata_os AS purchase_os
    FROM stg_order_status_history GROUP BY ALL""",
    "dim_products": """
    SELECT product_id, upper(md5(product_category_name)) AS category_key, product_weight_g
    FROM (SELECT product_id, product_category_name, product_weight_g
          FROM stg_order_items GROUP BY ALL)""",
    "dim_reviews": """
    SELECT review_id, order_id, review_score, review_comment_title, review_comment_message,
           reviewed_at
    FROM stg_order_reviews""",
    "dim_sellers": """
    SELECT seller_id, seller_zip_code AS zip_code FROM stg_order_items GROUP BY ALL""",
    "fct_orders": """
    SELECT order_id, user_id AS customer_unique_key, product_id, seller_id,
           1 AS order_item_quantity, product_price AS item_merchandise_revenue,
           freight_value AS item_logistic_cost, total_item_cost AS gross_amount,
           ifnull(total_payment_value, 0) AS cash_flow_received,
           ifnull(payment_installments, 1) AS financing_installments,
           estimated_delivery_date, actual_delivery_date,
           CASE WHEN actual_delivery_date IS NOT NULL
               THEN CAST(ifnull(actual_delivery_date > estimated_delivery_date, false) AS INTEGER)
           END AS count_delayed_order,
           created_at AS order_timestamp
    FROM stg_order_items LEFT JOIN payments_agg USING (order_id)
    LEFT JOIN delivery_dates USING (order_id)""",
}

_MODELS = {**_SILVER, **_GOLD}
_RAW_COLUMNS = "* EXCLUDE (moment)"


def _failures(check) -> str:
    table, column = check.model, check.column
    if check.kind == "not_null":
        count = f"SELECT count(*) FROM {table} WHERE {column} IS NULL"
    elif check.kind == "unique":
        count = (
            f"SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
            f"GROUP BY 1 HAVING count(*) > 1)"
        )
    elif check.kind == "accepted_values":
        values = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in check.argument)
        count = f"SELECT count(DISTINCT {column}) FROM {table} WHERE {column} NOT IN ({values})"
    elif check.kind == "expression_is_true":
        count = f"SELECT count(*) FROM {table} WHERE NOT ({column} {check.argument})"
    else:
        parent, key = check.argument
        count = (
            f"SELECT count(*) FROM {table} c WHERE c.{column} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column})"
        )
    test = f"{check.kind}_{table}_{column}" if check.kind == "expression_is_true" else check.kind
    layer = "silver" if table.startswith("stg_") else "gold"
    bad = "warn" if check.severity == "warn" else "fail"
    return f"""
    SELECT '{RUN_ID}' AS run_id, '{layer}' AS layer, '{table}' AS model_name,
           '{column}' AS column_name, '{test}' AS test_name, '{check.severity}' AS severity,
           CASE WHEN n = 0 THEN 'pass' ELSE '{bad}' END AS status,
           CAST(n AS BIGINT) AS failure_count,
           CASE WHEN n > 0 THEN 'Got ' || n || CASE WHEN n = 1 THEN ' result' ELSE ' results' END
               || ', configured to {bad} if != 0' END AS error_detail
    FROM (SELECT ({count}) AS n)"""


def _checks(kind: str | None = None) -> str:
    return " UNION ALL ".join(_failures(c) for c in CHECKS if kind in (None, c.kind))


def _with(body: str, **extra: str) -> str:
    """Query over the events and all models; unused parts are never evaluated."""
    parts = [_EVENTS.strip()]
    parts += [f"{name} AS ({sql})" for name, sql in {**_MODELS, **extra}.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


_COUNTS = " UNION ALL ".join(
    f"SELECT '{m}' AS table_name, count(*) AS record_count FROM {m}"
    for m in (*SILVER_MODELS, *GOLD_MODELS)
)
_HISTORY = f"""
    SELECT table_name, record_count * (100 - back * (length(table_name) % 8)) // 100 AS record_count,
           TIMESTAMP '{AS_OF}' - back * INTERVAL 1 DAY AS snapshot_hour
    FROM counts, range(1, 11) AS days(back)
    WHERE table_name <> 'dim_sellers'"""
_MEANS = f"""
    SELECT table_name, avg(record_count) AS mean_count FROM history
    WHERE snapshot_hour >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY ALL"""
_CHANGES = """
    SELECT counts.table_name, record_count, mean_count,
           CASE WHEN mean_count <> 0
               THEN round((record_count - mean_count) / mean_count * 100, 2) END AS change
    FROM counts LEFT JOIN means USING (table_name)"""
_VOLUME = {"counts": _COUNTS, "history": _HISTORY, "means": _MEANS, "changes": _CHANGES}
_AGE = f"round(epoch(TIMESTAMP '{AS_OF}' - max(moment)) / 60, 2)"
_FRESH = f"""
    SELECT max(moment) AS max_event_time, {_AGE} AS age,
           CASE WHEN {_AGE} <= 60 THEN 'fresh' WHEN {_AGE} <= 120 THEN 'stale'
                ELSE 'critical' END AS status
    FROM raw"""


def _losses() -> str:
    kinds = {
        "order.created": ("payload_items", "stg_order_items"),
        "payment.processed": ("payload_payments", "stg_order_payments"),
        "order.reviewed": ("payload_review", "stg_order_reviews"),
    }
    return " UNION ALL ".join(
        f"""SELECT '{event}' AS event_type, events, kept_rows, events - kept_rows AS dropped_rows
        FROM (SELECT (SELECT count(*) FROM raw WHERE event_type = '{event}'
                      AND {payload} IS NOT NULL) AS events,
                     (SELECT count(*) FROM {model}) AS kept_rows)"""
        for event, (payload, model) in kinds.items()
    )


_RAW = _with(f"SELECT {_RAW_COLUMNS} FROM raw")
# JSON lines carry the payment entries as nested values; they come back as compact text.
_LINES = _with(
    """SELECT * EXCLUDE (moment) REPLACE (
        replace(replace(replace(payload_payments, chr(39), chr(34)), ': ', ':'), ', ', ',')
            AS payload_payments)
    FROM raw"""
)



def _rejected(cases: str, skipped: str) -> str:
    """Rejects of records that `cases` breaks, with the counts of the rest; `skipped` counts as neither."""
    return f"""
    SELECT text, reason, kept, rejected
    FROM (SELECT {cases.format(what=0)} AS text, {cases.format(what=1)} AS reason, k FROM told_events) r,
         (SELECT count(*) FILTER ({cases.format(what=1)} IS NULL AND NOT ({skipped})) AS kept,
                 count({cases.format(what=1)}) AS rejected FROM told_events)
    WHERE reason IS NOT NULL"""


def _case(breaks: dict[int, tuple[str, str]]) -> str:
    whens = " ".join(f"WHEN k % {n} = 0 THEN ([{text}, {reason}])[{{what}} + 1]" for n, (text, reason) in breaks.items())
    return f"CASE {whens} END"


_HEADER = "'\\x00\\x00\\x00\\x00\\x01'::BLOB"
_BROKEN_LINES = _case(
    {
        23: ("'{{\"event_id\": \"' || event_id", "'not a JSON object'"),
        29: ("'[1, \"' || event_id || '\"]'", "'not a JSON object'"),
        31: ("'null'", "'not a JSON object'"),
        37: ("NULL", "NULL"),
    }
)
_BROKEN_WIRE = _case(
    {
        23: ("base64('\\x00\\x00\\x00'::BLOB)", "'no header'"),
        29: (f"base64({_HEADER} || encode('{{{{\"event_id\": \"' || event_id))", "'unreadable body'"),
        31: ("NULL", "'no value'"),
        37: (f"base64({_HEADER})", "'unreadable body'"),
    }
)

ORACLE: dict[str, str] = {
    **{model: _with(sql) for model, sql in _SILVER_LINES.items()},
    "order_totals": _with(
        """SELECT coalesce(l.order_id, p.order_id) AS order_id, coalesce(lines, 0) AS lines,
                  merchandise, freight, coalesce(payments, 0) AS payments, paid
           FROM (SELECT order_id, count(*) AS lines, round(sum(product_price), 2) AS merchandise,
                        round(sum(freight_value), 2) AS freight FROM order_lines GROUP BY 1) l
           FULL JOIN (SELECT order_id, count(*) AS payments, round(sum(payment_value), 2) AS paid
                      FROM payment_entries GROUP BY 1) p ON l.order_id = p.order_id""",
        **_SILVER_LINES,
    ),
    "raw_events": _RAW,
    "wire_decode": _RAW,
    "stream_to_bronze": _RAW,
    "backfill_then_stream": _RAW,
    "jsonl_load": _LINES,
    # Lines of spaces are skipped: neither events nor rejects.
    "jsonl_rejects": _with(_rejected(_BROKEN_LINES, "k % 37 = 0 AND k % 23 <> 0 AND k % 29 <> 0 AND k % 31 <> 0")),
    # The second schema, of orders with an even number, has no session.
    "wire_avro": _with(
        """SELECT * EXCLUDE (moment) REPLACE (
            CASE WHEN CAST(order_id AS BIGINT) % 2 = 1 THEN session_id END AS session_id) FROM raw"""
    ),
    "wire_rejects": _with(_rejected(_BROKEN_WIRE, "false")),
    **{model: _with(f"SELECT * FROM {model}") for model in _MODELS},
    "payload_losses": _with(_losses()),
    **{
        key: _with(
            f"SELECT model_name, column_name, status, failure_count FROM ({_checks(kind)})"
        )
        for key, kind in {
            "dq_unique": "unique",
            "dq_not_null": "not_null",
            "dq_accepted_values": "accepted_values",
            "dq_expression": "expression_is_true",
            "dq_relationships": "relationships",
        }.items()
    },
    "dq_results": _with(_checks()),
    "dq_gate": _with(
        f"""SELECT run_id, layer, count(*) AS checks,
            count(*) FILTER (status = 'fail') AS failed, count(*) FILTER (status = 'warn') AS warned,
            count(*) FILTER (status = 'fail') = 0 AS open
        FROM ({_checks()}) GROUP BY run_id, layer"""
    ),
    "repeated_order_keys": _with(
        """SELECT order_id, count(*) AS n_records FROM dim_order_attributes
        WHERE order_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""
    ),
    "orders_without_review": _with(
        """SELECT order_id AS foreign_key, count(*) AS n_records FROM fct_orders
        WHERE order_id NOT IN (SELECT order_id FROM stg_order_reviews) GROUP BY 1"""
    ),
    "freshness": _with(
        f"""SELECT '{RUN_ID}' AS run_id, 'raw_events' AS table_name, max_event_time,
            age AS freshness_min, status, 60 AS threshold_min,
            TIMESTAMP '{AS_OF}' AS checked_at
        FROM ({_FRESH})"""
    ),
    "mean_counts": _with("SELECT table_name, mean_count FROM means", **_VOLUME),
    "volume_snapshot": _with(
        f"""SELECT '{RUN_ID}' AS run_id,
            CASE WHEN table_name LIKE 'stg%' THEN 'silver' ELSE 'gold' END AS layer,
            table_name, record_count,
            time_bucket(INTERVAL 15 MINUTE, TIMESTAMP '{AS_OF}') AS snapshot_hour,
            change AS pct_change_vs_avg, coalesce(abs(change) > 30, false) AS is_anomaly,
            TIMESTAMP '{AS_OF}' AS created_at
        FROM changes""",
        **_VOLUME,
    ),
    "volume_anomaly": _with(
        """SELECT table_name AS "table", record_count AS current, mean_count AS avg_7d,
            change AS pct_change FROM changes WHERE abs(change) > 30""",
        **_VOLUME,
    ),
    "health": _with(
        f"""SELECT '{RUN_ID}' AS run_id, 'health_summary' AS task_id, status, n_anomalies,
            status <> 'HEALTHY' AS has_detail
        FROM (SELECT CASE WHEN f.status = 'critical' THEN 'CRITICAL'
                     WHEN f.status = 'stale' OR n_anomalies > 0 THEN 'WARNING'
                     ELSE 'HEALTHY' END AS status, n_anomalies
              FROM ({_FRESH}) f,
                   (SELECT count(*) AS n_anomalies FROM changes WHERE abs(change) > 30))""",
        **_VOLUME,
    ),
    "stream_clicks": """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS timestamp,
        CAST(user_id AS VARCHAR) AS user_id, props AS payload_items
    FROM events""",
    "export_report": _with(
        " UNION ALL ".join(
            f"SELECT '{m}' AS table_name, count(*) AS row_count, 'ok' AS status, "
            f"CAST(NULL AS VARCHAR) AS error FROM {m}"
            for m in GOLD_MODELS
        )
    ),
    "run_log": _with(
        f"""SELECT '{BUILD_JOB}' AS dag_id, run_id, layer || '_gate' AS task_id,
            CASE WHEN failed = 0 THEN 'success' ELSE 'failed' END AS status,
            CASE WHEN failed > 0 THEN failed || ' checks failed' END AS error_message,
            CAST(NULL AS VARCHAR) AS log_url, TIMESTAMP '{AS_OF}' AS started_at,
            TIMESTAMP '{AS_OF}' AS finished_at, CAST(NULL AS DOUBLE) AS duration_sec,
            TIMESTAMP '{AS_OF}' AS created_at, attempt
        FROM (SELECT run_id, layer, count(*) FILTER (status = 'fail') AS failed
              FROM ({_checks()}) GROUP BY run_id, layer), (VALUES (1), (2)) AS attempts(attempt)"""
    ),
    "dq_log": _with(
        f"""SELECT run_id, layer, model_name, test_name, status, failure_count, error_detail,
            TIMESTAMP '{AS_OF}' AS tested_at, attempt
        FROM ({_checks()}), (VALUES (1), (2)) AS attempts(attempt)"""
    ),
}
