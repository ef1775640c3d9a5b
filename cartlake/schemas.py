"""Column lists and types of every table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T


def _strings(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# The twenty text columns of the event record, in model order.
EVENT_COLUMNS = [
    "event_id", "event_type", "timestamp", "user_id", "session_id", "order_id", "order_status",
    "payload_items", "payload_payments", "payload_review", "metadata_device", "metadata_os",
    "customer_id", "customer_city", "customer_state", "customer_zip_code", "customer_latitude",
    "customer_longitude", "estimated_delivery_date", "actual_delivery_date",
]
EVENT = _strings(EVENT_COLUMNS)
EVENT_PARTITION = "event_type"

# Records that could not be read are kept beside the events, under an event type of their own.
REJECTED = "__rejected__"
REJECT_TEXT, REJECT_REASON = "_reject_text", "_reject_reason"
STORED_EVENT = T.StructType([*EVENT.fields, T.StructField(REJECT_TEXT, T.StringType()), T.StructField(REJECT_REASON, T.StringType())])

# Event types with a payload, and the keys read from each payload.
ORDER_CREATED = "order.created"
PAYMENT_PROCESSED = "payment.processed"
ORDER_REVIEWED = "order.reviewed"
ORDER_DELIVERED = "order.delivered"

ITEM = _strings((
    "product_id", "product_category_name", "price", "freight_value", "seller_id", "seller_city",
    "seller_state", "seller_latitude", "seller_longitude", "seller_zip_code", "product_weight_g",
))
PAYMENT = _strings((
    "payment_type", "payment_installments", "payment_value",
))
REVIEW = _strings((
    "review_id", "review_score", "review_comment_title", "review_comment_message",
))

# Stored tables, with the types the models give them.
TABLES = {
    "stg_customers": (
        "user_id string, customer_id string, customer_city string, customer_state string, "
        "customer_zip_code string, customer_latitude double, customer_longitude double"
    ),
    "stg_order_items": (
        "order_id string, user_id string, product_id string, product_category_name string, "
        "product_price double, freight_value double, seller_id string, seller_city string, "
        "seller_state string, seller_latitude double, seller_longitude double, "
        "seller_zip_code string, product_weight_g double, created_at timestamp, "
        "total_item_cost double"
    ),
    "stg_order_payments": (
        "order_id string, payment_type string, payment_installments int, "
        "payment_value double, approved_at timestamp"
    ),
    "stg_order_reviews": (
        "order_id string, review_id string, review_score int, review_comment_title string, "
        "review_comment_message string, reviewed_at timestamp"
    ),
    "stg_order_status_history": (
        "order_id string, order_status string, event_type string, metadata_device string, "
        "metadata_os string, status_updated_at timestamp, estimated_delivery_date date, "
        "actual_delivery_date timestamp_ntz"
    ),
    "dim_categories": "category_key string, category_name string",
    "dim_customers": "customer_id string, customer_unique_id string, zip_code string",
    "dim_geography": "zip_code string, city string, state string, latitude double, longitude double",
    "dim_order_attributes": (
        "order_id string, order_status string, purchase_device string, purchase_os string"
    ),
    "dim_products": "product_id string, category_key string, product_weight_g double",
    "dim_reviews": (
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, reviewed_at timestamp"
    ),
    "dim_sellers": "seller_id string, zip_code string",
    "fct_orders": (
        "order_id string, customer_unique_key string, product_id string, seller_id string, "
        "order_item_quantity int, item_merchandise_revenue double, item_logistic_cost double, "
        "gross_amount double, cash_flow_received double, financing_installments int, "
        "estimated_delivery_date date, actual_delivery_date timestamp_ntz, "
        "count_delayed_order int, order_timestamp timestamp"
    ),
    # Monitoring logs. The attempt tells a repeated run's rows from those before.
    "pipeline_run_log": (
        "dag_id string, run_id string, task_id string, status string, error_message string, "
        "log_url string, started_at timestamp, finished_at timestamp, "
        "duration_sec decimal(10,2), created_at timestamp, attempt int"
    ),
    "dq_gate_log": (
        "run_id string, layer string, model_name string, test_name string, status string, "
        "failure_count bigint, error_detail string, tested_at timestamp, attempt int"
    ),
    "volume_snapshot_log": (
        "run_id string, layer string, table_name string, record_count bigint, "
        "snapshot_hour timestamp, pct_change_vs_avg decimal(18,2), is_anomaly boolean, "
        "created_at timestamp, attempt int"
    ),
    "freshness_log": (
        "run_id string, table_name string, max_event_time timestamp, "
        "freshness_min decimal(10,2), status string, threshold_min int, checked_at timestamp, "
        "attempt int"
    ),
}
RUN_LOG, DQ_LOG = TABLES["pipeline_run_log"], TABLES["dq_gate_log"]
VOLUME_LOG = TABLES["volume_snapshot_log"]
EXPORT_REPORT = "table_name string, target string, row_count bigint, status string, error string"


def avro_schema(name: str = "ShopEvent", namespace: str = "cartlake") -> str:
    """Avro twin of the event record: every field a nullable string."""
    import json

    fields = [{"name": c, "type": ["null", "string"], "default": None} for c in EVENT_COLUMNS]
    return json.dumps({"type": "record", "name": name, "namespace": namespace, "fields": fields})
