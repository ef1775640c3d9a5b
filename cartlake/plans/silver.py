"""Silver models: typed, cleaned rows from the raw events.

Every function maps the event DataFrame to one table and starts no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartlake import schemas as S
from cartlake.functions.payload import spread_elements, spread_first_element, spread_object
from cartlake.functions.text import or_default, present, trim_space
from cartlake.functions.typing import iso_timestamp, number, wall_clock
from cartlake.operators.relational import latest_per_key


def raw_events(bronze: DataFrame) -> DataFrame:
    """The event columns by name, in model order."""
    return bronze.select(*S.EVENT_COLUMNS)


def stg_customers(events: DataFrame, on_bad_value: str = "error") -> DataFrame:
    """One row per user: the address on the newest event that names a customer."""
    c = F.col
    addresses = events.where(present(c("user_id")) & present(c("customer_id"))).select(
        "user_id",
        "customer_id",
        or_default(trim_space(c("customer_city")), "unknown").alias("customer_city"),
        or_default(F.upper(trim_space(c("customer_state"))), "un").alias("customer_state"),
        or_default(c("customer_zip_code"), "00000").alias("customer_zip_code"),
        *[
            or_default(number(c(name), on_bad_value=on_bad_value), 0.0).alias(name)
            for name in ("customer_latitude", "customer_longitude")
        ],
        "timestamp",
        "event_id",
    )
    newest = latest_per_key(
        addresses, ["user_id"], [c("timestamp").desc_nulls_last(), c("event_id").desc()]
    )
    return newest.drop("timestamp", "event_id")


def _with_payload(events: DataFrame, event_type: str, payload: str, *keep: str) -> DataFrame:
    return events.where((F.col("event_type") == event_type) & F.col(payload).isNotNull()).select(
        *keep, "timestamp", payload
    )


def _typed_items(items: DataFrame, on_bad_value: str, *keep: str) -> DataFrame:
    """Items with a price and no negative freight, typed."""
    c = F.col
    typed = items.select(
        *keep,
        "user_id",
        "product_id",
        or_default(c("product_category_name"), "unassigned").alias("product_category_name"),
        number(c("price"), on_bad_value=on_bad_value).alias("product_price"),
        number(c("freight_value"), on_bad_value=on_bad_value).alias("freight_value"),
        "seller_id",
        "seller_city",
        F.upper("seller_state").alias("seller_state"),
        number(c("seller_latitude"), on_bad_value=on_bad_value).alias("seller_latitude"),
        number(c("seller_longitude"), on_bad_value=on_bad_value).alias("seller_longitude"),
        "seller_zip_code",
        or_default(number(c("product_weight_g"), on_bad_value=on_bad_value), 0.0).alias(
            "product_weight_g"
        ),
        iso_timestamp(c("timestamp"), on_bad_value).alias("created_at"),
    )
    return typed.where((c("product_price") > 0) & (c("freight_value") >= 0)).withColumn(
        "total_item_cost", F.round(c("product_price") + c("freight_value"), 2)
    )


def stg_order_items(
    events: DataFrame, on_bad_value: str = "error", lenient: bool = False
) -> DataFrame:
    """First item of every created order with a price and no negative freight."""
    created = _with_payload(events, S.ORDER_CREATED, "payload_items", "order_id", "user_id")
    items = spread_first_element(created, "payload_items", S.ITEM, lenient)
    return _typed_items(items, on_bad_value, "order_id")


def order_lines(events: DataFrame, on_bad_value: str = "error", lenient: bool = False) -> DataFrame:
    """All items of created orders by the same rules, numbered as in the payload from 0."""
    created = _with_payload(events, S.ORDER_CREATED, "payload_items", "order_id", "user_id")
    items = spread_elements(created, "payload_items", S.ITEM, "line", lenient)
    return _typed_items(items, on_bad_value, "order_id", "line")


def _typed_payments(entries: DataFrame, on_bad_value: str, *keep: str) -> DataFrame:
    """Payment entries that moved money, typed."""
    c = F.col
    return entries.select(
        *keep,
        or_default(F.lower(trim_space(c("payment_type"))), "not_defined").alias("payment_type"),
        or_default(number(c("payment_installments"), "int", on_bad_value), 1).alias(
            "payment_installments"
        ),
        number(c("payment_value"), on_bad_value=on_bad_value).alias("payment_value"),
        iso_timestamp(c("timestamp"), on_bad_value).alias("approved_at"),
    ).where(c("payment_value") > 0)


def stg_order_payments(
    events: DataFrame, on_bad_value: str = "error", lenient: bool = False
) -> DataFrame:
    """First entry of every processed payment that moved money."""
    processed = _with_payload(events, S.PAYMENT_PROCESSED, "payload_payments", "order_id")
    entries = spread_first_element(processed, "payload_payments", S.PAYMENT, lenient)
    return _typed_payments(entries, on_bad_value, "order_id")


def payment_entries(events: DataFrame, on_bad_value: str = "error", lenient: bool = False) -> DataFrame:
    """All entries of processed payments by the same rules, numbered as in the payload from 0."""
    processed = _with_payload(events, S.PAYMENT_PROCESSED, "payload_payments", "order_id", "event_id")
    entries = spread_elements(processed, "payload_payments", S.PAYMENT, "entry", lenient)
    return _typed_payments(entries, on_bad_value, "order_id", "event_id", "entry")


def order_totals(lines: DataFrame, entries: DataFrame) -> DataFrame:
    """Lines, merchandise, freight and payments of every order that has either, over all its entries.

    One union and one aggregation by order instead of a join of two; rows combine before the shuffle.
    """
    c = F.col
    both = lines.select("order_id", "product_price", "freight_value").unionByName(
        entries.select("order_id", "payment_value"), allowMissingColumns=True
    )
    return both.groupBy("order_id").agg(
        F.count("product_price").alias("lines"),
        F.round(F.sum("product_price"), 2).alias("merchandise"),
        F.round(F.sum("freight_value"), 2).alias("freight"),
        F.count("payment_value").alias("payments"),
        F.round(F.sum(c("payment_value")), 2).alias("paid"),
    )


def stg_order_reviews(
    events: DataFrame, on_bad_value: str = "error", lenient: bool = False
) -> DataFrame:
    """Reviews with a score from one to five."""
    c = F.col
    reviewed = _with_payload(events, S.ORDER_REVIEWED, "payload_review", "order_id")
    review = spread_object(reviewed, "payload_review", S.REVIEW, lenient)
    return review.select(
        "order_id",
        "review_id",
        number(c("review_score"), "int", on_bad_value).alias("review_score"),
        trim_space(c("review_comment_title")).alias("review_comment_title"),
        trim_space(c("review_comment_message")).alias("review_comment_message"),
        iso_timestamp(c("timestamp"), on_bad_value).alias("reviewed_at"),
    ).where(c("review_score").between(1, 5))


def stg_order_status_history(events: DataFrame, on_bad_value: str = "error") -> DataFrame:
    """One row per event that carries an order status."""
    c = F.col
    return events.where(present(c("order_id")) & present(c("order_status"))).select(
        "order_id",
        F.lower(trim_space(c("order_status"))).alias("order_status"),
        "event_type",
        or_default(c("metadata_device"), "unknown").alias("metadata_device"),
        or_default(c("metadata_os"), "unknown").alias("metadata_os"),
        iso_timestamp(c("timestamp"), on_bad_value).alias("status_updated_at"),
        wall_clock(c("estimated_delivery_date")).cast("date").alias("estimated_delivery_date"),
        wall_clock(c("actual_delivery_date")).alias("actual_delivery_date"),
    )


def payload_losses(events: DataFrame, lenient: bool = False) -> DataFrame:
    """Per payload event type: events, rows the silver model keeps, rows it drops.

    Malformed payloads and filtered amounts leave no trace in the silver tables;
    this makes the loss visible. Values that are not numbers count as dropped.
    """
    c = F.col

    def kept(df: DataFrame, event_type: str, keep) -> DataFrame:
        return df.select(F.lit(event_type).alias("event_type"), keep.alias("keep"))

    def value(name: str, to: str = "double"):
        return number(c(name), to, "null")

    items = spread_first_element(
        _with_payload(events, S.ORDER_CREATED, "payload_items"), "payload_items", S.ITEM, lenient
    )
    payments = spread_first_element(
        _with_payload(events, S.PAYMENT_PROCESSED, "payload_payments"),
        "payload_payments", S.PAYMENT, lenient,
    )
    reviews = spread_object(
        _with_payload(events, S.ORDER_REVIEWED, "payload_review"),
        "payload_review", S.REVIEW, lenient,
    )
    flagged = (
        kept(items, S.ORDER_CREATED, (value("price") > 0) & (value("freight_value") >= 0))
        .unionByName(kept(payments, S.PAYMENT_PROCESSED, value("payment_value") > 0))
        .unionByName(kept(reviews, S.ORDER_REVIEWED, value("review_score", "int").between(1, 5)))
    )
    return flagged.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("keep").alias("kept_rows"),
        F.count_if(~F.coalesce("keep", F.lit(False))).alias("dropped_rows"),
    )


SILVER = {
    "stg_customers": stg_customers,
    "stg_order_items": stg_order_items,
    "stg_order_payments": stg_order_payments,
    "stg_order_reviews": stg_order_reviews,
    "stg_order_status_history": stg_order_status_history,
}
