"""Gold models: dimensions and the order fact, from the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartlake.functions.text import hash_key
from cartlake.operators.relational import left_join_per_order


def dim_categories(items: DataFrame) -> DataFrame:
    names = items.where(F.col("product_category_name").isNotNull()).select(
        F.col("product_category_name").alias("category_name")
    )
    return names.distinct().select(
        hash_key(F.col("category_name")).alias("category_key"), "category_name"
    )


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        F.col("user_id").alias("customer_unique_id"),
        F.col("customer_zip_code").alias("zip_code"),
    )


def dim_geography(customers: DataFrame) -> DataFrame:
    """Distinct addresses; one zip code may keep several rows."""
    parts = ("zip_code", "city", "state", "latitude", "longitude")
    return customers.select(*[F.col(f"customer_{p}").alias(p) for p in parts]).distinct()


def dim_order_attributes(history: DataFrame) -> DataFrame:
    """Distinct status, device and system per order; several rows per order."""
    return history.select(
        "order_id",
        "order_status",
        F.col("metadata_device").alias("purchase_device"),
        F.col("metadata_os").alias("purchase_os"),
    ).distinct()


def dim_products(items: DataFrame) -> DataFrame:
    distinct = items.select("product_id", "product_category_name", "product_weight_g").distinct()
    return distinct.select(
        "product_id",
        hash_key(F.col("product_category_name")).alias("category_key"),
        "product_weight_g",
    )


def dim_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "reviewed_at",
    )


def dim_sellers(items: DataFrame) -> DataFrame:
    return items.select("seller_id", F.col("seller_zip_code").alias("zip_code")).distinct()


def payments_agg(payments: DataFrame) -> DataFrame:
    """Payment totals per order; the type is the last one in text order."""
    return payments.groupBy("order_id").agg(
        F.max("payment_type").alias("payment_type"),
        F.sum("payment_value").alias("total_payment_value"),
        F.max("payment_installments").alias("payment_installments"),
    )


def delivery_dates(history: DataFrame) -> DataFrame:
    """Latest update, estimate and delivery per order."""
    return history.groupBy("order_id").agg(
        F.max("status_updated_at").alias("latest_update"),
        F.max("estimated_delivery_date").alias("estimated_delivery_date"),
        F.max("actual_delivery_date").alias("actual_delivery_date"),
    )


def order_totals(payments: DataFrame, history: DataFrame) -> DataFrame:
    """Payment totals and delivery dates of an order in one aggregation.

    The two inputs share the grouping key and their measures do not overlap, so
    one union, one exchange and one join replace two of each.
    """
    paid = payments.select("order_id", "payment_value", "payment_installments")
    moved = history.select("order_id", "estimated_delivery_date", "actual_delivery_date")
    return (
        paid.unionByName(moved, allowMissingColumns=True)
        .where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.sum("payment_value").alias("total_payment_value"),
            F.max("payment_installments").alias("payment_installments"),
            F.max("estimated_delivery_date").alias("estimated_delivery_date"),
            F.max("actual_delivery_date").alias("actual_delivery_date"),
        )
    )


def fct_orders(items: DataFrame, payments: DataFrame, history: DataFrame) -> DataFrame:
    """One row per item row with payment totals, dates and a late flag."""
    c = F.col
    lines = items.select(
        "order_id", "user_id", "product_id", "seller_id", "product_price", "freight_value",
        "created_at",
    )
    joined = left_join_per_order(lines, order_totals(payments, history), "order_id")
    due = c("estimated_delivery_date").cast("timestamp_ntz")
    late = F.when(
        c("actual_delivery_date").isNotNull(),
        F.coalesce((c("actual_delivery_date") > due).cast("int"), F.lit(0)),
    )
    return joined.select(
        "order_id",
        c("user_id").alias("customer_unique_key"),
        "product_id",
        "seller_id",
        F.lit(1).alias("order_item_quantity"),
        c("product_price").alias("item_merchandise_revenue"),
        c("freight_value").alias("item_logistic_cost"),
        F.round(c("product_price") + c("freight_value"), 2).alias("gross_amount"),
        F.coalesce("total_payment_value", F.lit(0.0)).alias("cash_flow_received"),
        F.coalesce("payment_installments", F.lit(1)).alias("financing_installments"),
        "estimated_delivery_date",
        "actual_delivery_date",
        late.alias("count_delayed_order"),
        c("created_at").alias("order_timestamp"),
    )


# Model name -> builder and the silver tables it reads.
GOLD = {
    "dim_categories": (dim_categories, ("stg_order_items",)),
    "dim_customers": (dim_customers, ("stg_customers",)),
    "dim_geography": (dim_geography, ("stg_customers",)),
    "dim_order_attributes": (dim_order_attributes, ("stg_order_status_history",)),
    "dim_products": (dim_products, ("stg_order_items",)),
    "dim_reviews": (dim_reviews, ("stg_order_reviews",)),
    "dim_sellers": (dim_sellers, ("stg_order_items",)),
    "fct_orders": (
        fct_orders,
        ("stg_order_items", "stg_order_payments", "stg_order_status_history"),
    ),
}
