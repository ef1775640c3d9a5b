"""The checks declared on silver and gold tables."""

from __future__ import annotations

from cartlake.operators.checks import ERROR, WARN, Check

# Columns that must not be null, by severity.
_NOT_NULL = {
    "stg_customers": {
        ERROR: ("user_id", "customer_id", "customer_zip_code"),
        WARN: ("customer_city", "customer_state", "customer_latitude", "customer_longitude"),
    },
    "stg_order_items": {
        ERROR: ("order_id", "user_id", "product_id", "product_price", "freight_value", "seller_id", "total_item_cost", "created_at"),
        WARN: ("product_category_name", "seller_city", "seller_state"),
    },
    "stg_order_payments": {
        ERROR: ("order_id", "payment_type", "payment_installments", "payment_value"),
        WARN: ("approved_at",),
    },
    "stg_order_status_history": {ERROR: ("order_id", "order_status", "status_updated_at")},
    "stg_order_reviews": {ERROR: ("order_id", "review_score"), WARN: ("review_id", "reviewed_at")},
    "dim_geography": {ERROR: ("zip_code",)},
    "dim_categories": {ERROR: ("category_key",)},
    "dim_customers": {ERROR: ("customer_unique_id",)},
    "dim_products": {ERROR: ("product_id",), WARN: ("category_key",)},
    "dim_sellers": {ERROR: ("seller_id",)},
    "dim_reviews": {ERROR: ("review_id",)},
    "dim_order_attributes": {ERROR: ("order_id",)},
    "fct_orders": {ERROR: ("order_id", "customer_unique_key", "product_id", "seller_id")},
}

# Columns declared unique, all of severity error. Several of these
# tables are distinct over more columns than the key, so failures are expected.
_UNIQUE = {
    "stg_customers": "user_id",
    "dim_geography": "zip_code",
    "dim_categories": "category_key",
    "dim_customers": "customer_unique_id",
    "dim_products": "product_id",
    "dim_sellers": "seller_id",
    "dim_order_attributes": "order_id",
}

# Accepted values, expressions and foreign keys.
_OTHER = [
    Check("stg_order_payments", "payment_type", "accepted_values", WARN,
          ("credit_card", "debit_card", "boleto", "voucher", "not_defined")),
    Check("stg_order_status_history", "order_status", "accepted_values", WARN,
          ("created", "approved", "processing", "shipped", "delivered", "cancelled",
           "unavailable", "invoiced")),
    Check("stg_order_reviews", "review_score", "accepted_values", ERROR, (1, 2, 3, 4, 5)),
    Check("fct_orders", "count_delayed_order", "accepted_values", WARN, (0, 1)),
    Check("stg_order_items", "product_price", "expression_is_true", ERROR, "> 0"),
    Check("stg_order_items", "freight_value", "expression_is_true", ERROR, ">= 0"),
    Check("stg_order_items", "total_item_cost", "expression_is_true", ERROR, "> 0"),
    Check("stg_order_payments", "payment_installments", "expression_is_true", WARN, ">= 1"),
    Check("stg_order_payments", "payment_value", "expression_is_true", ERROR, "> 0"),
    Check("dim_products", "category_key", "relationships", WARN,
          ("dim_categories", "category_key")),
    Check("fct_orders", "customer_unique_key", "relationships", ERROR,
          ("dim_customers", "customer_unique_id")),
    Check("fct_orders", "product_id", "relationships", ERROR, ("dim_products", "product_id")),
    Check("fct_orders", "seller_id", "relationships", ERROR, ("dim_sellers", "seller_id")),
]

CHECKS: tuple[Check, ...] = (
    *[
        Check(model, column, "not_null", severity)
        for model, by_severity in _NOT_NULL.items()
        for severity, columns in by_severity.items()
        for column in columns
    ],
    *[Check(model, column, "unique", ERROR) for model, column in _UNIQUE.items()],
    *_OTHER,
)

SILVER_CHECKS = tuple(c for c in CHECKS if c.model.startswith("stg_"))
GOLD_CHECKS = tuple(c for c in CHECKS if not c.model.startswith("stg_"))
