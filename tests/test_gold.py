from datetime import date, datetime

from hypothesis import HealthCheck, given, settings, strategies as st

from cartlake import schemas as S
from cartlake.plans import gold


def frame(spark, model, *rows):
    schema = spark.createDataFrame([], S.TABLES[model]).schema
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


ITEM = {
    "order_id": "o1", "user_id": "u1", "product_id": "p1", "product_category_name": "toys",
    "product_price": 10.0, "freight_value": 2.5, "seller_id": "s1", "seller_zip_code": "1",
    "product_weight_g": 3.0, "created_at": datetime(2024, 1, 1), "total_item_cost": 12.5,
}


def fact(spark, items, payments=(), history=()):
    return gold.fct_orders(
        frame(spark, "stg_order_items", *[{**ITEM, **i} for i in items]),
        frame(spark, "stg_order_payments", *payments),
        frame(spark, "stg_order_status_history", *history),
    )


def test_order_without_payment_or_dates(spark):
    row = fact(spark, [{}]).head()
    assert (row["cash_flow_received"], row["financing_installments"]) == (0.0, 1)
    assert row["count_delayed_order"] is None
    assert (row["order_item_quantity"], row["gross_amount"]) == (1, 12.5)


def test_payments_add_up_and_installments_peak(spark):
    paid = [
        {"order_id": "o1", "payment_value": 5.0, "payment_installments": 2},
        {"order_id": "o1", "payment_value": 7.5, "payment_installments": 4},
        {"order_id": "o2", "payment_value": 99.0, "payment_installments": 9},
    ]
    rows = fact(spark, [{}, {"product_id": "p2"}], paid).collect()
    assert len(rows) == 2
    assert {(r["cash_flow_received"], r["financing_installments"]) for r in rows} == {(12.5, 4)}


def test_late_flag(spark):
    due = date(2024, 2, 1)
    cases = {
        "midnight": (due, datetime(2024, 2, 1), 0),
        "second": (due, datetime(2024, 2, 1, 0, 0, 1), 1),
        "early": (due, datetime(2024, 1, 20), 0),
        "no estimate": (None, datetime(2024, 2, 1), 0),
        "open": (due, None, None),
    }
    history = [
        {"order_id": k, "estimated_delivery_date": e, "actual_delivery_date": a}
        for k, (e, a, _) in cases.items()
    ]
    rows = fact(spark, [{"order_id": k} for k in cases], history=history).collect()
    assert {r["order_id"]: r["count_delayed_order"] for r in rows} == {
        k: flag for k, (_, _, flag) in cases.items()
    }


def test_latest_dates_count(spark):
    history = [
        {"order_id": "o1", "estimated_delivery_date": date(2024, 2, d)} for d in (1, 9, 4)
    ] + [{"order_id": None, "estimated_delivery_date": date(2025, 1, 1)}]
    assert fact(spark, [{}], history=history).head()["estimated_delivery_date"] == date(2024, 2, 9)


def test_items_without_order_id_are_kept(spark):
    paid = [{"order_id": None, "payment_value": 5.0, "payment_installments": 2}]
    row = fact(spark, [{"order_id": None}], paid).head()
    assert (row["order_id"], row["cash_flow_received"]) == (None, 0.0)


def test_dimensions_are_distinct(spark):
    items = frame(
        spark, "stg_order_items", ITEM, ITEM, {**ITEM, "product_weight_g": 4.0},
        {**ITEM, "seller_zip_code": "2"}, {**ITEM, "product_category_name": None},
    )
    assert [r["category_name"] for r in gold.dim_categories(items).collect()] == ["toys"]
    assert gold.dim_products(items).count() == 3
    assert gold.dim_sellers(items).count() == 2


def test_several_statuses_of_one_order_stay_apart(spark):
    history = frame(
        spark, "stg_order_status_history",
        {"order_id": "o1", "order_status": "created"}, {"order_id": "o1", "order_status": "shipped"},
        {"order_id": "o1", "order_status": "shipped"},
    )
    assert gold.dim_order_attributes(history).count() == 2


def test_payment_type_is_last_in_text_order(spark):
    payments = frame(
        spark, "stg_order_payments",
        {"order_id": "o1", "payment_type": "boleto", "payment_value": 1.0},
        {"order_id": "o1", "payment_type": "voucher", "payment_value": 2.0},
    )
    row = gold.payments_agg(payments).head()
    assert (row["payment_type"], row["total_payment_value"]) == ("voucher", 3.0)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.sampled_from("abc"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12),
    st.lists(st.sampled_from("abcd"), max_size=12),
)
def test_fact_keeps_every_item_row(spark, orders, paid, moved):
    rows = fact(
        spark,
        [{"order_id": o} for o in orders],
        [{"order_id": o, "payment_value": 1.0, "payment_installments": 1} for o in paid],
        [{"order_id": o, "actual_delivery_date": datetime(2024, 1, 1)} for o in moved],
    ).collect()
    assert sorted(r["order_id"] for r in rows) == sorted(orders)
    for r in rows:
        assert r["cash_flow_received"] == paid.count(r["order_id"])
        assert (r["count_delayed_order"] is None) == (r["order_id"] not in moved)


def test_schemas_are_as_declared(spark):
    for model, (build, needs) in gold.GOLD.items():
        built = build(*[frame(spark, n) for n in needs])
        declared = spark.createDataFrame([], S.TABLES[model]).schema
        assert built.schema.simpleString() == declared.simpleString(), model
