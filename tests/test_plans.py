"""Plans and their behaviour under skew."""

import pytest
from pyspark.sql import functions as F

from cartlake import catalogue
from cartlake.operators.relational import latest_per_key, left_join_per_order
from cartlake.plans import gold, silver

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    before = {}

    def set_conf(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_conf
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize(
    "model, event_type",
    [
        ("stg_order_items", "order.created"), ("stg_order_payments", "payment.processed"),
        ("stg_order_reviews", "order.reviewed"),
    ],
)
def test_payload_models_read_one_partition_and_few_columns(spark, model, event_type):
    text = plan(silver.SILVER[model](catalogue.bronze(spark, FOLDER)))
    assert f"PartitionFilters: [isnotnull(event_type#" in text and f"= {event_type})]" in text
    assert "PushedFilters: [IsNotNull(payload_" in text
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert "session_id" not in schema and "customer_city" not in schema
    assert "Exchange" not in text
    # One parse: the filter above the generator works on its output.
    assert text.count("Generate inline") == 1
    assert not any("from_json" in line for line in text.split("\n") if "Filter" in line.split("(")[0])


def test_latest_per_key_limits_before_the_shuffle(spark):
    text = plan(silver.stg_customers(catalogue.bronze(spark, FOLDER)))
    assert text.count("WindowGroupLimit") == 2
    exchange = text.index("Exchange hashpartitioning")
    assert text.index("WindowGroupLimit") < exchange < text.rindex("WindowGroupLimit")


def test_no_query_runs_python_or_a_cross_join(spark):
    for name, query in catalogue.QUERIES.items():
        if name in ("stream_to_bronze", "stream_clicks", "export_report", "run_log", "wire_avro"):
            continue
        text = query(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in text, name


def test_fact_has_one_join_and_skips_unused_columns(spark):
    text = plan(catalogue.QUERIES["fct_orders"](spark, FOLDER))
    assert text.count("Join") == 1
    assert "payment_type" not in text.split("ReadSchema")[0].split("Generate")[0]


def hot_rows(spark, n=60000):
    """A third of all rows carry one key."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id")))
    return spark.range(0, n, 1, 12).select(key.alias("order_id"), F.repeat(F.col("id").cast("string"), 9).alias("x"))


def test_hot_key_of_the_fact_join_is_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="128k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__shuffle__partitions="16",
    )
    left = hot_rows(spark)
    right = left.groupBy("order_id").agg(F.count("x").alias("n"))
    joined = left_join_per_order(left, right, "order_id")
    rows = joined.groupBy("n").count().collect()
    assert {r["n"]: r["count"] for r in rows} == {1: 40000, 20000: 20000}
    joined.collect()
    assert "SortMergeJoin(skew=true)" in plan(joined)


def test_hot_key_of_latest_per_key(spark):
    df = hot_rows(spark)
    newest = latest_per_key(df, ["order_id"], [F.col("x").desc()])
    assert newest.count() == df.select("order_id").distinct().count() == 40001


def test_hot_order_in_the_fact(spark):
    """Brute force over a fixture where one order has a third of all items."""
    items = hot_rows(spark, 3000).select(
        "order_id", F.lit("u").alias("user_id"), F.col("x").alias("product_id"),
        F.lit("s").alias("seller_id"), F.lit(1.0).alias("product_price"),
        F.lit(2.0).alias("freight_value"), F.lit(None).cast("timestamp").alias("created_at"),
    )
    payments = hot_rows(spark, 3000).select(
        "order_id", F.lit(0.5).alias("payment_value"), F.lit(3).alias("payment_installments")
    )
    history = hot_rows(spark, 0).select(
        "order_id", F.lit(None).cast("date").alias("estimated_delivery_date"),
        F.lit(None).cast("timestamp_ntz").alias("actual_delivery_date"),
    )
    rows = gold.fct_orders(items, payments, history).groupBy("cash_flow_received").count().collect()
    assert {r["cash_flow_received"]: r["count"] for r in rows} == {500.0: 1000, 0.5: 2000}
