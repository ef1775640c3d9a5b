"""Shop events derived from the order tables.

The given tables hold orders, lines, customers, parts and suppliers but no shop
events, so every order is told as the events it would have sent: created with all its
lines, paid once or twice and in one or two parts, delivered, reviewed. Orders without lines
have an empty item list and are never delivered. The values are chosen to reach the corners of
the models: empty ids, padded text, apostrophes, zero amounts, missing keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartlake import schemas as S
from cartlake.session import no_shuffle_left


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(*pieces) -> Column:
    """Pieces joined to one text; columns as they are, the rest literal."""
    return F.concat(
        *[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in pieces]
    )


def _sent_whole(df: DataFrame) -> bool:
    """Whether the planner takes a table for small enough to broadcast it."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= limit


def _kept(df: DataFrame, stage: str | None) -> DataFrame:
    """The rows, read back from folder `stage` if there is one."""
    if stage is None:
        return df
    with no_shuffle_left(df.sparkSession):
        df.write.parquet(stage, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(stage)


def _items(spark: SparkSession, folder: str, stage: str | None) -> DataFrame:
    """(l_orderkey, lines, shipped): each order's lines with what their items tell, and its latest shipping date.

    Line numbers repeat within an order; among the copies the greatest value of each column counts. An
    order's lines are gathered after that, so a list has one entry per line number.

    Narrow lines are dealt by order once, before both aggregations, which then need no exchange of their own
    as long as parts and sellers are broadcast. Lines that are shuffled to larger ones are kept in `stage`, so that the
    shuffle files of these joins are gone before those of the next exchange are written; they are dealt by order again while
    they are narrow, not as half-gathered lists. The nations come last: Spark takes the size of a join for the product
    of its sides, and would not broadcast a few sellers once they are joined.
    """
    c = F.col
    names = ("l_partkey", "l_suppkey", "l_extendedprice", "l_tax", "l_shipdate")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *names).repartition("l_orderkey")
    lines = lines.groupBy("l_orderkey", "l_linenumber").agg(*[F.max(n).alias(n) for n in names])
    nation = table(spark, folder, "nation").select("n_nationkey", c("n_name").alias("s_city"))
    sellers = table(spark, folder, "supplier").select("s_suppkey", c("s_nationkey").alias("sn"))
    parts = table(spark, folder, "part").select("p_partkey", "p_type", "p_size")
    joins = [(parts, c("l_partkey") == c("p_partkey")), (sellers, c("l_suppkey") == c("s_suppkey"))]
    sent = [_sent_whole(to) for to, _ in joins]
    if not all(sent):
        kept = lines.columns
        for (to, on), whole in zip(joins, sent, strict=True):
            if not whole:
                lines, kept = lines.join(to, on), kept + to.columns[1:]
        lines = _kept(lines.select(*kept), stage).repartition("l_orderkey")
    for (to, on), whole in zip(joins, sent, strict=True):
        if whole:
            lines = lines.join(to, on)
    lines = lines.join(nation, c("sn") == c("n_nationkey"))

    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_tax", "p_type", "p_size", "sn", "s_city")
    return lines.groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"), F.max("l_shipdate").alias("shipped"))


def _item_texts(lines: Column, k: Column) -> Column:
    """The lines of order `k` as the text of a JSON array, in the order of their numbers."""

    def item(line: Column) -> Column:
        pk, sk, sn = line["l_partkey"], line["l_suppkey"], line["sn"]
        category = F.when(pk % 10 == 0, F.lit("null")).otherwise(_text("'", line["p_type"], "'"))
        price = F.when(k % 97 == 0, F.lit("0.0")).otherwise(line["l_extendedprice"].cast("string"))
        weight = F.when(pk % 9 == 0, F.lit("")).otherwise(_text(", 'product_weight_g': ", line["p_size"]))
        return _text(
            "{'product_id': '", pk, "', 'product_category_name': ", category,
            ", 'price': ", price,
            ", 'freight_value': ", F.round(line["l_tax"] * 100).cast("int"), ".25",
            ", 'seller_id': '", sk, "', 'seller_city': '", line["s_city"],
            "', 'seller_state': 'n", sn,
            "', 'seller_zip_code': '", F.lpad(sk.cast("string"), 5, "0"),
            "', 'seller_latitude': -", sn, ".5, 'seller_longitude': ", sn, ".25", weight, "}",
        )

    ordered = F.array_sort(F.transform(lines, lambda x: F.struct(x["l_linenumber"].alias("number"), item(x).alias("item"))))
    return _text("[", F.array_join(F.transform(ordered, lambda x: x["item"]), ", "), "]")


def _orders(spark: SparkSession, folder: str, stage: str | None) -> DataFrame:
    """One row per order, with its items and the names its events need."""
    c = F.col
    nation = table(spark, folder, "nation").select("n_nationkey", c("n_name").alias("c_city"))
    # Both sides of these joins grow with the data, so they are never broadcast. Buyers come first, while
    # orders are narrow; the items come out partitioned by order, and become text only in the created events.
    buyers = table(spark, folder, "customer").select("c_custkey", c("c_nationkey").alias("cn")).hint("merge")
    orders = table(spark, folder, "orders").join(buyers, c("o_custkey") == c("c_custkey"))
    orders = orders.join(nation, c("cn") == c("n_nationkey"))
    items = _items(spark, folder, stage).hint("merge")
    return orders.join(items, c("o_orderkey") == c("l_orderkey"), "left")


def events(spark: SparkSession, folder: str, stage: str | None = None) -> DataFrame:
    """All events of all orders, twenty text columns.

    `stage` is a new folder for lines that meet large tables on the way; the events are read from it.
    """
    c = F.col
    k, u, cn, od, sh = c("o_orderkey"), c("o_custkey"), c("cn"), c("o_orderdate"), c("shipped")

    # One letter per event of the order; the wide columns are computed after this,
    # so filters on the event type drop rows first.
    kinds = F.array_compact(
        F.array(
            F.lit("c"),
            F.when(k % 11 != 0, F.lit("p")),
            F.when(k % 5 == 0, F.lit("q")),
            F.when(sh.isNotNull(), F.lit("d")),
            F.when(sh.isNotNull() & (k % 3 == 0), F.lit("r")),
        )
    )
    told = _orders(spark, folder, stage).withColumn("kind", F.explode(kinds))
    kind = c("kind")
    created, paid, voucher = kind == "c", kind == "p", kind == "q"
    delivered, reviewed = kind == "d", kind == "r"

    def hours(n: int) -> Column:
        return F.make_dt_interval(hours=F.lit(n))

    def days(n: int) -> Column:
        return F.make_dt_interval(days=F.lit(n))

    moment = (
        F.when(created, od)
        .when(paid, od + hours(1))
        .when(voucher, od + hours(2))
        .when(delivered, sh)
        .otherwise(sh + days(1))
    )
    method = (
        F.when(k % 4 == 0, F.lit(" Credit_Card "))
        .when(k % 4 == 1, F.lit(" boleto "))
        .when(k % 4 == 2, F.lit(" debit_card "))
        .otherwise(F.lit(" pix "))
    )
    amount = F.when(k % 13 == 0, F.lit("0.0")).otherwise(c("o_totalprice").cast("string"))
    payment = _text(
        "[{'payment_type': '", method, "', 'payment_installments': ", k % 10 + 1,
        ", 'payment_value': ", amount, "}",
        F.when(k % 6 == 0, F.lit(", {'payment_type': ' Gift_Card', 'payment_value': 5.5}")).otherwise(F.lit("")), "]",
    )
    voucher_payment = _text("[{'payment_type': 'voucher', 'payment_value': 10.5}]")
    message = (
        F.when(k % 21 == 0, F.lit("'it's late'"))
        .when(k % 2 == 0, F.lit("null"))
        .otherwise(F.lit("'ok '"))
    )
    review = _text(
        "{'review_id': 'rv", k, "', 'review_score': ", k % 7,
        ", 'review_comment_title': ' t", k, " ', 'review_comment_message': ", message, "}",
    )
    columns = {
        "event_id": _text(kind, k),
        "event_type": F.when(created, F.lit(S.ORDER_CREATED))
        .when(paid | voucher, F.lit(S.PAYMENT_PROCESSED))
        .when(delivered, F.lit(S.ORDER_DELIVERED))
        .otherwise(F.lit(S.ORDER_REVIEWED)),
        "timestamp": _text(F.replace(moment.cast("string"), F.lit(" "), F.lit("T")), "+00:00"),
        "user_id": F.when(delivered & (k % 50 == 7), F.lit("")).otherwise(u.cast("string")),
        "session_id": _text("s", k),
        "order_id": k.cast("string"),
        "order_status": F.when(created, F.lit("created"))
        .when(paid | voucher, F.lit("approved"))
        .when(delivered & (k % 17 == 0), F.lit(""))
        .when(delivered, F.lit(" Delivered ")),
        "payload_items": F.when(created, F.coalesce(_item_texts(c("lines"), k), F.lit("[]"))),
        "payload_payments": F.when(paid, payment).when(voucher, voucher_payment),
        "payload_review": F.when(reviewed, review),
        "metadata_device": F.when(k % 4 == 0, F.lit("mobile"))
        .when(k % 4 == 1, F.lit("desktop"))
        .when(k % 4 == 2, F.lit("tablet")),
        "metadata_os": F.when(k % 3 == 0, F.lit("android")).when(k % 3 == 1, F.lit("ios")),
        "customer_id": _text("cu", k),
        "customer_city": F.when(u % 30 != 0, _text(" ", c("c_city"), " ")),
        "customer_state": F.when(u % 35 != 0, _text(" n", cn)),
        "customer_zip_code": F.when(k % 40 != 0, F.lpad((k % 100000).cast("string"), 5, "0")),
        "customer_latitude": F.when(u % 25 != 0, _text("-", cn, ".5")),
        "customer_longitude": F.when(u % 25 != 0, _text(cn, ".75")),
        "estimated_delivery_date": (od + days(60)).cast("string"),
        "actual_delivery_date": F.when(delivered & (c("o_orderstatus") == "P"), F.lit("")).when(
            delivered, sh.cast("string")
        ),
    }
    return told.select(*[columns[name].alias(name) for name in S.EVENT_COLUMNS])
