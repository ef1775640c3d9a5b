"""Hand-made event rows."""

from cartlake import schemas as S

DEFAULTS = {
    "event_id": "e1", "event_type": "order.created", "timestamp": "2024-01-01T00:00:00+00:00",
    "user_id": "u1", "order_id": "o1", "customer_id": "c1",
}


def events(spark, *rows):
    full = [{**DEFAULTS, **row} for row in rows]
    return spark.createDataFrame([tuple(r.get(c) for c in S.EVENT_COLUMNS) for r in full], S.EVENT)


def item(**fields):
    import json

    base = {"product_id": "p1", "price": 10.0, "freight_value": 2.5, "seller_id": "s1"}
    return json.dumps([{**base, **fields}])
