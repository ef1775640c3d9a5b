"""The one-pass parse must give what one path getter per field gives, for scalars; nested values are null."""

import json

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from cartlake import schemas as S
from cartlake.functions.payload import repair_quotes, spread_first_element, spread_object

ODD_ARRAYS = [
    "[]", "x", "", "null", '{"price":3}', ' [{"price":1}]', '[{"price":1},5]', '[5,{"price":1}]',
    "[null]", '[{"price":{"a":1}}]', '[{"price":NaN}]', '[{"price":2},{"price":"x" y}]',
    '[{"price":2} tail', '[{"price":2}] tail', '[{"price":true,"seller_id":7}]',
    "[{'price': 'it's'}]", "[{'price': None}]", "[{'price': 1.5, 'seller_id': 's'}]",
    '[[{"price":1}]]', '[{"PRICE":1}]', '[{"price":"a\tb"}]', '[{"price":"\\u00e9"}]',
]
ODD_OBJECTS = [
    "{}", "x", '{"review_id":{"a":1},"review_score":[2],"review_comment_title":"[x]: {y}"}', '[{"review_id":"a"}]', '{"review_id":"it"s"}', "{'review_id': 'a', 'review_score': 3}",
    '{"review_score": 5} tail', '{"review_score"', '{"review_id": ["a"]}', "{'review_id': 'd'agua'}",
]


def nested(text, prefix):
    """Fields of the record that hold an object or an array."""
    try:
        record = json.loads(text.replace("'", '"'), strict=False)
        record = record[0] if prefix == "$[0]" else record
        return {k for k, v in record.items() if isinstance(v, (dict, list))}
    except (ValueError, LookupError, AttributeError, TypeError):
        return set()


def assert_same_as_paths(spark, texts, spread, fields, prefix):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, j string")
    fast = spread(df, "j", fields).drop("j").orderBy("i").collect()
    fixed = repair_quotes(F.col("j"))
    paths = [F.get_json_object(fixed, f"{prefix}.{n}").alias(n) for n in fields.names]
    slow = df.select("i", *paths).orderBy("i").collect()
    for f, s in zip(fast, slow, strict=True):
        gone = dict.fromkeys(nested(texts[f["i"]], prefix) & set(fields.names))
        assert f.asDict() == s.asDict() | gone, texts[f["i"]]


def test_odd_arrays(spark):
    assert_same_as_paths(spark, ODD_ARRAYS, spread_first_element, S.ITEM, "$[0]")


def test_odd_objects(spark):
    assert_same_as_paths(spark, ODD_OBJECTS, spread_object, S.REVIEW, "$")


values = st.one_of(
    st.none(), st.booleans(), st.integers(-(10**6), 10**6), st.text(max_size=8),
    st.floats(-1e6, 1e6).map(lambda x: round(x, 2)), st.lists(st.integers(0, 9), max_size=2),
)


def records(fields):
    return st.dictionaries(st.sampled_from(fields.names), values, max_size=5)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(st.one_of(records(S.ITEM), st.integers(0, 9)), max_size=3), min_size=20, max_size=40
    )
)
def test_any_array(spark, payloads):
    texts = [json.dumps(p, ensure_ascii=False) for p in payloads]
    assert_same_as_paths(spark, texts, spread_first_element, S.ITEM, "$[0]")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(records(S.REVIEW), min_size=20, max_size=40))
def test_any_object(spark, payloads):
    texts = [json.dumps(p, ensure_ascii=False) for p in payloads]
    assert_same_as_paths(spark, texts, spread_object, S.REVIEW, "$")


def test_lenient_reads_apostrophes(spark):
    texts = ['{"review_id": "it\'s"}', "{'review_id': 'a'}"]
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    strict = [r["review_id"] for r in spread_object(df, "j", S.REVIEW).collect()]
    lenient = [r["review_id"] for r in spread_object(df, "j", S.REVIEW, lenient=True).collect()]
    assert strict == [None, "a"]
    assert lenient == ["it's", "a"]


def test_a_repeated_key_gives_its_last_value(spark):
    df = spark.createDataFrame([('{"review_id": "a", "review_id": "b"}',)], "j string")
    assert spread_object(df, "j", S.REVIEW).first()["review_id"] == "b"
    df = spark.createDataFrame([('[{"price": 1, "price": 2}]',)], "j string")
    assert spread_first_element(df, "j", S.ITEM).first()["price"] == "2"


def test_texts_that_look_nested_stay(spark):
    df = spark.createDataFrame([('[{"price": "{1}", "seller_id": "a: [b", "seller_city": {"x": 1}}]',)], "j string")
    row = spread_first_element(df, "j", S.ITEM).first()
    assert (row["price"], row["seller_id"], row["seller_city"]) == ("{1}", "a: [b", None)


def test_each_payload_is_parsed_once(spark):
    df = spark.createDataFrame([("[]",)], "j string")
    plan = spread_object(df, "j", S.REVIEW).where("review_id = 'a' AND review_score = '1'")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1
