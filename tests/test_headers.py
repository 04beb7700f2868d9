import pytest

from starloom import schemas as S
from starloom.operators import headers as h


def frame(spark, *names):
    return spark.createDataFrame([tuple(range(len(names)))], list(names))


def test_junk_columns(spark):
    df = frame(spark, "Unnamed: 0", "unnamed", "_c0", "order_id", "_c0x")
    assert h.drop_junk_columns(df).columns == ["order_id", "_c0x"]


def test_normalise_all_and_targets(spark):
    df = frame(spark, " Order ID ", "Other Name")
    assert h.normalise_headers(df).columns == ["order_id", "other_name"]
    assert h.normalise_headers(df, ["order_id"]).columns == ["order_id", "Other Name"]


def test_colliding_headers_are_refused(spark):
    with pytest.raises(ValueError, match="order_id"):
        h.normalise_headers(frame(spark, "Order ID", "order_id"))


def test_fuzzy_first_rule_wins(spark):
    df = frame(spark, "Estimated order id", "the Order no Id", "TRANSACTION", "misc")
    assert h.fuzzy_headers(df).columns == [
        "estimated_arrival", "order_id", "transaction_date", "misc"]


@pytest.mark.parametrize("name, expected", [
    ("Order ID", "order_id"), ("2nd", "_2nd"), ("", "col"), ("a-b.c", "a_b_c"), ("é", "_")])
def test_safe_identifier(name, expected):
    assert h.safe_identifier(name) == expected


def test_sanitised_names_stay_unique(spark):
    assert h.sanitise_identifiers(frame(spark, "a b", "a-b", "a_b_2")).columns == [
        "a_b", "a_b_2", "a_b_2_2"]


def test_required_columns(spark):
    with pytest.raises(ValueError, match="user_id"):
        h.require_columns(frame(spark, "order_id"), ["order_id", "user_id"])


def test_fill_and_conform(spark):
    schema = S.STAGING["stg_order_delays"]
    df = spark.createDataFrame([("", "x"), ("A", "3")], ["order_id", "delay_in_days"])
    out = h.conform(df, schema, ())
    assert out.schema == schema
    assert [tuple(r) for r in out.collect()] == [(None, None), ("A", 3)]
    filled = h.fill_missing_columns(df.select("order_id"), schema)
    assert filled.schema["delay_in_days"].dataType == schema["delay_in_days"].dataType


def test_union_by_name_text(spark):
    out = h.union_by_name_text([frame(spark, "a", "b"), frame(spark, "b", "c")])
    assert out.columns == ["a", "b", "c"]
    assert {t for _, t in out.dtypes} == {"string"}
    assert sorted(map(tuple, out.collect()), key=str) == [("0", "1", None), (None, "0", "1")]
