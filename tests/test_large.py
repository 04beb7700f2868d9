"""Steps that must stay cheap per row: generated code of dates, pairs without a second shuffle."""

from datetime import datetime

from pyspark.sql import functions as F

from starloom import functions as fn
from starloom import schemas as S
from starloom.operators import blocks, pairing
from starloom.plans import jobs
from tests.test_blocks import hot_rows, positioned


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dates_fit_a_generated_method(spark):
    """Once, readers of all spellings stood in the projection itself, many thousand characters of it."""
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("2/1/2024 3:04 PM",), ("soon",), (None,)], "d string")
    stamped = df.select(fn.to_stamp(F.col("d")).alias("t"))
    code = stamped._jdf.queryExecution().debug().codegenToSeq().toString()
    assert len(code) < 100_000
    assert [r["t"] for r in stamped.collect()] == [
        datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 2, 1, 15, 4), None, None]


def _lists(spark):
    left = positioned(spark, hot_rows(), ["order_id", "product_id"]).withColumn("product_id", F.col("i"))
    right = positioned(spark, hot_rows(200), ["order_id", "price"]).withColumn("price", F.when(F.col("i") % 5 != 0, F.col("i")))
    return left.drop("i"), right.drop("i")


def _rows(df):
    return sorted(map(tuple, df.select("order_id", "rn", "product_id", "price").collect()), key=str)


def test_pairs_lie_by_order(spark):
    left, right = _lists(spark)
    paired = pairing.pair_lines(left, right)
    assert paired.columns == ["order_id", "rn", "product_id", "price"]
    # one shuffle on the order for both lists, and no join
    assert _plan(paired).count("hashpartitioning(order_id") == 1 and "Join" not in _plan(paired)


def test_busy_orders_are_paired_in_blocks_with_the_same_result(spark, monkeypatch):
    left, right = _lists(spark)
    want = _rows(pairing._pair_huge(left, right, "order_id"))
    assert len(want) > 100 and _rows(pairing.pair_lines(left, right)) == want
    monkeypatch.setattr(blocks, "BUSY", 50)
    assert len(blocks.busy_buckets(left, "order_id")) == 1
    some = pairing.pair_lines(left, right)
    assert "_block" in _plan(some) and _rows(some) == want
    monkeypatch.setattr(blocks, "BUSY", 0)
    assert _rows(pairing.pair_lines(left, right)) == want


def test_orders_are_not_gone_through_without_repeated_links(spark):
    # a missing id is no repeated order; the frame of orders would fail if it were looked at
    links = spark.createDataFrame([("A",), ("B",), (None,), (None,)], "order_id string")
    orders = links.withColumn("order_id", F.raise_error(F.lit("orders were read")).cast("string"))
    jobs.refuse_repeated_orders(orders, links, "links")


def test_generated_methods_stay_below_the_limit_of_the_jvm(spark):
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    assert S.POSITION not in pairing.pair_lines(*_lists(spark)).columns
