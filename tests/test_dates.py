"""Dates by shape, the order of day and month by column, and printed floats."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom import functions as fn
from starloom.functions.dates import Votes, settle_day_order, vote
from starloom.plans import jobs
from starloom.plans.jobs import Batch
from starloom.plans.load import Warehouse
from starloom.sources import Source
from tests.test_scalars import apply

D = datetime
SPELLINGS = {
    "01-02-2024": D(2024, 1, 2), "2024.01.02": D(2024, 1, 2), "1/2/24": D(2024, 1, 2),
    "1/2/70": D(1970, 1, 2), "2024-01-02 03:04:05 PM": D(2024, 1, 2, 15, 4, 5),
    "1/2/2024 3:04 PM": D(2024, 1, 2, 15, 4), "1/2/2024 12:04 am": D(2024, 1, 2, 0, 4),
    "Jan 2, 2024 10:00": D(2024, 1, 2, 10), "Tue, 02 Jan 2024": D(2024, 1, 2),
    "2 September 2024, 9:05": D(2024, 9, 2, 9, 5), "13/2/2024": D(2024, 2, 13),
    "2024-01-02T03:04:05+02:00": D(2024, 1, 2, 1, 4, 5),
    "2024-01-02 23:30:00-0130": D(2024, 1, 3, 1), "2024-01-02T03:04:05.25Z": D(2024, 1, 2, 3, 4, 5, 250000),
    "2024-01-02 3:04": D(2024, 1, 2, 3, 4), "2024-01-02": D(2024, 1, 2),
    "2/30/2024": None, "13/13/2024": None, "1/2/2024 13:04 PM": None, "Foo 2, 2024": None,
    "1-2/2024": None, "": None, "2024-01-02T25:00:00+02:00": None, "soon": None,
}


def test_spellings(spark):
    assert dict(zip(SPELLINGS, apply(spark, fn.to_stamp, list(SPELLINGS)))) == SPELLINGS


def test_columns_vote(spark):
    df = spark.createDataFrame(
        [("13-02-2024", "2-13-2024", "13/1/24", "1/2/2024"), ("01-02-2024", "1-2-2024", "1/13/24", None),
         (None, "soon", "3/3/24", "2024-01-02")], "d string, m string, both string, none string")
    assert vote(df, df.columns) == {
        "d": Votes(1, 0, 1), "m": Votes(0, 1, 1), "both": Votes(1, 1, 0), "none": Votes(0, 0, 1)}
    rows = settle_day_order(df, [*df.columns, "missing"]).select(
        *[fn.to_stamp(F.col(c)).alias(c) for c in df.columns]).collect()
    assert [r["d"] for r in rows] == [D(2024, 2, 13), D(2024, 2, 1), None]
    assert [r["m"] for r in rows] == [D(2024, 2, 13), D(2024, 1, 2), None]
    assert [r["both"] for r in rows] == [D(2024, 1, 13), D(2024, 1, 13), D(2024, 3, 3)]


def test_undecidable_column_is_refused(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    path = tmp_path / "orders.csv"
    path.write_text("order_id,user_id,estimated_arrival,Transaction Date\n"
                    "A,U,1,13-02-2024\nB,U,1,02-13-2024\nC,U,1,01-02-2024\n")
    with pytest.raises(fn.UndecidedDates, match="day_first=1, month_first=1, either=1"):
        jobs.append_batch(wh, Batch("stg_order_data", str(path)))
    path.write_text("order_id,user_id,estimated_arrival,Transaction Date\n"
                    "A,U,1,13-02-2024\nC,U,1,01-02-2024\n")
    jobs.append_batch(wh, Batch("stg_order_data", str(path)))
    assert {r["order_id"]: r["transaction_date"] for r in wh.read("stg_order_data").collect()} == {
        "A": D(2024, 2, 13), "C": D(2024, 2, 1)}


def test_printed_floats_are_the_numbers_of_their_source(spark):
    texts = ["0.30000000000000004", "19.989999999999998", "0.1234567890123", "12345678.123456789",
             "0.12345678901234567", "1e-11", "100.00000000000001", "3.0E-1", "12.5"]
    # the last digits of the fifth are no noise, and 18 digits are no float
    texts.append("0.300000000000000044")
    found = apply(spark, fn.decimal_from_text, texts)
    assert found == [Decimal("0.3"), Decimal("19.99"), None, Decimal("12345678.123456789"), None,
                     None, Decimal("100"), Decimal("0.3"), Decimal("12.5"), None]
    assert apply(spark, fn.inexact_number, texts) == [v is None for v in found]
    assert apply(spark, fn.decimal_from_text, [0.1 + 0.2, 19.989999999999998], "double") == [
        Decimal("0.3"), Decimal("19.99")]


def test_prices_and_discounts_that_cannot_be_stored_are_shown(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    prices, campaigns = tmp_path / "p.csv", tmp_path / "c.csv"
    prices.write_text("order_id,price,quantity\nA,1.5,1\nA,0.1234567890123,2\nA,free,3\n")
    campaigns.write_text("campaign_id,campaign_name,campaign_description,discount\n"
                         "C,c,d,0.1234567890123%\nE,e,d,5pct\n")
    done = jobs.load_staging(wh, {
        "stg_line_item_data_prices": [Source(str(prices))], "stg_campaign_data": [Source(str(campaigns))]})
    assert done["stg_line_item_data_prices"]["rows_loaded"] == 3
    assert [(r["raw_price"], r["reject_reasons"]) for r in wh.read(
        "stg_line_item_data_prices_rejects").collect()] == [("0.1234567890123", "inexact_price")]
    assert [(r["campaign_id"], r["raw_discount"], r["reject_reasons"]) for r in wh.read(
        "stg_campaign_data_rejects").collect()] == [("C", "0.1234567890123%", "inexact_discount")]
    assert wh.read("stg_campaign_data").count() == 2
