from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import functions as fn


def apply(spark, expr, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in rows.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize("expr, values, expected", [
    (fn.clean_id, [" A1 ", "", "NaN", "none", "\tB\n", None], ["A1", None, None, None, "B", None]),
    (fn.trim_ws, ["　x ", " a b ", "\n"], ["x", "a b", ""]),
    (fn.spaced_lower, ["Readymade_Food ", None], ["readymade food", None]),
    (fn.digits_to_int, ["15days", "-3", "1.5 days", "none", "2147483647", "2147483648", ""],
     [15, 3, 15, None, 2147483647, None, None]),
    (fn.digits_to_int, ["999999999", "9999999999", "99999999999999999999", "0" * 30 + "7", None],
     [999999999, None, None, 7, None]),
    (fn.digits_only, ["+1 (23) 4", "none", None], ["1234", None, None]),
    (fn.discount, ["1%", "10%%", "5pct", "0.20", "1.2.3", "free"],
     [Decimal("1"), Decimal("10"), Decimal("5"), Decimal("0.2"), None, None]),
    (fn.decimal_from_text, ["12.50", "free", "inf", "-inf", "nan", " 3 ", None],
     [Decimal("12.5"), None, None, None, None, Decimal("3"), None]),
    (fn.to_stamp, ["2023-07-01 12:00:00", "2023-07-02", "not-a-date", None],
     [datetime(2023, 7, 1, 12), datetime(2023, 7, 2), None, None]),
    (fn.to_date_lenient, ["1990-01-31", "1990-01-31 10:00:00", "x"],
     [date(1990, 1, 31), date(1990, 1, 31), None]),
    (fn.flag_int, ["1", "0", "1.0", "yes", None], [1, 0, 1, 0, 0]),
    (fn.flag_is_true, ["True", "FALSE", None], [True, False, False]),
    (fn.null_tokens, ["N/A", "null", "n", " N/A", ""], [None, None, "n", " N/A", None]),
    (fn.strip_quotes, ['"""a"" - b"'], ["a - b"]),
    (lambda c: fn.default_text(c, "N/A"), ["x", None], ["x", "N/A"]),
])
def test_text_rules(spark, expr, values, expected):
    assert apply(spark, expr, values) == expected


def test_numeric_arrivals_are_numbers(spark):
    expr = lambda c: fn.digits_to_int(c, T.DoubleType())
    assert apply(spark, expr, [15.0, 3e12, None], "double") == [15, None, None]


def test_date_key(spark):
    values = [datetime(2025, 1, 5, 10), None]
    assert apply(spark, fn.date_key, values, "timestamp_ntz") == [20250105, None]
