"""What a rebuild and a followed batch go through for every line and order."""

import glob
import re
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starloom import functions as fn
from starloom import schemas as S
from starloom.operators import pairing, validate
from starloom.plans.load import Warehouse
from starloom.session import materialise, scratch_path


def _lists(spark, products: int, prices: int):
    """Orders k = 0..40 with k % products product lines and k % prices price lines, out of order."""
    def lines(most: int, value: str):
        return spark.range(41).select(F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("i"), "id").filter(
            F.col("i") < F.col("id") % most).select(
            F.when(F.col("id") != 40, F.concat(F.lit("o"), "id")).alias("order_id"),
            F.concat(F.lit(value), "i").alias(value), F.struct(
                (F.col("i") % 2).cast("int").alias("slice"), F.lit("f").alias("file"),
                F.lit(0).cast("bigint").alias("block"), (-F.col("i")).cast("bigint").alias("row"),
            ).alias(S.POSITION)).repartition(5)

    return lines(products, "product_id"), lines(prices, "price")


@pytest.mark.parametrize("sizes", [(7, 5), (5, 7), (1, 4), (4, 4)])
def test_pairs_with_gaps_on_either_side(spark, sizes):
    left, right = _lists(spark, *sizes)

    def numbered(df, value):
        found = {}
        for r in df.filter("order_id IS NOT NULL").orderBy(S.POSITION).collect():
            found.setdefault(r["order_id"], []).append(r[value])
        return found

    ours, theirs = numbered(left, "product_id"), numbered(right, "price")
    want = sorted((k, n, a, b) for k in ours for n, (a, b) in enumerate(zip(ours[k], theirs.get(k, [])), 1))
    got = pairing.pair_lines(left, right).select("order_id", "rn", "product_id", "price")
    assert sorted(tuple(r) for r in got.collect()) == want


def test_lines_meet_in_one_group_per_order(spark):
    plan = pairing._pair_small(*_lists(spark, 7, 5), "order_id")._jdf.queryExecution().optimizedPlan().toString()
    keys = [re.sub(r"#\d+", "", k) for k in re.findall(r"Window \[.*?\], \[([^\[\]]*)\], \[", plan)]
    assert "order_id" in keys and not any("rn" in k for k in keys), plan


def _encodings(path: str, column: str) -> set[str]:
    found = set()
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                if meta.row_group(g).column(c).path_in_schema == column:
                    found.update(meta.row_group(g).column(c).encodings)
    return found


def test_plain_tables_and_order_ids_have_no_dictionary(spark):
    rows = spark.range(100).select(F.col("id").cast("string").alias("order_id"), F.lit("a").alias("x"))
    plain = materialise(rows, "plain", plain=True)
    path = plain.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert plain.count() == 100 and not any("DICT" in e for e in _encodings(path, "x"))
    path, n = Warehouse(spark, scratch_path(spark, "plain-ids")).write("some", rows)
    assert n == 100 and not any("DICT" in e for e in _encodings(path, "order_id"))
    assert any("DICT" in e for e in _encodings(path, "x"))


def test_exact_report_is_left_to_columns_in_doubt(spark, monkeypatch):
    asked = []
    report = validate.key_violations
    monkeypatch.setattr(validate, "key_violations", lambda df, t, unique, not_null=(): (
        asked.append(list(unique)), report(df, t, unique, not_null))[1])
    rows = spark.createDataFrame([("1", "a"), ("2", "a"), (None, None), (None, "b")], "id string, x string")
    validate.refuse_bad_keys(rows, "t", ["id"])
    assert asked == []
    with pytest.raises(validate.ConstraintError, match="not_unique.*'a'.*2"):
        validate.refuse_bad_keys(rows, "t", ["id", "x"])
    assert asked == [["x"]]
    with pytest.raises(validate.ConstraintError, match="null"):
        validate.refuse_bad_keys(rows, "t", ["id"], ["id"])


def test_decimals_as_if_read_twice(spark):
    texts = ["1", "0.1", " 2.50 ", "-7.1234567890", "0.1234567890123", "0.10000000000000000000000004",
             "0.00000000000000000000009", "99999999999999999.9999999999", "99999999999999999.99999999999",
             "999999999999999999", "1e3", "1e-10", "1e-11", "1e30", "-0", "", "x", None, "12345678901234567890.5"]
    read = spark.createDataFrame([(t,) for t in texts], "t string").repartition(3)
    money = F.trim("t").try_cast(S.MONEY)
    twice = F.when(money == F.trim("t").try_cast(S.WIDE_NUMBER), money)
    got = read.select("t", fn.scalar._exact(F.trim("t")).alias("a"), twice.alias("b")).collect()
    assert len(got) == len(texts) and [r["a"] for r in got] == [r["b"] for r in got]
    assert {r["t"]: r["a"] for r in got}["0.1"] == Decimal("0.1")
