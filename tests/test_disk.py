"""What jobs leave on the disks, and passes that keep it small."""

import os
import time

import pytest
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.plans import facts, touched
from starloom.plans.jobs import Calendar, load_staging, rebuild
from starloom.plans.load import Warehouse
from starloom.queries import ORACLES, QUERIES
from starloom.session import materialise, materialise_made, scratch_path, side_by_side, spent_tables
from starloom.sources import Source
from tests.oracle import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def own_scratch(spark, monkeypatch, tmp_path):
    monkeypatch.setattr("starloom.session.scratch_folder", lambda s: str(tmp_path / "scratch"))
    return lambda: sorted(x.rsplit("-", 1)[0] for x in os.listdir(tmp_path / "scratch"))


@pytest.fixture
def small_passes(monkeypatch):
    monkeypatch.setattr(facts, "PASS_LINES", 8)
    monkeypatch.setattr(facts, "_BORDER_IDS", 1 << 20)


def test_shuffle_files_go_with_their_query(spark):
    disks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> int:
        files = disks.getAllFiles()
        return sum(files.apply(i).getName().endswith(".data") for i in range(files.size()))

    before = shuffled()
    for n in (300, 301, 302):
        frame = spark.range(n).repartition(4, "id")
        materialise(frame, "shuffled")
        assert len(frame.collect()) == len(frame.collect()) == n  # the same frame runs again
    for _ in range(50):  # files are removed behind the query
        if shuffled() <= before:
            break
        time.sleep(0.2)
    assert shuffled() <= before


def test_spent_tables_go_and_results_stay(spark, own_scratch):
    def make():
        two = side_by_side([lambda: materialise(spark.range(3), "left"), lambda: materialise(spark.range(2), "right")])
        return two[0].join(two[1], "id")

    with spent_tables(spark):
        kept = materialise_made(make, "joined", plain=True)
        assert own_scratch() == ["joined"] and kept.count() == 2
    assert own_scratch() == []
    assert materialise_made(make, "alone").count() == 2 and own_scratch() == ["alone"]


def test_spent_tables_go_when_a_step_fails(spark, own_scratch):
    with pytest.raises(ZeroDivisionError), spent_tables(spark):
        materialise(spark.range(3), "left")
        1 // 0
    assert own_scratch() == []


def _lists(spark):
    """Orders o0..o29 with up to six lines, orders without id, an order id that heads name twice."""
    def lines(value, turn):
        return spark.range(30).select(F.explode(F.sequence(F.lit(0), F.col("id") % 6)).alias("i"), "id").select(
            F.when(F.col("id") != 17, F.concat(F.lit("ö"), "id")).alias("order_id"), value, F.struct(
                F.lit(0).alias("slice"), F.lit("f").alias("file"), F.lit(0).cast("bigint").alias("block"),
                (F.col("id") * 10 + turn * F.col("i")).cast("bigint").alias("row")).alias(S.POSITION))

    products = lines(F.concat(F.lit("p"), F.col("i") % 4).alias("product_id"), 1)
    prices = lines(F.col("i").cast("decimal(27,10)").alias("price"), -1).withColumn(
        "quantity", F.when(F.length("order_id") != 2, 3))
    dim = spark.createDataFrame([(1, "p0"), (2, "p1"), (3, "p1"), (4, "p2")], "product_key long, product_id string")
    head = spark.range(2, 32).select(
        F.concat(F.lit("ö"), F.when(F.col("id") == 31, 5).otherwise(F.col("id"))).alias("order_id"),
        F.col("id").alias("user_key"), F.lit(1).cast("long").alias("merchant_key"),
        F.lit(None).cast("long").alias("campaign_key"), F.lit(20240101).alias("date_key"))
    return products, prices, dim, head.unionByName(head.limit(1).withColumn("order_id", F.lit(None).cast("string")))


def test_passes_over_orders_number_like_one_pass(spark, own_scratch, small_passes):
    given = _lists(spark)
    whole = facts.fact_order_items(facts.order_items(*given), 5)
    parts = facts.all_order_items(*given, 5)
    layouts = [x for x in own_scratch() if x == "order_item_key"]
    assert len(layouts) == 1 + facts.MOST_PASSES == 4 and "items" not in own_scratch()

    def rows(df):
        # heads of one order differ in their user; which of their lines comes first was never told
        return sorted((tuple(r[c] for c in df.columns if c not in ("order_item_key", "user_key")), r["user_key"])
                      for r in df.collect())

    assert rows(parts) == rows(whole) and whole.count() > 40
    first = [[r["order_id"] for r in df.orderBy("order_item_key").collect()] for df in (whole, parts)]
    assert first[0] == first[1]
    numbers = [r["order_item_key"] for r in parts.orderBy("order_item_key").collect()]
    assert numbers == list(range(5, 5 + len(numbers)))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50])
def test_ranges_deal_every_order_once(spark, small_passes, n):
    ids = ["", "a", "ab", "é", "zz", "10", "9", "\U0001f642", "a", None]
    df = spark.createDataFrame([(x,) for x in ids], "order_id string")
    dealt = [[r["order_id"] for r in df.filter(x).collect()] for x in facts.order_ranges(df, n)]
    assert sorted(x for xs in dealt for x in xs) == sorted(x for x in ids if x is not None)
    in_order = [x.encode() for xs in dealt for x in sorted(xs, key=str.encode)]
    assert in_order == sorted(in_order) and len(dealt) <= n
    assert facts.order_ranges(df.limit(0), 3) and facts.order_ranges(df.filter("order_id IS NULL"), 3)


def test_ranges_deal_every_day_once(spark, small_passes):
    days = [None] * 3 + [20240101] * 20 + [20240102, 20240103, 20231231, 20250101] * 2
    df = spark.createDataFrame([(x,) for x in days], "date_key int")
    dealt = [[r["date_key"] for r in df.filter(x).collect()] for x in facts.day_ranges(df, len(days))]
    assert sorted((x or 0) for xs in dealt for x in xs) == sorted((x or 0) for x in days)
    tops = [max(x or 0 for x in xs) for xs in dealt]
    assert len(dealt) > 1 and tops == sorted(set(tops))


def test_parts_of_a_table_are_one_load(spark):
    wh = Warehouse(spark, scratch_path(spark, "parts"))
    one = spark.createDataFrame([(7, "a"), (9, "b")], "order_key long, order_id string")
    path, n = wh.write("fact_orders", one, one.limit(0), one.limit(1))
    wh.publish({"fact_orders": path})
    assert n == 3 and wh.read("fact_orders").count() == 3 and wh.snapshot()["fact_orders"][0].top == 9


def test_a_rebuild_leaves_nothing_but_its_tables(spark, own_scratch, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    rebuild(wh, Calendar("2024-01-01", "2024-01-31"), by_day=True)
    assert own_scratch() == []
    assert os.listdir(tmp_path / "wh" / "_order_headers") == []


def test_files_may_go_when_their_table_was_read(spark, own_scratch, tmp_path):
    def file(name: str, *rows: str) -> Source:
        (tmp_path / name).write_text("\n".join(rows) + "\n")
        return Source(str(tmp_path / name), "csv")

    sources = {
        "stg_product_list": [file("products.csv", "product_id,product_name,product_type,price", "p1,Pen,a_b,2", ",x,y,1")],
        "stg_user_data": [file("users.csv", "user_id,creation_date,name,street,state,city,country,birthdate,gender,"
                               "device_address,user_type", "u1,2024-01-01,Ann,,,,,,,,", "u1,2024-02-01,Bea,,,,,,,,")],
        "stg_line_item_data_prices": [file("prices.csv", "order_id,price,quantity", "o1,2.5,3")],
    }
    gone = []

    def remove(table):
        gone.append(table)
        for source in sources[table]:
            os.remove(source.path)

    wh = Warehouse(spark, str(tmp_path / "wh"))
    load_staging(wh, sources, remove)
    assert sorted(gone) == sorted(sources) and gone[-1] == "stg_user_data"
    assert own_scratch() == [] and os.listdir(tmp_path / "wh" / "stg_product_list_checked") == []
    assert [r["product_id"] for r in wh.read("stg_product_list").collect()] == ["p1"]
    assert wh.read("stg_product_list_rejects").count() == 1 and wh.read("stg_user_data").count() == 2
    assert wh.read("stg_line_item_data_prices").count() == 1


@pytest.mark.parametrize("name", ["follow_new_orders", "follow_late_campaign"])
def test_followed_batches_in_passes(spark, monkeypatch, small_passes, name):
    monkeypatch.setattr(touched, "LOOKED_UP", 0)
    assert compare(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLES[name]) == []
