"""Batches that change only what they touch, against full rebuilds of the same staging."""

import random

import pytest
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.operators import validate
from starloom.plans import jobs, touched
from starloom.plans.jobs import Batch, Calendar
from starloom.plans.load import Warehouse

CALENDAR = Calendar("2024-01-01", "2024-12-31")


@pytest.fixture
def put(spark, tmp_path):
    def write(header, rows):
        path = tmp_path / f"{len(list(tmp_path.iterdir()))}.csv"
        path.write_text("\n".join([header, *[",".join(map(str, r)) for r in rows]]) + "\n")
        return str(path)

    return write


class Shop:
    """Random batches for one warehouse."""

    def __init__(self, put, seed):
        self.put, self.rng, self.orders = put, random.Random(seed), 0

    def members(self, low, high):
        ids = range(low, high)
        return [
            Batch("stg_user_data", self.put("user_id,creation_date,name,city", [
                (f"U{i}", "2023-01-01", f"name {i}", "Rome") for i in ids]), "test"),
            Batch("stg_product_list", self.put("product_id,product_name,product_type,price", [
                (f"P{i}", f"thing {i}", "toy", i + 0.5) for i in ids]), "test"),
            Batch("stg_campaign_data", self.put(
                "campaign_id,campaign_name,campaign_description,discount",
                [(f"C{i}", f"c {i}", "text", "0.1") for i in ids]), "test"),
            Batch("stg_merchant_data", self.put("merchant_id,creation_date,name", [
                (f"M{i}", "2023-01-01", f"m {i}") for i in ids]), "test"),
            Batch("stg_staff_data", self.put("staff_id,name,creation_date", [
                (f"S{i}", f"s {i}", "2023-01-01") for i in ids]), "test"),
        ]

    def sales(self, n, members, days=300, lines=True):
        rng = self.rng
        ids = range(self.orders, self.orders + n)
        self.orders += n
        pick = lambda letter: f"{letter}{rng.randrange(members)}"
        day = {i: f"2024-{1 + rng.randrange(days) // 28:02d}-{1 + rng.randrange(28):02d}" for i in ids}
        batches = [Batch("stg_order_data", self.put(
            "order_id,user_id,estimated_arrival,transaction_date",
            [(f"O{i}", pick("U"), 3, day[i]) for i in ids])),
            Batch("stg_order_with_merchant_data", self.put("order_id,merchant_id,staff_id", [
                (f"O{i}", pick("M"), pick("S")) for i in ids]), "test"),
            Batch("stg_transactional_campaign_data", self.put(
                "transaction_date,campaign_id,order_id,estimated_arrival,availed",
                [(day[i], pick("C"), f"O{i}", 3, 1) for i in ids if i % 3]))]
        if lines:
            batches += self.lines([f"O{i}" for i in ids], members)
        return batches

    def lines(self, orders, members):
        rng = self.rng
        orders = [o for o in orders for _ in range(rng.randint(0, 3))]
        return [
            Batch("stg_line_item_data_products", self.put("order_id,product_name,product_id", [
                (o, "x", f"P{rng.randrange(members)}") for o in orders]), "test"),
            Batch("stg_line_item_data_prices", self.put("order_id,price,quantity", [
                (o, rng.randrange(1, 50), rng.randrange(1, 5)) for o in orders]), "test")]


def natural(wh):
    """All rows of the facts and dimensions with business keys in place of generated ones."""
    t = {name: wh.read(name, S.STAR[name]) for name in S.STAR}
    found = {}
    for name, df in t.items():
        for key, dim in S.REFERENCES.get(name, {}).items():
            if key in S.GENERATED_KEYS:
                ids = [c for c in S.STAR[dim].fieldNames() if c != key]
                df = df.join(t[dim].select(key, F.struct(*ids).alias(f"of_{dim}")), key, "left").drop(key)
        own = [c for c in df.columns if c not in S.GENERATED_KEYS]
        found[name] = sorted(map(str, df.select(*sorted(own)).collect()))
    return found


def check_keys(wh):
    for name in S.STAR:
        key = S.STAR[name].fieldNames()[0]
        assert wh.read(name).groupBy(key).count().filter("count > 1").count() == 0, name


def rebuilt(spark, wh, tmp_path, name):
    """The star schema of the same staging tables, made from scratch."""
    other = Warehouse(spark, str(tmp_path / name))
    other.full_refresh_all({t: wh.read(t) for t in S.STAGING if wh.exists(t)})
    jobs.rebuild(other, CALENDAR)
    return other


def test_followed_batches_equal_a_rebuild(spark, put, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    shop = Shop(put, 1)
    first = touched.follow(wh, shop.members(0, 6) + shop.sales(40, 8), CALENDAR)
    assert first["days"] is None
    keys = {r["order_id"]: r["order_key"] for r in wh.read("fact_orders").collect()}
    # members that known orders already name, later lines of known orders, new orders
    steps = [shop.members(6, 8) + shop.lines(["O1", "O2", "O39", "O777"], 8), shop.sales(5, 9),
             shop.sales(90, 9, lines=False)]
    for batches in steps:
        done = touched.follow(wh, batches, CALENDAR)
        assert done["days"]
    assert natural(wh) == natural(rebuilt(spark, wh, tmp_path, "other"))
    check_keys(wh)
    now = {r["order_id"]: r["order_key"] for r in wh.read("fact_orders").collect()}
    assert keys.items() <= now.items()
    assert min(now[o] for o in now.keys() - keys.keys()) > max(keys.values())
    assert wh.vacuum() > 0
    check_keys(wh)


def records_read(spark, action):
    """Rows that all stages of an action read from files."""
    store = spark.sparkContext._jsc.sc().statusStore()
    none = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)

    def total():
        stages = store.stageList(None, False, False, none, None)
        return {(stages.apply(i).stageId(), stages.apply(i).attemptId()): stages.apply(i).inputRecords()
                for i in range(stages.size())}

    before = total()
    action()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    return sum(n for k, n in total().items() if k not in before)


def test_small_batch_reads_and_writes_little(spark, put, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    shop = Shop(put, 2)
    touched.follow(wh, shop.members(0, 9) + shop.sales(6000, 9), CALENDAR)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        jobs.rebuild(wh, CALENDAR, by_day=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    batch = shop.sales(2, 9, days=1)
    follow = records_read(spark, lambda: touched.follow(wh, batch, CALENDAR))
    whole = records_read(spark, lambda: jobs.rebuild(wh, CALENDAR))
    assert follow < whole / 3, (follow, whole)
    patch = wh.snapshot()["fact_orders"]
    done = touched.follow(wh, shop.sales(1, 9, days=1), CALENDAR)
    assert done["star"]["fact_orders"] < 6000 / 20
    assert natural(wh) == natural(rebuilt(spark, wh, tmp_path, "other"))
    assert len(patch) == 1


def test_batches_that_touch_nothing(spark, put, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    shop = Shop(put, 3)
    touched.follow(wh, shop.members(0, 3) + shop.sales(5, 3), CALENDAR)
    before = wh.snapshot()
    assert touched.follow(wh, [Batch("stg_order_data", None)], CALENDAR)["days"] == []
    assert wh.snapshot() == before
    # a member nobody names: only its dimension changes
    done = touched.follow(wh, shop.members(7, 8), CALENDAR)
    assert done["star"]["fact_orders"] == 0 and done["days"] == []


def test_days_outside_the_calendar(spark, put, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    shop = Shop(put, 4)
    touched.follow(wh, shop.members(0, 3) + shop.sales(5, 3), CALENDAR)
    header = "order_id,user_id,estimated_arrival,transaction_date"
    late = Batch("stg_order_data", put(header, [("X", "U1", 1, "2031-01-01"), ("Y", "U1", 1, "")]))
    done = touched.follow(wh, [late], CALENDAR, on_orphans="quarantine")
    assert [r["order_id"] for r in wh.read("orphan_orders").collect()] == ["X"]
    assert [r["date_key"] for r in wh.read("fact_orders").filter("order_id = 'Y'").collect()] == [None]
    assert 0 in done["days"]
    before = wh.snapshot()
    bad = Batch("stg_order_data", put(header, [("Z", "U1", 1, "2032-01-01")]))
    with pytest.raises(validate.ConstraintError, match="missing days"):
        touched.follow(wh, [bad], CALENDAR)
    assert wh.snapshot()["fact_orders"] == before["fact_orders"]
    with pytest.raises(ValueError, match="on_orphans"):
        touched.follow(wh, [], CALENDAR, "drop")
