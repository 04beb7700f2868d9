"""Load modes and the four batch scenarios on small files written out as text."""

import itertools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.operators import validate
from starloom.plans import dims, facts, jobs, staging
from starloom.plans.jobs import Batch
from starloom.plans.load import Warehouse
from starloom.sources import Source, read_csv

_count = itertools.count()

# Own rows. A day gets new orders; a campaign, its link and its order arrive late; three batches
# hold one fault of each rule beside sound rows.
NEW_DAY = 20220317
NEW_ORDERS = """order_id,user_id,estimated_arrival,transaction_date
n71,u5,12 days,2022-03-17 23:59:59
n70,u5,1 days,2022-03-17
n72,u8,30days,2022-03-17 00:00:01
n73,u9,2 days,2022-03-18 06:30:00
"""
LATE_CAMPAIGN = """campaign_id,campaign_name,description,discount
spring-late,Blossom,found in a drawer,0.35
"""
LATE_LINK = """Transaction_date,Campaign_id,Order_id,Estimated_arrival,Availed
2023-04-09,spring-late,late-1,8,0
"""
LATE_ORDER = """order_id,user_id,estimated_arrival,transaction_date
late-1,u77,8 days,2023-04-09 21:05:00
"""
DIRTY_ORDERS = """Order_id,User_id,Estimated_arrival,Transaction_date
k1,a,soon,2022-06-01
k2,nan,4,2022-06-01
k3,b,21 days,06/02/2022
k4,c,88888888888,2022-06-03
none,d,2,2022-06-03
k5,e,6days,31st of June
k6,f,0,2022-06-04 10:11:12
k6,f,0,2022-06-04 10:11:12
"""
DIRTY_PRODUCTS = """Product_id,Product_name,Product_type,Price
q9,Kettle,steel_ware,1e400
q8, Lamp,light_and_sound,0.123456
q7,Rope,outdoor,0.12345678901
,Nameless,outdoor,3
q6,Tent,outdoor,on request
q5,Stove,outdoor,-4.5
q4,Mug,steel_ware,17
"""
DIRTY_LINES = """Order_id,Product_name,Product_id
k3,Mug,q4
,Mug,q4
k3,Lamp,
k6,Lamp,q8
k3,Mug,q4
"""


@pytest.fixture
def put(tmp_path):
    def write(text, ext="csv"):
        path = tmp_path / f"f{next(_count)}.{ext}"
        path.write_text(text, encoding="utf-8")
        return str(path)
    return write


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def base_sources(put):
    people = "creation_date,name,street,state,city,country,contact_number"
    return {
        "stg_order_data": [Source(put(
            "Unnamed: 0,order_id,user_id,estimated arrival,transaction_date\n"
            "0,O1,U1,3days,2021-05-01\n1,O2,U2,4days,2021-05-01 08:00:00\n1,O2,U2,4days,2021-05-01 08:00:00\n"
            "2,O3,U9,1days,2021-05-02\n3,nan,U1,1days,2021-05-02\n")),
            Source(put('[{"order_id":"O4","user_id":"U1","estimated_arrival":7.0,'
                       '"transaction_date":"2021-06-01"}]', "json"),
                   columns=("order_id", "user_id", "estimated_arrival", "transaction_date"),
                   options={"multi_line": True})],
        "stg_order_delays": [Source(put(
            "<table><tr><th></th><th>order_id</th><th>delay in days</th></tr>"
            "<tr><td>0</td><td>O1</td><td>2</td></tr></table>", "html"),
            columns=("order_id", "delay_in_days"))],
        "stg_line_item_data_products": [Source(put(
            "order_id,product_name,product_id\nO1,pan,P1\nO1,pot,P2\nO2,pan,P1\nO1,pan,P1\nO4,cup,P8\n"))],
        "stg_line_item_data_prices": [
            Source(put("order_id,price,quantity\nO1,2.5,2pieces\nO2,3,1px\n")),
            Source(put("order_id,price,quantity\nO1,10,3PC\nO3,1,1\n"))],
        "stg_order_with_merchant_data": [Source(put(
            "order_id,merchant_id,staff_id\nO1,M1,S1\nO2,M7,S1\n"))],
        "stg_campaign_data": [Source(put(
            "\tcampaign_id\tcampaign_name\tcampaign_description\tdiscount\n"
            '0\tC1\tone\t"""First."" - A B"\t10%%\n'), "tab_packed",
            tuple(S.STAGING["stg_campaign_data"].fieldNames()))],
        "stg_transactional_campaign_data": [Source(put(
            "Unnamed: 0,transaction_date,campaign_id,order_id,estimated arrival,availed\n"
            "0,2021-05-01,C1,O1,3days,1\n1,2021-05-01,C1,O2,3days,0\n2,2021-05-02,C1,O3,3days,\n"))],
        "stg_user_data": [Source(put(
            '{"user_id":{"0":"U1","1":"U2","2":"U1"},'
            '"creation_date":{"0":"2020-01-01","1":"2020-01-01","2":"2021-01-01"},'
            '"name":{"0":" Old ","1":"Two","2":" One "},"street":{},"state":{},"city":{"2":"Here"},'
            '"country":{},"birthdate":{"2":"1990-01-01 00:00:00"},"gender":{},"device_address":{},'
            '"user_type":{}}', "json"), "json_columnar",
            tuple(S.STAGING["stg_user_data"].fieldNames()[:11]))],
        "stg_user_job": [Source(put(
            "user_id,name,job_title,job_level\nU1,One,clerk,L1\nU1,One,chief,N/A\n"))],
        "stg_user_credit_card": [Source(put(
            "user_id,name,credit_card_number,issuing_bank\nU1,One,4000,Bank\n"))],
        "stg_product_list": [Source(put(
            "product_id,product_name,product_type,price\nP1, PAN ,kitchen_ware,5\nP2,pot,x,6\n"
            "P2,pot,x,6\nP3,bad,x,free\n"))],
        "stg_merchant_data": [Source(put(f"merchant_id,{people}\nM1,2020-01-01,Shop,s,st,c,co,+1 2-3\n"))],
        "stg_staff_data": [Source(put(f"staff_id,job_level,{people}\nS1,L1,2020-01-01,Sam,s,st,c,co,12\n"))],
    }


def test_refresh_all(spark, put, tmp_path):
    done = jobs.refresh_all(spark, str(tmp_path / "wh"), base_sources(put))
    assert {t: r["rows_loaded"] for t, r in done["staging"].items()}["stg_order_data"] == 4
    assert done["star"]["dim_date"] == 4018
    wh = Warehouse(spark, str(tmp_path / "wh"))
    assert rows(wh.read("dim_user").select(
        "user_key", "source_user_id", "name", "city", "job_title", "job_level")) == [
        (1, "U1", "One", "Here", "chief", "N/A"), (2, "U2", "Two", None, None, None)]
    assert rows(wh.read("dim_campaign").drop("campaign_key")) == [
        ("C1", "one", "First. - A B", Decimal("10.0000"))]
    assert rows(wh.read("dim_product").select("product_id", "product_name", "product_type")) == [
        ("P1", "pan", "kitchen ware"), ("P2", "pot", "x")]
    # O1 has three product lines but two price lines; O4's product is unknown
    assert rows(wh.read("fact_order_items").select(
        "order_item_key", "order_id", "product_key", "quantity", "total_price")) == [
        (1, "O1", 1, 2, Decimal("5.0000")), (2, "O1", 2, 3, Decimal("30.0000")),
        (3, "O2", 1, 1, Decimal("3.0000"))]
    assert rows(wh.read("fact_orders")) == [
        (1, "O1", 1, 1, 1, 1, 20210501, 2, Decimal("35.0000")),
        (2, "O2", 2, None, 1, 1, 20210501, None, Decimal("3.0000")),
        (3, "O3", None, None, None, 1, 20210502, None, Decimal("0.0000")),
        (4, "O4", 1, None, None, None, 20210601, None, Decimal("0.0000"))]
    assert rows(wh.read("fact_campaign_performance")) == [
        (1, 1, 20210501, 2, Decimal("38.0000"), Decimal("19.00000000"), 2),
        (2, 1, 20210502, 1, Decimal("0.0000"), Decimal("0E-8"), 0)]
    # scenario 1: the new day has its orders
    jobs.run_scenario(wh, [Batch("stg_order_data", put(NEW_ORDERS))])
    assert jobs.orders_on_day(wh.read("fact_orders"), NEW_DAY).first()["n_orders"] == 3
    # scenario 3: attribution resolves although nobody knows the user
    jobs.run_scenario(wh, [
        Batch("stg_campaign_data", put(LATE_CAMPAIGN)),
        Batch("stg_transactional_campaign_data", put(LATE_LINK)),
        Batch("stg_order_data", put(LATE_ORDER))])
    late = wh.read("dim_campaign").filter("campaign_id = 'spring-late'").first()
    assert late["discount"] == Decimal("0.35")
    got = wh.read("fact_campaign_performance").filter(F.col("campaign_key") == late["campaign_key"])
    assert rows(got.drop("campaign_perf_key", "campaign_key")) == [
        (20230409, 1, Decimal("0.0000"), Decimal("0E-8"), 0)]


def test_new_entities(wh, put):
    batches = [
        Batch("stg_user_data", put(
            "User_id,Creation_date,Name,Street,State,City,Country,Birthdate,Gender,Device_address,"
            "User_type,Possible_duplicate\nhand-u,2021-09-30,Quill,Dock 4,N,Port,Isle,"
            "1971-12-24,male,ff:01,trial,False\n"), "test"),
        Batch("stg_user_job", put(
            "User_id,Name,Job_title,Job_level,Possible_duplicate\n"
            "hand-u,Quill,Diver,L7,False\n"), "test"),
        Batch("stg_product_list", put(
            "Product_id,Product_name,Product_type,Price\nhand-p,Fins,Sea Gear,7.25\n"),
            "test"),
        Batch("stg_order_data", put(
            "Order_id,User_id,Estimated_arrival,Transaction_date\n"
            "hand-o,hand-u,11,2021-10-02 04:00:00\n"), "test"),
        Batch("stg_line_item_data_products", put(
            "Order_id,Product_name,Product_id\nhand-o,Fins,hand-p\n"), "test"),
        Batch("stg_line_item_data_prices", put(
            "Order_id,Price,Quantity\nhand-o,7.25,6\n"), "test"),
        Batch("stg_order_with_merchant_data", put(
            "Order_id,Merchant_id,Staff_id\nhand-o,nobody,no one\n"), "test"),
    ]
    jobs.run_scenario(wh, batches)
    assert rows(wh.read("fact_orders")) == [
        (1, "hand-o", 1, None, None, None, 20211002, None, Decimal("43.5"))]
    user = wh.read("dim_user").first()
    assert (user["source_user_id"], user["job_title"], user["job_level"]) == (
        "hand-u", "Diver", "L7")
    assert str(user["birthdate"]) == "1971-12-24"


def test_dirty_batches(spark, wh, put):
    wh.full_refresh("stg_order_data", staging.stage_orders([read_csv(spark, put(
        "order_id,user_id,estimated_arrival,transaction_date\nk3,z,1,2019-01-01\n"))]))
    orders = jobs.append_batch(wh, Batch("stg_order_data", put(DIRTY_ORDERS), "dirty"))
    assert (orders["rows_loaded"], orders["rows_rejected"]) == (1, 7)
    rejects = wh.read("stg_order_data_rejects")
    assert rows(rejects.select("order_id", validate.REASONS)) == sorted([
        (None, "missing_order_id"), ("k1", "bad_estimated_arrival"), ("k2", "missing_user_id"),
        ("k3", "duplicate_key"), ("k4", "bad_estimated_arrival"), ("k5", "bad_transaction_date"),
        ("k6", "duplicate_key")], key=str)
    products = jobs.append_batch(wh, Batch("stg_product_list", put(DIRTY_PRODUCTS), "dirty"))
    assert (products["rows_loaded"], products["rows_rejected"]) == (3, 4)
    assert rows(wh.read("stg_product_list_rejects").select("product_id", validate.REASONS)) == sorted([
        (None, "missing_product_id"), ("q9", "bad_price"), ("q7", "inexact_price"),
        ("q6", "bad_price")], key=str)
    assert (" Lamp", "light_and_sound", Decimal("0.123456")) in rows(
        wh.read("stg_product_list").select("product_name", "product_type", "price"))
    lines = jobs.append_batch(wh, Batch("stg_line_item_data_products", put(DIRTY_LINES), "dirty"))
    assert (lines["rows_loaded"], lines["rows_rejected"]) == (3, 2)
    assert wh.read("stg_line_item_data_products").columns == [
        "order_id", "product_name", "product_id", S.POSITION]


def test_quarantine_first_row_wins_and_nothing_is_lost(spark, put):
    text = "order_id,user_id,estimated_arrival,transaction_date\n" + "".join(
        f"{'hot' if i % 3 else f'k{i}'},U{i},{'x' if i < 3 else 1},2020-01-01\n" for i in range(90))
    judged = validate.flag_key_conflicts(
        staging.check_orders(read_csv(spark, put(text))), "order_id",
        spark.createDataFrame([("k9",)], "order_id string"))
    got = {r["user_id"]: r[validate.REASONS] for r in judged.collect()}
    assert len(got) == 90
    assert [u for u, r in got.items() if r == "bad_estimated_arrival"] and got["U9"] == "duplicate_key"
    assert got["U4"] == "" and got["U5"] == "duplicate_key"
    assert sum(r == "" for r in got.values()) == 1 + 30 - 2


def test_append_refuses_known_and_repeated_keys(spark, wh, put):
    first = Batch("stg_order_data", put(LATE_ORDER))
    assert jobs.append_batch(wh, first)["rows_loaded"] == 1
    with pytest.raises(validate.ConstraintError, match="already loaded"):
        jobs.append_batch(wh, first)
    twice = put(LATE_ORDER.replace("late", "twice") + LATE_ORDER.replace("late", "twice").split("\n")[1] + "\n")
    with pytest.raises(validate.ConstraintError, match="not_unique"):
        jobs.append_batch(wh, Batch("stg_order_data", twice))
    assert wh.read("stg_order_data").count() == 1


def test_empty_and_absent_batches(wh, put):
    assert jobs.append_batch(wh, Batch("stg_order_data", None))["rows_loaded"] == 0
    landed = Batch("stg_product_list", None, default=put("product_id,product_name,product_type,price\nd1,Dust,x,2\n"))
    assert jobs.append_batch(wh, landed)["rows_loaded"] == 1
    empty = put("order_id,user_id,estimated_arrival,transaction_date\n")
    assert jobs.append_batch(wh, Batch("stg_order_data", empty))["rows_loaded"] == 0
    assert not wh.exists("stg_order_data")


def test_late_batches_keep_bad_values(wh, put):
    text = "order_id,user_id,estimated_arrival,transaction_date\nL1,U1,soon,someday\n"
    jobs.append_batch(wh, Batch("stg_order_data", put(text)))
    assert rows(wh.read("stg_order_data")) == [("L1", "U1", None, None)]


def test_failed_rebuild_publishes_nothing(spark, wh, put):
    jobs.append_batch(wh, Batch("stg_order_data", put(LATE_ORDER)))
    jobs.rebuild(wh)
    before = wh.snapshot()
    old = "order_id,user_id,estimated_arrival,transaction_date\nX,U,1,1999-01-01\n"
    jobs.append_batch(wh, Batch("stg_order_data", put(old)))
    with pytest.raises(validate.ConstraintError, match="missing members"):
        jobs.rebuild(wh)
    after = wh.snapshot()
    assert {t: p for t, p in after.items() if t != "stg_order_data"} == {
        t: p for t, p in before.items() if t != "stg_order_data"}
    assert wh.read("fact_orders").count() == 1
    with pytest.raises(ValueError, match="on_orphans"):
        jobs.rebuild(wh, on_orphans="ignore")
    jobs.rebuild(wh, on_orphans="quarantine")
    assert [r["order_id"] for r in wh.read("orphan_orders").collect()] == ["X"]
    assert wh.read("fact_orders").count() == 1
    jobs.rebuild(wh, jobs.Calendar("1999-01-01", "2024-12-31"))
    assert wh.read("fact_orders").count() == 2
    assert wh.vacuum() > 0 and wh.vacuum() == 0
    assert wh.read("fact_orders").count() == 2


def test_full_refresh_keeps_rejects(wh, put):
    done = jobs.load_staging(wh, {"stg_order_data": [Source(put(DIRTY_ORDERS))],
                                  "stg_product_list": [Source(put(DIRTY_PRODUCTS))]})
    assert (done["stg_order_data"]["rows_loaded"], done["stg_order_data_rejects"]["rows_loaded"]) == (2, 5)
    assert (done["stg_product_list"]["rows_loaded"], done["stg_product_list_rejects"]["rows_loaded"]) == (3, 4)


def test_orders_without_user_never_meet_a_member(spark):
    orders = spark.createDataFrame([("o1", None), ("o2", "u")], "order_id string, user_id string")
    dim = spark.createDataFrame([(1, "\x00o1"), (2, "u")], "user_key long, source_user_id string")
    out = facts._lookup(orders, dim, "user_id", "source_user_id", "user_key")
    assert rows(out.select("order_id", "user_key")) == [("o1", None), ("o2", 2)]


def test_campaign_variants_are_refused(wh, put):
    text = LATE_CAMPAIGN + "spring-late,Blossom,found in a drawer,0.4\n"
    jobs.append_batch(wh, Batch("stg_campaign_data", put(text)))
    with pytest.raises(validate.ConstraintError, match="dim_campaign"):
        jobs.rebuild(wh)


def test_incremental_dimension_keeps_keys(spark, put):
    def staff(text):
        head = "staff_id,job_level,creation_date,name,street,state,city,country,contact_number\n"
        return staging.stage_staff(read_csv(spark, put(head + text)))

    first = dims.dim_staff(staff("S2,L1,2020-01-01,Two,s,st,c,co,1\nS5,L1,2020-01-01,Five,s,st,c,co,1\n"))
    again = dims.dim_staff(staff(
        "S1,L1,2020-01-01,One,s,st,c,co,1\nS5,L2,2021-01-01,Renamed,s,st,d,co,1\n"
        "S2,L1,2020-01-01,Two,s,st,c,co,1\n"), first)
    assert rows(again.select("staff_key", "source_staff_id", "name", "job_level", "city")) == [
        (1, "S2", "Two", "L1", "c"), (2, "S5", "Five", "L2", "d"), (3, "S1", "One", "L1", "c")]


def test_null_totals_and_averages(spark):
    heads = spark.createDataFrame(
        [("a", 1, 7), ("b", 1, 7), ("c", 1, None)], "order_id string, campaign_key long, user_key long"
    ).withColumn("date_key", F.lit(20200101))
    totals = spark.createDataFrame([("a", None), ("b", Decimal("9"))], "order_id string, order_total decimal(38,4)")
    orders = facts.with_totals(heads, totals)
    assert rows(orders.select("order_id", "total_amount")) == [
        ("a", None), ("b", Decimal("9.0000")), ("c", Decimal("0.0000"))]
    day = facts.campaign_days(orders).first()
    assert (day["total_orders"], day["total_revenue"], day["average_order_value"],
            day["unique_customers"]) == (3, Decimal("9.0000"), Decimal("4.50000000"), 1)


def test_repeated_product_id_repeats_the_line(spark):
    pos = lambda c: F.struct(
        F.lit(0).alias("slice"), F.lit("f").alias("file"), F.lit(0).cast("long").alias("block"),
        F.lit(c).cast("long").alias("row")).alias(S.POSITION)
    products = spark.range(1).select(F.lit("o").alias("order_id"), F.lit("p").alias("product_id"), pos(0))
    prices = spark.range(1).select(
        F.lit("o").alias("order_id"), F.lit(2).cast(S.MONEY).alias("price"), F.lit(3).alias("quantity"), pos(0))
    dim = spark.createDataFrame([(1, "p"), (2, "p")], "product_key long, product_id string")
    head = spark.createDataFrame(
        [("o", 1, 1, 1, 20200101)],
        "order_id string, user_key long, merchant_key long, campaign_key long, date_key int")
    items = facts.order_items(products, prices, dim, head)
    assert facts.order_totals(items).first()["order_total"] == Decimal("12")


def test_several_links_per_order_are_refused(wh, put):
    jobs.append_batch(wh, Batch("stg_order_data", put(LATE_ORDER)))
    jobs.append_batch(wh, Batch("stg_transactional_campaign_data", put(
        LATE_LINK + LATE_LINK.split("\n")[1] + "\n")))
    with pytest.raises(validate.ConstraintError, match="several rows"):
        jobs.rebuild(wh)
