"""Grouped order rules against plain windows, with one key that holds a third of all rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.operators import blocks, dedup, history
from starloom.operators.pairing import pair_lines
from starloom.sources.position import make_position


def positioned(spark, rows, columns, per_block=4):
    """Rows in shuffled order; three files, blocks of a few rows."""
    n = len(rows)
    data = [(i, *r) for i, r in enumerate(rows)]
    random.Random(7).shuffle(data)
    df = spark.createDataFrame(data, ["i", *columns]).repartition(5)
    third = F.least(F.floor(F.col("i") * 3 / n), F.lit(2))
    file = F.concat(F.lit("f"), third.cast("string"))
    return df.withColumn(
        S.POSITION, make_position(0, file, F.floor(F.col("i") / per_block), F.col("i")))


def hot_rows(n=300):
    rnd = random.Random(3)
    return [("hot" if i % 3 == 0 else f"k{rnd.randrange(40)}", i % 11) for i in range(n)]


def test_number_in_group_equals_window(spark):
    df = positioned(spark, hot_rows(), ["key", "v"])
    got = blocks.number_in_group(df, ["key"]).select("i", "rn")
    want = df.select("i", F.row_number().over(
        Window.partitionBy("key").orderBy("i")).cast("bigint").alias("rn"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_window_never_groups_by_key_alone(spark):
    df = positioned(spark, hot_rows(), ["key", "v"])
    plan = blocks.number_in_group(df, ["key"])._jdf.queryExecution().optimizedPlan().toString()
    local = [line for line in plan.splitlines() if "row_number()" in line and "Window" in line]
    assert local and all("_block" in line.split("], [")[1] for line in local)


def test_pairing_drops_lines_without_partner(spark):
    left = positioned(spark, [("a", "p1"), ("a", "p2"), ("b", "p3"), (None, "p4"), ("a", "p5")],
                      ["order_id", "product_id"], 2)
    right = positioned(spark, [("b", 1), ("a", 2), ("a", 3), ("b", 4), (None, 5)],
                       ["order_id", "price"], 2)
    got = pair_lines(left.drop("i"), right.drop("i")).select("order_id", "product_id", "price")
    assert sorted(map(tuple, got.collect())) == [("a", "p1", 2), ("a", "p2", 3), ("b", "p3", 1)]


def test_scd2_equals_lead(spark):
    rnd = random.Random(5)
    rows = {("hot" if rnd.random() < .4 else f"u{rnd.randrange(9)}",
             f"2020-01-{rnd.randrange(1, 28):02d} {rnd.randrange(24):02d}:00:00") for _ in range(300)}
    df = spark.createDataFrame(sorted(rows), ["id", "t"]).select(
        "id", F.col("t").cast("timestamp_ntz").alias("valid_from"))
    got = history.scd2_versions(df, "id").select("id", "valid_from", "valid_to", "is_current")
    lead = F.lead("valid_from").over(Window.partitionBy("id").orderBy("valid_from"))
    want = df.select("id", "valid_from", lead.alias("valid_to"), lead.isNull().alias("is_current"))
    key = lambda r: (r[0], r[1])
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)


def test_asof_equals_range_scan(spark):
    rnd = random.Random(6)
    stamp = lambda: f"2020-{rnd.randrange(1, 4):02d}-{rnd.randrange(1, 28):02d} 00:00:00"
    user = lambda: rnd.choice(["hot", "hot", "u1", "u2", None])
    versions = [(u, t, n) for n, (u, t) in enumerate(sorted(
        {(rnd.choice(["hot", "u1"]), stamp()) for _ in range(40)}))]
    rows = [(n, user(), stamp()) for n in range(200)]
    vdf = history.scd2_versions(
        spark.createDataFrame(versions, ["id", "t", "key"]).select(
            "id", F.col("t").cast("timestamp_ntz").alias("valid_from"), "key"), "id")
    # one version ends early, which leaves a gap
    gap = min(n for u, _, n in versions if u == "hot")
    vdf = vdf.withColumn("valid_to", F.when(
        F.col("key") == gap, F.col("valid_from")).otherwise(F.col("valid_to")))
    rdf = spark.createDataFrame(rows, ["n", "id", "t"]).select(
        "n", "id", F.col("t").cast("timestamp_ntz").alias("at"))
    got = history.asof_lookup(rdf, vdf, "id", "at", "key")
    spans = [(r["id"], r["valid_from"], r["valid_to"], r["key"]) for r in vdf.collect()]
    want = {}
    for r in rdf.collect():
        hit = [k for u, a, b, k in spans if u == r["id"] and a <= r["at"] and (b is None or r["at"] < b)]
        want[r["n"]] = hit[0] if hit else None
    assert {r["n"]: r["key"] for r in got.collect()} == want
    assert any(v is not None for v in want.values()) and got.count() == 200


def test_soft_dedup_ties_nulls_and_hot_id(spark):
    rows = [("a", "2020-01-01"), ("a", "2021-01-01"), ("a", "2021-01-01"), ("b", None),
            ("b", "2019-05-05"), (None, "2020-02-02"), (None, None), ("c", None), ("c", None)]
    rows += [("hot", f"2020-01-{1 + i % 20:02d}") for i in range(60)]
    df = positioned(spark, rows, ["id", "creation_date"]).withColumn(
        "creation_date", F.col("creation_date").cast("timestamp_ntz"))
    got = dedup.soft_dedup_latest(df, "id").collect()
    masters = {r["i"] for r in got if not r["possible_duplicate"]}
    first_hot_max = next(i for i, r in enumerate(rows) if r == ("hot", "2020-01-20"))
    assert masters == {1, 4, 5, 7, first_hot_max}
    assert len(got) == len(rows)
    assert all(r["possible_duplicate_of"] == (r["id"] if r["possible_duplicate"] else None)
               for r in got)


def test_file_order_dedup_keeps_last(spark):
    df = positioned(spark, [("a", 1), ("b", 2), ("a", 3), ("a", 4)], ["id", "v"], 2)
    got = dedup.soft_dedup_file_order(df, "id")
    assert {r["v"] for r in got.filter("not possible_duplicate").collect()} == {2, 4}


def test_master_rows(spark):
    rows = [("a", "x", True), ("a", "y", False), ("a", "z", None), (None, "n", False), ("b", "w", None)]
    df = positioned(spark, rows, ["id", "name", "possible_duplicate"], 2)
    got = dedup.master_rows(df, "id").select("id", "name")
    assert sorted(map(tuple, got.collect())) == [("a", "y"), ("b", "w")]


@pytest.mark.parametrize("key", ["hot", "k1"])
def test_exact_dedup_keeps_nulls_equal(spark, key):
    df = spark.createDataFrame([(key, None), (key, None), (key, 1)], "a string, b int")
    assert dedup.dedup_exact(df).count() == 2


def test_new_members_are_current_from_the_run_on(spark):
    run = F.lit("2024-05-01 10:00:00").cast("timestamp_ntz")
    got = history.current_versions(spark.createDataFrame([("a",)], "id string"), run).first()
    assert (str(got["valid_from"]), got["valid_to"], got["is_current"]) == (
        "2024-05-01 10:00:00", None, True)


def test_asof_with_ties_missing_parts_and_a_hot_id(spark):
    day = "timestamp_ntz'2024-01-0{} 00:00:00'"
    versions = spark.sql(
        f"SELECT * FROM VALUES ('a', {day.format(2)}, {day.format(2)}, 1), ('a', {day.format(2)}, {day.format(4)}, 2),"
        f"('a', {day.format(2)}, {day.format(4)}, 3), ('a', {day.format(4)}, NULL, 4), (NULL, {day.format(1)}, NULL, 8),"
        f"('a', NULL, NULL, 9) AS t(id, valid_from, valid_to, k)")
    hot = spark.range(3000).selectExpr("'a' AS id", f"{day.format(3)} AS at", "id AS row")
    odd = spark.sql(
        f"SELECT * FROM VALUES ('a', {day.format(1)}, -1L), ('a', {day.format(4)}, -2L), (NULL, {day.format(4)}, -3L),"
        f"('a', NULL, -4L), ('b', {day.format(4)}, -5L) AS t(id, at, row)")
    for order in ("k", "-k"):
        out = history.asof_lookup(
            hot.unionByName(odd), versions.orderBy(F.expr(order)), "id", "at", "k")
        got = {r["row"]: r["k"] for r in out.collect()}
        assert len(got) == 3005 and {got[i] for i in range(3000)} == {3}
        assert [got[-i] for i in range(1, 6)] == [None, 4, None, None, None]


def test_versions_without_id_or_start(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', DATE'2024-01-01'), ('a', DATE'2024-02-01'), (NULL, DATE'2024-01-01'),"
                   "('a', NULL) AS t(id, valid_from)")
    got = {(r["id"], str(r["valid_from"])): (str(r["valid_to"]), r["is_current"])
           for r in history.scd2_versions(df, "id").collect()}
    assert got == {("a", "2024-01-01"): ("2024-02-01", False), ("a", "2024-02-01"): ("None", True),
                   (None, "2024-01-01"): ("None", False), ("a", "None"): ("None", False)}


def test_a_hot_id_on_one_day_has_many_blocks(spark):
    df = spark.range(8000).selectExpr("'hot' AS id", "DATE'2024-01-01' AS t", "id AS n")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows are merged else
    try:
        found = blocks.range_blocks(df, ["id", "t", F.xxhash64("n")], "b").groupBy("block").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(found) > 4 and max(r["count"] for r in found) < 4000
