import pytest

from starloom.operators import keys, validate


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id string")


@pytest.mark.parametrize("partitions", [1, 7, None])
def test_dense_in_order_without_gaps(spark, partitions):
    values = [f"u{i:04d}" for i in range(500)]
    df = ids(spark, reversed(values)).repartition(6)
    got = keys.dense_keys(df, "k", ["id"], start=11, partitions=partitions).orderBy("k").collect()
    assert [(r["id"], r["k"]) for r in got] == [(v, 11 + i) for i, v in enumerate(values)]


def test_keys_do_not_change_when_read_again(spark):
    keyed = keys.dense_keys(ids(spark, "dcba").repartition(3), "k", ["id"], partitions=3)
    assert sorted(keyed.collect()) == sorted(keyed.repartition(2).collect())


def test_empty_input(spark):
    got = keys.dense_keys(ids(spark, []), "k", ["id"])
    assert got.count() == 0 and dict(got.dtypes)["k"] == "bigint"


def test_new_members_continue_after_the_largest_key(spark):
    old = spark.createDataFrame([(4, "b"), (9, "x")], "k long, id string")
    got = keys.assign_surrogate_keys(ids(spark, ["c", "b", "a"]), old, "k", "id")
    assert sorted(map(tuple, got.collect())) == [("a", 10), ("c", 11)]
    none = spark.createDataFrame([], "k long, id string")
    assert keys.next_key(none, "k") == 1


def test_key_and_reference_reports(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 3)], "id string, ref int")
    report = validate.key_violations(df, "t", ["id"], ["id"])
    assert sorted((r["problem"], r["value"], r["n_rows"]) for r in report.collect()) == [
        ("not_unique", "a", 2), ("null", None, 2)]
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    lost = validate.fk_orphans(df, "t", {"ref": (dim, "k")}).collect()
    assert [(r["column_name"], r["value"], r["n_rows"]) for r in lost] == [("ref", "3", 2)]
    with pytest.raises(validate.ConstraintError, match="not_unique"):
        validate.refuse_if_any(report.filter("value = 'a'"), "t")


def test_merged_ranges_keep_their_order(spark):
    small = {
        "spark.sql.shuffle.partitions": "60",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "8KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    old = {n: spark.conf.get(n) for n in small}
    try:
        for n, v in small.items():
            spark.conf.set(n, v)
        df = spark.range(20000).selectExpr("lpad(id * 7919 % 20000, 6, '0') AS id")
        keyed = keys.dense_keys(df, "k", ["id"])
        files = {f for f, in keyed.selectExpr("_metadata.file_path").distinct().collect()}
        assert 1 < len(files) < 60
        assert keyed.filter("k <> cast(id AS long) + 1").count() == 0
    finally:
        for n, v in old.items():
            spark.conf.set(n, v)
