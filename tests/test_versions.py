"""Version tables kept by comparing states, and time lines with many equal rows."""

import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import history, validate
from starloom.operators.blocks import range_blocks

VERSIONS = ("k long, id string, a string, b int, valid_from timestamp_ntz, "
            "valid_to timestamp_ntz, is_current boolean")


def day(n):
    return f"2024-01-{n:02d}"


def merged(spark, states, **options):
    table = spark.createDataFrame([], VERSIONS)
    for n, state in states:
        df = spark.createDataFrame(state, "id string, a string, b int")
        table = history.merge_versions(table, df, "id", F.lit(day(n)), "k", **options)
    return table


def brute(states):
    done, current, number = [], {}, 0
    for n, state in states:
        now = {i: (a, b) for i, a, b in state if i is not None}
        for i, (key, cells, start) in list(current.items()):
            if now.get(i) != cells:
                done.append((key, i, *cells, start, day(n), False))
                del current[i]
        for i in sorted(now.keys() - current.keys()):
            number += 1
            current[i] = (number, now[i], day(n))
    return sorted(done + [(k, i, *c, s, None, True) for i, (k, c, s) in current.items()], key=str)


def shown(table):
    return sorted([tuple(str(v)[:10] if c.startswith("valid") and v is not None else v
                         for c, v in r.asDict().items()) for r in table.collect()], key=str)


def test_states_against_brute_force(spark):
    rng = random.Random(1)
    states = [(n, [(f"i{i}", rng.choice(["x", None]), rng.choice([1, None]))
                   for i in rng.sample(range(12), rng.randint(0, 12))] + [(None, "lost", 1)])
              for n in (1, 2, 5, 9)]
    assert shown(merged(spark, states)) == brute(states)


def test_since_holds_for_ids_never_seen(spark):
    table = merged(spark, [(3, [("i", "x", 1)]), (5, []), (7, [("i", "x", 1), ("j", "y", 2)])],
                   since=F.lit("2000-01-01"))
    starts = sorted((r["id"], str(r["valid_from"])[:10]) for r in table.collect())
    assert starts == [("i", "2000-01-01"), ("i", day(7)), ("j", "2000-01-01")]


def test_bad_states_are_refused(spark):
    with pytest.raises(validate.ConstraintError, match="several rows"):
        merged(spark, [(1, [("i", "x", 1), ("i", "y", 1)])])
    with pytest.raises(validate.ConstraintError, match="older"):
        merged(spark, [(5, [("i", "x", 1)]), (3, [("i", "y", 1)])])


def test_equal_rows_lie_in_many_blocks(spark):
    rows = spark.createDataFrame([("i",)] * 5000, "id string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = [r["count"] for r in range_blocks(rows, ["id"], "equal").groupBy(
            "block").count().collect()]
        same = spark.createDataFrame([("i", day(3), 1)] * 3000, "id string, at string, x int").select(
            "id", F.col("at").cast("timestamp_ntz").alias("at"), "x")
        versions = spark.createDataFrame(
            [("i", day(1), day(2), 1), ("i", day(2), None, 2)],
            "id string, valid_from string, valid_to string, key int").withColumns({
                c: F.col(c).cast("timestamp_ntz") for c in ("valid_from", "valid_to")})
        found = history.asof_lookup(same, versions, "id", "at", "key")
        assert [tuple(r) for r in found.groupBy("x", "key").count().collect()] == [(1, 2, 3000)]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(blocks) == 5000 and len(blocks) > 4 and max(blocks) < 2500
