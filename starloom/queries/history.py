"""Validity windows and point-in-time lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators import history as h
from starloom.queries import standin as st
from starloom.queries.registry import query


@query("scd2_dim_user", """
SELECT user_id, valid_from, lead(valid_from) OVER w AS valid_to,
       lead(valid_from) OVER w IS NULL AS is_current
FROM (SELECT DISTINCT o_custkey::VARCHAR AS user_id, o_orderdate AS valid_from FROM orders)
WINDOW w AS (PARTITION BY user_id ORDER BY valid_from)
""")
def scd2_dim_user(spark, sf_dir):
    """A version of the customer from each order day on."""
    starts = st.table(spark, sf_dir, "orders").select(
        st.text("o_custkey").alias("user_id"), F.col("o_orderdate").alias("valid_from")).distinct()
    return h.scd2_versions(starts, "user_id")


@query("asof_user_key", """
SELECT o.o_orderkey::VARCHAR AS order_id, o.o_custkey::VARCHAR AS user_id,
       o.o_orderdate AS transaction_date, v.user_key
FROM orders o ASOF LEFT JOIN (
    SELECT o_custkey, o_orderdate AS valid_from, min(o_orderkey) AS user_key
    FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL) v
  ON o.o_custkey = v.o_custkey AND o.o_orderdate >= v.valid_from
""")
def asof_user_key(spark, sf_dir):
    """Each order with the customer version valid at its time; urgent orders start versions."""
    orders = st.table(spark, sf_dir, "orders")
    starts = orders.filter("o_orderpriority = '1-URGENT'").groupBy(
        st.text("o_custkey").alias("user_id"), F.col("o_orderdate").alias("valid_from")).agg(
        F.min("o_orderkey").alias("user_key"))
    versions = h.scd2_versions(starts, "user_id")
    rows = orders.select(
        st.text("o_orderkey").alias("order_id"), st.text("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("transaction_date"))
    return h.asof_lookup(rows, versions, "user_id", "transaction_date", "user_key").select(
        "order_id", "user_id", "transaction_date", "user_key")


@query("identity_match", """
SELECT c_custkey::VARCHAR AS user_id, CASE WHEN c_custkey % 10 <> 0 THEN c_name END AS name,
       CASE WHEN c_custkey % 7 <> 0 OR c_custkey % 10 = 0 THEN c_custkey END AS user_key
FROM customer
""")
def identity_match(spark, sf_dir):
    """Users found again by (id, name); a missing name matches a missing name only."""
    k = F.col("c_custkey")
    base = st.table(spark, sf_dir, "customer")
    rows = base.select(
        st.text(k).alias("user_id"), F.when(k % 10 != 0, F.col("c_name")).alias("name"))
    dim = base.select(
        k.alias("user_key"), st.text(k).alias("source_user_id"),
        F.when(k % 10 != 0, F.when(k % 7 == 0, F.lower("c_name")).otherwise(F.col("c_name")))
        .alias("name"))
    return h.identity_match(rows, dim, ["user_id", "name"], ["source_user_id", "name"], "user_key")


@query("current_versions", """
SELECT c_custkey::VARCHAR AS user_id, TIMESTAMP '2024-05-06 07:08:09' AS valid_from,
       NULL::TIMESTAMP AS valid_to, true AS is_current
FROM customer
""")
def current_versions(spark, sf_dir):
    """Members found by a run are valid from its time on."""
    users = st.table(spark, sf_dir, "customer").select(st.text("c_custkey").alias("user_id"))
    return h.current_versions(users, F.lit("2024-05-06 07:08:09").cast("timestamp_ntz"))


@query("merge_versions", """
WITH told AS (
  SELECT c_custkey AS k, c_custkey::VARCHAR AS user_id, c_name AS name,
         CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS segment,
         CASE WHEN c_custkey % 3 = 0 THEN 'MOVED' WHEN c_custkey % 4 <> 0 THEN c_mktsegment END
             AS later
  FROM customer)
SELECT user_id, name, segment, TIMESTAMP '1995-01-01' AS valid_from,
       CASE WHEN k % 7 = 0 OR k % 3 = 0 THEN TIMESTAMP '1998-01-01' END AS valid_to,
       NOT (k % 7 = 0 OR k % 3 = 0) AS is_current
FROM told WHERE k % 5 <> 0
UNION ALL
SELECT user_id, name, later, TIMESTAMP '1998-01-01', NULL, true
FROM told WHERE k % 7 <> 0 AND (k % 5 = 0 OR k % 3 = 0)
""")
def merge_versions(spark, sf_dir):
    """Two loads of customers: some move, some are gone, some are new in the second."""
    k = F.col("c_custkey")
    rows = st.table(spark, sf_dir, "customer").select(
        k, st.text(k).alias("user_id"), F.col("c_name").alias("name"),
        F.when(k % 4 != 0, F.col("c_mktsegment")).alias("segment"))
    first = rows.filter(k % 5 != 0).drop("c_custkey")
    second = rows.filter(k % 7 != 0).withColumn(
        "segment", F.when(k % 3 == 0, "MOVED").otherwise(F.col("segment"))).drop("c_custkey")
    table = spark.createDataFrame([], "version_key long, user_id string, name string, "
                                  "segment string, valid_from timestamp_ntz, "
                                  "valid_to timestamp_ntz, is_current boolean")
    for state, at in ((first, "1995-01-01"), (second, "1998-01-01")):
        table = h.merge_versions(table, state, "user_id", F.lit(at), "version_key")
    return table.drop("version_key")
