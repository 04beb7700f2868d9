"""Header rules on wide frames; they change names only, so the scans stay pruned."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.operators import headers as h
from starloom.queries import standin as st
from starloom.queries.registry import query


@query("drop_junk_columns", "SELECT o_orderkey AS order_id, o_custkey AS user_id FROM orders")
def drop_junk_columns(spark, sf_dir):
    k = F.col("o_orderkey")
    return h.drop_junk_columns(st.table(spark, sf_dir, "orders").select(
        k.alias("Unnamed: 0"), k.alias("order_id"), k.alias("_c0"), k.alias("unnamed"),
        F.col("o_custkey").alias("user_id"), k.alias("UNNAMED: 5")))


@query("normalise_headers", """
SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderpriority AS estimated_arrival,
       o_orderdate AS "Other Column"
FROM orders
""")
def normalise_headers(spark, sf_dir):
    """Only known targets are renamed."""
    df = st.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(" Order ID "), F.col("o_custkey").alias("USER_ID"),
        F.col("o_orderpriority").alias("Estimated Arrival"),
        F.col("o_orderdate").alias("Other Column"))
    return h.normalise_headers(df, S.STAGING["stg_order_data"].fieldNames())


@query("rename_synonyms", """
SELECT p_partkey AS campaign_id, p_name AS campaign_name, p_type AS campaign_description,
       p_size AS discount
FROM part
""")
def rename_synonyms(spark, sf_dir):
    df = st.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("Campaign_id"), F.col("p_name").alias("Campaign_name"),
        F.col("p_type").alias("Description"), F.col("p_size").alias("Discount"))
    return h.rename_synonyms(df, h.CAMPAIGN_SYNONYMS)


@query("fuzzy_headers", """
SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderpriority AS estimated_arrival,
       o_orderdate AS transaction_date, o_orderstatus AS remark
FROM orders
""")
def fuzzy_headers(spark, sf_dir):
    return h.fuzzy_headers(st.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ID of Order"), F.col("o_custkey").alias("user-id"),
        F.col("o_orderpriority").alias("Estimated order id days"),
        F.col("o_orderdate").alias("TransDate"), F.col("o_orderstatus").alias("remark")))


@query("sanitise_identifiers", """
SELECT s_suppkey AS _2nd_id, s_name AS name_, s_nationkey AS name__2, s_acctbal AS acct_bal
FROM supplier
""")
def sanitise_identifiers(spark, sf_dir):
    return h.sanitise_identifiers(st.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("2nd ID"), F.col("s_name").alias("Name!"),
        F.col("s_nationkey").alias("name?"), F.col("s_acctbal").alias(" Acct-Bal ")))


@query("constant_flags", """
SELECT c_custkey, c_name, false AS possible_duplicate,
       CAST(NULL AS VARCHAR) AS possible_duplicate_of
FROM customer
""")
def constant_flags(spark, sf_dir):
    return h.constant_flags(st.table(spark, sf_dir, "customer").select("c_custkey", "c_name"))


@query("fill_missing_columns", """
SELECT o_orderkey::VARCHAR AS order_id, o_custkey::VARCHAR AS user_id,
       CAST(NULL AS INTEGER) AS estimated_arrival, o_orderdate AS transaction_date
FROM orders
""")
def fill_missing_columns(spark, sf_dir):
    schema = S.STAGING["stg_order_data"]
    df = st.table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("transaction_date"), F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"))
    return h.conform(h.fill_missing_columns(df, schema), schema, ())
