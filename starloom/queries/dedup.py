"""Duplicates, masters, new members and surrogate keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.operators import dedup as d
from starloom.operators import keys
from starloom.queries import standin as st
from starloom.queries.registry import query


@query("dedup_exact", "SELECT DISTINCT product_id, product_name, product_type, price::DOUBLE AS price "
       "FROM product_rows")
def dedup_exact(spark, sf_dir):
    """Equal product rows once."""
    return st.money_as_double(st.stg_products(spark, sf_dir), "price")


@query("soft_dedup_latest", """
SELECT user_id, name, creation_date, slice, possible_duplicate,
       CASE WHEN possible_duplicate THEN user_id END AS possible_duplicate_of
FROM stg_users
""")
def soft_dedup_latest(spark, sf_dir):
    """Every user row, all but the newest of an id flagged; ties and missing dates included."""
    return st.stg_users(spark, sf_dir).select(
        "user_id", "name", "creation_date", F.col(f"{S.POSITION}.slice").alias("slice"),
        "possible_duplicate", "possible_duplicate_of")


@query("soft_dedup_file_order", """
SELECT event_id, user_id::VARCHAR AS user_id, event_type,
       row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) > 1 AS possible_duplicate,
       CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) > 1
            THEN user_id::VARCHAR END AS possible_duplicate_of
FROM events
""")
def soft_dedup_file_order(spark, sf_dir):
    """The last row per id wins; ids with very many rows."""
    rows = st.table(spark, sf_dir, "events").select(
        "event_id", st.text("user_id").alias("user_id"), "event_type", st.pos(0, "event_id"))
    return d.soft_dedup_file_order(rows, "user_id").drop(S.POSITION)


@query("dedup_master", """
SELECT user_id, name, creation_date, city FROM stg_users WHERE NOT possible_duplicate
""")
def dedup_master(spark, sf_dir):
    """One master row per user."""
    return d.master_rows(st.stg_users(spark, sf_dir), "user_id").select(
        "user_id", "name", "creation_date", "city")


def _members(spark, sf_dir):
    """All customers as candidates, those with orders before 1998 as the existing dimension."""
    ids = st.table(spark, sf_dir, "customer").select(st.text("c_custkey").alias("source_user_id"))
    old = st.table(spark, sf_dir, "orders").filter(F.col("o_orderdate") < "1995-07-01").groupBy(
        st.text("o_custkey").alias("source_user_id")).agg(F.min("o_orderkey").alias("user_key"))
    return ids, old


_OLD = """
SELECT o_custkey::VARCHAR AS source_user_id, min(o_orderkey) AS user_key
FROM orders WHERE o_orderdate < TIMESTAMP '1995-07-01' GROUP BY o_custkey
"""


@query("new_dim_members", f"""
SELECT c_custkey::VARCHAR AS source_user_id FROM customer
WHERE c_custkey::VARCHAR NOT IN (SELECT source_user_id FROM ({_OLD}))
""")
def new_dim_members(spark, sf_dir):
    ids, old = _members(spark, sf_dir)
    return keys.new_members(ids, old, "source_user_id")


@query("assign_surrogate_keys", f"""
SELECT source_user_id, (SELECT max(user_key) FROM ({_OLD}))
       + row_number() OVER (ORDER BY source_user_id) AS user_key
FROM (SELECT c_custkey::VARCHAR AS source_user_id FROM customer
      WHERE c_custkey::VARCHAR NOT IN (SELECT source_user_id FROM ({_OLD})))
""")
def assign_surrogate_keys(spark, sf_dir):
    """Dense keys for the new members, from the largest old key on."""
    ids, old = _members(spark, sf_dir)
    return keys.assign_surrogate_keys(ids, old, "user_key", "source_user_id", partitions=16)
