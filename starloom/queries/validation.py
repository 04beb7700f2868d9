"""Row checks, quarantine and constraint reports over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.operators import validate
from starloom.plans import dims, jobs, staging
from starloom.queries import standin as st
from starloom.queries.registry import query
from starloom.session import materialise


@query("validate_orders", """
SELECT order_id, user_id, estimated_arrival, transaction_date, reject_reasons FROM judged_orders
""")
def validate_orders(spark, sf_dir):
    """Every dirty order with its cleaned values and the reasons against it."""
    return staging.check_orders(st.raw_dirty_orders(spark, sf_dir)).drop(S.POSITION)


@query("validate_products", """
SELECT CASE WHEN p_partkey % 11 <> 0 THEN p_partkey::VARCHAR END AS product_id,
       lower(p_name) AS product_name, lower(p_type) AS product_type,
       CASE WHEN p_partkey % 6 > 1 THEN p_retailprice END AS price,
       concat_ws(',', CASE WHEN p_partkey % 11 = 0 THEN 'missing_product_id' END,
                      CASE WHEN p_partkey % 6 < 2 THEN 'bad_price' END) AS reject_reasons
FROM part
""")
def validate_products(spark, sf_dir):
    """Products with blank ids and prices such as "free" or "inf"."""
    raw = st.raw_dirty_products(spark, sf_dir)
    return st.money_as_double(staging.check_products(raw).drop(S.POSITION), "price")


@query("validate_line_products", """
SELECT CASE WHEN l_linenumber <> 2 THEN l_orderkey::VARCHAR END AS order_id,
       l_shipdate::DATE::VARCHAR AS product_name,
       CASE WHEN l_partkey % 5 <> 0 THEN l_partkey::VARCHAR END AS product_id,
       concat_ws(',', CASE WHEN l_linenumber = 2 THEN 'missing_order_id' END,
                      CASE WHEN l_partkey % 5 = 0 THEN 'missing_product_id' END) AS reject_reasons
FROM lineitem
""")
def validate_line_products(spark, sf_dir):
    raw = st.raw_dirty_line_products(spark, sf_dir)
    return staging.check_line_products(raw).drop(S.POSITION)


def _conflicting_batch(spark, sf_dir):
    """Dirty orders listed twice; cleaned once and written, as the isolated append does."""
    raw = st.raw_dirty_orders(spark, sf_dir)
    again = raw.withColumn(S.POSITION, F.col(S.POSITION).withField("slice", F.lit(1)))
    return materialise(staging.check_orders(raw.unionByName(again)), "checked")


@query("quarantine_orders", """
SELECT order_id, slice, pos,
       CASE WHEN reject_reasons <> '' THEN reject_reasons
            WHEN old OR row_number() OVER (PARTITION BY order_id, reject_reasons
                                           ORDER BY slice, pos) > 1 THEN 'duplicate_key'
            ELSE '' END AS reject_reasons
FROM (SELECT *, order_id IN (SELECT o_orderkey::VARCHAR FROM orders
                             WHERE o_orderdate < TIMESTAMP '1996-01-01') AS old
      FROM (SELECT 0 AS slice, * FROM judged_orders
            UNION ALL SELECT 1, * FROM judged_orders))
""")
def quarantine_orders(spark, sf_dir):
    """A dirty batch against a unique key: earlier rows of the batch and loaded orders win."""
    history = st.stg_orders(spark, sf_dir).filter(F.col("transaction_date") < "1996-01-01")
    judged = validate.flag_key_conflicts(
        _conflicting_batch(spark, sf_dir), "order_id", history)
    return judged.select(
        "order_id", F.col(f"{S.POSITION}.slice").alias("slice"),
        F.col(f"{S.POSITION}.row").alias("pos"),
        validate.REASONS)


@query("load_metrics", """
SELECT outcome, count(*) AS n_rows
FROM (SELECT unnest(string_split(CASE WHEN reject_reasons = '' THEN 'loaded'
                                      ELSE reject_reasons END, ',')) AS outcome
      FROM judged_orders)
GROUP BY outcome
""")
def load_metrics(spark, sf_dir):
    """Rows loaded and rows refused by reason."""
    return validate.reject_metrics(staging.check_orders(st.raw_dirty_orders(spark, sf_dir)))


@query("key_violations", """
SELECT 'stg_order_data' AS table_name, 'order_id' AS column_name, 'not_unique' AS problem,
       order_id AS value, count(*) AS n_rows
FROM clean_orders WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1
UNION ALL
SELECT 'stg_order_data', 'user_id', 'not_unique', user_id, count(*)
FROM clean_orders WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1
UNION ALL
SELECT 'stg_order_data', 'order_id', 'null', NULL, count(*)
FROM clean_orders WHERE order_id IS NULL HAVING count(*) > 0
""")
def key_violations(spark, sf_dir):
    """Repeated values and NULLs of key columns."""
    prepared = st.raw_dirty_orders(spark, sf_dir).toDF(
        "order_id", "user_id", "estimated_arrival", "transaction_date", S.POSITION)
    return validate.key_violations(
        staging.clean_orders(prepared), "stg_order_data", ["order_id", "user_id"], ["order_id"])


@query("fk_orphans", """
SELECT 'lines' AS table_name, 'l_orderkey' AS column_name, l_orderkey::VARCHAR AS value,
       count(*) AS n_rows
FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
GROUP BY l_orderkey
UNION ALL
SELECT 'lines', 'date_key', strftime(l_shipdate, '%Y%m%d'), count(*)
FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01' GROUP BY ALL
""")
def fk_orphans(spark, sf_dir):
    """Line references to unknown orders, and ship days outside the calendar."""
    orders = st.table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    lines = st.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", (F.year("l_shipdate") * 10000 + F.month("l_shipdate") * 100
                       + F.dayofmonth("l_shipdate")).alias("date_key"))
    calendar = dims.dim_date(spark, "1995-01-01", "2000-12-31")
    return validate.fk_orphans(lines, "lines", {
        "l_orderkey": (orders, "o_orderkey"), "date_key": (calendar, "date_key")})


@query("probe_orders_by_day", """
SELECT count(*) AS n_orders FROM orders
WHERE o_orderdate::DATE = (SELECT max(o_orderdate)::DATE FROM orders)
""")
def probe_orders_by_day(spark, sf_dir):
    """Number of orders on the last day of the data."""
    heads = st.stg_orders(spark, sf_dir).select(
        (F.year("transaction_date") * 10000 + F.month("transaction_date") * 100
         + F.dayofmonth("transaction_date")).alias("date_key"))
    last = heads.agg(F.max("date_key").alias("d")).first()["d"]
    return jobs.orders_on_day(heads, last)
