"""Line pairing and the three facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators import history
from starloom.operators.pairing import lost_lines, pair_lines
from starloom.plans import facts as plan
from starloom.queries import standin as st
from starloom.queries.registry import query
from starloom.session import materialise_made


@query("pair_lines_positional", """
SELECT order_id, rn, product_id, price::DOUBLE AS price, quantity FROM paired_lines
""")
def pair_lines_positional(spark, sf_dir):
    """The n-th product line of an order with its n-th price line."""
    paired = pair_lines(
        st.stg_line_products(spark, sf_dir), st.stg_line_prices(spark, sf_dir))
    return st.money_as_double(
        paired.select("order_id", "rn", "product_id", "price", "quantity"), "price")


@query("unpaired_lines", """
WITH counted AS (
    SELECT coalesce(a.order_id, b.order_id) AS order_id, coalesce(a.n, 0) AS n, coalesce(b.n, 0) AS m
    FROM (SELECT order_id, count(*) AS n FROM numbered_products WHERE order_id::BIGINT % 7 <> 0
          GROUP BY order_id) a
    FULL JOIN (SELECT order_id, count(*) AS n FROM numbered_prices WHERE order_id::BIGINT % 5 <> 0
               GROUP BY order_id) b ON a.order_id = b.order_id)
SELECT 'no_price' AS reason, sum(greatest(n - m, 0))::BIGINT AS n_rows FROM counted
UNION ALL SELECT 'no_product_line', sum(greatest(m - n, 0))::BIGINT FROM counted
UNION ALL SELECT 'unknown_product', count(*) FROM paired_lines
    WHERE order_id::BIGINT % 35 NOT IN (0, 5, 7, 10, 14, 15, 20, 21, 25, 28, 30)
      AND product_id::BIGINT % 3 = 0
UNION ALL SELECT 'unknown_order', count(*) FROM paired_lines
    WHERE order_id::BIGINT % 35 NOT IN (0, 5, 7, 10, 14, 15, 20, 21, 25, 28, 30)
      AND order_id::BIGINT % 11 = 0
""")
def unpaired_lines(spark, sf_dir):
    """Lines that reach no fact, by reason, where orders, prices and products are missing."""
    key = F.col("order_id").cast("long")
    return lost_lines(
        st.stg_line_products(spark, sf_dir).filter(key % 7 != 0),
        st.stg_line_prices(spark, sf_dir).filter(key % 5 != 0),
        st.table(spark, sf_dir, "part").filter("p_partkey % 3 <> 0").select(
            st.text("p_partkey").alias("product_id")),
        st.stg_orders(spark, sf_dir).filter(key % 11 != 0))


@query("fact_orders_asof", """
SELECT o.o_orderkey::VARCHAR AS order_id, v.user_key,
       strftime(o.o_orderdate, '%Y%m%d')::INTEGER AS date_key
FROM orders o ASOF LEFT JOIN (
    SELECT o_custkey % 3 AS who, o_orderdate::DATE::TIMESTAMP AS valid_from, max(o_orderkey) AS user_key
    FROM orders GROUP BY ALL) v
  ON o.o_custkey % 3 = v.who AND o.o_orderdate::DATE::TIMESTAMP >= v.valid_from
""")
def fact_orders_asof(spark, sf_dir):
    """Orders of three customers with the user version of their day; starts are tied."""
    orders = st.table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date").cast("timestamp_ntz")
    who = st.text(F.col("o_custkey") % 3)
    starts = orders.select(who.alias("user_id"), day.alias("valid_from"), F.col("o_orderkey").alias("user_key"))
    versions = history.scd2_versions(starts, "user_id").unionByName(starts.groupBy(
        "user_id", "valid_from").agg(F.max("user_key").alias("user_key")).withColumns({
            "valid_to": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(False)}))
    plain = orders.select(
        st.text("o_orderkey").alias("order_id"), who.alias("user_id"), day.alias("transaction_date"))
    nothing = spark.createDataFrame([], "order_id string, merchant_id string, staff_id string, "
                                    "campaign_id string, delay_in_days int")
    head = plan.order_headers(
        plain, nothing, nothing, nothing, None,
        st.build(spark, sf_dir, "dim_merchant"), st.build(spark, sf_dir, "dim_staff"),
        st.build(spark, sf_dir, "dim_campaign"), user_versions=versions)
    return head.select("order_id", "user_key", "date_key")


@query("fact_order_items", """
SELECT row_number() OVER (ORDER BY order_id, rn, product_key) AS order_item_key, order_id,
       product_key, user_key, merchant_key, campaign_key, date_key, quantity,
       unit_price::DOUBLE AS unit_price, total_price::DOUBLE AS total_price
FROM order_items
""")
def fact_order_items(spark, sf_dir):
    """Priced lines with product and header keys, numbered."""
    headers = materialise_made(lambda: st.order_headers(spark, sf_dir), "order_headers")
    items = plan.all_order_items(
        st.stg_line_products(spark, sf_dir), st.stg_line_prices(spark, sf_dir),
        st.build(spark, sf_dir, "dim_product"), headers)
    return st.money_as_double(items, "unit_price", "total_price")


@query("order_totals", "SELECT order_id, order_total::DOUBLE AS order_total FROM order_totals_v")
def order_totals(spark, sf_dir):
    """Sum of line totals per order; of the orders only their ids are needed."""
    keys = [F.lit(None).cast("long").alias(k) for k in ("user_key", "merchant_key", "campaign_key")]
    orders = st.stg_orders(spark, sf_dir).select(
        "order_id", *keys, F.lit(None).cast("int").alias("date_key"))
    items = st.order_items(spark, sf_dir, orders)
    return st.money_as_double(plan.order_totals(items), "order_total")


def _orders_with_totals(spark, sf_dir):
    """Headers and totals, headers written once because items and orders both need them."""
    headers = materialise_made(lambda: st.order_headers(spark, sf_dir), "order_headers")
    totals = plan.order_totals(st.order_items(spark, sf_dir, headers))
    return headers, totals


@query("fact_orders", """
SELECT order_key, order_id, user_key, merchant_key, staff_key, campaign_key, date_key,
       delay_in_days, total_amount::DOUBLE AS total_amount
FROM fact_orders_v
""")
def fact_orders(spark, sf_dir):
    """Orders with five keys, delay and total, numbered."""
    return st.money_as_double(plan.fact_orders(*_orders_with_totals(spark, sf_dir)), "total_amount")


@query("fact_campaign_performance", """
SELECT row_number() OVER (ORDER BY campaign_key, date_key) AS campaign_perf_key, *
FROM campaign_days
""")
def fact_campaign_performance(spark, sf_dir):
    """Orders, revenue, average and customers per campaign and day, from raw data on."""
    orders = plan.with_totals(*_orders_with_totals(spark, sf_dir))
    return st.money_as_double(
        plan.fact_campaign_performance(orders), "total_revenue", "average_order_value")
