"""The six dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.plans import dims as plan
from starloom.queries import standin as st
from starloom.queries.registry import query


@query("dim_date", """
SELECT strftime(d, '%Y%m%d')::INTEGER AS date_key, d::DATE AS full_date, year(d)::INTEGER AS year,
       quarter(d)::INTEGER AS quarter, month(d)::INTEGER AS month, day(d)::INTEGER AS day,
       dayname(d) AS day_name, monthname(d) AS month_name, isodow(d) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series(date_trunc('year', min(l_shipdate)),
             date_trunc('year', max(l_shipdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
             INTERVAL 1 DAY)) AS d
      FROM lineitem)
""")
def dim_date(spark, sf_dir):
    """Calendar over the whole years that the data covers."""
    span = st.table(spark, sf_dir, "lineitem").agg(
        F.year(F.min("l_shipdate")).alias("a"), F.year(F.max("l_shipdate")).alias("b")).first()
    return plan.dim_date(spark, f"{span['a']}-01-01", f"{span['b']}-12-31")


@query("dim_user", "SELECT * FROM dim_user_v")
def dim_user(spark, sf_dir):
    """Master users with demographics and jobs."""
    return st.build(spark, sf_dir, "dim_user")


@query("dim_merchant", "SELECT * FROM dim_merchant_v")
def dim_merchant(spark, sf_dir):
    return st.build(spark, sf_dir, "dim_merchant")


@query("dim_staff", "SELECT * FROM dim_staff_v")
def dim_staff(spark, sf_dir):
    return st.build(spark, sf_dir, "dim_staff")


@query("dim_product", """
SELECT product_key, product_id, product_name, product_type, base_price::DOUBLE AS base_price
FROM dim_product_v
""")
def dim_product(spark, sf_dir):
    return st.money_as_double(st.build(spark, sf_dir, "dim_product"), "base_price")


@query("dim_campaign", """
SELECT campaign_key, campaign_id, campaign_name, description, discount::DOUBLE AS discount
FROM dim_campaign_v
""")
def dim_campaign(spark, sf_dir):
    return st.money_as_double(st.build(spark, sf_dir, "dim_campaign"), "discount")


@query("preview_dim", "SELECT * FROM dim_staff_v ORDER BY staff_key LIMIT 5")
def preview_dim(spark, sf_dir):
    """The first five members, as a look at the result."""
    return st.build(spark, sf_dir, "dim_staff").orderBy("staff_key").limit(5)
