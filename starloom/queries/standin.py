"""The retail relations, derived from the benchmark tables.

``raw_*`` frames look like freshly read source files (text columns, odd headers, dirty values,
positions); ``stg_*`` are the staging tables that the library makes of them. The same relations
are written as SQL views in ``oracle_views``.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.plans import dims, facts, staging
from starloom.session import materialise, side_by_side
from starloom.sources import read_parquet
from starloom.sources.position import row_position


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def pos(slice_no: int, row: str | Column) -> Column:
    row = F.col(row) if isinstance(row, str) else row
    return row_position(slice_no, F.lit("f"), row).alias(S.POSITION)


def money(c: str) -> Column:
    return F.col(c).cast(S.MONEY)


# -- orders ----------------------------------------------------------------------------


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean order file: ids and dates as text, arrival like "7days"."""
    return as_raw_orders(table(spark, sf_dir, "orders"))


def as_raw_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        text("o_orderkey").alias("Order ID"),
        text("o_custkey").alias("user_id"),
        F.concat(text(F.col("o_orderkey") % 20), F.lit("days")).alias("Estimated Arrival"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("transaction_date"),
        pos(0, "o_orderkey"))


def raw_dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order, some with blank ids, bad arrivals or bad dates."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.when(k % 101 == 0, "  ").when(k % 103 == 0, "nan")
        .when(k % 107 == 0, F.concat(F.lit(" \t"), text(k), F.lit("\n")))
        .otherwise(text(k)).alias("Order_id"),
        F.when(k % 53 == 0, "None").otherwise(text("o_custkey")).alias("User_id"),
        F.when(k % 17 == 0, F.lit(None)).when(k % 13 == 0, "999999999999")
        .when(k % 2 == 0, F.concat(text(k % 20), F.lit("days")))
        .otherwise(text(k % 20)).alias("Estimated_arrival"),
        F.when(k % 19 == 0, "not-a-date")
        .when(k % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("Transaction_date"),
        pos(0, "o_orderkey"))


def stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_orders([raw_orders(spark, sf_dir)])


# -- order lines -----------------------------------------------------------------------


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(
        spark, f"{sf_dir}/lineitem.parquet", schema=table(spark, sf_dir, "lineitem").schema)


def raw_line_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product lines in file order."""
    return lines(spark, sf_dir).select(
        text("l_orderkey").alias("order_id"), F.lit("item").alias("product_name"),
        text("l_partkey").alias("product_id"), S.POSITION)


def raw_line_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price lines from a file that lists the same lines backwards."""
    row = -F.col(f"{S.POSITION}.row")
    return lines(spark, sf_dir).select(
        text("l_orderkey").alias("order_id"), text("l_extendedprice").alias("price"),
        F.concat(text(F.col("l_quantity").cast("int")), F.lit("pieces")).alias("quantity"),
        row_position(0, F.col(f"{S.POSITION}.file"), row).alias(S.POSITION))


def stg_line_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_line_products([raw_line_products(spark, sf_dir)])


def stg_line_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_line_prices([raw_line_prices(spark, sf_dir)])


# -- links, delays, campaigns ----------------------------------------------------------


def raw_order_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One merchant and one staff member per order, taken from its lines."""
    per_order = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("s"), F.max("l_linenumber").alias("n"))
    return per_order.select(
        text("l_orderkey").alias("Order ID"), text("s").alias("Merchant ID"),
        F.concat(text("s"), F.lit("-"), text("n")).alias("Staff ID"), pos(0, "l_orderkey"))


def stg_order_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_order_links([raw_order_links(spark, sf_dir)])


def raw_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longest shipping time per order in days."""
    ships = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("shipped"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = orders.join(ships, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select(
        text("o_orderkey").alias("order_id"),
        text(F.datediff("shipped", "o_orderdate")).alias("delay in days"), pos(0, "o_orderkey"))


def stg_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_delays(raw_delays(spark, sf_dir))


def raw_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order priorities as campaigns."""
    p = F.col("o_orderpriority")
    found = table(spark, sf_dir, "orders").select(p).distinct()
    rank = F.substring(p, 1, 1)
    return found.select(
        p.alias("Campaign_id"), F.lower(F.substring(p, 3, 100)).alias("Campaign_name"),
        F.concat(F.lit('"Priority '), rank, F.lit('"')).alias("Description"),
        F.concat(rank, F.lit("pct")).alias("Discount"), pos(0, rank.cast("int")))


def stg_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_campaigns(raw_campaigns(spark, sf_dir))


def raw_campaign_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the first three priorities belong to that campaign."""
    linked = table(spark, sf_dir, "orders").filter(F.substring("o_orderpriority", 1, 1) < "4")
    k = F.col("o_orderkey")
    return linked.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("transaction_date"),
        F.col("o_orderpriority").alias("campaign_id"),
        text(k).alias("order_id"), F.concat(text(k % 20), F.lit(" days")).alias("estimated arrival"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(text(k % 2)).alias("availed"),
        pos(0, k))


def stg_campaign_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_campaign_links(raw_campaign_links(spark, sf_dir))


# -- master data -----------------------------------------------------------------------


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").withColumnRenamed("r_name", "region_name")
    return table(spark, sf_dir, "nation").join(
        region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "region_name")


def _day_text(days: Column) -> Column:
    return F.date_format(
        F.date_add(F.lit("1990-01-01").cast("date"), days.cast("int")), "yyyy-MM-dd")


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, with a second row for every seventh one: newer, equally old or undated."""
    k = F.col("c_custkey")
    base = table(spark, sf_dir, "customer").join(
        _nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "left")

    def rows(slice_no: int, df: DataFrame, day: Column, suffix: str) -> DataFrame:
        return df.select(
            text(k).alias("User_id"), day.alias("Creation_date"),
            F.concat(F.lit("  "), "c_name", F.lit(suffix), F.lit("\t")).alias("Name"),
            F.concat(text(k % 100), F.lit(" Main St")).alias("Street"),
            F.col("region_name").alias("State"),
            F.concat("n_name", F.lit(" City")).alias("City"), F.col("n_name").alias("Country"),
            _day_text(-(k % 9000)).alias("Birthdate"),
            F.when(k % 2 == 0, "female").otherwise("male").alias("Gender"),
            text(k).alias("Device_address"), F.lower("c_mktsegment").alias("User_type"),
            pos(slice_no, k))

    day = _day_text(k % 1000)
    again = base.filter(k % 7 == 0)
    newer = F.when(k % 3 == 0, _day_text(k % 1000 + 500)).when(k % 3 == 1, day)
    return rows(0, base, day, "").unionByName(rows(1, again, newer, " jr"))


def stg_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_users(raw_users(spark, sf_dir))


def raw_user_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs; every fifth user appears again later in the file, every fourth has no job at all."""
    k = F.col("c_custkey")
    base = table(spark, sf_dir, "customer").filter(k % 4 != 0)

    def rows(slice_no: int, df: DataFrame, level: Column) -> DataFrame:
        return df.select(
            text(k).alias("user_id"), F.col("c_name").alias("name"),
            F.concat(F.lower("c_mktsegment"), F.lit(" clerk")).alias("job_title"),
            level.alias("job_level"), pos(slice_no, k))

    first = F.when(k % 3 != 0, F.concat(F.lit("L"), text(k % 3)))
    return rows(0, base, first).unionByName(rows(1, base.filter(k % 5 == 0), F.lit("L9")))


def stg_user_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_user_jobs(raw_user_jobs(spark, sf_dir))


def raw_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers, with an older second row for every third one."""
    k = F.col("s_suppkey")
    base = table(spark, sf_dir, "supplier").join(
        _nations(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"), "left")

    def rows(slice_no: int, df: DataFrame, day: Column, suffix: str) -> DataFrame:
        return df.select(
            text(k).alias("merchant_id"), day.alias("creation_date"),
            F.concat("s_name", F.lit(suffix)).alias("name"),
            F.concat(text(k), F.lit(" Market Sq")).alias("street"),
            F.col("region_name").alias("state"),
            F.concat("n_name", F.lit(" Port")).alias("city"), F.col("n_name").alias("country"),
            F.concat(F.lit("+1 ("), text(k % 1000), F.lit(") 555")).alias("contact_number"),
            pos(slice_no, k))

    day = _day_text(k % 700)
    return rows(0, base.filter(k % 3 == 0), _day_text(k % 700 - 30), " old").unionByName(
        rows(1, base, day, ""))


def stg_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_merchants(raw_merchants(spark, sf_dir))


def raw_staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staff: a supplier's line numbers; one row per return flag, the last shipped is newest."""
    found = table(spark, sf_dir, "lineitem").groupBy(
        "l_suppkey", "l_linenumber", "l_returnflag").agg(F.max("l_shipdate").alias("d"))
    flag = F.when(
        F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
    s, n = F.col("l_suppkey"), F.col("l_linenumber")
    return found.select(
        F.concat(text(s), F.lit("-"), text(n)).alias("staff_id"),
        F.concat(F.lit("Clerk "), text(s), F.lit(" "), "l_returnflag").alias("name"),
        F.concat(F.lit("L"), text(n)).alias("job_level"),
        F.concat(text(n), F.lit(" Back Rd")).alias("street"),
        F.lit("ST").alias("state"), F.concat(F.lit("Town "), text(s % 50)).alias("city"),
        F.concat(F.lit("Land "), "l_returnflag").alias("country"),
        F.concat(text(s), F.lit("/"), text(n)).alias("contact_number"),
        F.date_format("d", "yyyy-MM-dd").alias("creation_date"),
        pos(0, s * 100 + n * 10 + flag))


def stg_staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_staff(raw_staff(spark, sf_dir))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts; every fiftieth id has a second product, every fortieth row is listed twice."""
    k = F.col("p_partkey")
    base = table(spark, sf_dir, "part")

    def rows(slice_no: int, df: DataFrame, suffix: str) -> DataFrame:
        return df.select(
            text(k).alias("Product_id"),
            F.concat(F.lit(" "), F.upper("p_name"), F.lit(suffix)).alias("Product_name"),
            F.translate("p_type", " ", "_").alias("Product_type"),
            text("p_retailprice").alias("Price"), pos(slice_no, k))

    return rows(0, base, "").unionByName(rows(1, base.filter(k % 50 == 0), " II")).unionByName(
        rows(2, base.filter(k % 40 == 0), ""))


def stg_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_products(raw_products(spark, sf_dir))


def raw_dirty_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part, some without id, some with prices that are no number."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.when(k % 11 == 0, "").otherwise(text(k)).alias("Product_id"),
        F.concat(F.lit(" "), "p_name").alias("Product_name"),
        F.translate("p_type", " ", "_").alias("Product_type"),
        F.when(k % 6 == 0, "free").when(k % 6 == 1, "inf").otherwise(
            text("p_retailprice")).alias("Price"), pos(0, k))


def raw_dirty_line_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every product line, some without order, some without product."""
    return lines(spark, sf_dir).select(
        F.when(F.col("l_linenumber") == 2, "").otherwise(text("l_orderkey")).alias("Order_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("Product_name"),
        F.when(F.col("l_partkey") % 5 != 0, text("l_partkey")).alias("Product_id"),
        S.POSITION)


# -- star schema -----------------------------------------------------------------------
# Every query builds the dimensions it needs; their keys are numbered in written tables.


def build(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "dim_user":
        return dims.dim_user(stg_users(spark, sf_dir), stg_user_jobs(spark, sf_dir))
    if name == "dim_merchant":
        return dims.dim_merchant(stg_merchants(spark, sf_dir))
    if name == "dim_staff":
        return dims.dim_staff(stg_staff(spark, sf_dir))
    if name == "dim_product":
        return dims.dim_product(stg_products(spark, sf_dir))
    if name == "dim_campaign":
        return dims.dim_campaign(stg_campaigns(spark, sf_dir))
    raise KeyError(name)


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    users, merchants, staff, campaigns = side_by_side([
        partial(build, spark, sf_dir, f"dim_{d}") for d in ("user", "merchant", "staff", "campaign")])
    # what is counted from lines is written first, so that its shuffles are gone before the joins
    links, delays = (
        materialise(make(spark, sf_dir), name, plain=True)
        for make, name in ((stg_order_links, "links"), (stg_delays, "delays")))
    return facts.order_headers(
        stg_orders(spark, sf_dir), links, stg_campaign_links(spark, sf_dir), delays,
        users, merchants, staff, campaigns)


def order_items(spark: SparkSession, sf_dir: str, headers: DataFrame) -> DataFrame:
    return facts.order_items(
        stg_line_products(spark, sf_dir), stg_line_prices(spark, sf_dir),
        build(spark, sf_dir, "dim_product"), headers)


def money_as_double(df: DataFrame, *columns: str) -> DataFrame:
    """Exact decimals to double at the very end, for comparison with other engines."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})
