"""Load modes and whole jobs, run against a warehouse in the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.operators import validate
from starloom.plans import jobs, touched
from starloom.plans.jobs import Batch, Calendar
from starloom.plans.load import Warehouse
from starloom.queries import standin as st
from starloom.queries.registry import query
from starloom.session import remove_folder, scratch_path, spent_tables
from starloom.sources import Source

CALENDAR = Calendar("1995-01-01", "2001-12-31")

_STAGED = {
    "stg_order_data": st.stg_orders,
    "stg_order_delays": st.stg_delays,
    "stg_line_item_data_products": st.stg_line_products,
    "stg_line_item_data_prices": st.stg_line_prices,
    "stg_order_with_merchant_data": st.stg_order_links,
    "stg_campaign_data": st.stg_campaigns,
    "stg_transactional_campaign_data": st.stg_campaign_links,
    "stg_user_data": st.stg_users,
    "stg_user_job": st.stg_user_jobs,
    "stg_product_list": st.stg_products,
    "stg_merchant_data": st.stg_merchants,
    "stg_staff_data": st.stg_staff,
}


def _warehouse(spark: SparkSession, name: str) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, name))


def _base(wh: Warehouse, sf_dir: str, **changed: DataFrame) -> Warehouse:
    """Staging loaded from the stand-ins, some tables replaced by the given frames."""
    with spent_tables(wh.spark):
        wh.full_refresh_all({
            name: changed[name] if name in changed else make(wh.spark, sf_dir)
            for name, make in _STAGED.items()})
    return wh


def _csv(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    plain = df.drop(S.POSITION) if S.POSITION in df.columns else df
    plain.write.csv(path, header=True, escape='"')
    return path


@query("load_full_refresh", """
SELECT order_id, user_id, estimated_arrival, transaction_date FROM stg_orders
""")
def load_full_refresh(spark, sf_dir):
    """A table loaded twice; only the second load is visible."""
    wh = _warehouse(spark, "full-refresh")
    staged = st.stg_orders(spark, sf_dir)
    wh.full_refresh("stg_order_data", staged.filter(F.col("transaction_date") < "1998-01-01"))
    wh.full_refresh("stg_order_data", staged)
    return wh.read("stg_order_data")


@query("load_append", """
SELECT l_orderkey::VARCHAR AS order_id, l_partkey::VARCHAR AS product_id,
       CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END::INTEGER AS load_no
FROM lineitem
""")
def load_append(spark, sf_dir):
    """Product lines in a first load and two appended batches; positions tell the loads apart."""
    wh = _warehouse(spark, "append")
    table = "stg_line_item_data_products"
    raw = st.lines(spark, sf_dir).select(
        F.col("l_returnflag").alias("batch"), st.text("l_orderkey").alias("order_id"),
        F.lit("item").alias("product_name"), st.text("l_partkey").alias("product_id"), S.POSITION)

    def batch(flag: str) -> DataFrame:
        return st.staging.stage_line_products([raw.filter(F.col("batch") == flag).drop("batch")])

    wh.full_refresh(table, batch("A"))
    wh.append(table, batch("N"))
    wh.append(table, batch("R"))
    return wh.read(table).select(
        "order_id", "product_id", F.col(f"{S.POSITION}.slice").alias("load_no"))


@query("refresh_rejects", """
SELECT CASE WHEN p_partkey % 11 <> 0 THEN p_partkey::VARCHAR END AS product_id,
       lower(p_name) AS product_name,
       concat_ws(',', CASE WHEN p_partkey % 11 = 0 THEN 'missing_product_id' END,
                 CASE WHEN p_partkey % 6 < 2 THEN 'bad_price' END) AS reject_reasons
FROM part WHERE p_partkey % 11 = 0 OR p_partkey % 6 < 2
""")
def refresh_rejects(spark, sf_dir):
    """A full load of dirty products keeps what it refuses, with the reasons."""
    path = scratch_path(spark, "dirty-products")
    st.raw_dirty_products(spark, sf_dir).drop(S.POSITION).write.parquet(path)
    wh = _warehouse(spark, "rejects")
    jobs.load_staging(wh, {"stg_product_list": [Source(path, "parquet")]})
    return wh.read("stg_product_list_rejects").select("product_id", "product_name", "reject_reasons")


@query("incremental_keys", """
SELECT CASE WHEN s_suppkey % 2 = 0 THEN rank() OVER (PARTITION BY s_suppkey % 2 ORDER BY s_suppkey::VARCHAR)
            ELSE (SELECT count(*) FROM supplier WHERE s_suppkey % 2 = 0)
                 + rank() OVER (PARTITION BY s_suppkey % 2 ORDER BY s_suppkey::VARCHAR) END AS merchant_key,
       s_suppkey::VARCHAR AS source_merchant_id
FROM supplier
""")
def incremental_keys(spark, sf_dir):
    """Half of the merchants, then all of them: a second job keeps the keys of the first."""
    wh = _warehouse(spark, "incremental")
    staged = st.stg_merchants(spark, sf_dir)
    wh.full_refresh("stg_merchant_data", staged.filter("CAST(merchant_id AS BIGINT) % 2 = 0"))
    jobs.rebuild(wh)
    wh.full_refresh("stg_merchant_data", staged)
    jobs.rebuild(wh, keep_keys=True)
    return wh.read("dim_merchant").select("merchant_key", "source_merchant_id")


@query("quarantine_orphans", """
SELECT o_orderkey::VARCHAR AS order_id, strftime(o_orderdate, '%Y%m%d')::INTEGER AS date_key
FROM orders WHERE o_orderdate >= '1998-01-01'
""")
def quarantine_orphans(spark, sf_dir):
    """Orders on days that the calendar lacks stay out of the facts and are kept apart."""
    wh = _warehouse(spark, "orphans")
    wh.full_refresh("stg_order_data", st.stg_orders(spark, sf_dir))
    jobs.rebuild(wh, jobs.Calendar("1994-01-01", "1997-12-31"), on_orphans="quarantine")
    return wh.read("orphan_orders").select("order_id", "date_key")


def _source_files(spark: SparkSession, sf_dir: str) -> dict[str, list[Source]]:
    """The stand-ins written in the formats that departments deliver."""
    def files(df: DataFrame, name: str, fmt: str, **options) -> Source:
        path = scratch_path(spark, name)
        data = df.drop(S.POSITION)
        if fmt == "csv":
            data.write.csv(path, header=True, escape='"')
        elif fmt == "json":
            data.write.json(path)
            options["multi_line"] = False
        else:
            data.write.parquet(path)
        return Source(path, fmt, tuple(data.columns), options=options)

    orders = st.raw_orders(spark, sf_dir)
    day = F.col("transaction_date")
    backwards = st.raw_line_prices(spark, sf_dir).orderBy(S.POSITION)

    delays = st.raw_delays(spark, sf_dir)
    cell = F.concat(F.lit("<tr><td>"), "order_id", F.lit("</td><td>"),
                    F.col("delay in days"), F.lit("</td></tr>"))
    reports = delays.groupBy(F.floor(F.col("order_id").cast("bigint") / 5000).alias("page")).agg(
        F.concat(
            F.lit("<table><tr><th>order_id</th><th>Delay in days</th></tr>"),
            F.array_join(F.collect_list(cell), ""), F.lit("</table>")).alias("value"))
    html = scratch_path(spark, "delays-html")
    reports.write.partitionBy("page").text(html)

    packed = scratch_path(spark, "campaigns-packed")
    campaigns = st.raw_campaigns(spark, sf_dir)
    names = S.STAGING["stg_campaign_data"].fieldNames()
    spark.createDataFrame([("\t" + "\t".join(names),)], "value string").write.text(packed)
    campaigns.select(F.concat_ws(
        "\t", F.substring("Campaign_id", 1, 1), "Campaign_id", "Campaign_name", "Description",
        "Discount").alias("value")).write.mode("append").text(packed)

    def one(df: DataFrame, name: str, fmt: str = "csv") -> list[Source]:
        return [files(df, name, fmt)]

    # names carry a leading blank in the raw rows; CSV would cut it, JSON and Parquet keep it
    users = st.raw_users(spark, sf_dir).orderBy(S.POSITION)
    jobs_ = st.raw_user_jobs(spark, sf_dir).orderBy(S.POSITION)
    return {
        "stg_order_data": [
            files(orders.filter(day < "1997-01-01"), "orders-a", "parquet"),
            files(orders.filter((day >= "1996-12-01") & (day < "1999-01-01")), "orders-b", "csv"),
            files(orders.filter(day >= "1998-12-01"), "orders-c", "json"),
        ],
        "stg_order_delays": [Source(html, "html", ("order_id", "delay_in_days"))],
        "stg_line_item_data_products": one(
            st.raw_line_products(spark, sf_dir), "products-lines", "parquet"),
        "stg_line_item_data_prices": one(backwards, "prices-lines"),
        "stg_order_with_merchant_data": one(st.raw_order_links(spark, sf_dir), "links"),
        "stg_campaign_data": [Source(packed, "tab_packed", tuple(names))],
        "stg_transactional_campaign_data": one(
            st.raw_campaign_links(spark, sf_dir), "campaign-links"),
        "stg_user_data": one(users, "users", "json"),
        "stg_user_job": one(jobs_, "jobs"),
        "stg_product_list": one(st.raw_products(spark, sf_dir), "products", "parquet"),
        "stg_merchant_data": one(st.raw_merchants(spark, sf_dir), "merchants"),
        "stg_staff_data": one(st.raw_staff(spark, sf_dir).orderBy(S.POSITION), "staff"),
    }


_PERFORMANCE = """
SELECT row_number() OVER (ORDER BY campaign_key, date_key) AS campaign_perf_key, *
FROM campaign_days
"""


def _performance(wh: Warehouse) -> DataFrame:
    return st.money_as_double(
        wh.read("fact_campaign_performance"), "total_revenue", "average_order_value")


@query("refresh_all", _PERFORMANCE)
def refresh_all(spark, sf_dir):
    """Files in six formats to staging, dimensions and facts; campaign performance read back."""
    root = scratch_path(spark, "refresh")
    sources = _source_files(spark, sf_dir)

    def remove_files(table: str) -> None:
        for source in sources[table]:
            remove_folder(spark, source.path)

    jobs.refresh_all(spark, root, sources, CALENDAR, on_read=remove_files)
    return _performance(Warehouse(spark, root))


@query("scenario_new_orders", """
SELECT strftime(transaction_date, '%Y%m%d')::INTEGER AS date_key, count(*) AS n_orders
FROM stg_orders GROUP BY ALL
""")
def scenario_new_orders(spark, sf_dir):
    """The orders of the last year arrive as a new file; orders per day after the rebuild."""
    raw = st.raw_orders(spark, sf_dir)
    day = F.col("transaction_date")
    history = st.stg_orders(spark, sf_dir).filter(day < "2001-01-01")
    wh = _base(_warehouse(spark, "new-orders"), sf_dir, stg_order_data=history)
    batch = Batch("stg_order_data", _csv(raw.filter(day >= "2001-01-01"), "new-orders"))
    jobs.run_scenario(wh, [batch], CALENDAR)
    return wh.read("fact_orders").groupBy("date_key").agg(F.count(F.lit(1)).alias("n_orders"))


@query("scenario_new_entities", """
SELECT h.order_id, h.user_key, count(i.order_id) AS n_items,
       CASE WHEN count(i.order_id) = 0 THEN 0 ELSE sum(i.total_price)::DOUBLE END AS total_amount
FROM order_headers h LEFT JOIN order_items i ON h.order_id = i.order_id
GROUP BY h.order_id, h.user_key
""")
def scenario_new_entities(spark, sf_dir):
    """One market segment, large parts and pending orders with their lines arrive together."""
    users, products = st.raw_users(spark, sf_dir), st.raw_products(spark, sf_dir)
    sizes = st.table(spark, sf_dir, "part").filter("p_size >= 40").select(
        st.text("p_partkey").alias("Product_id"))
    pending = st.table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(
        st.text("o_orderkey").alias("order_id"))
    orders, lines, prices = (
        make(spark, sf_dir)
        for make in (st.stg_orders, st.stg_line_products, st.stg_line_prices))
    new_user = F.col("user_type") == "building"
    first_only = F.col(f"{S.POSITION}.slice") == 0
    wh = _base(
        _warehouse(spark, "new-entities"), sf_dir,
        stg_user_data=st.stg_users(spark, sf_dir).filter(~new_user),
        stg_product_list=st.staging.stage_products(
            products.join(sizes, "Product_id", "left_anti")),
        stg_order_data=orders.join(pending, "order_id", "left_anti"),
        stg_line_item_data_products=lines.join(pending, "order_id", "left_anti"),
        stg_line_item_data_prices=prices.join(pending, "order_id", "left_anti"))

    def test(table: str, df: DataFrame, ordered: bool = False) -> Batch:
        rows = df.orderBy(S.POSITION) if ordered else df
        return Batch(table, _csv(rows, table), "test")

    in_pending = pending.withColumnRenamed("order_id", "Order ID")
    batches = [
        test("stg_user_data", users.filter(new_user & first_only)),
        test("stg_product_list", products.join(sizes, "Product_id", "left_semi")),
        test("stg_order_data", st.raw_orders(spark, sf_dir).join(in_pending, "Order ID", "left_semi")),
        test("stg_line_item_data_products", lines.join(pending, "order_id", "left_semi"), True),
        test("stg_line_item_data_prices", prices.join(pending, "order_id", "left_semi"), True),
    ]
    jobs.run_scenario(wh, batches, CALENDAR)
    items = wh.read("fact_order_items").groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_items"))
    facts = wh.read("fact_orders").select("order_id", "user_key", "total_amount")
    joined = facts.join(items, "order_id", "left").withColumn(
        "n_items", F.coalesce("n_items", F.lit(0)))
    return st.money_as_double(joined, "total_amount")


@query("scenario_late_campaign", _PERFORMANCE)
def scenario_late_campaign(spark, sf_dir):
    """A campaign, its order links and its orders arrive late and are attributed after rebuild."""
    late = "2-HIGH"
    campaigns, links = st.raw_campaigns(spark, sf_dir), st.raw_campaign_links(spark, sf_dir)
    late_ids = links.filter(F.col("campaign_id") == late).select("order_id")
    raw = st.raw_orders(spark, sf_dir)
    wh = _base(
        _warehouse(spark, "late-campaign"), sf_dir,
        stg_campaign_data=st.stg_campaigns(spark, sf_dir).filter(F.col("campaign_id") != late),
        stg_transactional_campaign_data=st.stg_campaign_links(spark, sf_dir).filter(
            F.col("campaign_id") != late),
        stg_order_data=st.stg_orders(spark, sf_dir).join(late_ids, "order_id", "left_anti"))
    late_orders = raw.join(
        late_ids.withColumnRenamed("order_id", "Order ID"), "Order ID", "left_semi")
    batches = [
        Batch("stg_campaign_data", _csv(
            campaigns.filter(F.col("Campaign_id") == late), "late-campaign")),
        Batch("stg_transactional_campaign_data", _csv(
            links.filter(F.col("campaign_id") == late), "late-links")),
        Batch("stg_order_data", _csv(late_orders, "late-orders")),
    ]
    jobs.run_scenario(wh, batches, CALENDAR)
    return _performance(wh)


@query("scenario_dirty", """
WITH winners AS (
  SELECT *, reject_reasons = '' AND row_number() OVER (
             PARTITION BY order_id, reject_reasons ORDER BY pos) = 1
         AND order_id NOT IN (SELECT order_id FROM stg_orders
                              WHERE transaction_date < TIMESTAMP '1996-01-01') AS won
  FROM judged_orders),
outcomes AS (
  SELECT 'stg_order_data' AS table_name,
         CASE WHEN won THEN 'loaded' WHEN reject_reasons = '' THEN 'duplicate_key'
              ELSE reject_reasons END AS outcome FROM winners
  UNION ALL
  SELECT 'stg_order_data', 'loaded' FROM stg_orders
  WHERE transaction_date < TIMESTAMP '1996-01-01'
  UNION ALL
  SELECT 'stg_product_list', CASE WHEN r = '' THEN 'loaded' ELSE r END
  FROM (SELECT concat_ws(',', CASE WHEN p_partkey % 11 = 0 THEN 'missing_product_id' END,
                              CASE WHEN p_partkey % 6 < 2 THEN 'bad_price' END) AS r FROM part)
  UNION ALL
  SELECT 'stg_line_item_data_products', CASE WHEN r = '' THEN 'loaded' ELSE r END
  FROM (SELECT concat_ws(',', CASE WHEN l_linenumber = 2 THEN 'missing_order_id' END,
                              CASE WHEN l_partkey % 5 = 0 THEN 'missing_product_id' END) AS r
        FROM lineitem))
SELECT table_name, outcome, count(*) AS n_rows
FROM (SELECT table_name, unnest(string_split(outcome, ',')) AS outcome FROM outcomes)
GROUP BY ALL
""")
def scenario_dirty(spark, sf_dir):
    """Dirty orders, products and lines: good rows land, bad rows land in the reject tables."""
    wh = _warehouse(spark, "dirty")
    wh.full_refresh("stg_order_data", st.stg_orders(spark, sf_dir).filter(
        F.col("transaction_date") < "1996-01-01"))
    dirty = {
        "stg_order_data": st.raw_dirty_orders,
        "stg_product_list": st.raw_dirty_products,
        "stg_line_item_data_products": st.raw_dirty_line_products,
    }
    parts = []
    for name, make in dirty.items():
        jobs.append_batch(wh, Batch(name, _csv(make(spark, sf_dir), name), "dirty"))
        good = wh.read(name).select(F.lit("").alias(validate.REASONS))
        bad = wh.read(f"{name}_rejects").select(validate.REASONS)
        parts.append(validate.reject_metrics(good.unionByName(bad)).select(
            F.lit(name).alias("table_name"), "outcome", "n_rows"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_FOLLOWED = """
SELECT c.campaign_id, d.date_key, d.total_orders, d.total_revenue, d.average_order_value,
       d.unique_customers
FROM campaign_days d JOIN dim_campaign_v c ON d.campaign_key = c.campaign_key
"""


@query("follow_late_campaign", _FOLLOWED)
def follow_late_campaign(spark, sf_dir):
    """The late campaign of ``scenario_late_campaign``, but only the days it touches are replaced."""
    late = "2-HIGH"
    campaigns, links = st.raw_campaigns(spark, sf_dir), st.raw_campaign_links(spark, sf_dir)
    late_ids = links.filter(F.col("campaign_id") == late).select("order_id")
    wh = _base(
        _warehouse(spark, "follow-campaign"), sf_dir,
        stg_campaign_data=st.stg_campaigns(spark, sf_dir).filter(F.col("campaign_id") != late),
        stg_transactional_campaign_data=st.stg_campaign_links(spark, sf_dir).filter(
            F.col("campaign_id") != late))
    jobs.rebuild(wh, CALENDAR, by_day=True)
    touched.follow(wh, [
        Batch("stg_campaign_data", _csv(
            campaigns.filter(F.col("Campaign_id") == late), "late-campaign")),
        Batch("stg_transactional_campaign_data", _csv(
            links.join(late_ids, "order_id", "left_semi"), "late-links")),
    ], CALENDAR)
    figures = wh.read("fact_campaign_performance", S.STAR["fact_campaign_performance"])
    ids = wh.read("dim_campaign", S.STAR["dim_campaign"]).select("campaign_key", "campaign_id")
    return st.money_as_double(figures.join(ids, "campaign_key").select(
        "campaign_id", "date_key", "total_orders", "total_revenue", "average_order_value",
        "unique_customers"), "total_revenue", "average_order_value")


@query("follow_new_orders", """
SELECT order_id, date_key, total_amount::DOUBLE AS total_amount FROM fact_orders_v
""")
def follow_new_orders(spark, sf_dir):
    """The orders of the last month arrive behind their lines; their days alone are replaced."""
    raw = st.raw_orders(spark, sf_dir)
    day = F.col("transaction_date")
    history = st.stg_orders(spark, sf_dir).filter(day < "2001-07-01")
    wh = _base(_warehouse(spark, "follow-orders"), sf_dir, stg_order_data=history)
    jobs.rebuild(wh, CALENDAR, by_day=True)
    touched.follow(wh, [Batch("stg_order_data", _csv(
        raw.filter(day >= "2001-07-01"), "last-month"))], CALENDAR)
    return st.money_as_double(wh.read("fact_orders", S.STAR["fact_orders"]).select(
        "order_id", "date_key", "total_amount"), "total_amount")


@query("scenario_user_versions", """
SELECT o.order_id, CASE WHEN o.transaction_date >= TIMESTAMP '1996-01-01' THEN u.name END AS name,
       CASE WHEN o.transaction_date < TIMESTAMP '1996-01-01' THEN NULL
            WHEN o.transaction_date >= TIMESTAMP '1998-01-01' AND u.user_type = 'building'
            THEN 'Newtown' ELSE u.city END AS city
FROM stg_orders o LEFT JOIN dim_user_v u ON o.user_id = u.source_user_id
""")
def scenario_user_versions(spark, sf_dir):
    """A segment of users moves between two runs; orders name the user as of their time."""
    wh = _base(_warehouse(spark, "user-versions"), sf_dir)
    jobs.rebuild(wh, CALENDAR, versions_at="1997-01-01", versions_since="1996-01-01")
    moved = F.when(F.col("user_type") == "building", "Newtown").otherwise(F.col("city"))
    wh.full_refresh("stg_user_data", st.stg_users(spark, sf_dir).withColumn("city", moved))
    jobs.rebuild(wh, CALENDAR, keep_keys=True, versions_at="1998-01-01")
    who = wh.read("user_versions", S.USER_VERSIONS).select(
        F.col("version_key").alias("user_key"), "name", "city")
    return wh.read("fact_orders", S.STAR["fact_orders"]).join(who, "user_key", "left").select(
        "order_id", "name", "city")


@query("refresh_price_rejects", """
SELECT l_orderkey::VARCHAR AS order_id,
       CASE l_linenumber % 3 WHEN 0 THEN round(l_extendedprice, 2) WHEN 1 THEN NULL ELSE 0.3 END::DOUBLE
           AS price,
       CASE WHEN l_linenumber % 3 = 1 THEN 'inexact_price' ELSE '' END AS reject_reasons
FROM lineitem
""")
def refresh_price_rejects(spark, sf_dir):
    """Line prices: printed floats load as their number, too long decimals are shown as rejects."""
    n = F.col("l_linenumber") % 3
    text = F.when(n == 0, st.text(F.round("l_extendedprice", 2).cast("decimal(18,2)"))).when(
        n == 1, "0.1234567890123").otherwise("0.30000000000000004")
    path = scratch_path(spark, "prices")
    st.table(spark, sf_dir, "lineitem").select(
        st.text("l_orderkey").alias("order_id"), text.alias("price"),
        st.text(F.col("l_quantity").cast("int")).alias("quantity")).write.parquet(path)
    wh = _warehouse(spark, "price-rejects")
    jobs.load_staging(wh, {"stg_line_item_data_prices": [Source(path, "parquet")]})
    kept = wh.read("stg_line_item_data_prices").filter("price IS NOT NULL").select(
        "order_id", "price", F.lit("").alias("reject_reasons"))
    shown = wh.read("stg_line_item_data_prices_rejects").select("order_id", "price", "reject_reasons")
    return kept.unionByName(shown).withColumn("price", F.col("price").cast("double"))
