"""The three facts.

Items need the keys of their header and headers need the totals of their items. The circle is cut:
headers without totals -> items -> totals -> headers with totals.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import functions as fn
from starloom import schemas as S
from starloom.operators import headers, keys
from starloom.operators.history import asof_lookup
from starloom.operators.pairing import line_counts, pair_lines
from starloom.session import remove_folder, write_scratch


def _lookup(orders: DataFrame, dim: DataFrame, on: str, source: str, key: str) -> DataFrame:
    """Left lookup of a surrogate key for orders.

    No broadcast hint: dimensions may outgrow any executor, and the optimiser broadcasts the
    two-column side by its measured size anyway. When it has to shuffle, orders without an id,
    often the largest group, are spread by their order id (behind a character that no id holds)
    instead of meeting in one task; hot ids are split by adaptive skew handling, since the
    dimension side has one row per id. Such an order never meets a member, whatever its id.
    """
    spread = F.coalesce(F.col(on), F.concat(F.lit("\x00"), F.col("order_id")))
    right = dim.select(F.col(source).alias("_source"), key)
    known = (spread == F.col("_source")) & F.col(on).isNotNull()
    return orders.join(right, known, "left").drop("_source")


def order_headers(
    orders: DataFrame, links: DataFrame, campaign_links: DataFrame, delays: DataFrame,
    dim_user: DataFrame, dim_merchant: DataFrame, dim_staff: DataFrame, dim_campaign: DataFrame,
    user_versions: DataFrame | None = None,
) -> DataFrame:
    """Orders with dimension keys and delay, without totals.

    The three order-level joins share one shuffle on order_id. With ``user_versions`` (user_id,
    user_key, valid_from, valid_to) an order has the user key that was valid at its time, and
    ``dim_user`` is not looked at.
    """
    base = orders.select("order_id", "user_id", fn.date_key(F.col("transaction_date")).alias("date_key"))
    if user_versions is not None:
        base = asof_lookup(
            orders.select("order_id", "user_id", "transaction_date"), user_versions, "user_id",
            "transaction_date", "user_key").select(
            "order_id", "user_id", "user_key",
            fn.date_key(F.col("transaction_date")).alias("date_key"))
    joined = (
        base
        .join(links.select("order_id", "merchant_id", "staff_id"), "order_id", "left")
        .join(campaign_links.select("order_id", "campaign_id"), "order_id", "left")
        .join(delays.select("order_id", "delay_in_days"), "order_id", "left")
    )
    keyed = joined if user_versions is not None else _lookup(
        joined, dim_user, "user_id", "source_user_id", "user_key")
    keyed = _lookup(keyed, dim_merchant, "merchant_id", "source_merchant_id", "merchant_key")
    keyed = _lookup(keyed, dim_staff, "staff_id", "source_staff_id", "staff_key")
    keyed = _lookup(keyed, dim_campaign, "campaign_id", "campaign_id", "campaign_key")
    return keyed.select(
        "order_id", "user_key", "merchant_key", "staff_key", "campaign_key", "date_key",
        "delay_in_days")


def _line_total() -> Column:
    return (F.col("quantity").cast("decimal(10,0)") * F.col("unit_price")).cast(S.TOTAL)


def order_items(
    products: DataFrame, prices: DataFrame, dim_product: DataFrame, headers_: DataFrame,
    busy: Sequence[int] | None = None,
) -> DataFrame:
    """Order lines with keys and extended price, before numbering.

    Only lines with a price partner, a known product and a known order remain. A product id that
    occurs several times in the dimension repeats the line. ``busy``: see ``pair_lines``.
    """
    paired = pair_lines(products.select("order_id", "product_id", S.POSITION), prices, busy=busy)
    priced = paired.select(
        "order_id", "rn", "product_id", "quantity", F.col("price").alias("unit_price"))
    # orders first: the pairs lie by order already
    head = headers_.select("order_id", "user_key", "merchant_key", "campaign_key", "date_key")
    known = priced.join(head, "order_id", "inner")
    return known.join(
        dim_product.select("product_id", "product_key"), "product_id", "inner").select(
        "order_id", "rn", "product_key", "user_key", "merchant_key", "campaign_key", "date_key",
        "quantity", "unit_price", _line_total().alias("total_price"))


def order_totals(items: DataFrame) -> DataFrame:
    """Sum of line totals per order; NULL when every line price is missing."""
    return items.groupBy("order_id").agg(F.sum("total_price").cast(S.TOTAL).alias("order_total"))


def with_totals(headers_: DataFrame, totals: DataFrame) -> DataFrame:
    """Header totals: 0 without lines, the (possibly NULL) sum with lines."""
    right = totals.select("order_id", "order_total", F.lit(True).alias("_has_lines"))
    total = F.when(F.col("_has_lines"), F.col("order_total")).otherwise(F.lit(0))
    return headers_.join(right, "order_id", "left").withColumn(
        "total_amount", total.cast(S.TOTAL)).drop("order_total", "_has_lines")


def _numbered(
    df: DataFrame, name: str, key: str, order: Sequence[str], start: int = 1
) -> tuple[DataFrame, int]:
    """Rows with a dense key, and the next free one. They are written before they are sorted, so that
    finding the range borders repeats no join, and that copy goes when the sorted one is there."""
    rows, folder = write_scratch(df, name, plain=True)
    keyed = keys.number_rows(rows, key, order, start, name=key)
    remove_folder(df.sparkSession, folder)
    return keyed


def fact_orders(headers_: DataFrame, totals: DataFrame) -> DataFrame:
    keyed, _ = _numbered(with_totals(headers_, totals), "orders", "order_key", ["order_id"])
    return headers.shape(keyed, S.STAR["fact_orders"])


def _fact_order_items(items: DataFrame, start: int) -> tuple[DataFrame, int]:
    keyed, free = _numbered(items.drop("total_price"), "items", "order_item_key", [
        "order_id", "rn", "product_key"], start)
    return headers.shape(
        keyed.withColumn("total_price", _line_total()), S.STAR["fact_order_items"]), free


def fact_order_items(items: DataFrame, start: int = 1) -> DataFrame:
    """Lines of ``order_items``, numbered. The total of a line follows from its other columns and is
    not carried through the sorting."""
    return _fact_order_items(items, start)[0]


#: Lines are gone through in a pass for every so many of them, and in at most so many passes.
PASS_LINES = 1 << 21
MOST_PASSES = 3
#: About so many order ids come to the driver when borders between passes are looked for.
_BORDER_IDS = 1 << 12


def n_passes(n_lines: int) -> int:
    return max(1, min(MOST_PASSES, -(-n_lines // PASS_LINES)))


def order_ranges(headers_: DataFrame, n: int) -> list[Column]:
    """Conditions that deal orders to ``n`` ranges of ids, in rising order, of about equal numbers.

    The borders are ids picked by their hashes, so two runs have the same ones. Few ids give fewer
    ranges. Rows without an id are in none.
    """
    order_id = F.col("order_id")
    ids = headers_.select(order_id).filter(order_id.isNotNull())
    some = [] if n < 2 else [r["order_id"] for r in ids.filter(F.pmod(
        F.xxhash64(order_id), F.lit(max(1, ids.count() // _BORDER_IDS))) == 0).distinct().orderBy(
        order_id).collect()]
    borders = list(dict.fromkeys(some[len(some) * i // n] for i in range(1, n))) if some else []
    lower = [None, *borders]
    upper = [*borders, None]
    found = []
    for low, high in zip(lower, upper):
        within = order_id.isNotNull() if low is None else order_id >= F.lit(low)
        found.append(within if high is None else within & (order_id < F.lit(high)))
    return found


def day_ranges(df: DataFrame, n_rows: int) -> list[Column]:
    """Conditions that deal ``n_rows`` rows to passes over ranges of days, in rising order, from the
    counts per day. Rows without a day are in the first range."""
    n = n_passes(n_rows)
    if n < 2:
        return [F.lit(True)]
    # one number per day of the calendar
    days = df.groupBy("date_key").count().orderBy("date_key").collect()
    borders, seen = [], 0
    for r in days:
        if len(borders) + 1 < n and r["date_key"] is not None and seen >= n_rows * (len(borders) + 1) // n:
            borders.append(r["date_key"])
        seen += r["count"]
    day = F.coalesce(F.col("date_key"), F.lit(-1))
    lower, upper = [None, *borders], [*borders, None]
    return [(F.lit(True) if low is None else day >= low) & (F.lit(True) if high is None else day < high)
            for low, high in zip(lower, upper)]


def laid_by_day(df: DataFrame) -> list[DataFrame]:
    """Parts of a fact, one pass each, that written one after the other are sorted by day and order.

    The total of an item is made again behind the sorting.
    """
    order = [c for c in ("date_key", "order_id") if c in df.columns]
    rows = df.drop("total_price")
    parts = [rows.filter(days).repartitionByRange(*order).sortWithinPartitions(*order)
             for days in day_ranges(df, df.count())]
    if "total_price" not in df.columns:
        return parts
    return [x.withColumn("total_price", _line_total()).select(*df.columns) for x in parts]


def all_order_items(
    products: DataFrame, prices: DataFrame, dim_product: DataFrame, headers_: DataFrame,
    start: int = 1,
) -> DataFrame:
    """``fact_order_items`` of ``order_items``, made in passes over ranges of orders.

    What pairing, lookups and sorting put on the disks is there for the orders of one pass at a time,
    beside the finished rows. A pass has the orders behind those of the one before, so it goes on with
    the next number, and keys are those that a single pass gives.
    """
    busy, n_lines = line_counts(products, prices)
    done = []
    for within in order_ranges(headers_, n_passes(n_lines)):
        items = order_items(products.filter(within), prices.filter(within), dim_product,
                            headers_.filter(within), busy)
        keyed, start = _fact_order_items(items, start)
        done.append(keyed)
    return reduce(DataFrame.unionByName, done)


def campaign_days(orders: DataFrame) -> DataFrame:
    """Orders, revenue, average and customers per campaign and day, before numbering.

    Averages skip NULL totals while the order count includes them. The distinct count runs on
    (campaign, day, customer) first, so a busy campaign day is spread over many tasks.
    """
    return orders.filter(F.col("campaign_key").isNotNull()).groupBy("campaign_key", "date_key").agg(
        F.count(F.lit(1)).cast("int").alias("total_orders"),
        F.sum("total_amount").cast(S.TOTAL).alias("total_revenue"),
        F.avg("total_amount").cast("decimal(38,8)").alias("average_order_value"),
        F.count_distinct("user_key").cast("int").alias("unique_customers"))


def fact_campaign_performance(orders: DataFrame) -> DataFrame:
    keyed = keys.dense_keys(
        campaign_days(orders), "campaign_perf_key", ["campaign_key", "date_key"],
        name="campaign_perf_key")
    return headers.shape(keyed, S.STAR["fact_campaign_performance"])
