"""Positional pairing of two line lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.operators.blocks import bucket_counts, in_buckets, number_in_group


def line_counts(
    products: DataFrame, prices: DataFrame, key: str = "order_id"
) -> tuple[list[int], int]:
    """Buckets with orders that may be huge, and the number of lines on both lists."""
    ours, theirs = (bucket_counts(df.filter(F.col(key).isNotNull()), key) for df in (products, prices))
    return sorted({*ours[0], *theirs[0]}), ours[1] + theirs[1]


def pair_lines(
    products: DataFrame, prices: DataFrame, key: str = "order_id", busy: Sequence[int] | None = None
) -> DataFrame:
    """The n-th product line of an order with the n-th price line of the same order.

    Lines without a partner vanish. Orders of ordinary size are paired in one shuffle on the order,
    which later steps on the order use again. Orders that may be huge, by counts per bucket of orders,
    are numbered block by block and joined on (order, n), which spreads even an order with very many
    lines. ``busy``: the buckets of ``line_counts``, where the lists are parts of lists counted before.
    """
    left = products.filter(F.col(key).isNotNull())
    right = prices.filter(F.col(key).isNotNull())
    if busy is None:
        busy, _ = line_counts(left, right, key)
    if not busy:
        return _pair_small(left, right, key)
    huge = in_buckets(key, busy)
    small = _pair_small(left.filter(~huge), right.filter(~huge), key)
    return small.unionByName(_pair_huge(left.filter(huge), right.filter(huge), key))


def _pair_small(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Both lists in one shuffle; a window numbers each side, a second one meets equal numbers.

    The second window goes over whole orders, where the row behind a product line is its price line or
    none, since groups of one pair each would cost more than the rows in them. Positions are taken
    apart, as comparing structs costs twice as much.
    """
    at = [f"_at_{f.name}" for f in S.POSITION_TYPE.fields]

    def side(df: DataFrame, n: int, names: dict[str, str]) -> DataFrame:
        place = [F.col(f"{S.POSITION}.{f.name}").alias(a) for f, a in zip(S.POSITION_TYPE.fields, at)]
        return df.select(key, F.lit(n).alias("_side"), *place, *[
            F.col(c).alias(a) for c, a in names.items()])

    ours = {c: f"_l{i}" for i, c in enumerate(c for c in left.columns if c not in (key, S.POSITION))}
    theirs = {c: f"_r{i}" for i, c in enumerate(c for c in right.columns if c not in (key, S.POSITION))}
    both = side(left, 0, ours).unionByName(side(right, 1, theirs), allowMissingColumns=True)
    numbered = both.repartition(key).withColumn("rn", F.row_number().over(
        Window.partitionBy(key, "_side").orderBy(*at)).cast("bigint")).drop(*at)
    meet = Window.partitionBy(key).orderBy("rn", "_side")
    met = numbered.withColumns(
        {"_partner": F.lead("rn").over(meet)} | {a: F.lead(a).over(meet) for a in theirs.values()})
    # numbers are unique on a side, so an equal one behind a product line is that of a price line
    return met.filter((F.col("_side") == 0) & (F.col("_partner") == F.col("rn"))).select(
        key, "rn", *[F.col(a).alias(c) for c, a in (ours | theirs).items()])


def _pair_huge(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return number_in_group(left, [key]).join(number_in_group(right, [key]), [key, "rn"], "inner")


def lost_lines(
    products: DataFrame, prices: DataFrame, dim_product: DataFrame, orders: DataFrame,
    key: str = "order_id",
) -> DataFrame:
    """(reason, n_rows): lines that reach no fact, because a partner, product or order is missing.

    Lines without partner follow from the counts per order, which are combined before the shuffle.
    A pair that lacks both product and order counts for both.
    """
    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))

    both = counts(products, "n").join(counts(prices, "m"), key, "full")
    gap = F.coalesce("n", F.lit(0)) - F.coalesce("m", F.lit(0))
    sums = both.agg(F.sum(F.greatest(gap, F.lit(0))).alias("no_price"),
                    F.sum(F.greatest(-gap, F.lit(0))).alias("no_product_line"))
    pairs = pair_lines(products, prices, key).select(key, "product_id")

    def lost(df: DataFrame, known: DataFrame, on: str, reason: str) -> DataFrame:
        return df.join(known.select(on), on, "left_anti").agg(
            F.count(F.lit(1)).alias("n_rows")).select(F.lit(reason).alias("reason"), "n_rows")

    apart = sums.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("reason"), F.coalesce(c, F.lit(0)).alias("n_rows"))
        for c in ("no_price", "no_product_line")])))
    return apart.unionByName(lost(pairs, dim_product, "product_id", "unknown_product")).unionByName(
        lost(pairs, orders, key, "unknown_order"))
