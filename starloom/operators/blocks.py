"""Ordered work inside groups of any size.

A window over a key puts all rows of that key into one task; with a key that holds a third of the
data this task never ends. Here the window runs over (key, block), where a block is a run of
limited length in the sort order, and a small table with one row per (key, block) carries the
result across block borders. The wide rows are shuffled once, on (key, block). Keys must not be
NULL: a NULL key is no group, its rows are only looked at block by block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.session import materialise

_BLOCK = "_block"
_TIE = "_running"


def range_blocks(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """The rows, written once, with a column ``block``: runs of about equal length in ``order``.

    Ranges are cut by the number of rows, so a busy key has many blocks. ``order`` begins with the
    key; rows that it does not tell apart, equal ones too, are cut by a running number.
    """
    order = [*order, _TIE]
    told = df.withColumn(_TIE, F.monotonically_increasing_id())
    dealt = told.repartitionByRange(*order).sortWithinPartitions(*order).drop(_TIE)
    return materialise(dealt.withColumn("block", F.spark_partition_id()), name)


#: Keys are counted in so many buckets, a bucket with more rows than BUSY may hold a huge key.
BUCKETS = 1 << 16
BUSY = 1 << 20


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS))


def busy_buckets(df: DataFrame, key: str, busy: int | None = None) -> list[int]:
    """Buckets of keys with more than ``busy`` rows; every key with so many rows lies in one.

    Counts per bucket are combined before the shuffle, so this is little more than a scan of the
    key. What comes back has at most one number for every ``busy`` rows and no more than BUCKETS.
    """
    return bucket_counts(df, key, busy)[0]


def bucket_counts(df: DataFrame, key: str, busy: int | None = None) -> tuple[list[int], int]:
    """``busy_buckets`` with the number of all rows."""
    counts = df.groupBy(_bucket(key).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    often = F.when(F.col("n") > (BUSY if busy is None else busy), F.col("b"))
    found = counts.agg(F.collect_list(often).alias("often"), F.sum("n").alias("rows")).first()
    return found["often"], found["rows"] or 0


def in_buckets(key: str, buckets: Sequence[int]) -> Column:
    return _bucket(key).isin(list(buckets))


def position_block(position: str = S.POSITION) -> Column:
    return F.struct(f"{position}.slice", f"{position}.file", f"{position}.block")


def _with_carry(df: DataFrame, per_block: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach the one row per (key, block) of ``per_block``.

    Plain equality on purpose: it lets the join reuse the (key, block) shuffle of the window.
    """
    carry = [c for c in per_block.columns if c.startswith("_carry")]
    return df.join(per_block.select(*keys, _BLOCK, *carry), [*keys, _BLOCK], "left")


def number_in_group(
    df: DataFrame, keys: Sequence[str], out: str = "rn", position: str = S.POSITION
) -> DataFrame:
    """``row_number() over (partition by keys order by position)`` with bounded groups.

    The number replaces the position in the result.
    """
    # the position is cut to what the windows need before anything is shuffled
    rows = df.withColumn(_BLOCK, position_block(position)).withColumn(
        "_row", F.col(f"{position}.row")).drop(position)
    # rows of earlier blocks of the same key
    sizes = rows.groupBy(*keys, _BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(
        Window.unboundedPreceding, -1)
    carry = sizes.withColumn("_carry_n", F.sum("_n").over(earlier)).filter(
        F.col("_carry_n").isNotNull())
    local = F.row_number().over(Window.partitionBy(*keys, _BLOCK).orderBy("_row"))
    numbered = _with_carry(rows.withColumn("_local", local), carry, keys)
    return numbered.withColumn(
        out, (F.col("_local") + F.coalesce(F.col("_carry_n"), F.lit(0))).cast("bigint")
    ).drop("_local", "_carry_n", "_row", _BLOCK)


def next_in_group(
    df: DataFrame, keys: Sequence[str], order: str, block: Column, out: str
) -> DataFrame:
    """``lead(order) over (partition by keys order by order)``; ``block`` must rise with order."""
    rows = df.withColumn(_BLOCK, block)
    firsts = rows.groupBy(*keys, _BLOCK).agg(F.min(order).alias("_first"))
    by_block = Window.partitionBy(*keys).orderBy(_BLOCK)
    carry = firsts.withColumn("_carry_next", F.lead("_first").over(by_block))
    local = F.lead(order).over(Window.partitionBy(*keys, _BLOCK).orderBy(order))
    joined = _with_carry(rows.withColumn(out, local), carry, keys)
    return joined.withColumn(out, F.coalesce(F.col(out), F.col("_carry_next"))).drop(
        "_carry_next", _BLOCK)


def last_before(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, block: Column,
    out: str,
) -> DataFrame:
    """Last non-NULL ``value`` at or before each row, in ``order`` within ``keys``.

    ``block`` must rise with the first order column.
    """
    rows = df.withColumn(_BLOCK, block).withColumn("_order", F.struct(*order))
    lasts = rows.filter(F.col(value).isNotNull()).groupBy(*keys, _BLOCK).agg(
        F.max_by(value, "_order").alias("_last"))
    blocks = rows.select(*keys, _BLOCK).distinct()
    filled = _with_carry(blocks, lasts.withColumnRenamed("_last", "_carry_last"), keys)
    earlier = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(
        Window.unboundedPreceding, -1)
    carry = filled.withColumn(
        "_carry_prev", F.last("_carry_last", ignorenulls=True).over(earlier)
    ).drop("_carry_last").filter(F.col("_carry_prev").isNotNull())
    upto = Window.partitionBy(*keys, _BLOCK).orderBy("_order").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = F.last(value, ignorenulls=True).over(upto)
    joined = _with_carry(rows.withColumn(out, local), carry, keys)
    return joined.withColumn(out, F.coalesce(F.col(out), F.col("_carry_prev"))).drop(
        "_carry_prev", _BLOCK, "_order")
