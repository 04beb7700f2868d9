"""Surrogate keys: dense, stable, assigned without a global one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import materialise

_ROW_BITS = 33


def new_members(candidates: DataFrame, existing: DataFrame, id_col: str) -> DataFrame:
    """Candidates whose business key the dimension does not have yet."""
    return candidates.join(existing.select(id_col), id_col, "left_anti")


def next_key(existing: DataFrame, key: str) -> int:
    """First free key: largest key + 1, or 1 for an empty dimension."""
    top = existing.agg(F.max(key).alias("top")).first()["top"]
    return 1 if top is None else int(top) + 1


def dense_keys(
    df: DataFrame, key: str, order: Sequence[str | Column], start: int = 1,
    partitions: int | None = None, name: str = "keys",
) -> DataFrame:
    """Number all rows ``start, start+1, ...`` in ``order``.

    The rows are range-partitioned and sorted, so partition i holds only smaller rows than
    partition i+1 and the running id of a row inside its partition is its local number. This
    layout is written once (re-running the sampling of a range partitioning could move the
    borders), then one count per partition turns local into global numbers. The driver sees as
    many numbers as there are partitions. Without ``partitions`` the session's shuffle setting
    applies and small neighbouring ranges are merged, which keeps their order.
    """
    return number_rows(df, key, order, start, partitions, name)[0]


def number_rows(
    df: DataFrame, key: str, order: Sequence[str | Column], start: int = 1,
    partitions: int | None = None, name: str = "keys",
) -> tuple[DataFrame, int]:
    """``dense_keys`` with the first number that is still free."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = (df.repartitionByRange(partitions, *cols) if partitions
              else df.repartitionByRange(*cols))
    laid_out = materialise(
        ranged.sortWithinPartitions(*cols).withColumn("_rid", F.monotonically_increasing_id()),
        name, plain=True)
    part = F.shiftright("_rid", _ROW_BITS).cast("int")
    counts = {r["p"]: r["n"] for r in laid_out.groupBy(part.alias("p")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    offsets, total = [], start
    for p in range(max(counts, default=-1) + 1):
        offsets.append(total)
        total += counts.get(p, 0)
    if not offsets:
        return laid_out.withColumn(key, F.lit(None).cast("bigint")).drop("_rid"), start
    local = F.col("_rid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    base = F.get(F.lit(offsets).cast("array<bigint>"), part)
    return laid_out.withColumn(key, (base + local).cast("bigint")).drop("_rid"), total


def assign_surrogate_keys(
    candidates: DataFrame, existing: DataFrame, key: str, id_col: str,
    partitions: int | None = None,
) -> DataFrame:
    """New members only, numbered by business key from the largest existing key on."""
    fresh = new_members(candidates, existing, id_col)
    return dense_keys(
        fresh, key, [id_col], start=next_key(existing, key), partitions=partitions, name=key)
