"""Row validation, quarantine and constraint reports.

Reasons are computed in one pass as one text column, joined by commas (plain expressions only, so
the check stays inside generated code); a row is valid when the text is empty. Nothing is dropped
without a trace: rejected rows keep their values and their reasons.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import schemas as S

REASONS = "reject_reasons"
INEXACT = "_inexact"


def with_reasons(
    df: DataFrame, rules: Mapping[str, Column], checked: Sequence[str] | None = None
) -> DataFrame:
    """``rules`` maps a reason to the condition under which a row is bad.

    Filters on cleaned columns would be pushed below the cleaning and repeat all of it inside the
    filter, several times over. Passing the ``checked`` columns (those the rules look at, all by
    default) through ``inline`` stops that: every value is computed once. The other columns stay
    outside, so a query that does not select them does not read them.
    """
    inside = list(checked) if checked is not None else df.columns
    found = [F.when(bad, F.lit(reason)) for reason, bad in rules.items()]
    row = F.struct(*[F.col(c) for c in inside], F.concat_ws(",", *found).alias(REASONS))
    outside = [c for c in df.columns if c not in inside]
    return df.select(*outside, F.inline(F.array(row))).select(*df.columns, REASONS)


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASONS) == "").drop(REASONS)


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASONS) != "")


def reject_metrics(df: DataFrame) -> DataFrame:
    """Rows per outcome: "loaded" and one line per reason (a row counts once per reason)."""
    # combinations of reasons are few: they are counted first and taken apart afterwards
    counts = df.groupBy(REASONS).agg(F.count(F.lit(1)).alias("n"))
    outcome = F.when(F.col(REASONS) == "", "loaded").otherwise(F.col(REASONS))
    return counts.select(F.explode(F.split(outcome, ",")).alias("outcome"), "n").groupBy(
        "outcome").agg(F.sum("n").alias("n_rows"))


def order_rules() -> dict[str, Column]:
    """Rules for orders that went through ``plans.staging.clean_orders``."""
    return {
        "missing_order_id": F.col("order_id").isNull(),
        "missing_user_id": F.col("user_id").isNull(),
        "bad_estimated_arrival": F.col("estimated_arrival").isNull(),
        "bad_transaction_date": F.col("transaction_date").isNull(),
    }


def product_rules() -> dict[str, Column]:
    """Rules for products; ``INEXACT`` tells that the price is a number too long to be stored."""
    return {
        "missing_product_id": F.col("product_id").isNull(),
        "bad_price": F.col("price").isNull() & ~F.col(INEXACT),
        "inexact_price": F.col(INEXACT),
    }


def line_product_rules() -> dict[str, Column]:
    return {
        "missing_order_id": F.col("order_id").isNull(),
        "missing_product_id": F.col("product_id").isNull(),
    }


def known_keys(existing: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The key values of ``batch`` that ``existing`` has."""
    return existing.select(key).join(batch.select(key), key, "left_semi").distinct()


def flag_key_conflicts(
    df: DataFrame, key: str, existing: DataFrame | None = None, position: str = S.POSITION
) -> DataFrame:
    """Add the reason "duplicate_key" to valid rows that a unique column would refuse.

    Row by row in load order the first valid row of a key wins, unless the key is already there.
    The winner per key is one aggregation; winners meet the rows on their position, so copies of
    one key never meet in a task. The loaded table is reduced to the keys of the batch first: with
    a small batch it is only streamed past a broadcast, not shuffled.
    """
    winners = df.filter((F.col(REASONS) == "") & F.col(key).isNotNull()).groupBy(key).agg(
        F.min(position).alias("_winner"))
    if existing is not None:
        winners = winners.join(known_keys(existing, winners, key), key, "left_anti")
    winners = winners.select("_winner")
    joined = df.join(winners, F.col(position) == F.col("_winner"), "left")
    conflict = (F.col(REASONS) == "") & F.col(key).isNotNull() & F.col("_winner").isNull()
    return joined.withColumn(
        REASONS,
        F.when(conflict, F.lit("duplicate_key")).otherwise(F.col(REASONS)),
    ).drop("_winner")


def key_violations(df: DataFrame, table: str, unique: Sequence[str], not_null: Sequence[str] = ()
                   ) -> DataFrame:
    """(table, column, problem, value, n_rows) per repeated value and per NULL in a key column."""
    def line(src: DataFrame, column: str, problem: str) -> DataFrame:
        return src.select(
            F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
            F.lit(problem).alias("problem"), F.col("value"), F.col("n_rows"))

    parts = []
    for c in unique:
        counts = df.filter(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("value"))
        counts = counts.agg(F.count(F.lit(1)).alias("n_rows"))
        parts.append(line(counts.filter("n_rows > 1"), c, "not_unique"))
    for c in not_null:
        nulls = df.filter(F.col(c).isNull()).agg(F.count(F.lit(1)).alias("n_rows"))
        nulls = nulls.withColumn("value", F.lit(None).cast("string"))
        parts.append(line(nulls.filter("n_rows > 0"), c, "null"))
    return reduce(DataFrame.unionByName, parts)


def any_repeated(df: DataFrame, column: str) -> bool:
    """Whether values of a column may repeat; False is certain, as equal values have equal hashes.

    Hashes are counted in place of values, which makes long texts short numbers in the shuffle.
    """
    hashes = df.filter(F.col(column).isNotNull()).groupBy(
        F.xxhash64(F.col(column).cast("string")).alias("h")).agg(F.count(F.lit(1)).alias("n_rows"))
    return not hashes.filter("n_rows > 1").isEmpty()


def refuse_bad_keys(
    df: DataFrame, table: str, unique: Sequence[str], not_null: Sequence[str] = (),
) -> None:
    """Raise when ``key_violations`` has rows, which is gone through for the columns in doubt only."""
    doubtful = [c for c in unique if any_repeated(df, c)]
    if doubtful or not_null:
        refuse_if_any(key_violations(df, table, doubtful, not_null), f"{table} breaks its keys")


def fk_orphans(
    df: DataFrame, table: str, references: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """(table, column, value, n_rows) per key value that its dimension does not have.

    The fact is first reduced to distinct key values, so the anti join sees each value once.
    """
    parts = []
    for column, (dim, dim_key) in references.items():
        used = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v")).agg(
            F.count(F.lit(1)).alias("n_rows"))
        lost = used.join(dim.select(F.col(dim_key).alias("_v")), "_v", "left_anti")
        parts.append(lost.select(
            F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
            F.col("_v").cast("string").alias("value"), "n_rows"))
    return reduce(DataFrame.unionByName, parts)


class ConstraintError(ValueError):
    """A load was refused because it breaks a declared constraint."""


def refuse_if_any(report: DataFrame, what: str) -> None:
    """Raise with a few examples when a constraint report has rows."""
    examples = report.limit(5).collect()
    if examples:
        raise ConstraintError(f"{what}: {[r.asDict() for r in examples]}")
