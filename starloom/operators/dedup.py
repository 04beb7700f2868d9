"""Duplicate handling that survives ids with any number of copies.

The kept row per id is found by an aggregation (combined before the shuffle), and rows are then
matched on their unique position instead of on the id. No step gathers all copies of an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.functions import flag_is_true
from starloom.session import materialise


def dedup_exact(df: DataFrame) -> DataFrame:
    """Drop rows that are equal in all columns (NULL equals NULL); positions do not count."""
    return df.drop(S.POSITION).distinct()


def _flag(df: DataFrame, id_col: str, master: Column, position: str) -> DataFrame:
    """Flag every row whose position is not the ``master`` position of its id.

    The rows are written once: positions of text files may differ between two scans of them.
    """
    df = materialise(df, "positioned")
    masters = df.groupBy(id_col).agg(master.alias("_master")).select(
        F.col(f"_master.{position}").alias("_master"))
    flagged = df.join(masters, F.col(position) == F.col("_master"), "left")
    dup = F.col("_master").isNull()
    return flagged.withColumns({
        "possible_duplicate": dup,
        "possible_duplicate_of": F.when(dup, F.col(id_col)),
    }).drop("_master")


def soft_dedup_latest(
    df: DataFrame, id_col: str, date_col: str = "creation_date", position: str = S.POSITION
) -> DataFrame:
    """Newest row per id is the master; all others are flagged and point to the id.

    Missing dates are oldest; equal dates are settled by load order. Rows without an id form one
    group of their own.
    """
    # the smallest (undated, minus date, position) is the newest row that was loaded first
    age = -F.unix_micros(F.col(date_col).cast("timestamp"))
    rank = F.struct(
        F.col(date_col).isNull().alias("undated"), age.alias("age"), F.col(position).alias(position))
    return _flag(df, id_col, F.min(rank), position)


def soft_dedup_file_order(df: DataFrame, id_col: str, position: str = S.POSITION) -> DataFrame:
    """The last row of the file is the master, all earlier ones are flagged."""
    return _flag(df, id_col, F.max(F.struct(F.col(position).alias(position))), position)


def master_rows(
    df: DataFrame, id_col: str, flag: str = "possible_duplicate", position: str = S.POSITION
) -> DataFrame:
    """One row per id: flagged rows and rows without id dropped, first in load order kept."""
    kept = df
    if flag in df.columns:
        kept = kept.filter(~flag_is_true(F.col(flag)))
    kept = kept.filter(F.col(id_col).isNotNull())
    others = [c for c in df.columns if c != id_col]
    first = F.min_by(F.struct(*[F.col(c) for c in others]), F.col(position)).alias("_row")
    return kept.groupBy(id_col).agg(first).select(id_col, "_row.*").select(*df.columns)
