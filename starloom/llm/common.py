"""Helpers that several operators share: row locators, batch sizes, stable text columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import materialise

LOCATOR = "__locator"

#: White space of the text contracts: blank and the five control characters 9 to 13.
WHITE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Texts sent to a Python worker at once; with Spark's 10,000 a worker would hold several copies of
#: tens of megabytes.
TEXT_ROWS = 256


def text_batches(spark: SparkSession) -> None:
    """From now on the session sends rows to Python in batches of few rows."""
    if int(spark.conf.get(_ARROW_ROWS)) != TEXT_ROWS:
        spark.conf.set(_ARROW_ROWS, str(TEXT_ROWS))


@contextmanager
def slim_batches(spark: SparkSession, rows: int = 1 << 16) -> Iterator[None]:
    """Larger batches for jobs over narrow rows that run within the block."""
    before = spark.conf.get(_ARROW_ROWS)
    spark.conf.set(_ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_ARROW_ROWS, before)


def whole_text(c: str | Column) -> Column:
    """The text, a missing one as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


#: Steps of an analysed plan after which a row of a file is still one row.
_ROW_FOR_ROW = {"Project", "Filter", "SubqueryAlias", "Relation", "LogicalRelation", "View"}


def _plain_scan(df: DataFrame) -> bool:
    """Whether the rows are those of one scan of files, each once at most."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.children().size() == 1 and plan.nodeName() in _ROW_FOR_ROW:
        plan = plan.children().apply(0)
    return plan.children().size() == 0 and plan.nodeName() in _ROW_FOR_ROW


def with_locator(df: DataFrame) -> DataFrame:
    """Adds ``LOCATOR`` struct(file, row): where a row's content lies, the same on every read.

    A frame that is a scan of files, with columns and rows chosen from it, uses their own paths and
    row numbers. Behind anything else (a join, an explode, a union) such places need not be unique,
    so the frame is written to the shared folder first, with numbers that no longer change. A frame
    that has the column keeps it.
    """
    if LOCATOR in df.columns:
        return df
    if "_metadata" not in df.columns and _plain_scan(df):
        try:
            return df.select("*", F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.row_index").alias("row")).alias(LOCATOR))
        except AnalysisException:  # not read from files
            pass
    return materialise(df.withColumn(LOCATOR, F.struct(
        F.lit("").alias("file"), F.monotonically_increasing_id().alias("row"))), "located")


def id_order(id_col: str) -> Column:
    """Sorts by id, rows without id last, equal ids by place."""
    return F.struct(
        F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"),
        F.col(LOCATOR).alias("at"))


def portions(texts: Sequence[str], rows: int = 256, letters: int = 1 << 20) -> Iterator[slice]:
    """Cuts a batch of texts so that arrays over one part stay small, however long the texts are.

    Spark bounds a batch by rows and bytes; a part ends after so many rows or letters.
    """
    start = seen = 0
    for i, text in enumerate(texts):
        seen += len(text)
        if i + 1 - start >= rows or seen >= letters or i + 1 == len(texts):
            yield slice(start, i + 1)
            start, seen = i + 1, 0
