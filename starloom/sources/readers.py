"""File readers.

All readers return the source columns (text for text formats, native types for Parquet) plus the
position column. Headers are not touched here; see ``operators.headers``.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas as S
from starloom.functions import null_tokens
from starloom.session import materialise
from starloom.sources.csv_records import csv_lines, csv_records, has_bare_returns
from starloom.sources.html import extract_first_table, html_columns
from starloom.sources.position import (
    make_position,
    parquet_position,
    row_position,
    with_text_position,
)


def _nulls(df: DataFrame) -> DataFrame:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: null_tokens(F.col(f"`{n}`")) for n in names}) if names else df


def read_parquet(
    spark: SparkSession, path: str, slice_no: int = 0, schema: T.StructType | None = None
) -> DataFrame:
    """Parquet files; a known ``schema`` saves reading a footer for it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).withColumn(S.POSITION, parquet_position(slice_no))


DAMAGED = "_damaged"


def _csv_layouts(spark: SparkSession, path: str) -> list[tuple[str, list[str] | str, bool]]:
    """(header, files, whether a line has an odd number of quotes) per distinct header line.

    One scan of the lines. Where all files are alike, only their header comes back and ``files`` is
    ``path``; else the names of the files come too.
    """
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"),
        (quotes % 2 == 1).alias("odd")).filter(F.trim("value") != "")
    files = materialise(lines.groupBy("file").agg(
        F.min_by("value", "at").alias("header"), F.bool_or("odd").alias("odd")), "csv-layouts")
    layouts = files.select("header", "odd").distinct().limit(2).collect()
    if len(layouts) == 1:
        return [(layouts[0]["header"], path, layouts[0]["odd"])]
    found = files.groupBy("header", "odd").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return sorted((r["header"], r["files"], r["odd"]) for r in found.collect())


def read_csv(
    spark: SparkSession, path: str, slice_no: int = 0, multi_line: bool = False,
    damaged: bool = False,
) -> DataFrame:
    """Comma-separated files with a header row; every column is text, null spellings are NULL.

    Files of a folder may list their columns in different orders: each is read by its own header,
    columns that a file lacks are NULL. Files in which a line has an odd number of quotes may hold
    line breaks inside quotes: their lines are put together to records first, by as many tasks as
    the files have splits (see ``sources.csv_records``). Read whole, one task a file, are only files
    with a line break in their header or with carriage returns alone, and all with ``multi_line``.
    A record with too many or too few fields ends the job, or, with ``damaged``, comes with its text
    in the column ``_damaged``.
    """
    parts = [
        _csv_files(spark, files, slice_no, multi_line, damaged, header if odd else None)
        for header, files, odd in _csv_layouts(spark, path) or [("", path, False)]]
    return parts[0] if len(parts) == 1 else union_slices(parts)


def _csv_files(
    spark: SparkSession, paths: str | list[str], slice_no: int, multi_line: bool, damaged: bool,
    odd_header: str | None = None,
) -> DataFrame:
    """Files of one header; ``odd_header`` is that line, if quotes may span lines."""
    lines = None
    if odd_header is not None and not multi_line:
        multi_line = odd_header.count('"') % 2 == 1
        if not multi_line:
            lines = csv_lines(spark, paths, slice_no)
            multi_line = has_bare_returns(lines)
    reader = spark.read.option("header", True).option("escape", '"').option(
        "multiLine", multi_line).option("columnPruning", False)
    names = reader.option("inferSchema", False).csv(paths).columns
    fields = [*names, DAMAGED] if damaged else names
    schema = T.StructType([T.StructField(c, T.StringType()) for c in fields])
    mode = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": DAMAGED} if damaged else {
        "mode": "FAILFAST"}
    if not names:  # empty files
        return _nulls(with_text_position(reader.csv(paths), slice_no))
    if lines is not None and not multi_line:
        ddl = ", ".join(f"`{c.replace('`', '``')}` string" for c in fields)
        row = F.from_csv("value", ddl, {"escape": '"', **mode}).alias("_row")
        return _nulls(csv_records(lines).select(row, S.POSITION).select("_row.*", S.POSITION))
    df = reader.options(**mode).schema(schema).csv(paths)
    return _nulls(with_text_position(df, slice_no))


def read_json_records(
    spark: SparkSession, path: str, columns: Sequence[str], slice_no: int = 0,
    multi_line: bool = False, damaged: bool = False,
) -> DataFrame:
    """One record per line, or arrays of records (``multi_line``, one task per file).

    Declared columns, as text. A record that is no JSON ends the job, or, with ``damaged``, comes
    with its text (a whole file, if arrays are read) in the column ``_damaged``.
    """
    fields = [*columns, DAMAGED] if damaged else columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in fields])
    mode = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": DAMAGED} if damaged else {
        "mode": "FAILFAST"}
    df = spark.read.schema(schema).options(**mode).json(path, multiLine=multi_line)
    return _nulls(with_text_position(df, slice_no))


def split_tab_packed(line: Column, columns: Sequence[str], has_index: bool = True) -> list[Column]:
    """Fields of a tab-separated line that was packed into one column."""
    parts = F.split(line, "\t")
    shift = 1 if has_index else 0
    return [F.get(parts, F.lit(i + shift)).alias(c) for i, c in enumerate(columns)]


def read_tab_packed(
    spark: SparkSession, path: str, columns: Sequence[str], slice_no: int = 0,
    has_index: bool = True,
) -> DataFrame:
    """Tab-separated lines inside a file that calls itself comma-separated.

    The header line is recognised by its content, so files can be split and listed freely.
    """
    lines = with_text_position(spark.read.text(path), slice_no)
    first, *_ = columns
    df = lines.select(*split_tab_packed(F.col("value"), columns, has_index), S.POSITION)
    is_header = F.coalesce(F.lower(F.trim(F.col(first))) == first, F.lit(False))
    return df.filter(~is_header)


def columnar_json_rows(
    docs: DataFrame, text: str, file: str, columns: Sequence[str], slice_no: int = 0
) -> DataFrame:
    """Rows out of documents shaped ``{column: {row index: value}}``.

    Columns of a document are aligned on the row index (outer). Groups are single records: at
    most one cell per column. A document that cannot be parsed ends the job; an empty text has no
    rows.
    """
    nested = T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))
    doc = F.from_json(F.col(text), nested)
    broken = F.raise_error(F.concat(F.lit("no columnar JSON document: "), F.col(file).cast("string")))
    parsed = docs.select(
        F.col(file).alias("_file"),
        F.when(doc.isNull() & (F.trim(F.col(text)) != ""), broken).otherwise(doc).alias("_doc"))
    cells = (
        parsed.select("_file", F.size("_doc").alias("_width"),
                      F.posexplode("_doc").alias("_ord", "_name", "_values"))
        .select("_file", "_width", "_ord", F.lower(F.trim("_name")).alias("_name"),
                F.posexplode("_values").alias("_at", "_idx", "_value"))
    )
    # the cell where a row index is first met is unique to it and follows document order
    rows = cells.groupBy("_file", "_idx").agg(
        F.min(F.col("_at").cast("bigint") * F.col("_width") + F.col("_ord")).alias("_row"),
        *[F.max(F.when(F.col("_name") == c, F.col("_value"))).alias(c) for c in columns],
    )
    position = row_position(slice_no, F.col("_file"), F.col("_row"))
    return rows.select(*columns, position.alias(S.POSITION))


def read_json_columnar(
    spark: SparkSession, path: str, columns: Sequence[str], slice_no: int = 0
) -> DataFrame:
    """Column-oriented JSON files. One file is one document, so the unit of work is a file."""
    docs = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path"))
    return columnar_json_rows(docs, "value", "file_path", columns, slice_no)


def read_html(
    spark: SparkSession, path: str, columns: Sequence[str], slice_no: int = 0
) -> DataFrame:
    """First table of each HTML file; a file without a table is an error."""
    pages = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("_file"), "value")
    rows = extract_first_table(pages, "value", ["_file"], require=True)
    position = row_position(slice_no, F.col("_file"), F.col("row_no"))
    cells = {c: null_tokens(v) for c, v in html_columns(list(columns)).items()}
    return rows.withColumns(cells).select(*columns, position.alias(S.POSITION))


@dataclass(frozen=True)
class Source:
    """Where a slice lies and how to read it; ``format`` defaults to the file extension."""

    path: str
    format: str | None = None
    columns: tuple[str, ...] = ()
    fallback: str | None = None
    options: dict = field(default_factory=dict)


def _format_of(source: Source) -> str:
    if source.format:
        return source.format
    ext = os.path.splitext(source.path.rstrip("/"))[1].lstrip(".").lower()
    return {"htm": "html", "parq": "parquet"}.get(ext, ext)


_READERS = {
    "parquet": lambda s, src, n: read_parquet(s, src.path, n, **src.options),
    "csv": lambda s, src, n: read_csv(s, src.path, n, **src.options),
    "json": lambda s, src, n: read_json_records(s, src.path, src.columns, n, **src.options),
    "json_columnar": lambda s, src, n: read_json_columnar(s, src.path, src.columns, n),
    "html": lambda s, src, n: read_html(s, src.path, src.columns, n),
    "tab_packed": lambda s, src, n: read_tab_packed(
        s, src.path, src.columns, n, **src.options),
}


def read_source(spark: SparkSession, source: Source, slice_no: int = 0) -> DataFrame:
    """Read one source by its format.

    A format without a reader, and a file that its reader refuses when it is opened (a Parquet
    reader meeting no Parquet file), go to ``fallback`` if one is named. Damage that is met later,
    in the middle of the data, still ends the job.
    """
    fmt = _format_of(source)
    if fmt in _READERS:
        try:
            return _READERS[fmt](spark, source, slice_no)
        except (PySparkException, Py4JJavaError):
            if source.fallback not in _READERS:
                raise
    elif source.fallback not in _READERS:
        raise ValueError(f"no reader for format {fmt!r} of {source.path}")
    return _READERS[source.fallback](spark, source, slice_no)


def union_slices(slices: Sequence[DataFrame], distinct: bool = False) -> DataFrame:
    """Union by name; columns that a slice lacks are NULL. ``distinct`` drops equal rows."""
    combined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), slices)
    return combined.distinct() if distinct else combined


def table_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """A catalog table, or an empty frame if it does not exist. Other errors are not hidden."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


__all__ = [
    "Source", "columnar_json_rows", "make_position", "read_csv", "read_html",
    "read_json_columnar", "read_json_records", "read_parquet", "read_source",
    "read_tab_packed", "split_tab_packed", "table_or_empty", "union_slices",
]
