"""Load-order positions.

Order-dependent rules ("the last row of the file wins", "the n-th product line belongs to the
n-th price line") need to know where a row stood. A position is unique per row and sorts in load
order. Its ``block`` covers at most 2**20 rows of one file, which bounds every group that is
formed per (key, file, block), however often a single key occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import schemas as S

BLOCK_BITS = 20
_LOCAL_ROW = (1 << 33) - 1


def make_position(slice_no: int | Column, file: Column, block: Column, row: Column) -> Column:
    slice_col = slice_no if isinstance(slice_no, Column) else F.lit(slice_no)
    return F.struct(
        slice_col.cast("int").alias("slice"),
        file.cast("string").alias("file"),
        block.cast("bigint").alias("block"),
        row.cast("bigint").alias("row"),
    )


def row_position(slice_no: int, file: Column, row: Column) -> Column:
    """Position from a plain running row number of a file."""
    return make_position(slice_no, file, F.shiftright(row.cast("bigint"), BLOCK_BITS), row)


def parquet_position(slice_no: int) -> Column:
    return row_position(slice_no, F.col("_metadata.file_path"), F.col("_metadata.row_index"))


def with_text_position(df: DataFrame, slice_no: int) -> DataFrame:
    """Position for text-like files, which carry no row index.

    Rows of one split are read in order, so (split start, running id) is load order. The running
    row number of the task, cut to blocks, is far below the length of a split in bytes, so adding
    it to the split start keeps blocks of consecutive splits in order.
    """
    running = F.monotonically_increasing_id()
    block = F.col("_metadata.file_block_start") + F.shiftright(
        running.bitwiseAND(F.lit(_LOCAL_ROW)), BLOCK_BITS)
    return df.withColumn(
        S.POSITION, make_position(slice_no, F.col("_metadata.file_path"), block, running))
