"""Exact deduplication with stateful streaming.

The state, one row per digest, lies on disk (RocksDB) and never expires; it retains the digest, the
stable identifier of the row that stays, its content locator and the number of rows. Rows whose
digest was met before (hits) are compared byte by byte, so a digest collision never merges two
texts. Everything runs as DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import LOCATOR, WHITE, id_order, whole_text, with_locator
from starloom.session import materialise, scratch_path

STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # One bounded pool for all partitions of an executor, however many there are.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Without it every partition sets aside 4 MB of disk for its log, however small its state.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: str | Column) -> Column:
    """The text with every run of white space as one blank; a missing text is empty."""
    return F.regexp_replace(whole_text(text), WHITE, " ")


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


class DigestStore:
    """The disk-backed keyed state. ``ingest`` may be called again with later tables.

    folder: below it lie the stream's checkpoint (the state), the digests it has read and what each
    micro-batch changed. A lost executor reloads its part of the state from there.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.digests, self.changes = f"{folder}/digests", f"{folder}/changes"

    def ingest(self, rows: DataFrame) -> None:
        """rows: digest, row (struct of ``id_order``)."""
        rows.write.mode("append").parquet(self.digests)
        spark, changes = self.spark, self.changes
        before = {k: spark.conf.get(k, None) for k in STREAM_CONF}
        for k, v in STREAM_CONF.items():
            spark.conf.set(k, v)
        try:
            stream = (
                spark.readStream.schema(rows.schema).parquet(self.digests)
                .groupBy("digest").agg(
                    F.min("row").alias("keep"), F.count(F.lit(1)).alias("group_size")))
            query = (
                stream.writeStream.outputMode("update")
                .option("checkpointLocation", f"{self.folder}/state")
                .foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(
                    f"{changes}/batch={n}"))
                .trigger(availableNow=True).start())
            query.awaitTermination()
        finally:
            for k, v in before.items():
                spark.conf.set(k, v) if v is not None else spark.conf.unset(k)

    def current(self) -> DataFrame:
        """The newest row of each digest; with one batch that is the batch itself.

        Both columns only move one way, so the newest values are the least row and the largest count.
        """
        return self.spark.read.parquet(self.changes).groupBy("digest").agg(
            F.min("keep").alias("keep"), F.max("group_size").alias("group_size"))


def exact_duplicates(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id",
    digest: Callable[[Column], Column] = sha256_hex,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256 and ``LOCATOR``.

    Equal texts are those identical after replacing each run of white space by one blank; a missing
    text counts as empty. Of equal texts the row with the smallest id stays (rows without id come
    last; of rows with one id, the first by file and position). An empty table gives no rows.
    Other columns of ``docs`` are not read, whatever their names.
    digest: the key of the state; weaker ones give the same result with more byte comparisons.
    """
    spark = docs.sparkSession
    located = with_locator(docs).select(
        F.col(id_col).alias("id"), F.col(text).alias("text"), LOCATOR)
    clean = normalised("text")
    rows = located.select(
        id_order("id").alias("row"), digest(clean).alias("digest"),
        sha256_hex(clean).alias("text_sha256"))
    rows = materialise(rows, "digests")
    store = DigestStore(spark, scratch_path(spark, "digest-state"))
    store.ingest(rows.select("digest", "row"))
    groups = materialise(store.current(), "digest-groups")

    hits = rows.join(groups.filter("group_size > 1").select("digest"), "digest").select(
        "digest", F.col("row.at").alias(LOCATOR), "row")
    checked = located.select(LOCATOR, "text").join(
        hits.hint("shuffle_hash"), LOCATOR).select("digest", "row", normalised("text").alias("text"))
    # Equal bytes throughout a group: its least and its greatest text are the same. Both are
    # combined before the shuffle, so a large group of copies sends one text per task.
    mixed = materialise(
        checked.groupBy("digest").agg(F.min("text").alias("lo"), F.max("text").alias("hi"))
        .filter("lo != hi").select("digest"), "collisions")

    result = rows.join(groups, "digest").select("row", "text_sha256", "keep", "group_size", "digest")
    if not mixed.isEmpty():
        apart = checked.join(mixed, "digest", "left_semi")
        texts = apart.groupBy("digest", "text").agg(
            F.min("row").alias("keep_2"), F.count(F.lit(1)).alias("size_2"))
        split = apart.join(texts, ["digest", "text"]).select(
            F.col("row").alias("row_2"), "keep_2", "size_2")
        result = result.join(split, F.col("row") == F.col("row_2"), "left").select(
            "row", "text_sha256", F.coalesce("keep_2", "keep").alias("keep"),
            F.coalesce("size_2", "group_size").alias("group_size"))
    return result.select(
        F.col("row.id").alias(id_col), F.col("keep.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep")).alias("kept"), "text_sha256",
        F.col("row.at").alias(LOCATOR))


def keep_first(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows that repeat a text, all columns as they were."""
    located = with_locator(docs)
    kept = exact_duplicates(located, text, id_col).filter("kept").select(F.col(LOCATOR).alias("__kept"))
    return located.join(kept, F.col(LOCATOR) == F.col("__kept"), "left_semi").drop(LOCATOR)
