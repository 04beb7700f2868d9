"""Load modes on Parquet: full refresh, append, quarantine append, all-or-nothing publish.

Data files are always written to a fresh folder first. A load becomes visible by one small record
in the publish log, written after all its folders are complete; a failed load leaves no trace but
unreferenced files. Old folders stay readable for running queries.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence
from functools import partial, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas as S
from starloom.operators import validate
from starloom.operators.headers import fill_missing_columns
from starloom.session import remove_folder, side_by_side

_LOG = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("days", T.ArrayType(T.IntegerType())),
    T.StructField("top", T.LongType()),
])

#: Stands for a missing day in the days of a load.
NO_DAY = 0


class Load(NamedTuple):
    """A folder of a table. ``days``: the days of which it holds all rows, in place of earlier
    folders; ``top``: the largest generated key, where the table has one."""

    path: str
    days: tuple[int, ...] | None = None
    top: int | None = None


def on_days(days: Sequence[int], column: str = "date_key") -> Column:
    """Rows of these days; ``NO_DAY`` stands for those without one.

    A plain list, so that Parquet row groups of other days are skipped.
    """
    hit = F.col(column).isin([d for d in days if d != NO_DAY])
    return F.coalesce(hit, F.lit(NO_DAY in days))


class Warehouse:
    """Tables below one root folder. One writer at a time, any number of readers."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self._log_path = os.path.join(self.root, "_publish_log")
        self._tops: dict[str, int | None] = {}

    # -- reading -----------------------------------------------------------------------
    def _log(self) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._log_path)
        storage = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not storage.exists(path):
            return self.spark.createDataFrame([], _LOG)
        return self.spark.read.schema(_LOG).json(self._log_path)

    def snapshot(self) -> dict[str, list[Load]]:
        """Folders of every table: its last full load, and appends and replaced days since then.

        The log has one row per table and load, so what comes back counts loads, not data.
        """
        tables: dict[str, list[Load]] = {}
        for r in self._log().orderBy("seq", "table_name").collect():
            if r["mode"] == "replace":
                tables[r["table_name"]] = []
            days = None if r["mode"] != "days" else tuple(r["days"])
            tables.setdefault(r["table_name"], []).append(Load(r["path"], days, r["top"]))
        return tables

    def exists(self, table: str) -> bool:
        return table in self.snapshot()

    def read(
        self, table: str, schema: T.StructType | None = None,
        snapshot: Mapping[str, list[Load]] | None = None,
    ) -> DataFrame:
        """The published table; without one, an empty frame of ``schema`` if that is given.

        A given ``schema`` is also what is read. Tables read with the same ``snapshot`` belong to
        the same published state.
        """
        loads = (self.snapshot() if snapshot is None else snapshot).get(table)
        if loads:
            reader = self.spark.read if schema is None else self.spark.read.schema(schema)
            if all(x.days is None for x in loads):
                return reader.parquet(*[x.path for x in loads])
            parts, gone = [], set()
            for load in reversed(loads):
                part = reader.parquet(load.path)
                parts.append(part if not gone else part.filter(~on_days(sorted(gone))))
                gone.update(load.days or ())
            return reduce(DataFrame.unionByName, parts)
        if schema is None:
            raise ValueError(f"table {table} was never published")
        return self.spark.createDataFrame([], schema)

    def _current(self, table: str, batch: DataFrame) -> DataFrame:
        """What a batch is appended to; for a new table, nothing in the shape of the batch."""
        now = self.snapshot()
        if table in now:
            return self.read(table, snapshot=now)
        return self.spark.createDataFrame([], batch.schema)

    # -- writing -----------------------------------------------------------------------
    def write(self, table: str, *parts: DataFrame) -> tuple[str, int]:
        """Write the files of a table without publishing them: (folder, rows written).

        Several parts are written one after the other, so what is shuffled for one is gone when the
        next one is made.
        """
        path = os.path.join(self.root, table, uuid.uuid4().hex)
        done = [self._write_part(table, df, path) for df in parts]
        tops = [top for _, top in done if top is not None]
        self._tops[path] = max(tops) if tops else None
        return path, sum(n for n, _ in done)

    def _write_part(self, table: str, df: DataFrame, path: str) -> tuple[int, int | None]:
        """Rows written and the largest generated key, where the table has one."""
        seen = Observation(f"load-{table}-{uuid.uuid4().hex}")
        made = [c for c in df.columns[:1] if c in S.GENERATED_KEYS]
        top = F.col(made[0]) if made else F.lit(None).cast("long")
        writer = df.observe(
            seen, F.count(F.lit(1)).alias("rows_loaded"), F.max(top).alias("top")
        ).write.mode("append").option("compression", "zstd")
        if "order_id" in df.columns:  # ids seldom repeat, so a dictionary of them is built in vain
            writer = writer.option("parquet.enable.dictionary#order_id", "false")
            if not (table.startswith("_") or table.endswith("_checked")):
                # a look-up of few orders then skips nearly all row groups
                writer = writer.option("parquet.bloom.filter.enabled#order_id", "true").option(
                    "parquet.bloom.filter.adaptive.enabled", "true")
        writer.parquet(path)
        return int(seen.get["rows_loaded"]), seen.get["top"]

    def publish(
        self, written: Mapping[str, str], mode: str = "replace",
        modes: Mapping[str, str] | None = None, days: Sequence[int] = (),
    ) -> None:
        """Make written folders visible together.

        ``modes`` has the tables for which ``mode`` does not hold. A folder of mode "days" holds all
        rows of ``days`` and takes the place of what was there.
        """
        modes = modes or {}
        listed = F.array(*map(F.lit, days)).cast("array<int>")
        top = self._log().agg(F.max("seq").alias("top")).first()["top"]
        seq = 1 if top is None else int(top) + 1
        records = F.array(*[
            F.struct(F.lit(seq), F.lit(table), F.lit(path), F.lit(modes.get(table, mode)),
                     listed if modes.get(table, mode) == "days" else F.lit(None).cast("array<int>"),
                     F.lit(self._tops.get(path)).cast("long"))
            for table, path in sorted(written.items())])
        entry = self.spark.range(0, 1, 1, 1).select(F.inline(records)).toDF(*_LOG.fieldNames())
        entry.write.mode("append").json(self._log_path)

    def discard(self, path: str) -> None:
        """Remove a folder that was written and never published, when it was read."""
        remove_folder(self.spark, path)
        self._tops.pop(path, None)

    def vacuum(self) -> int:
        """Remove folders that no published state refers to; returns their number.

        Folders of failed loads, of intermediate tables and of replaced loads go. Nobody may write
        meanwhile, and readers of older snapshots lose them.
        """
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        storage = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not storage.exists(root):
            return 0
        live = {p.rstrip("/").rsplit("/", 1)[-1] for ps in self.snapshot().values()
                for p in (x.path for x in ps)}
        gone = 0
        for table in storage.listStatus(root):
            if table.isDirectory() and table.getPath().getName() != "_publish_log":
                for load in storage.listStatus(table.getPath()):
                    if load.isDirectory() and load.getPath().getName() not in live:
                        gone += storage.delete(load.getPath(), True)
        return gone

    # -- load modes --------------------------------------------------------------------
    def full_refresh(self, table: str, df: DataFrame) -> dict:
        """Replace a table as a whole, after its constraints hold on the written files."""
        return self.full_refresh_all({table: df})[table]

    def full_refresh_all(self, frames: Mapping[str, DataFrame]) -> dict[str, dict]:
        """Replace several independent tables; they become visible together."""
        def load(table: str) -> tuple[str, int]:
            path, n = self.write(table, frames[table])
            self._refuse_bad(table, self.spark.read.parquet(path))
            return path, n

        done = dict(zip(frames, side_by_side([partial(load, t) for t in frames])))
        self.publish({t: path for t, (path, _) in done.items()})
        return {t: {"table": t, "rows_loaded": n} for t, (_, n) in done.items()}

    def append(self, table: str, df: DataFrame) -> dict:
        """Append a batch. An empty batch publishes nothing; a key conflict refuses the batch."""
        current = self._current(table, df)
        path, n = self.write(table, self._fit(table, current, df))
        if not n:  # the folder stays unpublished until the next vacuum
            return {"table": table, "rows_loaded": 0}
        batch = self.spark.read.parquet(path)
        for key in S.UNIQUE.get(table, ()):
            clash = validate.known_keys(current, batch, key).select(
                F.lit(table).alias("table_name"), F.col(key).alias("value"))
            validate.refuse_if_any(clash, f"{table}.{key} already loaded")
        self._refuse_bad(table, batch)
        self.publish({table: path}, "append")
        return {"table": table, "rows_loaded": n}

    def append_isolated(self, table: str, checked: DataFrame) -> dict:
        """Append the good rows of a checked batch; the others go to ``<table>_rejects``.

        The batch is written once after cleaning and once after the key check, so neither text
        nor keys are gone through again for the two sides.
        """
        checked_path, _ = self.write(f"{table}_checked", checked)
        batch = self.spark.read.schema(checked.schema).parquet(checked_path)
        for key in S.UNIQUE.get(table, ()):
            flagged = validate.flag_key_conflicts(batch, key, self._current(table, batch))
            flagged_path, _ = self.write(f"{table}_checked", flagged)
            batch = self.spark.read.schema(flagged.schema).parquet(flagged_path)
            self.discard(checked_path)
            checked_path = flagged_path
        good = validate.accepted(batch)
        if table not in S.ORDERED_TABLES:
            good = good.drop(S.POSITION)
        current = self._current(table, good)
        good_path, n_good = self.write(table, self._fit(table, current, good))
        bad_path, n_bad = self.write(f"{table}_rejects", validate.rejected(batch))
        self.publish({table: good_path, f"{table}_rejects": bad_path}, "append")
        self.discard(checked_path)
        return {"table": table, "rows_loaded": n_good, "rows_rejected": n_bad}

    # -- helpers -----------------------------------------------------------------------
    def _fit(self, table: str, current: DataFrame, batch: DataFrame) -> DataFrame:
        """Batch with exactly the table's columns, positioned behind what is already there."""
        unknown = [c for c in batch.columns if c not in current.columns]
        if unknown:
            raise ValueError(f"batch for {table} has unknown columns {unknown}")
        fitted = fill_missing_columns(batch, current.schema).select(*current.columns)
        if S.POSITION not in current.columns:
            return fitted
        top = current.agg(F.max(f"{S.POSITION}.slice").alias("top")).first()["top"]
        if top is None:
            return fitted
        moved = F.col(S.POSITION).withField(
            "slice", (F.col(f"{S.POSITION}.slice") + int(top) + 1).cast("int"))
        return fitted.withColumn(S.POSITION, moved)

    def _refuse_bad(self, table: str, df: DataFrame) -> None:
        unique, not_null = S.UNIQUE.get(table, ()), S.NOT_NULL.get(table, ())
        if unique or not_null:
            validate.refuse_bad_keys(df, table, unique, not_null)
