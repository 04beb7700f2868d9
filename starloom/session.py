"""Session settings and shared scratch space.

Every setting here is a runtime SQL setting, so it can be applied to a session that
somebody else built (a notebook, spark-submit, the bench).
"""

from __future__ import annotations

import contextvars
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Joins on a hot key are split at run time from measured shuffle sizes; "force" allows the
    # split even where a later operator on the same key then needs one more exchange.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Sides below this measured size are broadcast, larger ones are shuffled. A lookup needs only
    # two columns of a dimension, so most dimensions save the fact table a shuffle.
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    # Parquet files are counted as several times their size, which is nearer to rows in memory.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # The JVM never compiles a method beyond 8000 bytes of code, so a generated stage of many cleaning
    # rules would be interpreted row by row; above this limit its operators are generated one by one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Shuffle files go when their query ends; else those of all steps of a job stay on the disks until
    # the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library relies on and return the session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster: ``spark.checkpoint.dir``, or the folder that was set on
    the context with ``setCheckpointDir``. One of them is required, because a folder of one machine
    cannot be read by the others.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return found.rstrip("/")


def scratch_folder(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{scratch_root(spark)}/starloom/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten there."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> bool:
    """Removes the intermediate tables of this application, when nothing reads them any more.

    Published tables lie in the warehouse and are not touched. True if there was anything.
    """
    return remove_folder(spark, scratch_folder(spark))


def remove_folder(spark: SparkSession, folder: str) -> bool:
    """Removes a folder that nothing reads any more. True if there was one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.delete(path, True)


#: Where ``spent_tables`` notes the folders written inside, the innermost one of a thread.
_SPENT: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("spent", default=None)


@contextmanager
def spent_tables(spark: SparkSession) -> Iterator[None]:
    """Tables materialised inside are removed at the end, when what was made of them is written.

    Frames that read them must not leave the block.
    """
    folders: list[str] = []
    token = _SPENT.set(folders)
    try:
        yield
    finally:
        _SPENT.reset(token)
        for folder in folders:
            remove_folder(spark, folder)


def write_scratch(df: DataFrame, name: str, plain: bool = False) -> tuple[DataFrame, str]:
    """Like ``materialise``, with the folder, for callers that remove it when it was read."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    folders = _SPENT.get()
    if folders is not None:
        folders.append(path)
    writer = df.write.mode("errorifexists")
    if plain:
        writer = writer.option("parquet.enable.dictionary", "false").option("compression", "zstd")
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame, name: str, plain: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, never a recomputation, and values that
    depend on the physical layout (partition ids, row ids) are frozen. ``plain`` does without
    dictionaries, which cost more than they save where rows are read once and values seldom repeat,
    and packs the columns closer instead.
    """
    return write_scratch(df, name, plain)[0]


def materialise_made(make: Callable[[], DataFrame], name: str, plain: bool = False) -> DataFrame:
    """What ``make`` returns, materialised; the tables that it wrote on the way are removed."""
    spark = SparkSession.getActiveSession()
    outer = _SPENT.get()
    with spent_tables(spark):
        df = make()
        token = _SPENT.set(outer)
        try:
            return materialise(df, name, plain)
        finally:
            _SPENT.reset(token)


_T = TypeVar("_T")


def side_by_side(actions: Sequence[Callable[[], _T]], at_once: int = 4) -> list[_T]:
    """Run independent Spark actions at the same time, so small jobs fill idle executors.

    Results come in the order of ``actions``; the first failure is raised.
    """
    if len(actions) == 1:
        return [actions[0]()]
    spark = SparkSession.getActiveSession()
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return [f.result() for f in [
            pool.submit(contextvars.copy_context().run, inheritable_thread_target(spark)(a))
            for a in actions]]
