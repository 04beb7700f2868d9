"""The six dimensions, each a pure function of staging (and, when incremental, of itself)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import functions as fn
from starloom import schemas as S
from starloom.operators import dedup, headers, keys


def dim_date(
    spark: SparkSession, start: str = S.CALENDAR_START, end: str = S.CALENDAR_END
) -> DataFrame:
    """One row per day. The range is a parameter, so its size is known beforehand."""
    days = spark.range(1).select(F.explode(F.sequence(
        F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))).alias("d"))
    return days.select(*[c.alias(n) for n, c in fn.calendar_parts(F.col("d")).items()])


def _keyed(
    master: DataFrame, key: str, source_col: str, existing: DataFrame | None
) -> DataFrame:
    """Keyed members: all numbered anew on a rebuild, old keys kept when ``existing`` is given.

    ``master`` has one row per id with its attributes, so no other staging row of an id is looked
    at again. An existing member keeps its key and the name it was first added with.
    """
    if existing is None:
        return keys.dense_keys(master, key, [source_col], name=key)
    old = existing.select(key, source_col, F.struct("name").alias("_old"))
    fresh = keys.assign_surrogate_keys(
        master.select(source_col), old, key, source_col).select(key, source_col)
    members = old.unionByName(fresh, allowMissingColumns=True).join(master, source_col, "left")
    first_name = F.when(F.col("_old").isNotNull(), F.col("_old.name")).otherwise(F.col("name"))
    return members.withColumn("name", first_name).drop("_old")


def _masters(stg: DataFrame, id_col: str, source_col: str) -> DataFrame:
    return dedup.master_rows(stg, id_col).withColumnRenamed(id_col, source_col)


def dim_user(
    stg_user: DataFrame, stg_job: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Users with demographics and job; an id without a job row has NULL job columns."""
    jobs = _masters(
        stg_job.select("user_id", "job_title", "job_level", "possible_duplicate", S.POSITION),
        "user_id", "source_user_id").select("source_user_id", "job_title", "job_level")
    members = _masters(stg_user, "user_id", "source_user_id").join(jobs, "source_user_id", "left")
    wanted = members.select(S.STAR["dim_user"].fieldNames()[1:])
    return headers.shape(
        _keyed(wanted, "user_key", "source_user_id", existing), S.STAR["dim_user"])


def dim_merchant(stg: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    members = _masters(stg, "merchant_id", "source_merchant_id")
    wanted = members.select(S.STAR["dim_merchant"].fieldNames()[1:])
    return headers.shape(
        _keyed(wanted, "merchant_key", "source_merchant_id", existing), S.STAR["dim_merchant"])


def dim_staff(stg: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    members = _masters(stg, "staff_id", "source_staff_id")
    wanted = members.select(S.STAR["dim_staff"].fieldNames()[1:])
    return headers.shape(
        _keyed(wanted, "staff_key", "source_staff_id", existing), S.STAR["dim_staff"])


def dim_product(stg: DataFrame) -> DataFrame:
    """Distinct products. An id may occur with several names or prices."""
    rows = stg.select(
        "product_id", "product_name", "product_type", F.col("price").alias("base_price"))
    keyed = keys.dense_keys(
        rows.distinct(), "product_key",
        ["product_id", "product_name", "product_type", "base_price"], name="product_key")
    return headers.shape(keyed, S.STAR["dim_product"])


def dim_campaign(stg: DataFrame) -> DataFrame:
    """Distinct campaigns; variants of one id are reported by the constraint checks."""
    rows = stg.select(
        "campaign_id", "campaign_name", F.col("campaign_description").alias("description"),
        "discount")
    keyed = keys.dense_keys(
        rows.distinct(), "campaign_key",
        ["campaign_id", "campaign_name", "description", "discount"], name="campaign_key")
    return headers.shape(keyed, S.STAR["dim_campaign"])
