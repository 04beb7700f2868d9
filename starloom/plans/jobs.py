"""Whole jobs: full refresh of the warehouse, and late, new or dirty batches before a rebuild."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import functions as fn
from starloom import schemas as S
from starloom.operators import dedup, history, validate
from starloom.plans import dims, facts, staging
from starloom.plans.load import Load, Warehouse
from starloom.session import side_by_side, spent_tables
from starloom.sources import Source, read_source, union_slices

_MANY = {
    "stg_order_data": staging.stage_orders,
    "stg_line_item_data_products": staging.stage_line_products,
    "stg_line_item_data_prices": staging.stage_line_prices,
    "stg_order_with_merchant_data": staging.stage_order_links,
}
_ONE = {
    "stg_order_delays": staging.stage_delays,
    "stg_campaign_data": staging.stage_campaigns,
    "stg_transactional_campaign_data": staging.stage_campaign_links,
    "stg_user_data": staging.stage_users,
    "stg_user_job": staging.stage_user_jobs,
    "stg_user_credit_card": staging.stage_credit_cards,
    "stg_product_list": staging.stage_products,
    "stg_merchant_data": staging.stage_merchants,
    "stg_staff_data": staging.stage_staff,
}


def stage(table: str, slices: Sequence[DataFrame]) -> DataFrame:
    """Apply the staging rules of a table to its raw slices."""
    if table in _MANY:
        return _MANY[table](slices)
    if len(slices) != 1:
        raise ValueError(f"{table} takes exactly one source")
    return _ONE[table](slices[0])


#: Tables whose rows may be refused: rules for a slice, and what becomes of the accepted rows.
_CHECKED = {
    "stg_order_data": (staging.check_orders, dedup.dedup_exact),
    "stg_product_list": (staging.check_products, dedup.dedup_exact),
    "stg_line_item_data_products": (staging.check_line_products, lambda df: df),
}

#: Tables whose rows all stay, while those with a reason are shown among the rejects as well.
_NOTED = {
    "stg_line_item_data_prices": (staging.check_line_prices, staging.kept_line_prices),
    "stg_campaign_data": (staging.check_campaigns, staging.kept_campaigns),
}

#: Date columns as sources spell them, in the order of their words.
_DATES = ("transaction_date", "creation_date", "birthdate")


def settled(raw: DataFrame) -> DataFrame:
    """Raw rows whose date columns have one order of day and month; an undecidable one is refused."""
    names = [c for c in raw.columns
             if re.sub("[^a-z]+", "_", c.strip().lower()).strip("_") in _DATES]
    return fn.settle_day_order(raw, names)


def load_staging(
    wh: Warehouse, sources: Mapping[str, Sequence[Source]],
    on_read: Callable[[str], None] | None = None,
) -> dict[str, dict]:
    """Read, clean and replace staging tables from their source files, all at once.

    Refused rows replace ``<table>_rejects``, with their reasons. Checked rows are written once, so
    no source is gone through twice for the two sides. ``on_read`` is called with the name of a table
    when its files are not read any more, which may be before the table is published.
    """
    with spent_tables(wh.spark):
        return _load_staging(wh, sources, on_read or (lambda table: None))


def _load_staging(
    wh: Warehouse, sources: Mapping[str, Sequence[Source]], on_read: Callable[[str], None]
) -> dict[str, dict]:
    frames, spent = {}, {}
    for table, specs in sources.items():
        slices = [settled(read_source(wh.spark, spec, n)) for n, spec in enumerate(specs)]
        if table not in _CHECKED and table not in _NOTED:
            frames[table] = stage(table, slices)
            continue
        if table in _NOTED and table not in _MANY and len(slices) != 1:
            raise ValueError(f"{table} takes exactly one source")
        check, finish = (_CHECKED | _NOTED)[table]
        path, _ = wh.write(f"{table}_checked", union_slices([check(s) for s in slices]))
        spent[table] = path
        on_read(table)
        checked = wh.spark.read.parquet(path)
        frames[table] = finish(checked if table in _NOTED else validate.accepted(checked))
        frames[f"{table}_rejects"] = validate.rejected(checked)
    done = wh.full_refresh_all(frames)
    for path in spent.values():
        wh.discard(path)
    for table in sources:
        if table not in spent:
            on_read(table)
    return done


@dataclass
class Calendar:
    start: str = S.CALENDAR_START
    end: str = S.CALENDAR_END


def staged(wh: Warehouse, table: str, snapshot: Mapping[str, list[Load]]) -> DataFrame:
    fields = list(S.STAGING[table].fields)
    if table in S.ORDERED_TABLES:
        fields.append(T.StructField(S.POSITION, S.POSITION_TYPE))
    return wh.read(table, T.StructType(fields), snapshot)


def refuse_repeated_orders(orders: DataFrame, side: DataFrame, table: str) -> None:
    """Several side rows per order would break the order key of the fact.

    Seen here from counts per order, before a join could multiply the rows of a hot order. The
    orders are gone through only if the side table has several rows for any id at all.
    """
    if not validate.any_repeated(side, "order_id"):
        return
    repeated = side.filter("order_id IS NOT NULL").groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    if repeated.isEmpty():
        return
    validate.refuse_if_any(
        repeated.join(orders.select("order_id"), "order_id", "left_semi"),
        f"{table} has several rows for an order")


def rebuild(
    wh: Warehouse, calendar: Calendar | None = None, on_orphans: str = "fail",
    keep_keys: bool = False, by_day: bool = False, versions_at: str | None = None,
    versions_since: str | None = None,
) -> dict[str, int]:
    """Dimensions, then facts, from published staging; all nine tables become visible together.

    Every table is written before the next one reads it, so each is computed once. Nothing is
    published when a constraint fails. Orders on a day outside the calendar end the job, or, with
    ``on_orphans="quarantine"``, go to the table ``orphan_orders`` and into no fact. With
    ``keep_keys`` users, merchants and staff that are already published keep their keys and new
    ones are numbered after them. With ``by_day`` the facts are laid out by day, so that a later batch
    (``plans.touched``) reads only the days it touches.

    With ``versions_at`` (a timestamp text) the users of this run are merged into the published table
    ``user_versions`` as their state from that time on, and the user key of a fact is the key of the
    version that was valid at the order's time. Users never seen before start at ``versions_since``
    or else at ``versions_at``; an order before that has no user key.
    """
    if on_orphans not in ("fail", "quarantine"):
        raise ValueError(f"on_orphans is fail or quarantine, not {on_orphans!r}")
    calendar = calendar or Calendar()
    spark = wh.spark
    written: dict[str, str] = {}
    rows: dict[str, int] = {}

    def put(table: str, make: Callable[[], DataFrame]) -> DataFrame:
        with spent_tables(spark):
            df = make()
            parts = facts.laid_by_day(df) if by_day and table.startswith("fact_") else [df]
            written[table], rows[table] = wh.write(table, *parts)
        out = spark.read.schema(S.STAR[table]).parquet(written[table])
        # generated keys are dense by construction, only business keys can be wrong
        unique = [c for c in S.UNIQUE.get(table, ()) if c not in S.GENERATED_KEYS]
        not_null = S.NOT_NULL.get(table, ())
        if unique or not_null:
            validate.refuse_bad_keys(out, table, unique, not_null)
        return out

    now = wh.snapshot()
    stg = {t: staged(wh, t, now) for t in S.STAGING if t != "stg_user_credit_card"}

    def known(table: str) -> DataFrame | None:
        return wh.read(table, S.STAR[table], now) if keep_keys and table in now else None

    plans = {
        "dim_date": lambda: dims.dim_date(spark, calendar.start, calendar.end),
        "dim_user": lambda: dims.dim_user(
            stg["stg_user_data"], stg["stg_user_job"], known("dim_user")),
        "dim_merchant": lambda: dims.dim_merchant(stg["stg_merchant_data"], known("dim_merchant")),
        "dim_staff": lambda: dims.dim_staff(stg["stg_staff_data"], known("dim_staff")),
        "dim_product": lambda: dims.dim_product(stg["stg_product_list"]),
        "dim_campaign": lambda: dims.dim_campaign(stg["stg_campaign_data"]),
    }
    star = dict(zip(plans, side_by_side([partial(put, t, plans[t]) for t in plans])))

    side_by_side([
        partial(refuse_repeated_orders, stg["stg_order_data"], stg[table], table) for table in (
            "stg_order_with_merchant_data", "stg_transactional_campaign_data", "stg_order_delays")])
    versions = None
    if versions_at is not None:
        known_versions = wh.read("user_versions", S.USER_VERSIONS, now)
        since = None if versions_since is None else F.lit(versions_since)
        with spent_tables(spark):
            written["user_versions"], rows["user_versions"] = wh.write(
                "user_versions", history.merge_versions(
                    known_versions, star["dim_user"].drop("user_key"), "source_user_id",
                    F.lit(versions_at), "version_key", since))
        versions = spark.read.schema(S.USER_VERSIONS).parquet(written["user_versions"]).select(
            F.col("source_user_id").alias("user_id"), F.col("version_key").alias("user_key"),
            "valid_from", "valid_to")
    # headers feed the items and the order fact: computed once, kept as a written table
    with spent_tables(spark):
        head = facts.order_headers(
            stg["stg_order_data"], stg["stg_order_with_merchant_data"],
            stg["stg_transactional_campaign_data"], stg["stg_order_delays"],
            star["dim_user"], star["dim_merchant"], star["dim_staff"], star["dim_campaign"], versions)
        head_path, _ = wh.write("_order_headers", head)
    head = spark.read.schema(head.schema).parquet(head_path)
    if on_orphans == "quarantine":
        days = star["dim_date"].select("date_key")
        lost = head.filter("date_key IS NOT NULL").join(days, "date_key", "left_anti")
        written["orphan_orders"], rows["orphan_orders"] = wh.write("orphan_orders", lost)
        head = head.join(days, "date_key", "left_semi").unionByName(head.filter("date_key IS NULL"))
    items = put("fact_order_items", lambda: facts.all_order_items(
        stg["stg_line_item_data_products"], stg["stg_line_item_data_prices"],
        star["dim_product"], head))
    orders = put("fact_orders", lambda: facts.fact_orders(head, facts.order_totals(items)))
    wh.discard(head_path)
    put("fact_campaign_performance", lambda: facts.fact_campaign_performance(orders))

    if on_orphans == "fail":
        for table, refs in S.REFERENCES.items():
            fact = spark.read.schema(S.STAR[table]).parquet(written[table])
            # keys that were looked up in this run cannot dangle; computed ones (the day) can
            computed = {c: (star[d], c) for c, d in refs.items() if c not in S.GENERATED_KEYS}
            validate.refuse_if_any(
                validate.fk_orphans(fact, table, computed), f"{table} refers to missing members")
    wh.publish(written)
    return rows


def refresh_all(
    spark: SparkSession, root: str, sources: Mapping[str, Sequence[Source]],
    calendar: Calendar | None = None, on_orphans: str = "fail", keep_keys: bool = False,
    by_day: bool = False, on_read: Callable[[str], None] | None = None,
) -> dict:
    """Full refresh: all staging tables from their files, then the star schema (see ``load_staging``
    and ``rebuild``)."""
    wh = Warehouse(spark, root)
    loaded = load_staging(wh, sources, on_read)
    return {"staging": loaded, "star": rebuild(wh, calendar, on_orphans, keep_keys, by_day)}


@dataclass
class Batch:
    """A late, new or hand-made batch for one staging table.

    ``kind`` picks the rules: "late" (bulk append, columns cleaned, nothing rejected), "test"
    (hand-made file) or "dirty" (row-isolated append with rejects). ``path`` None means there is
    nothing to append, unless a ``default`` file lies where batches land.
    """

    table: str
    path: str | None
    kind: str = "late"
    format: str | None = None
    options: dict = field(default_factory=dict)
    default: str | None = None


def _late(table: str, raw: DataFrame) -> DataFrame:
    if table == "stg_order_data":
        return staging.late_orders(raw)
    if table == "stg_transactional_campaign_data":
        return staging.stage_campaign_links(raw, day_only=True)
    return stage(table, [raw])


def _test(table: str, raw: DataFrame) -> DataFrame:
    if table == "stg_order_data":
        return staging.fuzzy_orders(raw)
    if table in ("stg_user_data", "stg_user_job"):
        return staging.stage_flagless(raw, table)
    return staging.stage_test_rows(raw, table)


def _dirty(table: str, raw: DataFrame) -> DataFrame:
    if table == "stg_order_data":
        return staging.check_orders(raw)
    if table == "stg_product_list":
        return staging.check_products(raw, normalise=False)
    if table == "stg_line_item_data_products":
        return staging.check_line_products(raw)
    raise ValueError(f"no dirty-batch rules for {table}")


def append_batch(wh: Warehouse, batch: Batch) -> dict:
    """Append one batch to its staging table."""
    path = batch.path or batch.default
    if path is None:
        return {"table": batch.table, "rows_loaded": 0}
    source = Source(
        path, batch.format, tuple(S.STAGING[batch.table].fieldNames()), "csv",
        batch.options)
    raw = settled(read_source(wh.spark, source))
    if batch.kind == "dirty":
        return wh.append_isolated(batch.table, _dirty(batch.table, raw))
    rules = {"late": _late, "test": _test}[batch.kind]
    return wh.append(batch.table, rules(batch.table, raw))


def run_scenario(
    wh: Warehouse, batches: Sequence[Batch], calendar: Calendar | None = None,
    on_orphans: str = "fail", keep_keys: bool = False, by_day: bool = False,
) -> dict:
    """Append batches in order, then rebuild the star schema (see ``rebuild``)."""
    loads = [append_batch(wh, b) for b in batches]
    return {"loads": loads, "star": rebuild(wh, calendar, on_orphans, keep_keys, by_day)}


def orders_on_day(fact_orders: DataFrame, day: int) -> DataFrame:
    """After-state probe: number of orders on one day."""
    return fact_orders.filter(F.col("date_key") == day).agg(F.count(F.lit(1)).alias("n_orders"))
