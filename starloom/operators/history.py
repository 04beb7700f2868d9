"""Validity windows of dimension members and lookups as of a point in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators import validate
from starloom.operators.blocks import last_before, next_in_group, range_blocks
from starloom.operators.keys import dense_keys, next_key
from starloom.session import materialise


def current_versions(df: DataFrame, run_ts: Column) -> DataFrame:
    """Newly found members: valid from the run on, open ended, current."""
    return df.withColumns({
        "valid_from": run_ts,
        "valid_to": F.lit(None).cast("timestamp_ntz"),
        "is_current": F.lit(True),
    })


def scd2_versions(df: DataFrame, id_col: str, valid_from: str = "valid_from") -> DataFrame:
    """``valid_to`` is the start of the next version of the id; the last one is current.

    Versions of an id that share a start have no length, but for one of them. Rows without id or
    start are no versions: they stay open and are not current.
    """
    whole = F.col(id_col).isNotNull() & F.col(valid_from).isNotNull()
    stamp = df.schema[valid_from].dataType
    blocks = range_blocks(df.filter(whole), [id_col, valid_from], "versions")
    out = next_in_group(blocks, [id_col], valid_from, F.col("block"), "valid_to").drop("block")
    out = out.withColumn("is_current", F.col("valid_to").isNull())
    others = df.filter(~whole).withColumns({
        "valid_to": F.lit(None).cast(stamp), "is_current": F.lit(False)})
    return out.unionByName(others)


def merge_versions(
    versions: DataFrame, state: DataFrame, id_col: str, at: Column, key: str,
    since: Column | None = None,
) -> DataFrame:
    """The version table after a new state of its members, whose attributes are compared.

    ``versions`` has ``key`` (generated), ``id_col``, the attributes, valid_from, valid_to and
    is_current; ``state`` has ``id_col`` and the attributes, one row per id. A member whose
    attributes differ in any cell gets a new version from ``at`` on and its last one ends there; one
    that is gone has its last version ended; one that was not current before starts at ``at``, or at
    ``since`` if its id never had a version. A missing cell equals a missing cell. New versions are
    numbered after the largest key, so keys stay.

    Only current versions are compared, one row per id on either side, so an id with many versions
    is no hot key; versions that ended are handed on as they are. State rows without id are left out.
    Repeated ids in the state and an ``at`` before the start of a current version are refused.
    """
    shape = versions.columns
    attributes = [c for c in state.columns if c != id_col]
    stamp = versions.schema["valid_from"].dataType
    at = at.cast(stamp)
    state = state.filter(F.col(id_col).isNotNull())
    validate.refuse_if_any(state.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_rows")).filter(
        "n_rows > 1"), f"several rows of one {id_col} in a state")
    current = versions.filter("is_current")
    validate.refuse_if_any(
        current.filter(F.col("valid_from") > at).select(id_col, "valid_from"),
        "a state is older than a version")
    old = current.select(F.col(id_col).alias("_id"), F.struct(*attributes).alias("_old"), *[
        F.col(c).alias(f"_{c}") for c in (key, "valid_from")])
    new = state.select(id_col, F.struct(*attributes).alias("_new"))
    both = materialise(old.join(new, old["_id"] == new[id_col], "full"), "versions-compared")
    same = F.col("_old").eqNullSafe(F.col("_new"))

    def version(attrs: str, start: Column, end: Column) -> list[Column]:
        cells = {id_col: F.coalesce("_id", id_col), "valid_from": start, "valid_to": end,
                 "is_current": end.isNull()}
        cells |= {a: F.col(f"{attrs}.{a}") for a in attributes}
        return [cells[c].alias(c) for c in shape if c != key]

    end = F.when(~same, at)
    kept = both.filter(F.col("_id").isNotNull()).select(
        F.col(f"_{key}").alias(key), *version("_old", F.col("_valid_from"), end))
    opened = both.filter(F.col("_new").isNotNull() & ~same)
    known = versions.select(F.col(id_col).alias("_seen")).distinct()
    opened = opened.join(known, opened[id_col] == F.col("_seen"), "left")
    start = F.when(F.col("_seen").isNull(), at if since is None else since.cast(stamp)).otherwise(at)
    opened = dense_keys(
        opened.select(*version("_new", start, F.lit(None).cast(stamp))), key, [id_col],
        start=next_key(versions, key), name=key)
    return versions.filter("NOT is_current").select(*shape).unionByName(kept).unionByName(opened)


def asof_lookup(
    rows: DataFrame, versions: DataFrame, id_col: str, at: str, key: str,
    valid_from: str = "valid_from", valid_to: str = "valid_to", row_cols: Sequence[str] = (),
) -> DataFrame:
    """The version of the same id with ``valid_from <= at < valid_to``, NULL if there is none.

    Rows and versions are merged into one time line per id, and every row takes the last version
    before it: linear in both inputs, where a range join would try every version of the id for
    every row. Versions of an id must not overlap; those without length are left out, and of
    versions that share a start the one that is valid longest counts, then the largest key. Rows
    without id or time have no version and do not enter the time line, which is written once and
    cut into blocks of equal length.
    """
    carry = list(row_cols) or [c for c in rows.columns if c not in (id_col, at)]
    left = rows.select(
        F.col(id_col).alias("_id"), F.col(at).alias("_t"), F.lit(1).alias("_kind"),
        F.struct(*carry).alias("_row") if carry else F.struct(F.lit(0).alias("_z")).alias("_row"),
        F.lit(None).cast(_version_type(versions, key, valid_to)).alias("_ver"))
    long = F.col(valid_to).isNull() | (F.col(valid_to) > F.col(valid_from))
    right = versions.filter(F.col(id_col).isNotNull() & F.col(valid_from).isNotNull() & long).select(
        F.col(id_col).alias("_id"), F.col(valid_from).alias("_t"), F.lit(0).alias("_kind"),
        F.lit(None).cast(left.schema["_row"].dataType).alias("_row"),
        F.struct(F.col(key).alias("key"), F.col(valid_to).alias("until")).alias("_ver"))
    placed = F.col("_id").isNotNull() & F.col("_t").isNotNull()
    order = F.struct(
        "_t", "_kind", F.col("_ver.until").isNull().alias("open"), "_ver.until", "_ver.key")
    line = left.filter(placed).unionByName(right).withColumn("_order_in", order)
    line = range_blocks(line, ["_id", "_order_in"], "time_line")
    found = last_before(
        line, ["_id"], [F.col("_order_in")], "_ver", F.col("block"), "_hit").filter("_kind = 1")
    open_or_later = F.col("_hit.until").isNull() | (F.col("_t") < F.col("_hit.until"))
    hit = F.when(open_or_later, F.col("_hit.key"))
    cells = [F.col("_id").alias(id_col), F.col("_t").alias(at),
             *[F.col(f"_row.{c}").alias(c) for c in carry]]
    lost = left.filter(~placed).select(
        *cells, F.lit(None).cast(versions.schema[key].dataType).alias(key))
    return found.select(*cells, hit.alias(key)).unionByName(lost)


def _version_type(versions: DataFrame, key: str, valid_to: str) -> str:
    kt = versions.schema[key].dataType.simpleString()
    tt = versions.schema[valid_to].dataType.simpleString()
    return f"struct<key:{kt},until:{tt}>"


def identity_match(
    rows: DataFrame, dim: DataFrame, row_cols: Sequence[str], dim_cols: Sequence[str], key: str
) -> DataFrame:
    """Left join on a composite identity; a missing part equals a missing part."""
    right = dim.select(*[F.col(c).alias(f"_d_{c}") for c in dim_cols], F.col(key))
    cond = None
    for a, b in zip(row_cols, dim_cols):
        part = F.col(a).eqNullSafe(F.col(f"_d_{b}"))
        cond = part if cond is None else cond & part
    return rows.join(right, cond, "left").drop(*[f"_d_{b}" for b in dim_cols])
