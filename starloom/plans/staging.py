"""Staging rules, one function per staging table.

Input: source columns plus position, headers as found. Output: the staging schema, plus the
position in tables whose load order matters later.
Functions that validate return rows with ``reject_reasons``; ``validate.accepted`` and
``validate.rejected`` split it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import functions as fn
from starloom import schemas as S
from starloom.operators import dedup, headers, validate
from starloom.sources import union_slices


def _prepared(df: DataFrame, table: str, skip: Sequence[str] = ()) -> DataFrame:
    """Junk columns dropped, headers normalised, required columns present."""
    required = [c for c in S.STAGING[table].fieldNames() if c not in skip]
    df = headers.normalise_headers(headers.drop_junk_columns(df), [*required, S.POSITION])
    return headers.require_columns(df, required, table)


def _staged(df: DataFrame, table: str) -> DataFrame:
    """Declared columns; the position stays only where load order matters later."""
    return headers.conform(
        df, S.STAGING[table], [S.POSITION] if table in S.ORDERED_TABLES else [])


def clean_orders(df: DataFrame) -> DataFrame:
    """Order columns cleaned and typed; bad values are NULL, no row is dropped."""
    source = df.schema["estimated_arrival"].dataType
    cleaned = df.withColumns({
        "order_id": fn.clean_id(F.col("order_id")),
        "user_id": fn.clean_id(F.col("user_id")),
        "estimated_arrival": fn.digits_to_int(F.col("estimated_arrival"), source),
        "transaction_date": fn.to_stamp(F.col("transaction_date")),
    })
    return headers.conform(cleaned, S.STAGING["stg_order_data"])


def check_orders(df: DataFrame) -> DataFrame:
    """One order slice, cleaned, with reject reasons."""
    prepared = _prepared(df, "stg_order_data")
    return validate.with_reasons(clean_orders(prepared), validate.order_rules())


def late_orders(df: DataFrame) -> DataFrame:
    """A late or new order batch: cleaned, but bad values are kept as NULL."""
    return clean_orders(_prepared(df, "stg_order_data")).drop(S.POSITION)


def stage_orders(slices: Sequence[DataFrame]) -> DataFrame:
    """All order slices: valid rows, equal rows once."""
    valid = [validate.accepted(check_orders(s)) for s in slices]
    return dedup.dedup_exact(union_slices(valid))


def fuzzy_orders(df: DataFrame) -> DataFrame:
    """Hand-made order files: headers found by words, missing columns NULL, nothing rejected."""
    found = headers.fuzzy_headers(headers.drop_junk_columns(df))
    filled = headers.fill_missing_columns(found, S.STAGING["stg_order_data"])
    return clean_orders(filled).drop(S.POSITION)


def stage_delays(df: DataFrame) -> DataFrame:
    prepared = _prepared(df, "stg_order_delays")
    days = F.col("delay_in_days").cast("string").try_cast("double").try_cast("int")
    return _staged(prepared.withColumn("delay_in_days", days), "stg_order_delays")


def check_line_products(df: DataFrame) -> DataFrame:
    prepared = _prepared(df, "stg_line_item_data_products")
    typed = headers.conform(prepared, S.STAGING["stg_line_item_data_products"])
    return validate.with_reasons(
        typed, validate.line_product_rules(), ["order_id", "product_id"])


def stage_line_products(slices: Sequence[DataFrame]) -> DataFrame:
    """Product lines of all slices. Equal lines stay: they mean a quantity above one."""
    return union_slices([validate.accepted(check_line_products(s)) for s in slices])


def check_line_prices(df: DataFrame) -> DataFrame:
    """Price lines with a reason where a number cannot be stored; ``raw_price`` keeps its text.

    Such a line stays in the table with a missing price, because the n-th price line belongs to the
    n-th product line.
    """
    prepared = _prepared(df, "stg_line_item_data_prices")
    source = prepared.schema["quantity"].dataType
    cleaned = prepared.withColumns({
        "raw_price": F.col("price").cast("string"),
        "price": fn.decimal_from_text(F.col("price")),
        validate.INEXACT: F.coalesce(fn.inexact_number(F.col("price")), F.lit(False)),
        "quantity": fn.digits_to_int(F.col("quantity"), source),
    })
    typed = headers.conform(cleaned, S.STAGING["stg_line_item_data_prices"], [
        S.POSITION, "raw_price", validate.INEXACT])
    return validate.with_reasons(typed, {"inexact_price": F.col(validate.INEXACT)}, [
        "price", "raw_price", validate.INEXACT]).drop(validate.INEXACT)


def kept_line_prices(checked: DataFrame) -> DataFrame:
    """All price lines, whatever their reasons."""
    return _staged(checked, "stg_line_item_data_prices")


def _line_prices(df: DataFrame) -> DataFrame:
    return kept_line_prices(check_line_prices(df))


def stage_line_prices(slices: Sequence[DataFrame]) -> DataFrame:
    return union_slices([_line_prices(s) for s in slices])


def stage_order_links(slices: Sequence[DataFrame]) -> DataFrame:
    """Order-merchant-staff links: union of all source columns, all text, safe names."""
    cleaned = [headers.sanitise_identifiers(headers.drop_junk_columns(s)) for s in slices]
    linked = headers.union_by_name_text(cleaned)
    linked = headers.require_columns(
        linked, S.STAGING["stg_order_with_merchant_data"].fieldNames(), "order links")
    linked = linked.drop(S.POSITION)
    return linked.withColumns({c: fn.nullif_blank(F.col(c)) for c in linked.columns})


def stage_campaigns(df: DataFrame) -> DataFrame:
    """Campaigns from the packed file (already split) or from a plain file."""
    renamed = headers.rename_synonyms(headers.drop_junk_columns(df), headers.CAMPAIGN_SYNONYMS)
    filled = headers.fill_missing_columns(renamed, S.STAGING["stg_campaign_data"])
    cleaned = filled.withColumns({
        "discount": fn.discount(F.col("discount")),
        "campaign_description": fn.strip_quotes(F.col("campaign_description")),
    })
    return _staged(cleaned, "stg_campaign_data")


def check_campaigns(df: DataFrame) -> DataFrame:
    """Campaigns with a reason where a discount cannot be stored; ``raw_discount`` keeps its text."""
    renamed = headers.rename_synonyms(headers.drop_junk_columns(df), headers.CAMPAIGN_SYNONYMS)
    raw = (F.col("discount").cast("string") if "discount" in renamed.columns
           else F.lit(None).cast("string"))
    digits = F.regexp_replace(raw, S.NOT_DIGIT_OR_DOT, "")
    told = renamed.withColumns({
        "raw_discount": raw, validate.INEXACT: F.coalesce(fn.inexact_number(digits), F.lit(False))})
    filled = headers.fill_missing_columns(told, S.STAGING["stg_campaign_data"])
    cleaned = filled.withColumns({
        "discount": fn.discount(F.col("discount")),
        "campaign_description": fn.strip_quotes(F.col("campaign_description")),
    })
    typed = headers.conform(cleaned, S.STAGING["stg_campaign_data"], [
        "raw_discount", validate.INEXACT])
    return validate.with_reasons(typed, {"inexact_discount": F.col(validate.INEXACT)}, [
        "discount", "raw_discount", validate.INEXACT]).drop(validate.INEXACT)


def kept_campaigns(checked: DataFrame) -> DataFrame:
    """All campaigns, whatever their reasons."""
    return _staged(checked, "stg_campaign_data")


def stage_campaign_links(df: DataFrame, day_only: bool = False) -> DataFrame:
    """Order-campaign links. Late batches carry a day instead of a timestamp (``day_only``)."""
    schema = S.STAGING["stg_transactional_campaign_data"]
    renamed = headers.normalise_headers(
        headers.drop_junk_columns(df), [*schema.fieldNames(), S.POSITION])
    filled = headers.fill_missing_columns(renamed, schema)
    stamp = fn.to_stamp(F.col("transaction_date"))
    if day_only:
        stamp = stamp.cast("date").cast("timestamp_ntz")
    cleaned = filled.withColumns({
        "order_id": fn.clean_id(F.col("order_id")),
        "campaign_id": fn.clean_id(F.col("campaign_id")),
        "estimated_arrival": fn.digits_to_int(
            F.col("estimated_arrival"), filled.schema["estimated_arrival"].dataType),
        "transaction_date": stamp,
        "availed": fn.flag_int(F.col("availed")),
    })
    return _staged(cleaned, "stg_transactional_campaign_data")


_FLAGS = ("possible_duplicate", "possible_duplicate_of")


def stage_users(df: DataFrame) -> DataFrame:
    trimmed = fn.trim_all(_prepared(df, "stg_user_data", _FLAGS))
    cleaned = trimmed.withColumns({
        "creation_date": fn.to_stamp(F.col("creation_date")),
        "birthdate": fn.to_date_lenient(F.col("birthdate")),
    })
    flagged = dedup.soft_dedup_latest(cleaned, "user_id")
    return _staged(flagged, "stg_user_data")


def stage_user_jobs(df: DataFrame) -> DataFrame:
    trimmed = fn.trim_all(_prepared(df, "stg_user_job", _FLAGS))
    cleaned = trimmed.withColumn(
        "job_level", fn.default_text(F.col("job_level"), S.MISSING_LEVEL))
    flagged = dedup.soft_dedup_file_order(cleaned, "user_id")
    return _staged(flagged, "stg_user_job")


def stage_flagless(df: DataFrame, table: str) -> DataFrame:
    """Hand-made user and job batches: missing columns NULL, marked as no duplicates."""
    named = headers.normalise_headers(headers.drop_junk_columns(df))
    filled = headers.constant_flags(headers.fill_missing_columns(named, S.STAGING[table]))
    return _staged(filled, table)


def stage_test_rows(df: DataFrame, table: str) -> DataFrame:
    """Hand-made batches of the remaining tables: normal headers, declared columns and types."""
    named = headers.normalise_headers(headers.drop_junk_columns(df))
    return _staged(headers.fill_missing_columns(named, S.STAGING[table]), table)


def stage_credit_cards(df: DataFrame) -> DataFrame:
    return _staged(_prepared(df, "stg_user_credit_card"), "stg_user_credit_card")


def check_products(df: DataFrame, normalise: bool = True) -> DataFrame:
    """Product list with reject reasons; dirty batches keep names as given (``normalise=False``)."""
    prepared = _prepared(df, "stg_product_list")
    cleaned = prepared.withColumns({
        "price": fn.decimal_from_text(F.col("price")),
        validate.INEXACT: F.coalesce(fn.inexact_number(F.col("price")), F.lit(False))})
    if normalise:
        cleaned = cleaned.withColumns({
            "product_type": fn.spaced_lower(F.col("product_type")),
            "product_name": fn.trim_ws(F.lower(F.col("product_name"))),
        })
    typed = headers.conform(
        cleaned, S.STAGING["stg_product_list"], [S.POSITION, validate.INEXACT])
    return validate.with_reasons(
        typed, validate.product_rules(), ["product_id", "price", validate.INEXACT]
    ).drop(validate.INEXACT)


def stage_products(df: DataFrame) -> DataFrame:
    return dedup.dedup_exact(validate.accepted(check_products(df)))


def _stage_people(df: DataFrame, table: str, id_col: str) -> DataFrame:
    trimmed = fn.trim_all(_prepared(df, table, _FLAGS))
    cleaned = trimmed.withColumns({
        "contact_number": fn.digits_only(F.col("contact_number")),
        "creation_date": fn.to_stamp(F.col("creation_date")),
    })
    return _staged(dedup.soft_dedup_latest(cleaned, id_col), table)


def stage_merchants(df: DataFrame) -> DataFrame:
    return _stage_people(df, "stg_merchant_data", "merchant_id")


def stage_staff(df: DataFrame) -> DataFrame:
    return _stage_people(df, "stg_staff_data", "staff_id")
