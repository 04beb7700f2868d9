"""Scalar cleaning rules as column expressions."""

from starloom.functions.dates import UndecidedDates, settle_day_order, vote
from starloom.functions.scalar import (
    calendar_parts,
    clean_id,
    date_key,
    decimal_from_text,
    inexact_number,
    default_text,
    digits_only,
    digits_to_int,
    discount,
    flag_int,
    flag_is_true,
    null_tokens,
    nullif_blank,
    spaced_lower,
    strip_quotes,
    to_date_lenient,
    to_stamp,
    trim_all,
    trim_ws,
)

__all__ = [
    "UndecidedDates", "settle_day_order", "vote",
    "calendar_parts", "clean_id", "date_key", "decimal_from_text", "inexact_number", "default_text", "digits_only",
    "digits_to_int", "discount", "flag_int", "flag_is_true", "null_tokens", "nullif_blank",
    "spaced_lower", "strip_quotes", "to_date_lenient", "to_stamp", "trim_all", "trim_ws",
]
