"""Scalar cleaning rules.

Everything is a built-in column expression, so it stays inside whole-stage codegen. Dirty text
is always converted with ``try_cast``: the session runs in ANSI mode and a plain cast would end
the job on the first bad value. A missing value stays missing (it never becomes the text "nan").
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas as S
from starloom.functions.dates import apart, has_offset, read_shapes


def trim_ws(c: Column) -> Column:
    """Strip all leading and trailing white space, tabs and line breaks included."""
    return F.btrim(c, F.lit(S.WHITE_SPACE))


def trim_all(df: DataFrame) -> DataFrame:
    """``trim_ws`` on every text column."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: trim_ws(F.col(n)) for n in names}) if names else df


def nullif_blank(c: Column) -> Column:
    return F.when(c != "", c)


def null_tokens(c: Column) -> Column:
    """The null spellings of delimited files become NULL (exact match, as the readers do)."""
    return F.when(~c.isin(*S.NULL_TOKENS), c)


def clean_id(c: Column) -> Column:
    """Id as trimmed text; blank, "nan" and "none" in any case are NULL."""
    text = trim_ws(c.cast("string"))
    return F.when(~F.lower(text).isin(*S.ID_PLACEHOLDERS), text)


def spaced_lower(c: Column) -> Column:
    """Lower case, underscores to spaces, trimmed: product types."""
    return trim_ws(F.translate(F.lower(c), "_", " "))


def digits_to_int(c: Column, source: T.DataType | None = None) -> Column:
    """The digits of a text as INT ("15days" -> 15); NULL when there are none or too many.

    A numeric source column is taken as a number, so 15.0 is 15 and not the digits "150".
    """
    if isinstance(source, T.NumericType):
        return c.try_cast("bigint").try_cast("int")
    digits = F.regexp_replace(c.cast("string"), S.NOT_A_DIGIT, "")
    # a failing try_cast costs many times a good one, so it is left to texts that need it
    size = F.length(digits)
    return (F.when(size.between(1, 9), digits.cast("int"))
            .when(size.between(10, 18), _int_if_fits(digits.cast("bigint")))
            .when(size > 18, digits.try_cast("int")))


def _int_if_fits(c: Column) -> Column:
    return F.when(c <= S.INT_MAX, c.cast("int"))


def digits_only(c: Column) -> Column:
    """Phone numbers: digits kept as text, blank to NULL."""
    return nullif_blank(F.regexp_replace(c.cast("string"), S.NOT_A_DIGIT, ""))


def decimal_from_text(c: Column) -> Column:
    """Number or NULL; "free", "inf" and numbers that the storage type cannot hold exactly are NULL.

    A binary float that prints with 16 or 17 digits is the number of its first 15, which is what its
    source wrote: 0.30000000000000004 is 0.3. Decimal texts with as many digits are no such floats.
    Nothing else is rounded: ``inexact_number`` tells those numbers from texts that are none.
    """
    def printed(text: Column) -> Column:
        number = text.try_cast("double")
        short = F.format_string("%.14e", number).try_cast("double")
        return F.when(_printed_float(text, number, short), _exact(short.cast("string")))

    text = F.trim(c.cast("string"))
    return F.coalesce(_exact(text), apart(text, printed))


def _exact(text: Column) -> Column:
    # the text is read once: what the wide type rounds away is less than half of its last place, so
    # a wide number that fits the narrow type is what the narrow type would have read
    wide = text.try_cast(S.WIDE_NUMBER)
    money = wide.try_cast(S.MONEY)
    return F.when(money == wide, money)


def _printed_float(text: Column, number: Column, short: Column) -> Column:
    """A binary float printed with the 16 or 17 digits that tell it from its neighbours, which lie
    within two steps (2^-52 of its size) of the number of 15 digits."""
    digits = F.regexp_replace(F.regexp_replace(text, "[eE].*$", ""), "[^0-9]|^[-+0.]+", "")
    near = F.abs(number - short) <= F.abs(short) * F.lit(2.0 ** -51)
    return number.isNotNull() & F.length(digits).between(16, 17) & near


def inexact_number(c: Column) -> Column:
    """True for a finite number that ``decimal_from_text`` refuses, with too many digits."""
    number = F.trim(c.cast("string")).try_cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))
    # the storable number first: it is looked at anyway, and only few rows need the other conversion
    return decimal_from_text(c).isNull() & finite


def discount(c: Column) -> Column:
    """The digits and dots of a discount text: "10%%" -> 10, "1pct" -> 1."""
    return decimal_from_text(F.regexp_replace(c.cast("string"), S.NOT_DIGIT_OR_DOT, ""))


def strip_quotes(c: Column) -> Column:
    return F.translate(c, '"', "")


def to_stamp(c: Column) -> Column:
    """Timestamp without zone from a date or a date-time text, row by row; bad text is NULL.

    ISO spellings first, then those of ``schemas.DATE_FORMATS``, then the shapes of ``dates``. A time
    with an offset becomes the time in UTC. All but the ISO spellings are read ``apart``.
    """
    def others(text: Column) -> Column:
        named = F.lit(None).cast(S.STAMP)
        for pattern, spelling in reversed(S.DATE_FORMATS):
            read = F.try_to_timestamp(text, F.lit(spelling)).cast(S.STAMP)
            named = F.when(text.rlike(pattern), read).otherwise(named)
        shaped = read_shapes(text)
        return F.when(has_offset(text), shaped).otherwise(F.coalesce(named, shaped))

    text = F.trim(c.cast("string"))
    iso = F.when(~has_offset(text), c.try_cast(S.STAMP))
    return F.coalesce(iso, apart(text, others))


def to_date_lenient(c: Column) -> Column:
    return to_stamp(c).cast("date")


def default_text(c: Column, value: str) -> Column:
    return F.coalesce(c, F.lit(value))


def flag_int(c: Column) -> Column:
    """0/1 style integer: bad or missing is 0, decimals are cut off."""
    return F.coalesce(c.cast("string").try_cast("double").try_cast("int"), F.lit(0))


def flag_is_true(c: Column) -> Column:
    """True only for the text or boolean true; missing counts as false."""
    return F.coalesce(F.lower(c.cast("string")) == "true", F.lit(False))


def date_key(c: Column) -> Column:
    """Day as YYYYMMDD integer, from date parts (no text formatting per row)."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def calendar_parts(day: Column) -> dict[str, Column]:
    return {
        "date_key": date_key(day),
        "full_date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_name": F.date_format(day, "EEEE"),
        "month_name": F.date_format(day, "MMMM"),
        "is_weekend": F.dayofweek(day).isin(1, 7),
    }
