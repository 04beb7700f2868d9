"""Dates in spellings that differ by source, read as expressions, and the order of day and month.

Texts are taken apart by shape: what stands in front (a day name), three parts with one separator or
a month by name, a clock, an offset. Whether 01-02-2024 begins with the day is no property of a row
but of its column: rows that can be read one way only vote, in one aggregation over the column.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CLOCK = r"(?:[T ,]+(\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d{1,6})\d*)?)?(?: ?([AaPp])\.?[Mm]\.?)?)?"
_OFFSET = r"(?: ?(Z|UTC|GMT|[+-]\d{2}:?\d{2}))?"
_WEEKDAY = r"(?:(?:[Mm]on|[Tt]ue|[Ww]ed|[Tt]hu|[Ff]ri|[Ss]at|[Ss]un)[a-z]*,? +)?"

#: Year first, year last, day and month by name, month by name and day.
YEAR_FIRST = rf"^{_WEEKDAY}(\d{{4}})([-/.])(\d{{1,2}})\2(\d{{1,2}}){_CLOCK}{_OFFSET}$"
YEAR_LAST = rf"^{_WEEKDAY}(\d{{1,2}})([-/.])(\d{{1,2}})\2(\d{{4}}|\d{{2}}){_CLOCK}{_OFFSET}$"
DAY_NAME = rf"^{_WEEKDAY}(\d{{1,2}})([- ]+)([A-Za-z]{{3,9}})\.?[- ,]+(\d{{4}}){_CLOCK}{_OFFSET}$"
NAME_DAY = rf"^{_WEEKDAY}([A-Za-z]{{3,9}})([. ]+)(\d{{1,2}}),? +(\d{{4}}){_CLOCK}{_OFFSET}$"

#: Years of two digits from here on belong to the last century.
CENTURY = 70

_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september",
           "october", "november", "december")


def _month(name: Column) -> Column:
    """Number of a month given by its name or at least three letters of it."""
    low = F.lower(name)
    found = F.lit(None).cast("int")
    for n, month in enumerate(_MONTHS, 1):
        found = F.when(F.lit(month).startswith(low), n).otherwise(found)
    return found


def _stamp(text: Column, shape: str, year: Column, month: Column, day: Column) -> Column:
    def part(i: int) -> Column:
        return F.regexp_extract(text, shape, i)

    def number(c: Column) -> Column:
        return F.coalesce(F.nullif(c, F.lit("")).try_cast("int"), F.lit(0))

    hour, half = number(part(5)), F.lower(part(9))
    # 12 AM is midnight, 12 PM noon; 13 PM is no time
    of_half = F.when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    seconds = (number(part(7)) + F.concat(F.lit("0."), part(8), F.lit("0")).try_cast(
        "decimal(8,6)")).cast("decimal(16,6)")
    local = F.call_function(
        "try_make_timestamp_ntz", year, month, day,
        F.when(half == "", hour).otherwise(of_half), number(part(6)), seconds)
    offset = F.translate(part(10), ":", "")
    numeric = offset.rlike(r"^[+-]\d{4}$")
    minutes = F.when(numeric, number(offset.substr(2, 2)) * 60 + number(offset.substr(4, 2)))
    sign = F.when(offset.startswith("-"), 1).otherwise(-1)
    return F.when(minutes > 0, local + F.make_dt_interval(mins=sign * minutes)).otherwise(local)


def read_shapes(text: Column, day_first: bool = False) -> Column:
    """Timestamp without zone of a trimmed text, by its shape; NULL when it has none of the shapes.

    A time with an offset becomes the time in UTC. ``day_first`` holds for numeric dates that end
    with the year; those that can only be read the other way are read so.
    """
    def part(shape: str, i: int) -> Column:
        return F.regexp_extract(text, shape, i).try_cast("int")

    a, b = part(YEAR_LAST, 1), part(YEAR_LAST, 3)
    short = part(YEAR_LAST, 4)
    year = F.when(F.length(F.regexp_extract(text, YEAR_LAST, 4)) == 4, short).otherwise(
        short + F.when(short < CENTURY, 2000).otherwise(1900))
    swap = (b <= 12) if day_first else (a > 12)
    last = _stamp(text, YEAR_LAST, year, F.when(swap, b).otherwise(a), F.when(swap, a).otherwise(b))
    first = _stamp(text, YEAR_FIRST, part(YEAR_FIRST, 1), part(YEAR_FIRST, 3), part(YEAR_FIRST, 4))
    named = _stamp(text, DAY_NAME, part(DAY_NAME, 4), _month(F.regexp_extract(text, DAY_NAME, 3)),
                   part(DAY_NAME, 1))
    by_name = _stamp(text, NAME_DAY, part(NAME_DAY, 4), _month(F.regexp_extract(text, NAME_DAY, 1)),
                     part(NAME_DAY, 3))
    return (F.when(text.rlike(YEAR_LAST), last).when(text.rlike(YEAR_FIRST), first)
            .when(text.rlike(DAY_NAME), named).when(text.rlike(NAME_DAY), by_name))


def apart(text: Column, rule: Callable[[Column], Column]) -> Column:
    """``rule`` of a text, as a function of its own that only rows which need it go through.

    Written in line, the readers of all spellings exceed the size of a generated method; then the
    whole projection is interpreted, for every row.
    """
    return F.get(F.transform(F.array(text), rule), F.lit(0))


def has_offset(text: Column) -> Column:
    """A clock with an offset behind it, which a cast would drop."""
    return text.rlike(r":\d{2}(?:\.\d+)?(?: ?[AaPp]\.?[Mm]\.?)? ?(?:Z|UTC|GMT|[+-]\d{2}:?\d{2})$")


@dataclass(frozen=True)
class Votes:
    """How the numeric dates of a column that end with the year can be read."""

    day_first: int
    month_first: int
    either: int

    @property
    def decided(self) -> bool | None:
        """True: the day comes first; False: the month does, or it does not matter; None: unknown."""
        if self.day_first and self.month_first and self.either:
            return None
        return self.day_first > 0 and not self.month_first


def vote(df: DataFrame, columns: Sequence[str]) -> dict[str, Votes]:
    """Votes of every column, in one aggregation over all of them."""
    sums = []
    for c in columns:
        text = F.trim(F.col(c))
        some = text.rlike(YEAR_LAST)
        # only texts of the shape have parts; a failing try_cast costs many times a good one
        a = F.when(some, F.regexp_extract(text, YEAR_LAST, 1).try_cast("int"))
        b = F.when(some, F.regexp_extract(text, YEAR_LAST, 3).try_cast("int"))
        sums += [F.count_if(some & (a > 12) & (b <= 12)).alias(f"{c}_day"),
                 F.count_if(some & (b > 12) & (a <= 12)).alias(f"{c}_month"),
                 F.count_if(some & (a <= 12) & (b <= 12) & (a != b)).alias(f"{c}_either")]
    r = df.agg(*sums).first()
    return {c: Votes(r[f"{c}_day"], r[f"{c}_month"], r[f"{c}_either"]) for c in columns}


class UndecidedDates(ValueError):
    """A column mixes dates that begin with the day and dates that begin with the month."""


def settle_day_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns of dates, with day-first dates respelled from the year on.

    A column whose rows vote for the day is read so as a whole. One that has votes for both and rows
    that could be either is refused with its counts. Without any vote the month comes first. Columns
    that are missing or no text are left alone.
    """
    texts = [c for c in columns if c in df.columns and isinstance(
        df.schema[c].dataType, T.StringType)]
    if not texts:
        return df
    found = vote(df, texts)
    bad = {c: v for c, v in found.items() if v.decided is None}
    if bad:
        raise UndecidedDates(f"day or month first cannot be told: {bad}")
    for c in (c for c, v in found.items() if v.decided):
        text = F.trim(F.col(c))
        iso = apart(text, lambda t: read_shapes(t, day_first=True)).cast("string")
        df = df.withColumn(c, F.when(text.rlike(YEAR_LAST), iso).otherwise(F.col(c)))
    return df
