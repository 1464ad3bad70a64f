"""Calendar features of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_parts(d: Column) -> dict[str, Column]:
    """The eight calendar features; the week starts on Monday = 0."""
    weekday = F.weekday(d)
    return {
        "day_of_week": weekday,
        "day_of_month": F.dayofmonth(d),
        "week_of_year": F.weekofyear(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "is_weekend": (weekday >= 5).cast("int"),
        "is_month_start": (F.dayofmonth(d) == 1).cast("int"),
        "is_month_end": (F.last_day(d) == d).cast("int"),
    }


def parse_date(text: Column) -> Column:
    """The date of a year-month-day text, or null where it is none.

    Four digits of year; month and day may be unpadded. The shape is checked
    first because a cast alone would also take shorter and longer texts.
    """
    shaped = text.rlike(r"^[0-9]{4}-(1[0-2]|0?[1-9])-(3[01]|[12][0-9]|0?[1-9]| [1-9])$") & ~text.startswith("0000")
    return F.when(shaped, F.replace(text, F.lit(" "), F.lit("")).try_cast("date"))


def valid_date(text: Column) -> Column:
    """True for a real year-month-day date."""
    return parse_date(text).isNotNull()
