"""Calendar parts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(ts: datetime | Column) -> Column:
    """A wall-clock time, the same in every session time zone."""
    if isinstance(ts, Column):
        return ts.cast("timestamp_ntz")
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def date_parts(day: Column) -> dict[str, Column]:
    """Calendar columns of a date. Weeks are ISO weeks, Sunday is day 0."""
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "week": F.weekofyear(day),
        "day_of_year": F.dayofyear(day),
        "day_of_week": F.dayofweek(day) - 1,
        "day_of_the_month": F.dayofmonth(day),
        "day_name": F.date_format(day, "EEE"),
    }


def month_name(month: Column) -> Column:
    """``Jan`` to ``Dec``; a number outside 1 to 12 stays as text."""
    known = F.date_format(F.make_date(F.lit(2000), F.when(month.between(1, 12), month).cast("int"), F.lit(1)), "MMM")
    return F.coalesce(known, month.cast("string"))
