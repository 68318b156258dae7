"""The calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.dates import date_parts
from larder.functions.keys import date_key


def first_day(orders: DataFrame, order_date: str = "order_date") -> DataFrame:
    """One row: the date of the first order (NULL without orders)."""
    return orders.agg(F.to_date(F.min(order_date)).alias("first_day"))


def date_dim(orders: DataFrame, as_of: date | Column, order_date: str = "order_date", include_start: bool = True) -> DataFrame:
    """Every day from the first order to ``as_of``, newest key material last.

    ``include_start=False`` leaves the first order's own day out, as the
    literal recursive rule does (``as_of`` itself always stays).
    """
    last = as_of if isinstance(as_of, Column) else F.lit(as_of)
    start = F.col("first_day") if include_start else F.date_add("first_day", 1)
    # A sequence would count down from a start after its end: keep just the last day then.
    days = F.sequence(F.least(start, last), last)
    rows = first_day(orders, order_date).select(F.explode(days).alias("calendar_date"))
    return rows.select(
        date_key("calendar_date").alias("date_dim_hk"),
        "calendar_date",
        *[c.alias(n) for n, c in date_parts(F.col("calendar_date")).items()],
    )
