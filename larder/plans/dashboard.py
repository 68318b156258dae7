"""The queries behind the revenue dashboard, each on top of a mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.casts import whole_units
from larder.functions.dates import month_name
from larder.plans.marts import MEASURES

TOP_N_MIN, TOP_N_MAX, TOP_N_DEFAULT = 5, 25, 10  # fixed values: the slider of the report


def yearly_scorecard(yearly: DataFrame) -> DataFrame:
    return yearly.select("year", *MEASURES).orderBy("year")


def monthly_series(monthly: DataFrame, year: int) -> DataFrame:
    """Months of one year with revenue in whole units."""
    return (
        monthly.where(F.col("year") == year)
        .select(F.col("month"), whole_units(F.col("total_revenue")).alias("total_revenue"))
        .orderBy("month")
    )


def distinct_months(by_restaurant: DataFrame, year: int) -> DataFrame:
    return by_restaurant.where(F.col("year") == year).select("month").distinct().orderBy("month")


def top_stores(by_restaurant: DataFrame, year: int, month: int, limit: int = TOP_N_DEFAULT) -> DataFrame:
    """The stores with the most revenue in a month.

    The mart has one row per delivery status, so a store may appear more than
    once. Name and status break ties.
    """
    if not TOP_N_MIN <= limit <= TOP_N_MAX:
        raise ValueError(f"limit must be from {TOP_N_MIN} to {TOP_N_MAX}")
    return (
        by_restaurant.where((F.col("year") == year) & (F.col("month") == month))
        .orderBy(F.desc("total_revenue"), "restaurant_name", "delivery_status")
        .limit(limit)
        .select(F.col("restaurant_name").alias("store_name"), *MEASURES)
    )


def all_time_totals(yearly: DataFrame) -> DataFrame:
    return yearly.agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
        F.max("max_order_value").alias("max_order_value"),
    )


def yoy_delta(yearly: DataFrame) -> DataFrame:
    """Each year's measures minus those of exactly the year before.

    NULL where that year is missing. The window has no partition because its
    input is one row per year.
    """
    year_before = Window.orderBy("year").rangeBetween(-1, -1)
    deltas = [(F.col(m) - F.first(m).over(year_before)).alias(f"{m}_delta") for m in MEASURES]
    return yearly.select("year", *MEASURES, *deltas)


def cumulative_revenue(monthly: DataFrame) -> DataFrame:
    """Running revenue of each year, with month names; at most 12 rows per window."""
    so_far = Window.partitionBy("year").orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.select(
        "year",
        "month",
        month_name(F.col("month")).alias("month_name"),
        "total_revenue",
        F.sum("total_revenue").over(so_far).alias("cumulative_revenue"),
    )


def latest_period(monthly: DataFrame) -> DataFrame:
    """The last year with data and its last month."""
    return monthly.agg(F.max(F.struct("year", "month")).alias("p")).select(
        F.col("p.year").alias("year"), F.col("p.month").alias("month")
    )
