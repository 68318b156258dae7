"""Marts, dashboard queries, calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.dates import month_name
from larder.functions.text import format_inr
from larder.plans import dashboard, marts
from larder.plans.date_dim import date_dim, first_day
from larder.plans.retail import AS_OF, Retail
from larder.registry import sqltext as S
from larder.registry.base import query

YEAR, MONTH = 1998, 3


def yearly(r: Retail) -> DataFrame:
    return marts.yearly(r.revenue_fact(), r.dates())


def monthly(r: Retail) -> DataFrame:
    return marts.monthly(r.revenue_fact(), r.dates())


def by_restaurant(r: Retail) -> DataFrame:
    return marts.monthly_by_restaurant(r.revenue_fact(restaurants=True), r.dates(), r.dimension("restaurant"))


query("kpi_yearly", S.YEARLY)(yearly)
query("kpi_monthly", S.MONTHLY)(monthly)
query("kpi_daily", S.kpis("year, month, day_of_the_month AS day", S.DELIVERED))(
    lambda r: marts.daily(r.revenue_fact(), r.dates())
)
query("kpi_day_name", S.kpis("year, month, day_name"))(lambda r: marts.by_day_name(r.revenue_fact(), r.dates()))
query("kpi_monthly_restaurant", S.BY_RESTAURANT)(by_restaurant)
query(
    "kpi_max_order_total",
    f"""SELECT year, CAST(max(t) AS DOUBLE) AS max_order_total FROM (
          SELECT year, order_id, sum(subtotal) AS t FROM {S.REVENUE_ROWS} WHERE {S.DELIVERED} GROUP BY year, order_id)
        GROUP BY year""",
)(lambda r: marts.max_order_total(r.revenue_fact(), r.dates(), ["year"]))


def _one_of_all(name: str, mart_sql: str, *by: str) -> str:
    """A mart in the columns of ``all_marts``."""
    groups = ", ".join(c if c in by else f"CAST(NULL AS {'VARCHAR' if 'name' in c or 'status' in c else 'INTEGER'}) AS {c}" for c in marts.GROUP_COLUMNS)
    return f"SELECT '{name}' AS mart, {groups}, {', '.join(marts.MEASURES)} FROM ({mart_sql})"


ALL_MARTS = (
    S.YEARLY, S.MONTHLY, S.kpis("year, month, day_of_the_month AS day", S.DELIVERED), S.kpis("year, month, day_name"), S.BY_RESTAURANT,
)


@query("all_marts", " UNION ALL ".join(_one_of_all(n, t, *by) for n, t, (by, _) in zip(marts.VIEW_NAMES, ALL_MARTS, marts.MART_GROUPS)))
def all_marts(r: Retail) -> DataFrame:
    """The five marts from one scan of the fact."""
    return marts.all_marts(r.revenue_fact(restaurants=True), r.dates(), r.dimension("restaurant"))


@query(
    "agg_basic",
    """SELECT l_returnflag, l_linestatus, count(*) AS n_rows, count(l_shipdate) AS n_ship, count(DISTINCT l_orderkey) AS n_orders,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, max(l_extendedprice) AS max_price,
         min(l_extendedprice) AS min_price
       FROM {lineitem} GROUP BY l_returnflag, l_linestatus""",
)
def agg_basic(r: Retail) -> DataFrame:
    return r.table("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("l_shipdate").alias("n_ship"),
        F.countDistinct("l_orderkey").alias("n_orders"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("revenue"),
        F.max("l_extendedprice").alias("max_price"),
        F.min("l_extendedprice").alias("min_price"),
    )


query(
    "all_time_totals",
    f"""SELECT CAST(sum(total_revenue) AS DOUBLE) AS total_revenue, CAST(sum(total_orders) AS BIGINT) AS total_orders,
          CAST(max(max_order_value) AS DOUBLE) AS max_order_value FROM (
          SELECT year, sum(subtotal) AS total_revenue, count(DISTINCT order_id) AS total_orders, max(subtotal) AS max_order_value
          FROM {S.REVENUE_ROWS} WHERE {S.DELIVERED} GROUP BY year)""",
)(lambda r: dashboard.all_time_totals(yearly(r)))
query("distinct_months", f"SELECT DISTINCT month FROM ({S.BY_RESTAURANT}) WHERE year = {YEAR}")(
    lambda r: dashboard.distinct_months(by_restaurant(r), YEAR)
)
query("yearly_scorecard", S.YEARLY)(lambda r: dashboard.yearly_scorecard(yearly(r)))
query(
    "monthly_series",
    f"""SELECT month, CAST(CAST(CAST(total_revenue AS DECIMAL(38,2)) AS DECIMAL(38,0)) AS DOUBLE) AS total_revenue
        FROM ({S.MONTHLY}) WHERE year = {YEAR}""",
)(lambda r: dashboard.monthly_series(monthly(r), YEAR))
query(
    "top_stores",
    f"""SELECT restaurant_name AS store_name, total_revenue, total_orders, avg_revenue_per_order, avg_revenue_per_item,
          max_order_value FROM ({S.BY_RESTAURANT}) WHERE year = {YEAR} AND month = {MONTH}
        ORDER BY total_revenue DESC, restaurant_name, delivery_status LIMIT {dashboard.TOP_N_DEFAULT}""",
)(lambda r: dashboard.top_stores(by_restaurant(r), YEAR, MONTH))

MEASURES = marts.MEASURES
# Deltas in exact decimals, like the measures they come from.
DELTAS = ", ".join(
    f"CAST(CAST(c.{m} AS DECIMAL(28,2)) - CAST(p.{m} AS DECIMAL(28,2)) AS {'BIGINT' if m == 'total_orders' else 'DOUBLE'}) AS {m}_delta"
    for m in MEASURES
)
query(
    "yoy_delta",
    f"""WITH y AS ({S.YEARLY}) SELECT c.year, {', '.join('c.' + m for m in MEASURES)}, {DELTAS}
        FROM y c LEFT JOIN y p ON p.year = c.year - 1""",
)(lambda r: dashboard.yoy_delta(yearly(r)))
query(
    "cumulative_revenue",
    f"""WITH m AS ({S.MONTHLY}) SELECT year, month, strftime(make_date(2000, month, 1), '%b') AS month_name, total_revenue,
          CAST(sum(CAST(total_revenue AS DECIMAL(28,2))) OVER (PARTITION BY year ORDER BY month ROWS UNBOUNDED PRECEDING) AS DOUBLE)
          AS cumulative_revenue FROM m""",
)(lambda r: dashboard.cumulative_revenue(monthly(r)))


@query(
    "month_name",
    """SELECT CAST(month(o_orderdate) AS INT) AS month, strftime(o_orderdate, '%b') AS month_name, count(*) AS n_orders
       FROM {orders} GROUP BY ALL""",
)
def month_names(r: Retail) -> DataFrame:
    """Orders per calendar month, in calendar order."""
    months = r.table("orders").groupBy(F.month("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("n_orders"))
    return months.select("month", month_name(F.col("month")).alias("month_name"), "n_orders").orderBy("month")


@query(
    "format_inr",
    """SELECT order_id, CASE WHEN cents IS NULL THEN '—' ELSE '₹' || format('{:,}', units) END AS total_text,
         CASE WHEN cents IS NULL THEN '—' ELSE '₹' || format('{:,}', tenths // 10) || '.' || (tenths % 10) END AS total_text_1
       FROM (SELECT order_id, cents,
               cents // 100 + CASE WHEN cents % 100 > 50 OR (cents % 100 = 50 AND (cents // 100) % 2 = 1) THEN 1 ELSE 0 END AS units,
               cents // 10 + CASE WHEN cents % 10 > 5 OR (cents % 10 = 5 AND (cents // 10) % 2 = 1) THEN 1 ELSE 0 END AS tenths
             FROM (SELECT o_orderkey AS order_id,
                     CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS cents
                   FROM {orders}))""",
)
def format_amounts(r: Retail) -> DataFrame:
    amount = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("decimal(18,2)"))
    return r.table("orders").select(
        F.col("o_orderkey").alias("order_id"),
        format_inr(amount).alias("total_text"),
        format_inr(amount, 1).alias("total_text_1"),
    )


query(
    "latest_period",
    f"SELECT year, month FROM ({S.MONTHLY}) ORDER BY year DESC, month DESC LIMIT 1",
)(lambda r: dashboard.latest_period(monthly(r)))
query("date_dim", f"SELECT * FROM {S.DATES}")(lambda r: r.dates())
query(
    "date_dim_open_start",
    f"SELECT * FROM {S.DATES} WHERE calendar_date > (SELECT CAST(min(o_orderdate) AS DATE) FROM {{orders}})",
)(lambda r: date_dim(r.orders(), AS_OF, include_start=False))


@query(
    "scalar_subquery",
    """SELECT o_orderkey AS order_id,
         CAST(CAST(o_orderdate AS DATE) - (SELECT CAST(min(o_orderdate) AS DATE) FROM {orders}) AS INT) AS days_open
       FROM {orders}""",
)
def scalar_subquery(r: Retail) -> DataFrame:
    """Days between the first order of all and each order; the subquery is one row."""
    orders = r.orders()
    return orders.select(
        "order_id", F.date_diff(F.to_date("order_date"), first_day(orders).scalar()).alias("days_open")
    )


@query(
    "union_all",
    """SELECT 'customer' AS kind, c_custkey AS id, c_name AS name FROM {customer}
       UNION ALL SELECT 'supplier', s_suppkey, s_name FROM {supplier}
       UNION ALL SELECT 'part', p_partkey, p_name FROM {part}""",
)
def union_all(r: Retail) -> DataFrame:
    def named(table: str, key: str, name: str) -> DataFrame:
        return r.table(table).select(F.lit(table).alias("kind"), F.col(key).alias("id"), F.col(name).alias("name"))

    return (
        named("customer", "c_custkey", "c_name")
        .unionByName(named("supplier", "s_suppkey", "s_name"))
        .unionByName(named("part", "p_partkey", "p_name"))
    )


query("sort_rows", "SELECT c_custkey, c_name, c_acctbal FROM {customer} ORDER BY c_acctbal DESC, c_custkey")(
    lambda r: r.table("customer").select("c_custkey", "c_name", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey")
)
query("limit_rows", "SELECT c_custkey, c_name, c_acctbal FROM {customer} ORDER BY c_acctbal DESC, c_custkey LIMIT 10")(
    lambda r: r.table("customer").select("c_custkey", "c_name", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(10)
)
