"""Fact assembly, joins, keys, integrity checks and masks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import masking
from larder.functions.keys import date_key, hash_key
from larder.operators.lookup import lookup_along_history
from larder.operators.quality import column_violations, duplicate_keys, row_counts
from larder.operators.scd2 import Dimension, scd2_history
from larder.operators.surrogate import surrogate_key
from larder.plans import fact as fact_plan
from larder.plans.retail import Retail
from larder.registry import sqltext as S
from larder.registry.base import query

query("order_item_fact", f"SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(subtotal AS DOUBLE) AS subtotal) FROM {S.FACT}")(
    lambda r: r.fact()
)


@query(
    "left_join",
    """SELECT o_orderkey AS order_id, o_custkey, c_name, c_mktsegment FROM {orders}
       LEFT JOIN (SELECT * FROM {customer} WHERE c_acctbal > 0) ON o_custkey = c_custkey""",
)
def left_join(r: Retail) -> DataFrame:
    good = r.table("customer").where("c_acctbal > 0").select("c_custkey", "c_name", "c_mktsegment")
    joined = r.table("orders").join(good, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.select(F.col("o_orderkey").alias("order_id"), "o_custkey", "c_name", "c_mktsegment")


@query(
    "star_inner_join",
    f"""SELECT order_id, subtotal, CAST(year AS INT) AS year, CAST(month AS INT) AS month, restaurant_name
        FROM (SELECT order_id, CAST(subtotal AS DOUBLE) AS subtotal, year, month, restaurant_name FROM {S.REVENUE_ROWS})""",
)
def star_inner_join(r: Retail) -> DataFrame:
    dates = r.dates().select("date_dim_hk", "year", "month")
    names = r.dimension("restaurant").select("restaurant_hk", F.col("name").alias("restaurant_name"))
    return (
        r.revenue_fact(restaurants=True)
        .join(F.broadcast(dates), F.col("order_date_dim_key") == F.col("date_dim_hk"))  # one row per calendar day
        .join(names, F.col("restaurant_dim_key") == F.col("restaurant_hk"))
        .select("order_id", "subtotal", "year", "month", "restaurant_name")
    )


@query(
    "join_cast_keys",
    f"""SELECT o.order_id, c.name FROM {S.ORDERS} o JOIN ({S.snapshot('customer', True)}) c
          ON CAST(o.customer_id_fk AS VARCHAR) = c.customer_id""",
)
def join_cast_keys(r: Retail) -> DataFrame:
    """Number on one side, text on the other: the fact side is cast."""
    named = r.snapshot("customer", second=True).select("customer_id", "name")
    return r.orders().join(named, F.col("customer_id_fk").cast("string") == F.col("customer_id")).select("order_id", "name")


@query(
    "join_on_date",
    f"""SELECT e.event_id, d.date_dim_hk AS order_date_key FROM {{events}} e
        LEFT JOIN (SELECT {S.date_key('day')} AS date_dim_hk, day FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM {{events}}))
          d ON CAST(e.ts AS DATE) = d.day""",
)
def join_on_date(r: Retail) -> DataFrame:
    days = r.table("events").select(F.to_date("ts").alias("day")).distinct().select("day", date_key("day").alias("order_date_key"))
    return r.table("events").withColumn("_d", F.to_date("ts")).join(days, F.col("_d") == F.col("day"), "left").select(
        "event_id", "order_date_key"
    )


USER_DIM = Dimension("user_dim", "user_hk", ("user_id",), ("event_type",))
HISTORY_SQL = """SELECT user_id, event_type, ts AS eff_start_date,
    lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS eff_end_date,
    lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current
  FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM {events})
  WHERE before IS DISTINCT FROM event_type"""


def user_history(r: Retail) -> DataFrame:
    """States of each user replayed from the event log."""
    return scd2_history(r.table("events"), ["user_id"], ["event_type"], "ts", "event_id")


query("scd2_history", HISTORY_SQL)(user_history)


def _asof_sql(history: str) -> str:
    """A version that ends where it starts was never valid; the first one also covers the time before it."""
    return f"""WITH h AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY eff_start_date, hk) AS no
          FROM (SELECT *, {S.hash_key('user_id', 'event_type', 'eff_start_date')} AS hk FROM ({history}))
          WHERE eff_end_date IS NULL OR eff_start_date < eff_end_date)
        SELECT e.event_id, e.user_id, e.probe_at, h.hk AS user_hk
        FROM (SELECT event_id, user_id, ts - INTERVAL 6 HOUR AS probe_at FROM {{events}}) e
        LEFT JOIN h ON h.user_id = e.user_id AND (h.no = 1 OR h.eff_start_date <= e.probe_at)
             AND (h.eff_end_date IS NULL OR e.probe_at < h.eff_end_date)"""


def _asof(r: Retail, history: DataFrame) -> DataFrame:
    dim = history.withColumn("user_hk", hash_key("user_id", "event_type", "eff_start_date"))
    probes = r.table("events").select("event_id", "user_id", (F.col("ts") - F.expr("INTERVAL '6' HOUR")).alias("probe_at"))
    return lookup_along_history(probes, dim, USER_DIM, "probe_at", "user_hk", "user_hk")


@query("dim_lookup_asof", _asof_sql(HISTORY_SQL))
def dim_lookup_asof(r: Retail) -> DataFrame:
    """The user state that was valid six hours before each event."""
    return _asof(r, user_history(r))


@query("dim_lookup_asof_ties", _asof_sql(HISTORY_SQL.replace("{events}", "(SELECT * REPLACE (date_trunc('day', ts) AS ts) FROM {events})")))
def dim_lookup_asof_ties(r: Retail) -> DataFrame:
    """The same from a log that knows the day only, so that many changes of a user have one time."""
    log = r.table("events").withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    return _asof(r, scd2_history(log, ["user_id"], ["event_type"], "ts", "event_id"))


# Keys and integrity ---------------------------------------------------------


@query(
    "hash_key",
    f"""SELECT customer_id, {S.hash_key('customer_id', 'name', 'email', 'gender', 'dob', 'preferences')} AS hk
        FROM ({S.snapshot('customer', True)})""",
)
def hash_key_query(r: Retail) -> DataFrame:
    rows = r.snapshot("customer", second=True)
    return rows.select("customer_id", hash_key("customer_id", "name", "email", "gender", "dob", "preferences").alias("hk"))


@query("date_hash_key", f"SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, {S.date_key('o_orderdate')} AS hk FROM {{orders}}")
def date_hash_key(r: Retail) -> DataFrame:
    return r.table("orders").select(F.to_date("o_orderdate").alias("day")).distinct().select("day", date_key("day").alias("hk"))


@query(
    "surrogate_key",
    f"""SELECT row_number() OVER (ORDER BY substr(sha1({S.key_text('o_orderkey')}), 1, 4), o_orderkey) AS order_sk,
          o_orderkey, o_orderstatus FROM {{orders}}""",
)
def surrogate_key_query(r: Retail) -> DataFrame:
    return surrogate_key(r.table("orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], "order_sk")


@query(
    "check_not_null",
    f"""WITH c AS ({S.snapshot('customer', True)})
        SELECT 'customer_id' AS "column", 'not_null' AS rule, count(*) FILTER (customer_id IS NULL) AS violations FROM c
        UNION ALL SELECT 'email', 'not_null', count(*) FILTER (email IS NULL) FROM c
        UNION ALL SELECT 'gender', 'not_null', count(*) FILTER (gender IS NULL) FROM c
        UNION ALL SELECT 'preferences', 'max_length_10', count(*) FILTER (length(preferences) > 10) FROM c""",
)
def check_not_null(r: Retail) -> DataFrame:
    rows = r.snapshot("customer", second=True)
    return column_violations(rows, ["customer_id", "email", "gender"], {"preferences": 10})


@query(
    "check_unique",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM {lineitem} GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def check_unique(r: Retail) -> DataFrame:
    return duplicate_keys(r.table("lineitem"), ["l_orderkey", "l_linenumber"])


def _orphan_sql(fk: str, parent: str, key: str) -> str:
    return f"""SELECT '{fk}' AS fk, count(*) AS orphan_rows, count(DISTINCT f.{fk}) AS orphan_keys FROM f
               WHERE f.{fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = f.{fk})"""


@query(
    "check_foreign_key",
    f"""WITH f AS (SELECT *, l_suppkey AS restaurant, l_partkey AS menu, l_orderkey AS placed FROM {{lineitem}})
        {_orphan_sql('restaurant', "(SELECT * FROM {supplier} WHERE s_acctbal > 0)", 's_suppkey')}
        UNION ALL {_orphan_sql('menu', "(SELECT * FROM {part} WHERE p_size < 50)", 'p_partkey')}
        UNION ALL {_orphan_sql('placed', '{orders}', 'o_orderkey')}""",
)
def check_foreign_key(r: Retail) -> DataFrame:
    """Lines against parents from which some rows are missing."""
    lines = r.table("lineitem").select(
        F.col("l_suppkey").alias("restaurant"), F.col("l_partkey").alias("menu"), F.col("l_orderkey").alias("placed")
    )
    return fact_plan.fact_orphans(
        lines,
        {
            "restaurant": (r.table("supplier").where("s_acctbal > 0"), "s_suppkey"),
            "menu": (r.table("part").where("p_size < 50"), "p_partkey"),
            "placed": (r.table("orders"), "o_orderkey"),
        },
    )


FACT_PARENTS = {
    "customer_dim_key": ("customer", "customer_hk"),
    "customer_address_dim_key": ("customer_address", "customer_address_hk"),
    "restaurant_dim_key": ("restaurant", "restaurant_hk"),
    "restaurant_location_dim_key": ("location", "restaurant_location_hk"),
    "menu_dim_key": ("menu", "menu_dim_hk"),
    "delivery_agent_dim_key": ("delivery_agent", "delivery_agent_hk"),
}


@query(
    "check_fact_foreign_keys",
    f"""WITH f AS (SELECT * FROM {S.FACT})
        {' UNION ALL '.join(_orphan_sql(fk, S.dimension(e), k) for fk, (e, k) in FACT_PARENTS.items())}
        UNION ALL {_orphan_sql('order_date_dim_key', S.DATES, 'date_dim_hk')}""",
)
def check_fact_foreign_keys(r: Retail) -> DataFrame:
    """The seven references of the fact; none may be broken."""
    parents = {fk: (r.dimension(e), k) for fk, (e, k) in FACT_PARENTS.items()}
    return fact_plan.fact_orphans(r.fact(), {**parents, "order_date_dim_key": (r.dates(), "date_dim_hk")})


# Classification and masks ---------------------------------------------------

CUSTOMER_TAGS = {"mobile": "PII", "email": "EMAIL", "gender": "PII", "dob": "PII"}


@query(
    "tag_report",
    f"""WITH c AS ({S.snapshot('customer', True)})
        {' UNION ALL '.join(f"SELECT '{c}' AS column_name, '{t}' AS tag, count({c}) AS filled_rows FROM c" for c, t in CUSTOMER_TAGS.items())}""",
)
def tag_report(r: Retail) -> DataFrame:
    """Tagged columns and how many rows hold a value in them."""
    rows = masking.tag_columns(r.snapshot("customer", second=True), CUSTOMER_TAGS)
    tags = masking.tagged_columns(rows)
    counts = rows.agg(*[F.count(c).alias(c) for c in tags])
    report = [
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("tag"), F.col(c).alias("filled_rows")) for c, t in tags.items()
    ]
    return counts.select(F.inline(F.array(*report)))


def _masked(r: Retail, tags: dict[str, str], columns: list[str]) -> DataFrame:
    rows = masking.tag_columns(r.snapshot("customer", second=True), tags)
    return masking.mask_tagged(rows).select(*columns)


query(
    "mask_pii",
    f"SELECT customer_id, '** PII **' AS gender, '** PII **' AS dob, email FROM ({S.snapshot('customer', True)})",
)(lambda r: _masked(r, {"gender": "PII", "dob": "PII"}, ["customer_id", "gender", "dob", "email"]))
query("mask_email", f"SELECT customer_id, '** EMAIL **' AS email FROM ({S.snapshot('customer', True)})")(
    lambda r: _masked(r, {"email": "EMAIL"}, ["customer_id", "email"])
)
query("mask_phone", f"SELECT customer_id, '** Phone **' AS mobile FROM ({S.snapshot('customer', True)})")(
    lambda r: _masked(r, {"mobile": "SENSITIVE"}, ["customer_id", "mobile"])
)


@query(
    "stream_counts",
    """SELECT 'orders' AS table_name, count(*) AS n_rows FROM {orders} UNION ALL SELECT 'lineitem', count(*) FROM {lineitem}
       UNION ALL SELECT 'customer', count(*) FROM {customer}""",
)
def stream_counts(r: Retail) -> DataFrame:
    return row_counts({t: r.table(t) for t in ("orders", "lineitem", "customer")})
