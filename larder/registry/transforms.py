"""Casts, parses, value maps and other column work on the retail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import casts
from larder.functions import mapping as M
from larder.functions.dates import date_parts
from larder.functions.keys import concat_columns
from larder.plans.retail import Retail
from larder.registry import sqltext as S
from larder.registry.base import query

# Text columns as source files would hold them, some of them broken on purpose.
NUMBER_TEXT = """SELECT o_orderkey AS order_id,
  CASE o_orderstatus WHEN 'F' THEN ' ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) || ' '
       WHEN 'O' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 'N/A' WHEN o_orderpriority = '2-HIGH' THEN '' ELSE CAST(o_orderkey AS STRING) END
       ELSE CAST(CAST(o_totalprice / 1000 AS DECIMAL(18,1)) AS STRING) END AS amount_text
FROM {orders}"""

GOOD_TEXT = """SELECT CAST(o_orderkey AS STRING) AS orderid, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS totalamount,
  substr(CAST(o_orderdate AS STRING), 1, 10) AS orderday
FROM {orders}"""

DATE_TEXT = """SELECT event_id,
  CASE event_type WHEN 'click' THEN '2024-13-40' WHEN 'view' THEN 'soon' WHEN 'error' THEN CAST(NULL AS STRING)
       ELSE substr(CAST(ts AS STRING), 1, 10) END AS day_text
FROM {events}"""

TIME_TEXT = """SELECT event_id,
  CASE event_type WHEN 'click' THEN CAST(ts AS STRING) WHEN 'view' THEN replace(CAST(ts AS STRING), ' ', 'T')
       WHEN 'purchase' THEN substr(CAST(ts AS STRING), 1, 19) WHEN 'signup' THEN 'soon'
       ELSE CAST(NULL AS STRING) END AS time_text
FROM {events}"""

STRICT_TIME_TEXT = "SELECT event_id, substr(CAST(ts AS STRING), 1, 19) AS time_text FROM {events}"


def _case(column: str, values) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {column} {arms} END"


# Customers placed in the states and cities that the place rules know, and some that they do not.
PLACES = f"""SELECT c_custkey,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN 'Elsewhere' ELSE {_case('c_nationkey', M.STATE_CODES)} END AS state,
  CASE WHEN c_acctbal < 0 THEN 'Smallville' WHEN c_acctbal > 5000 AND c_nationkey = 0 THEN 'New Delhi'
       WHEN c_acctbal > 5000 AND c_nationkey = 1 THEN 'Mumbai' ELSE {_case('c_nationkey', M.TIER_1 + M.TIER_2)} END AS city
FROM {{customer}}"""


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


@query(
    "strict_cast",
    f"""SELECT CAST(orderid AS BIGINT) AS order_id, CAST(CAST(totalamount AS DECIMAL(18,2)) AS DOUBLE) AS total_amount,
          CAST(orderday AS DATE) AS order_day FROM ({GOOD_TEXT})""",
)
def strict_cast(r: Retail) -> DataFrame:
    return r.sql(GOOD_TEXT).select(
        casts.strict("orderid", "bigint").alias("order_id"),
        casts.strict("totalamount", "decimal(18,2)").alias("total_amount"),
        casts.strict("orderday", "date").alias("order_day"),
    )


@query(
    "try_cast_number",
    f"""SELECT order_id, TRY_CAST(TRY_CAST(trim(amount_text) AS DECIMAL(38,0)) AS BIGINT) AS whole,
          CAST(TRY_CAST(trim(amount_text) AS DECIMAL(10,2)) AS DOUBLE) AS money,
          CAST(TRY_CAST(trim(amount_text) AS DECIMAL(4,2)) AS DOUBLE) AS rating FROM ({NUMBER_TEXT})""",
)
def try_cast_number(r: Retail) -> DataFrame:
    return r.sql(NUMBER_TEXT).select(
        "order_id",
        casts.try_long("amount_text").alias("whole"),
        casts.try_decimal("amount_text", 10, 2).alias("money"),
        casts.try_decimal("amount_text", 4, 2).alias("rating"),
    )


@query("try_to_date", f"SELECT event_id, CAST(try_strptime(day_text, '%Y-%m-%d') AS DATE) AS day FROM ({DATE_TEXT})")
def try_to_date(r: Retail) -> DataFrame:
    return r.sql(DATE_TEXT).select("event_id", casts.try_date("day_text").alias("day"))


@query(
    "try_to_timestamp",
    f"""SELECT event_id, try_strptime(time_text, '%Y-%m-%dT%H:%M:%S.%f') AS t_fraction,
          try_strptime(time_text, '%Y-%m-%d %H:%M:%S') AS plain_time FROM ({TIME_TEXT})""",
)
def try_to_timestamp(r: Retail) -> DataFrame:
    return r.sql(TIME_TEXT).select(
        "event_id",
        casts.try_timestamp("time_text", casts.TS_T_FRACTION).cast("timestamp_ntz").alias("t_fraction"),
        casts.try_timestamp("time_text", casts.TS_SPACE).cast("timestamp_ntz").alias("plain_time"),
    )


@query(
    "try_to_timestamp_auto",
    f"""SELECT event_id, try_strptime(time_text, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S.%f', '%Y-%m-%d %H:%M:%S.%f'])
          AS event_time FROM ({TIME_TEXT})""",
)
def try_to_timestamp_auto(r: Retail) -> DataFrame:
    return r.sql(TIME_TEXT).select(
        "event_id", casts.try_timestamp("time_text").cast("timestamp_ntz").alias("event_time")
    )


@query("to_timestamp_strict", f"SELECT event_id, strptime(time_text, '%Y-%m-%d %H:%M:%S') AS event_time FROM ({STRICT_TIME_TEXT})")
def to_timestamp_strict(r: Retail) -> DataFrame:
    return r.sql(STRICT_TIME_TEXT).select(
        "event_id", casts.strict_timestamp("time_text").cast("timestamp_ntz").alias("event_time")
    )


@query(
    "case_value_map",
    f"""SELECT c_custkey, CASE WHEN p.state = 'Delhi' THEN 'New Delhi' ELSE p.state END AS state,
          coalesce(k.code, 'xx') AS state_code
        FROM ({PLACES}) p LEFT JOIN (VALUES {', '.join(f"('{s}', '{c}')" for s, c in M.STATE_CODES.items())}) AS k(state, code)
          ON p.state = k.state""",
)
def case_value_map(r: Retail) -> DataFrame:
    state = F.col("state")
    return r.sql(PLACES).select("c_custkey", M.state_name(state).alias("state"), M.state_code(state).alias("state_code"))


@query(
    "case_membership",
    f"SELECT c_custkey, state, state IN ({_quoted(M.UNION_TERRITORIES)}) AS is_union_territory FROM ({PLACES})",
)
def case_membership(r: Retail) -> DataFrame:
    return r.sql(PLACES).select("c_custkey", "state", M.union_territory(F.col("state")).alias("is_union_territory"))


@query(
    "case_compound",
    f"""SELECT c_custkey, state, city, (state = 'Delhi' AND city = 'New Delhi') OR (state = 'Maharashtra' AND city = 'Mumbai')
          AS capital_city_flag FROM ({PLACES})""",
)
def case_compound(r: Retail) -> DataFrame:
    return r.sql(PLACES).select(
        "c_custkey", "state", "city", M.capital_city(F.col("state"), F.col("city")).alias("capital_city_flag")
    )


@query(
    "tier_bucket",
    f"""SELECT c_custkey, city, CASE WHEN city IN ({_quoted(M.TIER_1)}) THEN 'Tier-1'
          WHEN city IN ({_quoted(M.TIER_2)}) THEN 'Tier-2' ELSE 'Tier-3' END AS city_tier FROM ({PLACES})""",
)
def tier_bucket(r: Retail) -> DataFrame:
    return r.sql(PLACES).select("c_custkey", "city", M.city_tier(F.col("city")).alias("city_tier"))


FLAG_TEXT = """SELECT o_orderkey AS order_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'TRUE' WHEN '2-HIGH' THEN 'False'
  WHEN '3-MEDIUM' THEN 'maybe' WHEN '5-LOW' THEN 'true' ELSE CAST(NULL AS STRING) END AS flag_text FROM {orders}"""


@query(
    "parse_boolean",
    f"""SELECT order_id, CASE lower(flag_text) WHEN 'true' THEN true WHEN 'false' THEN false ELSE NULL END AS flag
        FROM ({FLAG_TEXT})""",
)
def parse_boolean(r: Retail) -> DataFrame:
    return r.sql(FLAG_TEXT).select("order_id", casts.parse_boolean("flag_text").alias("flag"))


PADDED = "SELECT p_partkey, '  ' || upper(p_name) || ' ' AS padded FROM {part}"


@query("trim_lower", f"SELECT p_partkey, trim(padded) AS trimmed, lower(trim(padded)) AS lowered FROM ({PADDED})")
def trim_lower(r: Retail) -> DataFrame:
    return r.sql(PADDED).select("p_partkey", F.trim("padded").alias("trimmed"), F.lower(F.trim("padded")).alias("lowered"))


@query(
    "concat_columns",
    f"""SELECT customer_id, customer_id || name || email || CAST(dob AS VARCHAR) || preferences AS joined
        FROM ({S.snapshot('customer', True)})""",
)
def concat_query(r: Retail) -> DataFrame:
    """NULL as soon as one part is NULL."""
    rows = r.snapshot("customer", second=True)
    return rows.select("customer_id", concat_columns("customer_id", "name", "email", "dob", "preferences").alias("joined"))


@query("sha1_hex", "SELECT o_orderkey AS order_id, sha1(CAST(o_orderkey AS VARCHAR) || o_orderpriority) AS digest FROM {orders}")
def sha1_hex(r: Retail) -> DataFrame:
    return r.table("orders").select(
        F.col("o_orderkey").alias("order_id"), F.sha1(concat_columns("o_orderkey", "o_orderpriority")).alias("digest")
    )


@query("date_parts", f"SELECT o_orderkey AS order_id, {S.date_parts('o_orderdate')} FROM {{orders}}")
def date_parts_query(r: Retail) -> DataFrame:
    day = F.to_date("o_orderdate")
    return r.table("orders").select(
        F.col("o_orderkey").alias("order_id"), *[c.alias(n) for n, c in date_parts(day).items()]
    )


@query(
    "date_arith",
    """SELECT event_id, CAST(ts AS DATE) AS day, CAST(CAST(ts AS DATE) - INTERVAL 1 DAY AS DATE) AS day_before,
         ts - INTERVAL 1 HOUR AS hour_before, ts - INTERVAL 4 DAY AS four_days_before FROM {events}""",
)
def date_arith(r: Retail) -> DataFrame:
    day = F.to_date("ts")
    return r.table("events").select(
        "event_id",
        day.alias("day"),
        F.date_add(day, -1).alias("day_before"),
        (F.col("ts") - F.expr("INTERVAL '1' HOUR")).alias("hour_before"),
        (F.col("ts") - F.expr("INTERVAL '4' DAY")).alias("four_days_before"),
    )


@query(
    "round_ratio",
    f"""SELECT o_custkey, {S.ratio('sum(CAST(o_totalprice AS DECIMAL(18,2)))', 'count(*)')} AS avg_order
        FROM {{orders}} GROUP BY o_custkey""",
)
def round_ratio(r: Retail) -> DataFrame:
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)"))
    return r.table("orders").groupBy("o_custkey").agg(casts.round_ratio(total, F.count(F.lit(1))).alias("avg_order"))


@query(
    "cast_round_integer",
    """SELECT o_orderkey AS order_id, CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,0)) AS BIGINT) AS whole
       FROM {orders}""",
)
def cast_round_integer(r: Retail) -> DataFrame:
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    return r.table("orders").select(F.col("o_orderkey").alias("order_id"), casts.whole_units(amount).cast("bigint").alias("whole"))


@query(
    "filter_predicates",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
       WHERE l_returnflag = 'A' AND l_linestatus != 'F' AND l_shipdate >= TIMESTAMP '1998-01-01' AND p_name LIKE '%ring%'""",
)
def filter_predicates(r: Retail) -> DataFrame:
    lines = r.table("lineitem").where(
        (F.col("l_returnflag") == "A")
        & (F.col("l_linestatus") != "F")
        & (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    )
    parts = r.table("part").where(F.col("p_name").like("%ring%")).select("p_partkey")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )


@query(
    "project_alias",
    """SELECT o_orderkey AS order_id, CAST(year(o_orderdate) AS INT) AS order_year, CAST(year(o_orderdate) AS INT) - 1 AS prior_year,
         o_orderstatus AS status FROM {orders}""",
)
def project_alias(r: Retail) -> DataFrame:
    named = r.table("orders").select(
        F.col("o_orderkey").alias("order_id"), F.year("o_orderdate").alias("order_year"), F.col("o_orderstatus").alias("status")
    )
    return named.withColumn("prior_year", F.col("order_year") - 1)
