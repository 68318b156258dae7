"""Change sets, upserts and versioned dimensions on the retail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.change_set import change_set
from larder.operators.dedupe import latest_per_key
from larder.operators.merge import insert_select, merge_upsert
from larder.operators.scd2 import FIRST, current_rows
from larder.operators.surrogate import surrogate_key
from larder.plans import fact as fact_plan
from larder.plans.fact import changed_lines_with_orders
from larder.plans.retail import Retail
from larder.registry import sqltext as S
from larder.registry.base import query

# Two states of the orders table. In the later one new orders have arrived,
# open orders have been repriced and given a priority, some have lost it, and
# cancelled ones are gone.
OLD_ORDERS = """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderdate,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN CAST(NULL AS STRING) ELSE o_orderpriority END AS o_orderpriority
FROM {orders} WHERE o_orderdate < DATE '2000-01-01'"""
NEW_ORDERS = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderstatus = 'O' THEN 10.00 ELSE 0.00 END AS DECIMAL(18,2)) AS o_totalprice,
  o_orderdate, CASE WHEN o_orderpriority = '3-MEDIUM' THEN CAST(NULL AS STRING) ELSE o_orderpriority END AS o_orderpriority
FROM {orders} WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')"""
KEY = ["o_orderkey"]
COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def old_new(r: Retail) -> tuple[DataFrame, DataFrame]:
    return r.sql(OLD_ORDERS), r.sql(NEW_ORDERS)


def _cols(alias: str, replace: dict[str, str] | None = None) -> str:
    swap = replace or {}
    out = []
    for c in COLS:
        e = swap.get(c, f"{alias}.{c}")
        out.append(f"CAST({e} AS DOUBLE) AS {c}" if c == "o_totalprice" else f"{e} AS {c}")
    return ", ".join(out)


SAME = " AND ".join(f"o.{c} IS NOT DISTINCT FROM n.{c}" for c in COLS)
CHANGES_SQL = f"""WITH o AS ({OLD_ORDERS}), n AS ({NEW_ORDERS})
  SELECT {_cols('o')}, 'DELETE' AS _action, n.o_orderkey IS NOT NULL AS _is_update
  FROM o LEFT JOIN n ON o.o_orderkey = n.o_orderkey WHERE n.o_orderkey IS NULL OR NOT ({SAME})
  UNION ALL
  SELECT {_cols('n')}, 'INSERT', o.o_orderkey IS NOT NULL
  FROM n LEFT JOIN o ON o.o_orderkey = n.o_orderkey WHERE o.o_orderkey IS NULL OR NOT ({SAME})"""


@query("cdc_change_set", CHANGES_SQL)
def cdc_change_set(r: Retail) -> DataFrame:
    old, new = old_new(r)
    return change_set(old, new, KEY)


@query(
    "stream_join_check",
    f"""WITH o AS ({OLD_ORDERS}), n AS ({NEW_ORDERS}),
          changed AS (SELECT coalesce(o.o_orderkey, n.o_orderkey) AS order_id,
                        CASE WHEN o.o_orderkey IS NULL OR n.o_orderkey IS NULL THEN 1 ELSE 2 END AS times
                      FROM o FULL JOIN n ON o.o_orderkey = n.o_orderkey
                      WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR NOT ({SAME})),
          lines AS (SELECT l_orderkey, CAST(sum(CASE l_linenumber WHEN 1 THEN 2 ELSE 1 END) AS BIGINT) AS times
                    FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM {{lineitem}}) WHERE l_linenumber <= 3 GROUP BY l_orderkey)
        SELECT l_orderkey AS order_id_fk, order_id, lines.times * changed.times AS matches
        FROM lines JOIN changed ON l_orderkey = order_id""",
)
def stream_join_check(r: Retail) -> DataFrame:
    """Changed lines against changed orders: first lines were updated, second ones deleted, third ones added."""
    old, new = old_new(r)
    orders = change_set(old, new, KEY).select(F.col("o_orderkey").alias("order_id"))
    # A few line numbers occur twice in an order; a change set needs one row for each key.
    lines = r.table("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").alias("l_quantity"))
    later = F.when(F.col("l_linenumber") == 1, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    before, after = lines.where("l_linenumber <> 3"), lines.where("l_linenumber <> 2").withColumn("l_quantity", later)
    items = change_set(before, after, ["l_orderkey", "l_linenumber"]).withColumnRenamed("l_orderkey", "order_id_fk")
    return changed_lines_with_orders(items, orders).withColumnRenamed("n", "matches")


# Upserts --------------------------------------------------------------------


def _merge_sql(updated: dict[str, str], when: str = "true") -> str:
    """Full outer form of an upsert; ``updated`` maps column -> new expression."""
    swap = {
        c: f"CASE WHEN o.o_orderkey IS NULL THEN n.{c} WHEN n.o_orderkey IS NOT NULL AND ({when}) THEN {updated.get(c, 'o.' + c)} ELSE o.{c} END"
        for c in COLS
    }
    swap["o_orderkey"] = "coalesce(o.o_orderkey, n.o_orderkey)"
    return f"""WITH o AS ({OLD_ORDERS}), n AS ({NEW_ORDERS})
      SELECT {_cols('o', swap)} FROM o FULL JOIN n ON o.o_orderkey = n.o_orderkey"""


ALL_NEW = {c: f"n.{c}" for c in COLS}


@query("merge_upsert", _merge_sql(ALL_NEW))
def merge_all(r: Retail) -> DataFrame:
    old, new = old_new(r)
    return merge_upsert(old, new, KEY)


@query("merge_upsert_small_source", _merge_sql(ALL_NEW))
def merge_small(r: Retail) -> DataFrame:
    """The same result on the path for small batches, as long as the new orders are one."""
    old, new = old_new(r)
    return merge_upsert(old, new, KEY, small_source=True)


@query("merge_changed_only", _merge_sql(ALL_NEW, "o.o_orderpriority IS DISTINCT FROM n.o_orderpriority"))
def merge_changed_only(r: Retail) -> DataFrame:
    """Matched rows only take the new values when their priority changed, to or from NULL included."""
    old, new = old_new(r)
    return merge_upsert(old, new, KEY, changed_on=["o_orderpriority"])


@query("merge_subset_update", _merge_sql({c: f"n.{c}" for c in ("o_totalprice", "o_orderstatus")}))
def merge_subset_update(r: Retail) -> DataFrame:
    """Price and status follow the source, everything else keeps its first value."""
    old, new = old_new(r)
    return merge_upsert(old, new, KEY, update_cols=["o_totalprice", "o_orderstatus"])


OLD_LINES = """SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_quantity FROM {lineitem}
  WHERE l_shipdate < TIMESTAMP '2000-01-01'"""
NEW_LINES = """SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'X' AS l_returnflag, l_quantity + 1 AS l_quantity
  FROM {lineitem} WHERE l_linestatus = 'F'"""
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_ON = " AND ".join(f"o.{k} = n.{k}" for k in LINE_KEY)


@query(
    "merge_composite_key",
    f"""WITH o AS ({OLD_LINES}), n AS ({NEW_LINES})
        SELECT {', '.join(f'coalesce(o.{k}, n.{k}) AS {k}' for k in LINE_KEY)},
          coalesce(n.l_returnflag, o.l_returnflag) AS l_returnflag, coalesce(n.l_quantity, o.l_quantity) AS l_quantity
        FROM o FULL JOIN n ON {LINE_ON}""",
)
def merge_composite_key(r: Retail) -> DataFrame:
    return merge_upsert(r.sql(OLD_LINES), r.sql(NEW_LINES), LINE_KEY)


@query(
    "latest_per_key",
    """SELECT user_id, event_id, ts, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM {events}) WHERE rn = 1""",
)
def latest_per_user(r: Retail) -> DataFrame:
    rows = r.table("events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_per_key(rows, ["user_id"], ["ts", "event_id"])


@query(
    "insert_select",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id_fk, CAST(o_totalprice AS DOUBLE) AS total_amount,
         o_orderdate AS order_date FROM {orders}""",
)
def insert_select_query(r: Retail) -> DataFrame:
    """Older orders are in the table already, newer ones arrive as text."""
    target = r.sql(
        """SELECT o_orderkey AS order_id, o_custkey AS customer_id_fk, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
             o_orderdate AS order_date FROM {orders} WHERE o_orderdate < DATE '1998-01-01'"""
    )
    arrived = r.sql(
        """SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id_fk,
             CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS total_amount, CAST(o_orderdate AS STRING) AS order_date
           FROM {orders} WHERE o_orderdate >= DATE '1998-01-01'"""
    )
    return insert_select(target, arrived)


@query(
    "fact_merge",
    f"""WITH o AS (SELECT i.order_item_id, i.order_id_fk AS order_id, i.subtotal, 'Pending' AS delivery_status
                   FROM {S.ITEMS} i JOIN {S.ORDERS} d ON i.order_id_fk = d.order_id WHERE d.order_date < TIMESTAMP '2000-01-01'),
             n AS (SELECT i.order_item_id, i.order_id_fk AS order_id, i.subtotal + 1.00 AS subtotal, v.delivery_status
                   FROM {S.ITEMS} i JOIN {S.DELIVERIES} v ON i.order_id_fk = v.order_id_fk WHERE v.delivery_status = 'Delivered'),
             numbered AS (SELECT *, row_number() OVER (
                   ORDER BY substr(sha1({S.key_text('order_item_id', 'order_id')}), 1, 4), order_item_id, order_id) AS sk FROM o),
             fresh AS (SELECT order_item_id, order_id, (SELECT count(*) FROM o) + row_number() OVER (
                   ORDER BY substr(sha1({S.key_text('order_item_id', 'order_id')}), 1, 4), order_item_id, order_id) AS sk
                   FROM n ANTI JOIN o USING (order_item_id, order_id))
        SELECT coalesce(o.sk, f.sk) AS order_item_fact_sk, coalesce(o.order_item_id, n.order_item_id) AS order_item_id,
          coalesce(o.order_id, n.order_id) AS order_id, CAST(coalesce(n.subtotal, o.subtotal) AS DOUBLE) AS subtotal,
          coalesce(n.delivery_status, o.delivery_status) AS delivery_status
        FROM numbered o FULL JOIN n ON o.order_item_id = n.order_item_id AND o.order_id = n.order_id
          LEFT JOIN fresh f ON f.order_item_id = n.order_item_id AND f.order_id = n.order_id""",
)
def fact_merge(r: Retail) -> DataFrame:
    """Known fact rows keep their number, delivered ones are updated, new ones are numbered after them."""
    items, orders, deliveries = r.items(), r.orders(), r.deliveries()
    cols = ["order_item_id", F.col("order_id_fk").alias("order_id"), "subtotal"]
    before = orders.where(F.col("order_date") < F.lit("2000-01-01").cast("timestamp_ntz")).select(F.col("order_id").alias("order_id_fk"))
    known = items.join(before, "order_id_fk").select(*cols, F.lit("Pending").alias("delivery_status"))
    done = deliveries.where("delivery_status = 'Delivered'").select("order_id_fk", "delivery_status")
    changed = items.withColumn("subtotal", (F.col("subtotal") + F.lit("1.00").cast("decimal(18,2)")).cast("decimal(18,2)"))
    rows = changed.join(done, "order_id_fk").select(*cols, "delivery_status")
    table = surrogate_key(known, fact_plan.FACT_KEYS, "order_item_fact_sk")
    return fact_plan.merge_fact(table, rows, start_after=table.agg(F.max("order_item_fact_sk")).first()[0] or 0)


# Dimensions -----------------------------------------------------------------


def _dim_sql(entity: str, text: str | None = None) -> str:
    money = {"restaurant": ["pricing_for_two", "latitude", "longitude"], "menu": ["price"], "delivery_agent": ["rating"]}
    swap = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in money.get(entity, []))
    return f"SELECT * {f'REPLACE ({swap})' if swap else ''} FROM {text or S.dimension(entity, late_rows=True)}"


def _dim(entity: str):
    return lambda r: r.dimension(entity, late_rows=True).drop(FIRST)


for _name, _entity in {
    "scd2_location": "location",
    "scd2_restaurant": "restaurant",
    "scd2_customer": "customer",
    "scd2_address": "customer_address",
    "scd2_menu": "menu",
    "scd2_agent": "delivery_agent",
}.items():
    query(_name, _dim_sql(_entity))(_dim(_entity))

query("scd2_current", f"{_dim_sql('customer')} WHERE is_current")(
    lambda r: current_rows(_dim("customer")(r), r.role("customer"))
)

query("scd2_as_written", _dim_sql("location", S.as_written("location")))(lambda r: r.as_written("location"))
query("scd2_revert", _dim_sql("restaurant", S.reverted("restaurant")))(lambda r: r.reverted("restaurant"))
