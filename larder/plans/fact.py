"""The order item fact: lines with the keys of the dimension versions they met."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.casts import whole_units
from larder.operators.dedupe import latest_per_key
from larder.operators.lookup import lookup, match_audit, orphans
from larder.operators.merge import merge_upsert
from larder.operators.scd2 import Dimension
from larder.operators.surrogate import surrogate_key

FACT_KEYS = ("order_item_id", "order_id")
FACT_COLUMNS = (
    "order_item_id",
    "order_id",
    "customer_dim_key",
    "customer_address_dim_key",
    "restaurant_dim_key",
    "restaurant_location_dim_key",
    "menu_dim_key",
    "delivery_agent_dim_key",
    "order_date_dim_key",
    "quantity",
    "price",
    "subtotal",
    "delivery_status",
    "estimated_time",
)
MEASURES = ("quantity", "price", "subtotal")


@dataclass(frozen=True)
class Lookup:
    """A dimension and the column that refers to it.

    ``by`` names the referring column, ``out`` the fact's key column; ``carry``
    brings further dimension columns along for later lookups. ``small`` expects a
    dimension that can be broadcast, and measures it.
    """

    table: DataFrame
    dim: Dimension
    by: str
    out: str
    carry: tuple[str, ...] = ()
    small: bool = False


def _attach(df: DataFrame, item: Lookup, current_only: bool) -> DataFrame:
    take = {item.dim.hash_key: item.out} | {c: c for c in item.carry}
    at = None if current_only else F.col("order_date").cast("timestamp_ntz")
    return lookup(df.drop(*item.carry), item.table, item.dim, F.col(item.by), take, at, item.small)


def latest_delivery(deliveries: DataFrame) -> DataFrame:
    """One delivery per order: reassignment leaves several, the last one counts."""
    order = [c for c in ("modified_date", "delivery_date", "delivery_id") if c in deliveries.columns]
    return latest_per_key(deliveries, ["order_id_fk"], order)


def order_headers(
    orders: DataFrame,
    deliveries: DataFrame,
    dates: DataFrame,
    lookups: tuple[Lookup, ...] = (),
    current_only: bool = False,
) -> DataFrame:
    """Orders with delivery, date key and every lookup that hangs off the order.

    There are several lines per order, so resolving these keys once per order
    moves a fraction of the bytes that resolving them per line would.
    """
    wanted = [c for c in (
        "order_id_fk", "delivery_agent_id_fk", "delivery_status", "estimated_time", "customer_address_id_fk",
        "modified_date", "delivery_date", "delivery_id") if c in deliveries.columns]
    latest = latest_delivery(deliveries.select(*wanted)).drop("modified_date", "delivery_date", "delivery_id")
    # One row per calendar day: a bound that does not grow with the orders.
    days = F.broadcast(dates.select("calendar_date", F.col("date_dim_hk").alias("order_date_dim_key")))
    rows = orders.join(latest, F.col("order_id") == F.col("order_id_fk"), "left").drop("order_id_fk")
    for item in lookups:
        rows = _attach(rows, item, current_only)
    # Last, so that its keys are not shuffled by the lookups.
    dated = rows.withColumn("_day", F.to_date("order_date")).join(days, F.col("_day") == F.col("calendar_date"), "left")
    return dated.drop("_day", "calendar_date")


def order_item_fact(
    items: DataFrame,
    headers: DataFrame,
    lookups: tuple[Lookup, ...] = (),
    current_only: bool = False,
    columns: Sequence[str] = FACT_COLUMNS,
) -> DataFrame:
    """One row per order line: its header's keys plus the lookups of the line itself.

    A report that needs fewer ``columns`` names them; one that nothing provides is an error.
    """
    head = headers.drop(*[c for c in headers.columns if c in items.columns and c != "order_id"])
    rows = items.join(head, F.col("order_id_fk") == F.col("order_id"), "left").drop("order_id")
    for item in lookups:
        rows = _attach(rows, item, current_only)
    rows = rows.withColumnRenamed("order_id_fk", "order_id").withColumn("quantity", whole_units(F.col("quantity")).cast("bigint"))
    missing = [c for c in columns if c not in rows.columns]
    if missing:
        raise ValueError(f"no lookup or column gives {', '.join(missing)}")
    return rows.select(*columns)


def merge_fact(target: DataFrame, rows: DataFrame, start_after: int | None = None) -> DataFrame:
    """Upsert assembled rows on (order_item_id, order_id); the surrogate key of a known row stays.

    With ``start_after``, the highest number given so far, new rows are numbered from there on.
    """
    if start_after is None:
        return merge_upsert(target, rows, FACT_KEYS)
    fresh = rows.select(*FACT_KEYS).join(target.select(*FACT_KEYS), list(FACT_KEYS), "left_anti")
    numbered = rows.join(surrogate_key(fresh, FACT_KEYS, "order_item_fact_sk", start_after), list(FACT_KEYS), "left")
    body = [c for c in rows.columns if c not in FACT_KEYS]
    return merge_upsert(target, numbered, FACT_KEYS, update_cols=body, insert_cols=[*body, "order_item_fact_sk"])


def fact_orphans(fact: DataFrame, parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows of each dimension key column without a matching dimension row."""
    return orphans(fact, dict(parents))


def changed_lines_with_orders(item_changes: DataFrame, order_changes: DataFrame) -> DataFrame:
    """Orders with changed lines that changed in the same batch themselves, with the number of matching rows."""
    return match_audit(item_changes, order_changes, [("order_id_fk", "order_id")])
