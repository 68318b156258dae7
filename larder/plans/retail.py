"""Entities bound from retail tables (orders, lineitem, part, customer, ...).

The bindings are plain SELECTs that name tables in braces. They use only
functions that mean the same in every SQL engine, so the same text serves as
the input definition of a cross-check.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from larder import schemas
from larder.functions.keys import hash_key
from larder.operators.change_set import change_set
from larder.operators.scd2 import Dimension, apply_rows, apply_scd2, open_versions
from larder.plans import fact as fact_plan
from larder.plans.date_dim import date_dim

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# The two load times of the dimensions, some orders are older than both, and the last calendar day.
FIRST_LOAD = datetime(1996, 1, 1)
SECOND_LOAD = datetime(1998, 1, 1)
THIRD_LOAD = datetime(2000, 1, 1)
AS_OF = date(2001, 12, 31)
REVENUE_COLUMNS = ("order_item_id", "order_id", "order_date_dim_key", "quantity", "price", "subtotal", "delivery_status")

# Per entity: the SELECT, the condition of rows that change with the second
# load ({changed} stands for it in the SELECT) and of rows that only arrive then.
SNAPSHOTS: dict[str, tuple[str, str, str]] = {
    "location": (
        """SELECT CAST(n.n_nationkey AS BIGINT) AS location_id, n.n_name AS city, r.r_name AS state, 'xx' AS state_code,
                  false AS is_union_territory, false AS capital_city_flag, 'Tier-3' AS city_tier,
                  CASE WHEN {changed} THEN 'Z9' ELSE 'Z1' END AS zip_code, 'Yes' AS active_flag
           FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey WHERE {rows}""",
        "r.r_name = 'ASIA'",
        "r.r_name = 'EUROPE'",
    ),
    "restaurant": (
        """SELECT s_suppkey AS restaurant_id, s_name AS name, CAST(NULL AS STRING) AS cuisine_type,
                  CAST(s_acctbal AS DECIMAL(10,2)) AS pricing_for_two, '9000000000' AS restaurant_phone,
                  '10:00-22:00' AS operating_hours, CAST(s_nationkey AS BIGINT) AS location_id_fk, 'Yes' AS active_flag,
                  CASE WHEN {changed} THEN 'Closed' ELSE 'Open' END AS open_status,
                  CASE WHEN {changed} THEN 'High Street' ELSE CAST(NULL AS STRING) END AS locality,
                  'Main Road' AS restaurant_address,
                  CAST(12.5 AS DECIMAL(9,6)) AS latitude, CAST(77.25 AS DECIMAL(9,6)) AS longitude
           FROM {supplier} WHERE {rows}""",
        "s_acctbal < 3000",
        "s_acctbal > 9000",
    ),
    "customer": (
        """SELECT CAST(c_custkey AS STRING) AS customer_id, c_name AS name, '9000000000' AS mobile,
                  CASE WHEN c_acctbal < 1000 THEN CAST(NULL AS STRING) ELSE c_name || '@example.org' END AS email,
                  'app' AS login_by_using, CAST(NULL AS STRING) AS gender, DATE '1980-01-31' AS dob,
                  CAST(NULL AS DATE) AS anniversary,
                  CASE WHEN {changed} THEN c_mktsegment || ' PLUS' ELSE c_mktsegment END AS preferences
           FROM {customer} WHERE {rows}""",
        "c_acctbal > 5000",
        "c_acctbal < 0",
    ),
    "customer_address": (
        """SELECT c_custkey AS address_id, c_custkey AS customer_id_fk, CAST(NULL AS STRING) AS flat_no, '1' AS house_no,
                  'G' AS floor, 'Block' AS building, CAST(NULL AS STRING) AS landmark,
                  CASE WHEN {changed} THEN 'New Town' ELSE CAST(NULL AS STRING) END AS locality,
                  n_name AS city, 'State' AS state, '110001' AS pincode, '0,0' AS coordinates, 'Yes' AS primary_flag,
                  'Home' AS address_type
           FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey WHERE {rows}""",
        "c_mktsegment = 'FURNITURE'",
        "c_acctbal < 0",
    ),
    "menu": (
        """SELECT p_partkey AS menu_id, CAST(NULL AS BIGINT) AS restaurant_id_fk, p_name AS item_name, p_brand AS description,
                  CAST(CAST(p_retailprice AS DECIMAL(10,2)) + CASE WHEN {changed} THEN 1.50 ELSE 0.00 END AS DECIMAL(10,2)) AS price,
                  p_type AS category, true AS availability, p_brand AS item_type
           FROM {part} WHERE {rows}""",
        "p_size > 25",
        "p_type = 'PROMO'",
    ),
    "delivery_agent": (
        """SELECT CAST(n_nationkey AS BIGINT) AS delivery_agent_id, 'Agent ' || n_name AS name, '9000000000' AS phone,
                  'Bike' AS vehicle_type, CAST(n_nationkey AS BIGINT) AS location_id_fk,
                  CAST(NULL AS STRING) AS status, CAST(NULL AS STRING) AS gender,
                  CASE WHEN {changed} THEN CAST(3.50 AS DECIMAL(4,2)) ELSE CAST(4.50 AS DECIMAL(4,2)) END AS rating
           FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey WHERE {rows}""",
        "r.r_name = 'AMERICA'",
        "r.r_name = 'EUROPE'",
    ),
}

ORDERS = """SELECT o_orderkey AS order_id, o_custkey AS customer_id_fk, o_orderdate AS order_date,
       CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount, o_orderstatus AS status,
       CASE WHEN o_totalprice > 250000 THEN 'CARD' ELSE 'CASH' END AS payment_method
FROM {orders}"""

DELIVERIES = """SELECT o_orderkey AS delivery_id, o_orderkey AS order_id_fk, CAST(o_orderkey % 25 AS BIGINT) AS delivery_agent_id_fk,
       CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Out for Delivery' ELSE 'Pending' END AS delivery_status,
       o_orderpriority AS estimated_time, o_custkey AS customer_address_id_fk, o_orderdate AS delivery_date
FROM {orders}"""

ITEMS = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_orderkey AS order_id_fk, l_partkey AS menu_id_fk,
       l_suppkey AS restaurant_id_fk, CAST(l_quantity AS DECIMAL(10,2)) AS quantity,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS price,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS subtotal
FROM {lineitem}"""
ITEM_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


class Retail:
    """Bound entities of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}
        self._bound: dict[str, DataFrame] = {}
        self._dimensions: dict[tuple[str, bool], DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def sql(self, text: str, **fills: str) -> DataFrame:
        for name, value in fills.items():
            text = text.replace("{" + name + "}", value)
        if text not in self._bound:
            used = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
            self._bound[text] = self.spark.sql(text, **used)
        return self._bound[text]

    def snapshot(self, entity: str, second: bool, late_rows: bool = False) -> DataFrame:
        """State of an entity at the first or second load.

        With ``late_rows`` the rows that only arrive with the second load are
        left out of the first.
        """
        text, changed, late = SNAPSHOTS[entity]
        rows = f"NOT ({late})" if late_rows and not second else "true"
        return self.sql(text, changed=f"({changed})" if second else "false", rows=rows)

    def dimension(self, entity: str, late_rows: bool = False) -> DataFrame:
        """The dimension after both loads."""
        if (entity, late_rows) not in self._dimensions:
            self._dimensions[entity, late_rows] = self._two_loads(entity, late_rows)
        return self._dimensions[entity, late_rows]

    def _two_loads(self, entity: str, late_rows: bool) -> DataFrame:
        dim = self.role(entity)
        first = self.snapshot(entity, second=False, late_rows=late_rows)
        second = self.snapshot(entity, second=True)
        table = open_versions(first, dim, FIRST_LOAD, marked=True)
        if late_rows:
            return apply_scd2(table, change_set(first, second, dim.keys, compare=dim.attrs), dim, SECOND_LOAD)
        return apply_rows(table, second, dim, SECOND_LOAD)

    def as_written(self, entity: str) -> DataFrame:
        """The dimension after both loads by the literal rules."""
        dim = self.role(entity)
        first, second = self.snapshot(entity, second=False, late_rows=True), self.snapshot(entity, second=True)
        changes = change_set(first, second, dim.keys, compare=dim.attrs)
        return apply_scd2(open_versions(first, dim, FIRST_LOAD), changes, dim, SECOND_LOAD, mode="as_written")

    def reverted(self, entity: str) -> DataFrame:
        """The dimension after a third load that brings the first state back."""
        dim = self.role(entity)
        first, second = self.snapshot(entity, second=False), self.snapshot(entity, second=True)
        table = open_versions(first, dim, FIRST_LOAD)
        for old, new, at in ((first, second, SECOND_LOAD), (second, first, THIRD_LOAD)):
            table = apply_scd2(table, change_set(old, new, dim.keys, compare=dim.attrs), dim, at)
        return table

    @staticmethod
    def role(entity: str) -> Dimension:
        return schemas.ENTITIES[entity].dimension

    def orders(self) -> DataFrame:
        return self.sql(ORDERS)

    def deliveries(self) -> DataFrame:
        return self.sql(DELIVERIES)

    def items(self) -> DataFrame:
        rows = self.sql(ITEMS)
        return rows.select(hash_key(*ITEM_KEY).alias("order_item_id"), *[c for c in rows.columns if c not in ITEM_KEY])

    def dates(self) -> DataFrame:
        return date_dim(self.orders(), AS_OF)

    def lookup(self, entity: str, by: str, out: str, carry: tuple[str, ...] = (), small: bool = False) -> fact_plan.Lookup:
        return fact_plan.Lookup(self.dimension(entity), self.role(entity), by, out, carry, small)

    def fact(self) -> DataFrame:
        """The full fact. Customers, addresses and agents hang off the order, the rest off the line."""
        headers = fact_plan.order_headers(
            self.orders(),
            self.deliveries(),
            self.dates(),
            (
                self.lookup("customer", "customer_id_fk", "customer_dim_key"),
                self.lookup("customer_address", "customer_address_id_fk", "customer_address_dim_key"),
                self.lookup("delivery_agent", "delivery_agent_id_fk", "delivery_agent_dim_key"),
            ),
        )
        return fact_plan.order_item_fact(
            self.items(),
            headers,
            # The largest dimension first: each shuffle carries the keys found before it.
            (
                self.lookup("menu", "menu_id_fk", "menu_dim_key"),
                self.lookup("restaurant", "restaurant_id_fk", "restaurant_dim_key", carry=("location_id_fk",), small=True),
                self.lookup("location", "location_id_fk", "restaurant_location_dim_key"),
            ),
        )

    def revenue_fact(self, restaurants: bool = False) -> DataFrame:
        """Only the fact columns that revenue marts read, so only their joins."""
        deliveries = self.deliveries().select("order_id_fk", "delivery_id", "delivery_status")
        headers = fact_plan.order_headers(self.orders(), deliveries, self.dates())
        lookups = (self.lookup("restaurant", "restaurant_id_fk", "restaurant_dim_key", small=True),) if restaurants else ()
        columns = [c for c in fact_plan.FACT_COLUMNS if c in REVENUE_COLUMNS or restaurants and c == "restaurant_dim_key"]
        return fact_plan.order_item_fact(self.items(), headers, lookups, columns=columns)
