"""The nine source entities as data: file columns, types, keys, dimension roles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import mapping as M
from larder.operators.scd2 import Dimension


@dataclass(frozen=True)
class Field:
    """A file column, its clean name and how its text becomes a value.

    ``kind`` is one of text, trim, long, decimal(p,s), date, bool, timestamp;
    a trailing ``!`` makes the conversion strict.
    """

    source: str
    name: str
    kind: str = "text"
    required: bool = False
    max_length: int | None = None
    tag: str | None = None


@dataclass(frozen=True)
class Entity:
    name: str
    fields: tuple[Field, ...]
    keys: tuple[str, ...]
    modified: str
    # Columns a matched row keeps on upsert.
    frozen: tuple[str, ...] = ()
    # Columns that make a matched row worth updating; None updates always.
    changed_on: tuple[str, ...] | None = None
    # Adds computed columns, from the staged text columns.
    derive: Callable[[DataFrame], DataFrame] | None = None
    derived: tuple[str, ...] = ()
    dimension: Dimension | None = None
    # Key columns that decide where a row is stored; the whole key if not given.
    spread_by: tuple[str, ...] | None = None

    @property
    def file_columns(self) -> list[str]:
        return [f.source for f in self.fields]

    @property
    def clean_columns(self) -> list[str]:
        return [*[f.name for f in self.fields], *self.derived]

    @property
    def tags(self) -> dict[str, str]:
        return {f.name: f.tag for f in self.fields if f.tag}

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    @property
    def max_lengths(self) -> dict[str, int]:
        return {f.name: f.max_length for f in self.fields if f.max_length}


def _place_columns(df: DataFrame) -> DataFrame:
    raw_state, city = F.col("state"), F.col("city")
    return df.withColumns(
        {
            "state_code": M.state_code(raw_state),
            "is_union_territory": M.union_territory(raw_state),
            "capital_city_flag": M.capital_city(raw_state, city),
            "city_tier": M.city_tier(city),
            "state": M.state_name(raw_state),
        }
    )


LOCATION = Entity(
    name="location",
    fields=(
        Field("locationid", "location_id", "long!", required=True),
        Field("city", "city", required=True, max_length=100),
        Field("state", "state", required=True, max_length=100),
        Field("zipcode", "zip_code", required=True, max_length=10),
        Field("activeflag", "active_flag", required=True, max_length=10),
        Field("createddate", "created_ts", "timestamp!", required=True),
        Field("modifieddate", "modified_ts", "timestamp!"),
    ),
    keys=("location_id",),
    modified="modified_ts",
    frozen=("created_ts",),
    changed_on=(
        "city", "state", "state_code", "is_union_territory", "capital_city_flag", "city_tier",
        "zip_code", "active_flag", "modified_ts",
    ),
    derive=_place_columns,
    derived=("state_code", "is_union_territory", "capital_city_flag", "city_tier"),
    dimension=Dimension(
        "restaurant_location_dim",
        "restaurant_location_hk",
        ("location_id",),
        (
            "city", "state", "state_code", "is_union_territory", "capital_city_flag", "city_tier",
            "zip_code", "active_flag",
        ),
        start="eff_start_dt",
        end="eff_end_dt",
        current="current_flag",
        match_on=("location_id", "active_flag"),
    ),
)

RESTAURANT = Entity(
    name="restaurant",
    fields=(
        Field("restaurantid", "restaurant_id", "long"),
        Field("name", "name", required=True, max_length=100),
        Field("cuisinetype", "cuisine_type"),
        Field("pricing_for_2", "pricing_for_two", "decimal(10,2)"),
        Field("restaurant_phone", "restaurant_phone", max_length=15, tag="SENSITIVE"),
        Field("operatinghours", "operating_hours", max_length=100),
        Field("locationid", "location_id_fk", "long"),
        Field("activeflag", "active_flag", max_length=10),
        Field("openstatus", "open_status", max_length=10),
        Field("locality", "locality", max_length=100),
        Field("restaurant_address", "restaurant_address"),
        Field("latitude", "latitude", "decimal(9,6)"),
        Field("longitude", "longitude", "decimal(9,6)"),
        Field("createddate", "created_dt", "timestamp"),
        Field("modifieddate", "modified_dt", "timestamp"),
    ),
    keys=("restaurant_id",),
    modified="modified_dt",
    dimension=Dimension(
        "restaurant_dim",
        "restaurant_hk",
        ("restaurant_id",),
        (
            "name", "cuisine_type", "pricing_for_two", "restaurant_phone", "operating_hours",
            "location_id_fk", "active_flag", "open_status", "locality", "restaurant_address",
            "latitude", "longitude",
        ),
    ),
)

CUSTOMER = Entity(
    name="customer",
    fields=(
        Field("customerid", "customer_id", required=True),
        Field("name", "name", required=True, max_length=100),
        Field("mobile", "mobile", max_length=15, tag="PII"),
        Field("email", "email", max_length=100, tag="EMAIL"),
        Field("loginbyusing", "login_by_using", max_length=50),
        Field("gender", "gender", max_length=10, tag="PII"),
        Field("dob", "dob", "date", tag="PII"),
        Field("anniversary", "anniversary", "date"),
        Field("preferences", "preferences"),
        Field("createddate", "created_dt", "timestamp"),
        Field("modifieddate", "modified_dt", "timestamp"),
    ),
    keys=("customer_id",),
    modified="modified_dt",
    dimension=Dimension(
        "customer_dim",
        "customer_hk",
        ("customer_id",),
        ("name", "mobile", "email", "login_by_using", "gender", "dob", "anniversary", "preferences"),
    ),
)

CUSTOMER_ADDRESS = Entity(
    name="customer_address",
    fields=(
        Field("addressid", "address_id", "long!"),
        Field("customerid", "customer_id_fk", "long!"),
        Field("flatno", "flat_no"),
        Field("houseno", "house_no"),
        Field("floor", "floor"),
        Field("building", "building"),
        Field("landmark", "landmark"),
        Field("locality", "locality"),
        Field("city", "city"),
        Field("state", "state"),
        Field("pincode", "pincode"),
        Field("coordinates", "coordinates"),
        Field("primaryflag", "primary_flag"),
        Field("addresstype", "address_type"),
        Field("createddate", "created_date", "timestamp"),
        Field("modifieddate", "modified_date", "timestamp"),
    ),
    keys=("address_id",),
    modified="modified_date",
    frozen=("customer_id_fk",),
    dimension=Dimension(
        "customer_address_dim",
        "customer_address_hk",
        ("address_id",),
        (
            "customer_id_fk", "flat_no", "house_no", "floor", "building", "landmark", "locality",
            "city", "state", "pincode", "coordinates", "primary_flag", "address_type",
        ),
    ),
)

MENU = Entity(
    name="menu",
    fields=(
        Field("menuid", "menu_id", "long", required=True),
        Field("restaurantid", "restaurant_id_fk", "long"),
        Field("itemname", "item_name", "trim", required=True),
        Field("description", "description", "trim", required=True),
        Field("price", "price", "decimal(10,2)", required=True),
        Field("category", "category", "trim"),
        Field("availability", "availability", "bool"),
        Field("itemtype", "item_type", "trim"),
        Field("createddate", "created_dt", "timestamp"),
        Field("modifieddate", "modified_dt", "timestamp"),
    ),
    keys=("menu_id",),
    modified="modified_dt",
    dimension=Dimension(
        "menu_dim",
        "menu_dim_hk",
        ("menu_id",),
        ("restaurant_id_fk", "item_name", "description", "price", "category", "availability", "item_type"),
    ),
)

DELIVERY_AGENT = Entity(
    name="delivery_agent",
    fields=(
        Field("deliveryagentid", "delivery_agent_id", "long", required=True),
        Field("name", "name", required=True),
        Field("phone", "phone", required=True),
        Field("vehicletype", "vehicle_type", required=True),
        Field("locationid", "location_id_fk", "long"),
        Field("status", "status"),
        Field("gender", "gender"),
        Field("rating", "rating", "decimal(4,2)"),
        Field("createddate", "created_dt", "timestamp"),
        Field("modifieddate", "modified_dt", "timestamp"),
    ),
    keys=("delivery_agent_id",),
    modified="modified_dt",
    frozen=("name",),
    dimension=Dimension(
        "delivery_agent_dim",
        "delivery_agent_hk",
        ("delivery_agent_id",),
        ("name", "phone", "vehicle_type", "location_id_fk", "status", "gender", "rating"),
    ),
)

DELIVERY = Entity(
    name="delivery",
    fields=(
        Field("deliveryid", "delivery_id", "long!", required=True),
        Field("orderid", "order_id_fk", "long!", required=True),
        Field("deliveryagentid", "delivery_agent_id_fk", "long!", required=True),
        Field("deliverystatus", "delivery_status"),
        Field("estimatedtime", "estimated_time"),
        Field("addressid", "customer_address_id_fk", "long!", required=True),
        Field("deliverydate", "delivery_date", "timestamp!"),
        Field("createddate", "created_date", "timestamp!"),
        Field("modifieddate", "modified_date", "timestamp!"),
    ),
    keys=("delivery_id", "order_id_fk", "delivery_agent_id_fk"),
    modified="modified_date",
    spread_by=("order_id_fk",),
)

ORDERS = Entity(
    name="orders",
    fields=(
        Field("orderid", "order_id", "long"),
        Field("customerid", "customer_id_fk", "long"),
        Field("restaurantid", "restaurant_id_fk", "long"),
        Field("orderdate", "order_date", "timestamp"),
        Field("totalamount", "total_amount", "decimal(10,2)"),
        Field("status", "status"),
        Field("paymentmethod", "payment_method"),
        Field("createddate", "created_dt", "timestamp"),
        Field("modifieddate", "modified_dt", "timestamp"),
    ),
    keys=("order_id",),
    modified="modified_dt",
    frozen=("customer_id_fk", "restaurant_id_fk", "order_date", "created_dt"),
)

ORDER_ITEM = Entity(
    name="order_item",
    fields=(
        Field("orderitemid", "order_item_id", "long!", required=True),
        Field("orderid", "order_id_fk", "long!", required=True),
        Field("menuid", "menu_id_fk", "long!", required=True),
        Field("quantity", "quantity", "decimal(10,2)!"),
        Field("price", "price", "decimal(10,2)!"),
        Field("subtotal", "subtotal", "decimal(10,2)!"),
        Field("createddate", "created_dt", "timestamp!"),
        Field("modifieddate", "modified_dt", "timestamp!"),
    ),
    keys=("order_item_id", "order_id_fk", "menu_id_fk"),
    modified="modified_dt",
    spread_by=("order_id_fk",),
)

ENTITIES = {
    e.name: e
    for e in (
        LOCATION, RESTAURANT, CUSTOMER, CUSTOMER_ADDRESS, MENU, DELIVERY_AGENT, DELIVERY, ORDERS, ORDER_ITEM,
    )
}
