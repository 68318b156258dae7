import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from larder import schemas
from larder.operators.scd2 import Dimension, open_versions
from larder.plans import dashboard, marts
from larder.plans import fact as fact_plan
from larder.plans.date_dim import date_dim
from larder.plans.fact import FACT_COLUMNS, Lookup, order_headers, order_item_fact
from larder.plans.retail import Retail
from larder.streaming.loader import FactLoader, lines_of_orders

D = dt.datetime
CUSTOMER = Dimension("customer_dim", "customer_hk", ("customer_id",), ("name",))
ADDRESS = Dimension("address_dim", "customer_address_hk", ("address_id",), ("city",))
MENU = Dimension("menu_dim", "menu_dim_hk", ("menu_id",), ("price",))


@pytest.fixture
def world(spark):
    orders = spark.createDataFrame(
        [(1, 10, D(2024, 1, 1, 9)), (2, 10, D(2024, 2, 1, 9)), (3, 11, D(2024, 3, 1, 9)), (4, 99, D(2024, 3, 2, 9))],
        "order_id bigint, customer_id_fk bigint, order_date timestamp_ntz",
    )
    deliveries = spark.createDataFrame(
        [
            (1, 1, 7, "Delivered", "30", 100, D(2024, 1, 1)),
            (2, 2, 7, "Pending", "30", 101, D(2024, 2, 1)),
            (2, 2, 8, "Delivered", "20", 101, D(2024, 2, 2)),
            (3, 3, 8, "Delivered", "20", 102, D(2024, 3, 1)),
        ],
        "delivery_id bigint, order_id_fk bigint, delivery_agent_id_fk bigint, delivery_status string, estimated_time string,"
        " customer_address_id_fk bigint, modified_date timestamp_ntz",
    )
    items = spark.createDataFrame(
        [(1, 1, 50, "2.50", "5.00"), (2, 1, 51, "1.00", "7.00"), (3, 2, 50, "1.00", "9.00"), (4, 3, 50, "1.00", "1.00"),
         (5, 4, 50, "1.00", "3.00"), (6, 777, 50, "1.00", "3.00")],
        "order_item_id bigint, order_id_fk bigint, menu_id_fk bigint, q string, s string",
    ).select(
        "order_item_id", "order_id_fk", "menu_id_fk", F.col("q").cast("decimal(10,2)").alias("quantity"),
        F.col("s").cast("decimal(10,2)").alias("price"), F.col("s").cast("decimal(10,2)").alias("subtotal"),
    )
    names = spark.createDataFrame([("10", "Ann"), ("11", "Bob")], "customer_id string, name string")
    old = open_versions(names, CUSTOMER, D(2020, 1, 1))
    # Ann has a second version from mid January on.
    ann = F.col("customer_id") == "10"
    closed = old.where(ann).withColumn("eff_end_date", F.lit(D(2024, 1, 15)).cast("timestamp_ntz")).withColumn("is_current", F.lit(False))
    new = open_versions(spark.createDataFrame([("10", "Anna")], names.schema), CUSTOMER, D(2024, 1, 15))
    customers = old.where(~ann).unionByName(closed).unionByName(new)
    places = spark.createDataFrame([(100, "A"), (101, "B"), (102, "C"), (103, "D")], "address_id bigint, city string")
    addresses = open_versions(places, ADDRESS, D(2020, 1, 1))
    menu = open_versions(spark.createDataFrame([(50, "1"), (51, "2")], "menu_id bigint, price string"), MENU, D(2020, 1, 1))
    return {
        "orders": orders, "deliveries": deliveries, "items": items, "dates": date_dim(orders, dt.date(2024, 3, 31)),
        "customers": customers, "addresses": addresses, "menu": menu,
    }


def build(w, items=None, current_only=False):
    headers = order_headers(
        w["orders"], w["deliveries"], w["dates"],
        (
            Lookup(w["customers"], CUSTOMER, "customer_id_fk", "customer_dim_key"),
            Lookup(w["addresses"], ADDRESS, "customer_address_id_fk", "customer_address_dim_key"),
        ),
        current_only,
    )
    return order_item_fact(
        w["items"] if items is None else items, headers, (Lookup(w["menu"], MENU, "menu_id_fk", "menu_dim_key"),), current_only,
        columns=[c for c in FACT_COLUMNS if c not in ("restaurant_dim_key", "restaurant_location_dim_key", "delivery_agent_dim_key")],
    )


def test_a_forgotten_lookup_is_an_error(world):
    headers = order_headers(world["orders"], world["deliveries"], world["dates"])
    with pytest.raises(ValueError, match="customer_dim_key"):
        order_item_fact(world["items"], headers)


def test_orders_older_than_the_first_load_find_its_version(spark, world):
    world["addresses"] = world["addresses"].withColumn("eff_start_date", F.lit(D(2024, 6, 1)).cast("timestamp_ntz"))
    fact = build(world)
    assert fact.where("order_id IN (1, 2, 3) AND customer_address_dim_key IS NULL").count() == 0


def test_one_row_per_line_whatever_the_dimensions_hold(spark, world):
    fact = build(world)
    assert fact.count() == world["items"].count()
    assert fact.select("order_item_id").distinct().count() == 6


def test_versions_follow_the_order_date(spark, world):
    names = {r["customer_hk"]: r["name"] for r in world["customers"].collect()}
    seen = {r["order_id"]: names.get(r["customer_dim_key"]) for r in build(world).collect()}
    assert seen == {1: "Ann", 2: "Anna", 3: "Bob", 4: None, 777: None}
    now = {r["order_id"]: names.get(r["customer_dim_key"]) for r in build(world, current_only=True).collect()}
    assert now == {1: "Anna", 2: "Anna", 3: "Bob", 4: None, 777: None}


def test_address_comes_from_the_delivery(spark, world):
    cities = {r["customer_address_hk"]: r["city"] for r in world["addresses"].collect()}
    seen = {r["order_id"]: cities.get(r["customer_address_dim_key"]) for r in build(world).collect()}
    assert seen == {1: "A", 2: "B", 3: "C", 4: None, 777: None}


def test_last_delivery_counts(spark, world):
    status = {r["order_id"]: (r["delivery_status"], r["estimated_time"]) for r in build(world).collect()}
    assert status[2] == ("Delivered", "20")
    assert status[4] == (None, None)


def test_quantity_rounds_half_up(spark, world):
    assert {r["order_item_id"]: r["quantity"] for r in build(world).collect()}[1] == 3


def test_calendar_and_its_open_start(spark, world):
    dates = world["dates"]
    assert dates.count() == 91
    assert dates.agg(F.min("calendar_date")).first()[0] == dt.date(2024, 1, 1)
    literal = date_dim(world["orders"], dt.date(2024, 3, 31), include_start=False)
    assert literal.count() == 90
    first = dates.where("calendar_date = date'2024-01-01'").first()
    assert (first["year"], first["week"], first["day_of_week"], first["day_name"]) == (2024, 1, 1, "Mon")


def test_calendar_never_counts_down(spark, world):
    days = date_dim(world["orders"], dt.date(2023, 1, 1)).select("calendar_date").collect()
    assert days == [(dt.date(2023, 1, 1),)]


def test_marts(spark, world):
    fact = build(world)
    monthly = {r["month"]: r for r in marts.monthly(fact, world["dates"]).collect()}
    assert set(monthly) == {1, 2, 3}
    jan = monthly[1]
    assert (jan["total_revenue"], jan["total_orders"], jan["avg_revenue_per_order"], jan["avg_revenue_per_item"], jan["max_order_value"]) == (
        Decimal("12.00"), 1, Decimal("12.00"), Decimal("6.00"), Decimal("7.00")
    )
    assert marts.max_order_total(fact, world["dates"], ["year"]).collect() == [(2024, Decimal("12.00"))]
    # No status filter: the undelivered order of March 2nd counts here.
    saturday = marts.by_day_name(fact, world["dates"]).where("month = 3 and day_name = 'Sat'").first()
    assert saturday["total_revenue"] == Decimal("3.00")
    assert marts.daily(fact, world["dates"]).columns[:3] == ["year", "month", "day"]


def test_views_answer_sql(spark, world):
    stores = spark.createDataFrame([(1, "Store")], "restaurant_hk bigint, name string")
    fact = build(world).withColumn("restaurant_dim_key", F.lit(1).cast("bigint"))
    marts.register_views(fact, world["dates"], stores)
    top = spark.sql(
        """SELECT restaurant_name, total_revenue FROM vw_monthly_revenue_by_restaurant
           WHERE year = 2024 AND month = 1 ORDER BY total_revenue DESC LIMIT 5"""
    )
    assert top.collect() == [("Store", Decimal("12.00"))]
    for name in marts.VIEW_NAMES:
        assert spark.table(name).count() > 0


def test_five_marts_from_one_scan(spark, world, tmp_path):
    stores = spark.createDataFrame([(1, "Store"), (2, None), (3, "Store")], "restaurant_hk bigint, name string")
    key = F.when(F.col("order_id") < 4, F.col("order_item_id") % 4).cast("bigint")  # 0 is no store, NULL neither
    fact = build(world).withColumn("restaurant_dim_key", F.when(key != 0, key))
    fact = fact.unionByName(fact.where("order_id = 1").withColumn("order_id", F.lit(None).cast("bigint")))
    together = marts.all_marts(fact, world["dates"], stores)
    apart = {
        "vw_yearly_revenue_kpis": marts.yearly(fact, world["dates"]),
        "vw_monthly_revenue_kpis": marts.monthly(fact, world["dates"]),
        "vw_daily_revenue_kpis": marts.daily(fact, world["dates"]),
        "vw_day_revenue_kpis": marts.by_day_name(fact, world["dates"]),
        "vw_monthly_revenue_by_restaurant": marts.monthly_by_restaurant(fact, world["dates"], stores),
    }
    assert set(apart) == set(marts.VIEW_NAMES)
    for name, mart in apart.items():
        got = marts.one_mart(together, name)
        assert got.columns == mart.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, mart.collect())), name
    fact.write.parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    plan = marts.all_marts(stored, world["dates"], stores)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_year_over_year_leaves_gaps_empty(spark):
    cols = "year int, total_revenue decimal(18,2), total_orders bigint, avg_revenue_per_order decimal(18,2), avg_revenue_per_item decimal(18,2), max_order_value decimal(18,2)"
    one = Decimal(1)
    years = spark.createDataFrame([(2020, Decimal(5), 1, one, one, one), (2021, Decimal(9), 3, one, one, one), (2023, Decimal(2), 2, one, one, one)], cols)
    got = {r["year"]: (r["total_revenue_delta"], r["total_orders_delta"]) for r in dashboard.yoy_delta(years).collect()}
    assert got == {2020: (None, None), 2021: (Decimal(4), 2), 2023: (None, None)}
    assert dashboard.all_time_totals(years).first()["total_revenue"] == Decimal(16)


def test_fact_loader_upserts_once_and_keeps_numbers(spark, world, tmp_path):
    loader = FactLoader(spark, str(tmp_path / "tables"), buckets=4)
    early = world["items"].where("order_item_id <= 3")
    rows = build(world, early)
    loader.load(rows, 0)
    first = {r["order_item_id"]: r["order_item_fact_sk"] for r in loader.fact(rows).collect()}
    assert sorted(first.values()) == [1, 2, 3]

    # Order 1 changes; its lines are assembled again together with the new ones.
    touched = lines_of_orders(world["items"], spark.createDataFrame([(1,)], "order_id bigint"))
    assert sorted(r["order_item_id"] for r in touched.collect()) == [1, 2]
    again = build(world, world["items"].withColumn("subtotal", (F.col("subtotal") + 1).cast("decimal(10,2)")))
    loader.load(again, 1)
    got = {r["order_item_id"]: (r["order_item_fact_sk"], r["subtotal"]) for r in loader.fact(rows).collect()}
    assert {k: v[0] for k, v in got.items() if k <= 3} == first
    assert sorted(v[0] for v in got.values()) == [1, 2, 3, 4, 5, 6]
    assert got[1][1] == Decimal("6.00")

    loader.load(rows.where("false"), 1)  # a known version changes nothing
    assert loader.fact(rows).count() == 6


def test_entity_dimensions_carry_the_fact_lookup_columns():
    assert "location_id_fk" in schemas.RESTAURANT.dimension.attrs


def test_calendar_is_met_after_the_lookups(world):
    """Date keys are not shuffled by the lookups of an order."""
    customer = Lookup(world["customers"], CUSTOMER, "customer_id_fk", "customer_dim_key")
    headers = order_headers(world["orders"], world["deliveries"], world["dates"], (customer,))
    joins = [line for line in headers._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in line]
    assert "calendar_date" in joins[0] and not any("calendar_date" in j for j in joins[1:])


def test_largest_dimension_is_met_with_the_narrowest_lines(spark, monkeypatch):
    met = []
    attach = fact_plan._attach
    monkeypatch.setattr(fact_plan, "_attach", lambda df, item, current: met.append(item.out) or attach(df, item, current))
    Retail(spark, "/root/testdata/sf0.001").fact()
    assert met[-3:] == ["menu_dim_key", "restaurant_dim_key", "restaurant_location_dim_key"]


def test_small_dimension_is_measured_and_broadcast(spark, monkeypatch):
    from larder.functions import columns

    rows = spark.createDataFrame([(1, "ab"), (2, None)], "id bigint, name string")
    assert columns.row_bytes(rows) == 2 * 24 + 2 and columns.row_bytes(rows.where("false")) == 0
    hinted = lambda: "ResolvedHint (strategy=broadcast)" in columns.broadcast_if_small(rows)._jdf.queryExecution().analyzed().toString()
    assert hinted()
    monkeypatch.setattr(columns, "SMALL_BYTES", 49)
    assert not hinted()


def test_lines_are_not_dealt_by_restaurant(spark, monkeypatch):
    """The fact deals its lines by order and by menu entry; restaurants are broadcast up to a bound, whatever Spark expects of them."""
    from larder.functions import columns

    def dealt():
        plan = Retail(spark, "/root/testdata/sf0.001").fact()._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.splitlines() if "Exchange hashpartitioning(restaurant_id_fk" in line]

    monkeypatch.setattr(columns, "SMALL_BYTES", 0)
    large = dealt()
    monkeypatch.undo()
    with_bound = dealt()
    assert large and not with_bound


def test_all_marts_deal_lines_by_order_once(spark, world, tmp_path):
    """One shuffle of lines by order, one of sums by group; none by restaurant and none of a line for each mart."""
    stores = spark.createDataFrame([(1, "Store"), (2, "Other")], "restaurant_hk bigint, name string")
    fact = build(world).withColumn("restaurant_dim_key", (F.col("order_item_id") % 2 + 1).cast("bigint"))
    fact.write.parquet(str(tmp_path / "fact"))
    found = marts.all_marts(spark.read.parquet(str(tmp_path / "fact")), world["dates"], stores)
    plan = found._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 2 and "mart" in dealt[0] and "hashpartitioning(order_id" in dealt[1]
    assert marts.one_mart(found, "vw_yearly_revenue_kpis").first()["total_orders"] == marts.yearly(fact, world["dates"]).first()["total_orders"]
