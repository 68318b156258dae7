"""Clean changes to the fact, in several orders of arrival."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from larder import schemas
from larder.session import DROP_SHUFFLES
from larder.streaming import feed as feed_module
from larder.streaming.fact_line import FactLine, Role
from larder.streaming.feed import existing
from larder.streaming.loader import EntityLoader

START = dt.datetime(2024, 6, 1)
CUSTOMER = "{0},{1},900,a@x,app,F,1990-01-01,\\N,veg,2024-01-01 00:00:00,2024-01-0{2} 00:00:00"
RESTAURANT = "{0},{1},Indian,5,555,9-5,{2},Yes,Open,Here,Road,1,1,2024-01-01 00:00:00,2024-01-01 00:00:00"
LOCATION = "{0},{1},Goa,1,Yes,2024-01-01 00:00:00,2024-01-01 00:00:00"
MENU = "{0},5,Rice,desc,{1},Main,TRUE,Veg,2024-01-01 00:00:00,2024-01-0{2} 00:00:00"
ORDERS = "{0},{1},{2},2024-05-0{3} 12:00:00,10.00,{4},CARD,2024-05-01 12:00:00,2024-05-0{5} 12:00:00"
ITEM = "{0},{1},{2},{3},2.00,{4},2024-05-01 00:00:00,2024-05-0{5} 00:00:00"
DELIVERY = "{0},{1},{2},{3},30 min,5,2024-05-01 00:00:00,2024-05-01 00:00:00,2024-05-0{4} 00:00:00"

# (entity, lines): a first delivery and a later one for each.
FIRST = {
    "customer": [CUSTOMER.format(10, "Ann", 1)],
    "restaurant": [RESTAURANT.format(5, "Five", 1)],
    "location": [LOCATION.format(1, "Agra")],
    "menu": [MENU.format(50, "2.00", 1), MENU.format(51, "3.00", 1)],
    "orders": [ORDERS.format(1, 10, 5, 1, "Open", 1), ORDERS.format(2, 11, 6, 2, "Open", 1)],
    "order_item": [ITEM.format(1, 1, 50, 1, "2.00", 1), ITEM.format(2, 1, 51, 1, "3.00", 1), ITEM.format(3, 2, 52, 2, "4.00", 1)],
    "delivery": [DELIVERY.format(1, 1, 7, "Pending", 1)],
}
LATER = {
    "customer": [CUSTOMER.format(11, "Bob", 1)],
    "restaurant": [RESTAURANT.format(6, "Six", 2)],
    "location": [LOCATION.format(2, "Pune")],
    "menu": [MENU.format(52, "4.00", 1)],
    "orders": [ORDERS.format(3, 10, 6, 3, "Open", 1), ORDERS.format(1, 10, 5, 1, "Done", 2)],
    "order_item": [ITEM.format(1, 1, 50, 4, "8.00", 2), ITEM.format(4, 3, 50, 1, "2.00", 1), ITEM.format(5, 777, 50, 1, "2.00", 1),
                   ITEM.format(2, 1, 50, 1, "2.50", 3)],
    "delivery": [DELIVERY.format(1, 1, 8, "Delivered", 2), DELIVERY.format(2, 3, 7, "Delivered", 1)],
}
ROLES = ("customer", "restaurant", "location", "menu")


class World:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        names = ("orders", "order_item", "delivery", *ROLES)
        clock = lambda b: START + dt.timedelta(days=b)
        self.loaders = {n: EntityLoader(spark, schemas.ENTITIES[n], str(root / "tables"), buckets=4, clock=clock, feed=True) for n in names}
        by = {"customer": "customer_id_fk", "restaurant": "restaurant_id_fk", "location": "location_id_fk", "menu": "menu_id_fk"}
        out = {"location": "restaurant_location_dim_key"}
        self.roles = [
            Role(self.loaders[n], by[n], out.get(n, f"{n}_dim_key"), "line" if n == "menu" else "order", ("location_id_fk",) if n == "restaurant" else ())
            for n in ROLES
        ]
        self.line = self.make()

    def make(self):
        parts = (self.loaders[n] for n in ("orders", "order_item", "delivery"))
        return FactLine(self.spark, str(self.root / "tables"), *parts, self.roles, as_of=lambda: dt.date(2024, 6, 30), buckets=4)

    def deliver(self, entity, *deliveries):
        folder = self.root / "landing" / entity
        folder.mkdir(parents=True, exist_ok=True)
        header = ",".join(f"H{i}" for i in range(len(schemas.ENTITIES[entity].file_columns)))
        for lines in deliveries:
            name = f"{len(list(folder.glob('*.csv')))}.csv"
            (folder / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
        self.loaders[entity].run(str(folder))

    def fact(self):
        rows = self.line.fact()
        numbers = [r[0] for r in rows.select("order_item_fact_sk").collect()]
        assert len(numbers) == len(set(numbers))
        return named(rows, self)


def named(fact, world):
    """Fact rows with names in place of keys, which hold the time a version was loaded."""
    columns = {"customer": "name", "restaurant": "name", "location": "city", "menu": "price"}
    for r in world.roles:
        d = r.loader.entity.dimension
        side = r.loader.dimension().select(F.col(d.hash_key).alias("_k"), F.col(columns[r.name]).alias(r.name))
        fact = fact.join(side, F.col(r.out) == F.col("_k"), "left").drop("_k")
    wanted = ["order_item_id", "order_id", *ROLES, "order_date_dim_key", "quantity", "subtotal", "delivery_status"]
    return sorted((tuple(map(str, r)) for r in fact.select(*wanted).collect()))


@pytest.fixture(scope="module")
def bulk(spark, tmp_path_factory):
    """Dimensions first, everything loaded, then one refresh."""
    w = World(spark, tmp_path_factory.mktemp("bulk"))
    for entity in (*ROLES, "orders", "order_item", "delivery"):
        w.deliver(entity, FIRST[entity], LATER[entity])
    w.line.run()
    return w.fact()


def test_bulk_load(bulk):
    got = {r[0]: r[1:6] for r in bulk}
    # Of an order that is not there, only what hangs off the line is known.
    assert got == {
        "1": ("1", "Ann", "Five", "Agra", "2.00"), "2": ("1", "Ann", "Five", "Agra", "2.00"), "3": ("2", "Bob", "Six", "Pune", "4.00"),
        "4": ("3", "Ann", "Six", "Pune", "2.00"), "5": ("777", "None", "None", "None", "2.00"),
    }
    assert {r[0]: r[7:] for r in bulk}["1"] == ("4", "8.00", "Delivered")


def test_facts_before_dimensions_with_failures(spark, tmp_path, bulk, monkeypatch):
    """Lines, deliveries and orders come first, dimensions later, and runs break off at the worst moments."""
    w = World(spark, tmp_path)
    for entity in ("order_item", "delivery", "orders"):
        w.deliver(entity, FIRST[entity])
    w.line.run()
    assert {r[2:6] for r in w.fact()} == {("None",) * 4}
    open_keys = sorted((r.entity, r.key, r.order_id) for r in w.line.unresolved().distinct().collect())
    # Nothing is known of the location before the restaurant is.
    assert open_keys == [("customer", "10", 1), ("customer", "11", 2), ("menu", "50", 1), ("menu", "51", 1), ("menu", "52", 2),
                         ("restaurant", "5", 1), ("restaurant", "6", 2)]

    # The load is committed, but publishing its changes breaks off; the next run makes up for it.
    def broken(self, *args):
        raise RuntimeError("lost before publishing")

    with monkeypatch.context() as patch:
        patch.setattr(feed_module.ChangeFeed, "publish", broken)
        with pytest.raises(StreamingQueryException):
            w.deliver("order_item", LATER["order_item"])
    w.deliver("order_item")
    for entity in ("restaurant", "menu", "customer"):
        w.deliver(entity, FIRST[entity], LATER[entity])
    # The fact is committed, but the batch is not acknowledged: it comes again.
    real_load = w.line.store.load

    def late(*args, **kwargs):
        real_load(*args, **kwargs)
        raise RuntimeError("lost after commit")

    with monkeypatch.context() as patch:
        patch.setattr(w.line.store, "load", late)
        with pytest.raises(StreamingQueryException):
            w.line.run()
    w.line.run()
    assert {r[0]: r[2:6] for r in w.fact()}["3"] == ("Bob", "Six", "None", "4.00")

    w.deliver("location", FIRST["location"], LATER["location"])
    w.deliver("orders", LATER["orders"])
    w.deliver("delivery", LATER["delivery"])
    w.line.run()
    assert w.fact() == bulk
    version = w.line.store.store.state()["version"]
    w.line.run()  # nothing new
    assert w.line.store.store.state()["version"] == version
    # The stream's position is lost: everything is looked at again, and stays as it is.
    (tmp_path / "tables" / "fact_line" / "checkpoint").rename(tmp_path / "lost")
    w.line = w.make()
    w.line.run()
    assert w.line.store.store.state()["version"] > version and w.fact() == bulk


def test_a_feed_tells_net_changes(spark, tmp_path):
    w = World(spark, tmp_path)
    w.deliver("customer", FIRST["customer"])
    w.deliver("customer", [CUSTOMER.format(10, "Anna", 2), *LATER["customer"]])
    w.deliver("customer", [CUSTOMER.format(10, "Anna", 2)])  # as it is
    loader = w.loaders["customer"]
    rows = existing(spark, loader.feed.path, loader.feed.schema)
    got = sorted((r._batch, r.customer_id, r.name, r._action, r._is_update) for r in rows.collect())
    assert got == [(0, "10", "Ann", "INSERT", False), (1, "10", "Ann", "DELETE", True), (1, "10", "Anna", "INSERT", True), (1, "11", "Bob", "INSERT", False)]
    assert loader.feed.published() == 2
    loader.publish()
    assert rows.count() == 4
    late = EntityLoader(spark, schemas.CUSTOMER, str(tmp_path / "other"), clock=loader.clock)
    assert existing(spark, late.feed.path, late.feed.schema).count() == 0 and late.feed.published() == -1


def test_nothing_written_on_the_way_stays(spark, tmp_path, monkeypatch):
    """Once committed, a batch leaves no scratch tables; its queries drop their shuffle files, those of others don't."""
    seen, world = [], World(spark, tmp_path)

    def looking(made):
        def look(self, *args, **kwargs):
            seen.append(spark.conf.get(DROP_SHUFFLES, "false"))
            return made(self, *args, **kwargs)

        return look

    monkeypatch.setattr(EntityLoader, "_load", looking(EntityLoader._load))
    monkeypatch.setattr(FactLine, "_touched", looking(FactLine._touched))
    before = spark.conf.get(DROP_SHUFFLES, None)
    for entity, lines in FIRST.items():
        world.deliver(entity, lines)
    world.line.run()
    assert seen == ["true"] * (len(FIRST) + 1) and spark.conf.get(DROP_SHUFFLES, None) == before
    assert world.line.fact().count() == 3
    folders = [p for p in (tmp_path / "tables").rglob("*") if p.is_dir() and any(p.glob("*.parquet"))]
    scratch = [p for p in folders if {"incoming", "touched", "assembled"} & set(p.relative_to(tmp_path / "tables").parts)]
    assert not scratch and len(folders) > 20
