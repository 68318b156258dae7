"""Delta scenarios per entity, run through the streaming loader twice where it matters."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from larder import schemas
from larder.functions.masking import mask_tagged, tagged_columns
from larder.operators.scd2 import scd2_history
from larder.plans.clean import empty_clean, latest_rows
from larder.sources.csv_stage import resplit
from larder.streaming import loader as loader_module
from larder.streaming.loader import EntityLoader
from larder.streaming.progress import ProgressLog
from larder.streaming.store import TableStore

DAY = [dt.datetime(2024, 6, d) for d in range(1, 10)]


class Stage:
    """A landing folder and a loader for one entity."""

    def __init__(self, spark, tmp_path, entity, **kwargs):
        self.folder = tmp_path / "landing" / entity.name
        self.folder.mkdir(parents=True)
        self.entity = entity
        self.loader = EntityLoader(spark, entity, str(tmp_path / "tables"), buckets=4, clock=lambda b: DAY[b], **kwargs)

    def deliver(self, name, *lines):
        header = ",".join(f"H{i}" for i in range(len(self.entity.file_columns)))
        (self.folder / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
        self.loader.run(str(self.folder))

    def clean(self, *columns):
        return sorted(tuple(r) for r in self.loader.clean().select(*columns).collect())

    def versions(self, *columns):
        d = self.entity.dimension
        got = self.loader.dimension().select(*d.keys, *columns, d.start, d.end, d.current)
        return [tuple(r) for r in got.orderBy(*d.keys, d.start).collect()]


LOC = "{0},{1},{2},{3},Yes,2024-01-01 00:00:00,2024-01-0{4} 00:00:00"


def test_location_initial_update_redelivery(spark, tmp_path):
    s = Stage(spark, tmp_path, schemas.LOCATION)
    s.deliver("initial.csv", LOC.format(1, "Mumbai", "Maharashtra", 400001, 1), LOC.format(2, "New Delhi", "Delhi", 110001, 1),
              LOC.format(3, "Nowhere", "Atlantis", 1, 1))
    assert s.clean("location_id", "state", "state_code", "is_union_territory", "capital_city_flag", "city_tier") == [
        (1, "Maharashtra", "MH", False, True, "Tier-1"),
        (2, "New Delhi", "DL", True, True, "Tier-3"),
        (3, "Atlantis", "xx", False, False, "Tier-3"),
    ]
    numbers = dict(s.clean("location_id", "location_sk"))
    assert sorted(numbers.values()) == [1, 2, 3]

    s.deliver("update.csv", LOC.format(1, "Mumbai", "Maharashtra", 400002, 2), LOC.format(4, "Agra", "Uttar Pradesh", 282001, 2))
    assert s.clean("location_id", "zip_code") == [(1, "400002"), (2, "110001"), (3, "1"), (4, "282001")]
    assert dict(s.clean("location_id", "location_sk")) == {**numbers, 4: 4}
    assert s.versions("zip_code") == [
        (1, "400001", DAY[0], DAY[1], False),
        (1, "400002", DAY[1], None, True),
        (2, "110001", DAY[0], None, True),
        (3, "1", DAY[0], None, True),
        (4, "282001", DAY[1], None, True),
    ]

    before = s.versions("zip_code")
    s.loader.run(str(s.folder))  # nothing new
    assert s.loader.store.state()["version"] == 1
    s.deliver("again.csv", LOC.format(1, "Mumbai", "Maharashtra", 400002, 2))  # same content under a new name
    assert s.versions("zip_code") == before
    assert s.loader.manifest().count() == 3
    assert s.loader.stage().count() == 6


def test_wrong_delimiter_is_quarantined(spark, tmp_path):
    s = Stage(spark, tmp_path, schemas.LOCATION)
    s.deliver("bad.csv", "9|City|State|1|Yes|2024-01-01|2024-01-01", LOC.format(1, "Agra", "Goa", 1, 1))
    assert s.clean("location_id") == [(1,)]
    assert [r["locationid"] for r in s.loader.quarantined().collect()] == ["9|City|State|1|Yes|2024-01-01|2024-01-01"]


def test_rows_without_a_usable_key_are_quarantined(spark, tmp_path):
    line = "{0},{1},Indian,5,555,9-5,7,Yes,Open,Here,Road,1,1,2024-01-01 10:00:00,2024-01-01 10:00:00"
    s = Stage(spark, tmp_path, schemas.RESTAURANT)
    s.deliver("a.csv", line.format("abc", "One"), line.format("\\N", "Two"), line.format("3", "Three"))
    assert s.clean("restaurant_id", "name") == [(3, "Three")]
    assert sorted(r["name"] for r in s.loader.quarantined().collect()) == ["One", "Two"]


def test_enforced_rules_stop_the_load(spark, tmp_path):
    s = Stage(spark, tmp_path, schemas.LOCATION)
    with pytest.raises(StreamingQueryException, match="zip_code max_length_10: 1 rows"):
        s.deliver("a.csv", LOC.format(1, "Agra", "Goa", "12345678901", 1))
    assert s.clean("location_id") == []


def test_only_bad_rows(spark, tmp_path):
    s = Stage(spark, tmp_path, schemas.LOCATION)
    s.deliver("bad.csv", "9|City")
    assert s.clean("location_id") == []
    assert s.loader.quarantined().count() == 1


def test_strict_entity_aborts_and_nothing_is_committed(spark, tmp_path):
    s = Stage(spark, tmp_path, schemas.LOCATION)
    s.deliver("good.csv", LOC.format(1, "Agra", "Goa", 1, 1))
    with pytest.raises(StreamingQueryException):
        s.deliver("bad.csv", LOC.format("abc", "Agra", "Goa", 1, 1))
    assert s.clean("location_id") == [(1,)]
    assert s.loader.stage().count() == 1
    # Once the file is repaired the same batch goes through.
    s.deliver("bad.csv", LOC.format(2, "Agra", "Goa", 1, 1))
    assert s.clean("location_id") == [(1,), (2,)]


CUST = "{0},{1},900,{2},app,F,{3},\\N,{4},{5},{5}"


def test_customer_insert_then_update_with_nulls_and_two_layouts(spark, tmp_path):
    s = Stage(spark, tmp_path, schemas.CUSTOMER)
    s.deliver("initial.csv", CUST.format("C1", "Ann", "\\N", "1990-02-30", "veg", "2024-01-01 10:00:00"),
              CUST.format("C2", "Bob", "b@x", "1990-02-03", '"a, ""b"""', "2024-01-01T10:00:00.123456"))
    assert s.clean("customer_id", "email", "dob", "preferences", "created_dt") == [
        ("C1", None, None, "veg", dt.datetime(2024, 1, 1, 10)),
        ("C2", "b@x", dt.date(1990, 2, 3), 'a, "b"', dt.datetime(2024, 1, 1, 10, 0, 0, 123456)),
    ]
    s.deliver("insert.csv", CUST.format("C3", "Cid", "c@x", "1990-01-01", "veg", "2024-01-02 10:00:00"))
    s.deliver("both.csv", CUST.format("C1", "Ann", "a@x", "bad", "veg", "2024-01-03 10:00:00"),
              CUST.format("C4", "Dee", "d@x", "1990-01-01", "veg", "2024-01-03 10:00:00"))
    got = [v for v in s.versions("email") if v[0] == "C1"]
    assert got == [("C1", None, DAY[0], DAY[2], False), ("C1", "a@x", DAY[2], None, True)]
    s.deliver("back.csv", CUST.format("C1", "Ann", "\\N", "bad", "veg", "2024-01-04 10:00:00"))
    assert [v[1] for v in s.versions("email") if v[0] == "C1" and v[-1]] == [None]
    assert tagged_columns(s.loader.clean()) == {"mobile": "PII", "email": "EMAIL", "gender": "PII", "dob": "PII"}
    assert mask_tagged(s.loader.dimension()).select("email").distinct().collect() == [("** EMAIL **",)]


def test_restaurant_upsert_bad_numbers(spark, tmp_path):
    line = "{0},{1},Indian,{2},555,9-5,7,Yes,Open,Here,Road,{3},77.1,2024-01-01 10:00:00.123456789,2024-01-01 10:00:00.5"
    s = Stage(spark, tmp_path, schemas.RESTAURANT)
    s.deliver("a.csv", line.format(1, "One", "12.345", "28.1234567"), line.format(2, "Two", "cheap", "north"))
    assert s.clean("restaurant_id", "pricing_for_two", "latitude", "created_dt") == [
        (1, Decimal("12.35"), Decimal("28.123457"), dt.datetime(2024, 1, 1, 10, 0, 0, 123456)),
        (2, None, None, dt.datetime(2024, 1, 1, 10, 0, 0, 123456)),
    ]
    s.deliver("b.csv", line.format(2, "Two", "99.00", "28.0"), line.format(3, "Three", "5", "1"))
    assert s.clean("restaurant_id", "pricing_for_two") == [(1, Decimal("12.35")), (2, Decimal("99.00")), (3, Decimal("5.00"))]
    assert len([v for v in s.versions("pricing_for_two") if v[0] == 2]) == 2


def test_address_maps_state_and_pincode_by_position_and_keeps_its_customer(spark, tmp_path):
    line = "{0},{1},F1,H1,G,B,L,{2},Agra,Uttar Pradesh,282001,\"1,2\",Yes,Home,2024-01-01T00:00:00,2024-01-0{3}T00:00:00"
    s = Stage(spark, tmp_path, schemas.CUSTOMER_ADDRESS)
    s.deliver("a.csv", line.format(1, 10, "Old", 1))
    assert s.clean("state", "pincode", "coordinates") == [("Uttar Pradesh", "282001", "1,2")]
    s.deliver("b.csv", line.format(1, 99, "New", 2))
    assert s.clean("address_id", "customer_id_fk", "locality") == [(1, 10, "New")]


def test_menu_batch_with_the_same_id_twice(spark, tmp_path):
    line = "{0},5, {1} ,desc,{2},Main,{3},Veg,2024-01-01 00:00:00,2024-01-0{4} 00:00:00"
    s = Stage(spark, tmp_path, schemas.MENU, enforce=False)
    s.deliver("a.csv", line.format(1, "Rice", "10.00", "TRUE", 1), line.format(1, "Rice Bowl", "12.00", "False", 3),
              line.format(2, "Soup", "x", "maybe", 1))
    assert s.clean("menu_id", "item_name", "price", "availability") == [
        (1, "Rice Bowl", Decimal("12.00"), False), (2, "Soup", None, None)
    ]
    assert len(s.versions("price")) == 2


def test_agent_keeps_name_rating_keeps_scale(spark, tmp_path):
    line = "{0},{1},{2},Bike,7,On,F,{3},2024-01-01 00:00:00,2024-01-0{4} 00:00:00"
    s = Stage(spark, tmp_path, schemas.DELIVERY_AGENT)
    s.deliver("a.csv", line.format(1, "Ann", "1", "4.55", 1))
    s.deliver("b.csv", line.format(1, "Renamed", "2", "4.60", 2))
    assert s.clean("name", "phone", "rating") == [("Ann", "2", Decimal("4.60"))]
    assert [v[1] for v in s.versions("rating")] == [Decimal("4.55"), Decimal("4.60")]


def test_delivery_reassignment_is_a_second_row(spark, tmp_path):
    line = "{0},{1},{2},{3},30 min,5,2024-01-01 00:00:00,2024-01-01 00:00:00,2024-01-0{4} 00:00:00"
    s = Stage(spark, tmp_path, schemas.DELIVERY)
    s.deliver("a.csv", line.format(1, 100, 7, "Pending", 1))
    s.deliver("b.csv", line.format(1, 100, 8, "Pending", 2), line.format(1, 100, 7, "Delivered", 3))
    assert s.clean("delivery_id", "delivery_agent_id_fk", "delivery_status") == [(1, 7, "Delivered"), (1, 8, "Pending")]


def test_orders_keep_their_first_customer_and_cents(spark, tmp_path):
    line = "{0},{1},3,2024-01-01 12:00:00,{2},{3},CARD,2024-01-01 12:00:00,2024-01-0{4} 12:00:00"
    s = Stage(spark, tmp_path, schemas.ORDERS)
    s.deliver("a.csv", line.format(1, 10, "99.99", "Pending", 1))
    s.deliver("b.csv", line.format(1, 11, "105.49", "Delivered", 2))
    assert s.clean("order_id", "customer_id_fk", "total_amount", "status") == [(1, 10, Decimal("105.49"), "Delivered")]


def test_committed_batch_is_not_applied_again(spark, tmp_path, monkeypatch):
    line = "{0},{1},3,2024-01-01 12:00:00,5,Pending,CARD,2024-01-01 12:00:00,2024-01-01 12:00:00"
    s = Stage(spark, tmp_path, schemas.ORDERS)
    s.deliver("a.csv", line.format(1, 10))
    before = s.loader.store.state()
    batch = s.loader.stage().where("false")
    monkeypatch.setattr(loader_module, "stream_of", lambda batch: before["source"])
    s.loader.load_batch(batch, 0)
    assert s.loader.store.state() == before


def test_batch_interrupted_before_commit_is_repeated(spark, tmp_path, monkeypatch):
    line = "{0},{1},3,2024-01-01 12:00:00,5,Pending,CARD,2024-01-01 12:00:00,2024-01-01 12:00:00"
    s = Stage(spark, tmp_path, schemas.ORDERS)
    s.deliver("a.csv", line.format(1, 10))
    real = s.loader.store.commit

    def fail(*args, **kwargs):
        raise RuntimeError("lost before commit")

    monkeypatch.setattr(s.loader.store, "commit", fail)
    with pytest.raises(StreamingQueryException):
        s.deliver("b.csv", line.format(1, 11), line.format(2, 20))
    assert s.clean("order_id") == [(1,)]
    monkeypatch.setattr(s.loader.store, "commit", real)
    s.loader.run(str(s.folder))
    assert s.clean("order_id", "orders_sk") == [(1, 1), (2, 2)]
    assert s.loader.stage().count() == 3


def test_a_table_keeps_its_buckets(spark, tmp_path):
    s = Stage(spark, tmp_path, schemas.LOCATION)
    s.deliver("a.csv", *[LOC.format(k, "Agra", "Goa", k, 1) for k in range(1, 40)])
    root = str(tmp_path / "tables")
    with pytest.raises(ValueError, match="4 buckets, not 8"):
        EntityLoader(spark, schemas.LOCATION, root, buckets=8).clean()
    s.loader = EntityLoader(spark, schemas.LOCATION, root, clock=lambda b: DAY[b])
    s.deliver("b.csv", *[LOC.format(k, "Pune", "Goa", k, 2) for k in (3, 50)])
    assert [r[0] for r in s.clean("location_id")] == [*range(1, 40), 50]
    assert sum(v[-1] for v in s.versions("city")) == 40


def test_a_lost_checkpoint_neither_loses_nor_doubles_rows(spark, tmp_path):
    s = Stage(spark, tmp_path, schemas.LOCATION)
    for k in (1, 2, 3):
        s.deliver(f"{k}.csv", LOC.format(k, "Agra", "Goa", k, k))
    (tmp_path / "tables" / "location" / "checkpoint").rename(tmp_path / "lost")
    s.deliver("4.csv", LOC.format(4, "Agra", "Goa", 4, 4))
    s.deliver("5.csv", LOC.format(5, "Agra", "Goa", 5, 5))
    assert [r[0] for r in s.clean("location_id")] == [1, 2, 3, 4, 5]
    assert s.loader.stage().count() == 5
    assert len(s.versions("city")) == 5


def test_forced_reload(spark, tmp_path):
    s = Stage(spark, tmp_path, schemas.LOCATION)
    s.deliver("a.csv", LOC.format(1, "Agra", "Goa", 1, 1))
    s.loader.run(str(s.folder), force=True)
    assert s.loader.stage().count() == 2
    assert s.clean("location_id") == [(1,)]
    s.deliver("b.csv", LOC.format(2, "Agra", "Goa", 2, 2))
    assert s.loader.stage().count() == 3
    assert s.clean("location_id") == [(1,), (2,)]


def test_rules_hold_for_rows_that_later_ones_replace(spark, tmp_path):
    s = Stage(spark, tmp_path, schemas.LOCATION)
    with pytest.raises(StreamingQueryException, match="zip_code max_length_10: 1 rows"):
        s.deliver("a.csv", LOC.format(1, "Agra", "Goa", "12345678901", 1), LOC.format(1, "Agra", "Goa", "1", 2))


def test_every_entity_has_a_clean_schema(spark):
    for entity in schemas.ENTITIES.values():
        df = empty_clean(spark, entity)
        assert set(entity.keys) <= set(df.columns)
        assert latest_rows(df, entity).columns == df.columns
        if entity.dimension:
            assert set(entity.dimension.attrs) <= set(df.columns)


def test_quarantined_rows_come_back_once(spark, tmp_path, monkeypatch):
    s = Stage(spark, tmp_path, schemas.LOCATION)
    right = [LOC.format(k, "Agra", "Goa", k, 1) for k in (1, 2, 3)]
    s.deliver("a.csv", *[line.replace(",", "|") for line in right], LOC.format(4, "Pune", "Goa", 4, 1), "9|too|short")
    s.deliver("b.csv", LOC.format(2, "Delhi", "Goa", 2, 1))  # loaded later than the row that waits
    position = s.loader.store.state()
    again = lambda rows: resplit(rows, s.entity.file_columns, "|").where("city <> 'too'")
    real = s.loader.store.commit
    with monkeypatch.context() as patch:
        patch.setattr(s.loader.store, "commit", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            s.loader.replay(again)
    assert s.loader.waiting().count() == 4 and real == s.loader.store.commit
    assert s.loader.replay(again)
    want = [(1, "Agra"), (2, "Delhi"), (3, "Agra"), (4, "Pune")]
    assert s.clean("location_id", "city") == want
    state = s.loader.store.state()
    assert (state["source"], state["batch"]) == (position["source"], position["batch"])
    assert not s.loader.replay(again) and s.loader.store.state() == state
    s.deliver("c.csv", LOC.format(5, "Goa", "Goa", 5, 1))  # the stream goes on where it was
    assert s.clean("location_id", "city") == [*want, (5, "Goa")]
    assert s.loader.quarantined().count() == 4 and s.loader.stage().count() == 7


def test_rows_that_stay_unusable_wait_again(spark, tmp_path):
    s = Stage(spark, tmp_path, schemas.LOCATION)
    assert not s.loader.replay(lambda rows: rows)
    s.deliver("a.csv", "9|City")
    assert s.loader.replay(lambda rows: rows)
    assert s.loader.waiting().count() == 1 and s.clean("location_id") == []


def test_batches_are_counted_as_they_pass(spark, tmp_path):
    s = Stage(spark, tmp_path, schemas.LOCATION)
    with ProgressLog(spark, str(tmp_path / "progress")) as log:
        s.deliver("a.csv", LOC.format(1, "Agra", "Goa", 1, 1), LOC.format(1, "Pune", "Goa", 1, 2), "9|City", LOC.format(2, "Goa", "Goa", 2, 1))
        s.deliver("b.csv", LOC.format(2, "Delhi", "Goa", 2, 1))
    assert log.failed == []
    manifest = s.loader.manifest().groupBy("batch").agg(F.sum("row_count").alias("n"))
    want = sorted(map(tuple, manifest.collect()))
    assert want == [(0, 4), (1, 1)]
    assert sorted((r.batch, r.n) for r in log.counts("location_arrived").collect()) == want
    assert sorted((r.batch, r.staged, r.quarantined, r.merged) for r in s.loader.metrics().collect()) == [(0, 4, 1, 2), (1, 1, 0, 1)]


def test_closed_versions_are_written_once(spark, tmp_path):
    s = Stage(spark, tmp_path, schemas.LOCATION)
    root = tmp_path / "tables" / "location"

    def closed():
        return {p.relative_to(root): p.stat().st_mtime_ns for p in (root / "closed").rglob("*.parquet")}

    before = {}
    for day, city in enumerate(("Agra", "Pune", "Goa"), 1):
        s.deliver(f"{day}.csv", *[LOC.format(k, city, "Goa", k, day) for k in range(1, 30)], LOC.format(99, "Same", "Goa", 1, 1))
        assert before.items() <= closed().items()
        before = closed()
    assert [len(spark.read.parquet(str(root / "closed" / f"batch={b}")).collect()) for b in range(3)] == [0, 29, 29]
    live = s.loader.store.state()["tables"]["dimension"]
    now = spark.read.parquet(*[str(root / "dimension" / f"v={v}" / f"_bucket={b}") for b, v in live.items()])
    assert now.count() == 30 and now.where("NOT current_flag").count() == 0
    log = [(k, c, "Goa", DAY[d], d) for d, c in enumerate(("Agra", "Pune", "Goa")) for k in range(1, 30)] + [(99, "Same", "Goa", DAY[d], d) for d in range(3)]
    replayed = scd2_history(spark.createDataFrame(log, "location_id long, city string, state string, ts timestamp_ntz, seq int"), ["location_id"], ["city", "state"], "ts", "seq")
    columns = ["location_id", "city", "state"]
    want = replayed.select(*columns, "eff_start_date", "eff_end_date", "is_current")
    got = s.loader.dimension().select(*columns, "eff_start_dt", "eff_end_dt", "current_flag")
    assert sorted(map(str, got.collect())) == sorted(str(r).replace("eff_start_date", "eff_start_dt").replace("eff_end_date", "eff_end_dt").replace("is_current", "current_flag") for r in want.collect())


def test_first_load_joins_no_table_and_does_not_shuffle_for_file_keys(spark, tmp_path, monkeypatch):
    """A first load numbers its rows as they are; the content keys of its files are broadcast to the staged rows."""
    plans = []

    def watched(df, path):
        plans.append((path, df._jdf.queryExecution().executedPlan().toString()))
        return write_counted(df, path)

    write = TableStore.write

    def watched_write(self, table, rows, *rest):
        plans.append((table, rows._jdf.queryExecution().optimizedPlan().toString()))
        return write(self, table, rows, *rest)

    write_counted = loader_module.write_counted
    monkeypatch.setattr(loader_module, "write_counted", watched)
    monkeypatch.setattr(TableStore, "write", watched_write)
    header = ",".join(f"H{i}" for i in range(len(schemas.ORDERS.file_columns)))
    line = "{0},10,5,2024-05-01 12:00:00,10.00,{1},CARD,2024-05-01 12:00:00,2024-05-0{2} 12:00:00"
    (tmp_path / "in").mkdir()
    loader = EntityLoader(spark, schemas.ORDERS, str(tmp_path / "tables"), buckets=2, feed=True)
    (tmp_path / "in" / "1.csv").write_text("\n".join([header, line.format(1, "Open", 1), line.format(2, "Open", 1)]) + "\n")
    loader.run(str(tmp_path / "in"))
    staged = next(p for path, p in plans if "/stage/" in path)
    assert "BroadcastHashJoin" in staged and "SortMergeJoin" not in staged
    assert "Join FullOuter" not in dict(plans)["clean"] and "Join LeftAnti" not in dict(plans)["clean"]
    numbers = {r["order_id"]: r["orders_sk"] for r in loader.clean().collect()}
    assert sorted(numbers.values()) == [1, 2]
    (tmp_path / "in" / "2.csv").write_text("\n".join([header, line.format(2, "Done", 2), line.format(3, "Open", 2)]) + "\n")
    loader.run(str(tmp_path / "in"))
    assert {r["order_id"]: (r["orders_sk"], r["status"]) for r in loader.clean().collect()} == {
        1: (numbers[1], "Open"), 2: (numbers[2], "Done"), 3: (3, "Open"),
    }
