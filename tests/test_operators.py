import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.functions import masking
from larder.operators.change_set import change_set
from larder.operators.dedupe import latest_per_key
from larder.operators.lookup import lasting, lookup, lookup_along_history, match_audit, orphans
from larder.operators.merge import merge_upsert
from larder.operators.quality import QualityError, column_violations, duplicate_keys, quarantine, require_clean
from larder.operators.scd2 import FIRST, apply_rows, apply_scd2, Dimension, open_versions, scd2_history, without_place
from larder.operators.surrogate import surrogate_key

DIM = Dimension("d", "hk", ("k",), ("a", "b"))
SCHEMA = "k bigint, a string, b string"
T = [dt.datetime(2024, 1, d) for d in range(1, 9)]


def snap(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def replay(spark, snapshots, mode="corrected", dim=DIM):
    """Feed snapshots one after the other through change sets into a dimension."""
    table, before = dim.empty_like(snapshots[0]), snapshots[0].where("false")
    for ts, state in zip(T, snapshots):
        table = apply_scd2(table, change_set(before, state, dim.keys), dim, ts, mode)
        before = state
    return table


def versions(table):
    return [tuple(r) for r in table.select("k", "a", "b", "eff_start_date", "eff_end_date", "is_current").orderBy("k", "eff_start_date").collect()]


# Change sets ----------------------------------------------------------------


def test_change_set_kinds(spark, rows):
    old = snap(spark, (1, "a", None), (2, "b", "x"), (3, "c", "x"), (4, None, None))
    new = snap(spark, (1, "a", "y"), (2, "b", "x"), (4, None, None), (5, "e", "x"))
    assert rows(change_set(old, new, ["k"])) == rows(
        spark.createDataFrame(
            [
                (1, "a", None, "DELETE", True),
                (1, "a", "y", "INSERT", True),
                (3, "c", "x", "DELETE", False),
                (5, "e", "x", "INSERT", False),
            ],
            SCHEMA + ", _action string, _is_update boolean",
        )
    )


def test_change_set_compares_only_named_columns(spark):
    old, new = snap(spark, (1, "a", "file1")), snap(spark, (1, "a", "file2"))
    assert change_set(old, new, ["k"], compare=["a"]).count() == 0


def test_change_set_sees_rows_of_nulls_appear(spark, rows):
    old, new = snap(spark).where("false"), snap(spark, (1, None, None))
    assert rows(change_set(old, new, ["k"])) == [(1, None, None, "INSERT", False)]


# Upserts --------------------------------------------------------------------

keyed = st.dictionaries(st.integers(1, 6), st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from(["p", None])), max_size=6)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keyed, keyed)
def test_merge_matches_dict_update_and_is_idempotent(spark, t, s):
    target = snap(spark, *[(k, *v) for k, v in t.items()])
    source = snap(spark, *[(k, *v) for k, v in s.items()])
    want = {**t, **s}
    for small in (False, True):
        once = merge_upsert(target, source, ["k"], small_source=small)
        twice = merge_upsert(once, source, ["k"], small_source=small)
        for df in (once, twice):
            assert {r["k"]: (r["a"], r["b"]) for r in df.collect()} == want
            assert df.columns == ["k", "a", "b"]


def test_merge_updates_only_named_columns(spark, rows):
    merged = merge_upsert(snap(spark, (1, "a", "b")), snap(spark, (1, "A", "B"), (2, "A", "B")), ["k"], update_cols=["a"])
    assert rows(merged) == [(1, "A", "b"), (2, "A", "B")]


@pytest.mark.parametrize("old, new, taken", [("a", "a", False), ("a", None, True), (None, "a", True), (None, None, False)])
def test_merge_guard_treats_null_as_value(spark, old, new, taken):
    merged = merge_upsert(snap(spark, (1, old, "b")), snap(spark, (1, new, "B")), ["k"], changed_on=["a"])
    assert merged.first()["b"] == ("B" if taken else "b")


def test_merge_keeps_types_and_tags(spark):
    target = masking.tag_columns(snap(spark, (1, "a", "b")), {"a": "PII"})
    source = spark.createDataFrame([("2", 5, 6)], "k string, a int, b int")
    merged = merge_upsert(target, source, ["k"])
    assert [f.dataType for f in merged.schema] == [f.dataType for f in target.schema]
    assert masking.tagged_columns(merged) == {"a": "PII"}


def test_latest_per_key(spark, rows):
    data = [(1, "old", 1), (1, "new", 2), (2, "only", None), (3, "tie-a", 5), (3, "tie-b", 5)]
    df = spark.createDataFrame(data, "k int, v string, n int")
    assert rows(latest_per_key(df, ["k"], ["n"])) == [(1, "new", 2), (2, "only", None), (3, "tie-b", 5)]


# Surrogate numbers ----------------------------------------------------------


def test_surrogate_numbers_are_dense_and_repeatable(spark):
    df = spark.range(0, 5000, 1, 7).withColumnRenamed("id", "k")
    first = {r["k"]: r["sk"] for r in surrogate_key(df, ["k"], "sk", start_after=10).collect()}
    again = {r["k"]: r["sk"] for r in surrogate_key(df.repartition(3), ["k"], "sk", start_after=10).collect()}
    assert sorted(first.values()) == list(range(11, 5011))
    assert first == again


# Versioned dimensions -------------------------------------------------------


def test_insert_update_and_unchanged(spark):
    got = versions(replay(spark, [snap(spark, (1, "a", "x"), (2, "b", "x")), snap(spark, (1, "A", "x"), (2, "b", "x"), (3, "c", "x"))]))
    assert got == [
        (1, "a", "x", T[0], T[1], False),
        (1, "A", "x", T[1], None, True),
        (2, "b", "x", T[0], None, True),
        (3, "c", "x", T[1], None, True),
    ]


def test_going_back_to_an_old_value_opens_a_version(spark):
    states = [snap(spark, (1, v, "x")) for v in ("A", "B", "A")]
    assert versions(replay(spark, states)) == [
        (1, "A", "x", T[0], T[1], False), (1, "B", "x", T[1], T[2], False), (1, "A", "x", T[2], None, True)
    ]
    # The literal rules find the closed A row and leave the key without a current version.
    assert not any(v[-1] for v in versions(replay(spark, states, mode="as_written")))


def test_redelivered_equal_row_changes_nothing(spark):
    table = open_versions(snap(spark, (1, "a", None)), DIM, T[0])
    pair = spark.createDataFrame(
        [(1, "a", None, "DELETE", True), (1, "a", None, "INSERT", True)], SCHEMA + ", _action string, _is_update boolean"
    )
    assert versions(apply_scd2(table, pair, DIM, T[1])) == [(1, "a", None, T[0], None, True)]


def test_null_attributes_close_and_open(spark):
    got = versions(replay(spark, [snap(spark, (1, None, "x")), snap(spark, (1, "a", "x")), snap(spark, (1, None, "x"))]))
    assert [v[1] for v in got] == [None, "a", None]
    assert [v[-1] for v in got] == [False, False, True]


def test_key_that_only_disappears_stays_open(spark):
    got = versions(replay(spark, [snap(spark, (1, "a", "x"), (2, "b", "x")), snap(spark, (2, "b", "x"))]))
    assert got == [(1, "a", "x", T[0], None, True), (2, "b", "x", T[0], None, True)]


def test_literal_location_rule_loses_the_update(spark):
    dim = Dimension("d", "hk", ("k",), ("a", "b"), match_on=("k", "b"))
    states = [snap(spark, (1, "a", "Yes")), snap(spark, (1, "A", "Yes"))]
    assert versions(replay(spark, states, "as_written", dim)) == [(1, "a", "Yes", T[0], T[1], False)]
    assert [v[1] for v in versions(replay(spark, states, "corrected", dim))] == ["a", "A"]


def test_version_keys_differ_between_equal_versions(spark):
    table = replay(spark, [snap(spark, (1, v, "x")) for v in ("A", "B", "A")])
    assert table.select("hk").distinct().count() == 3


def random_log(n, keys, seed, hot=0.4):
    """(k, a, b, ts, seq): one key holds ``hot`` of the rows."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = 0 if rnd.random() < hot else rnd.randrange(1, keys)
        ts = dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(24 * 20))
        out.append((k, rnd.choice(["x", "y", None]), rnd.choice(["p", None]), ts, i))
    return out


def expected_history(log):
    out = []
    by_key = {}
    for row in sorted(log, key=lambda r: (r[0], r[3], r[4])):
        by_key.setdefault(row[0], []).append(row)
    for k, entries in by_key.items():
        kept = [e for i, e in enumerate(entries) if i == 0 or e[1:3] != entries[i - 1][1:3]]
        for i, e in enumerate(kept):
            end = kept[i + 1][3] if i + 1 < len(kept) else None
            out.append((k, e[1], e[2], e[3], end, end is None))
    return out


@pytest.mark.parametrize("bucket", ["hour", "day", "month"])
def test_history_equals_brute_force(spark, rows, bucket):
    log = random_log(1500, 9, seed=3)
    df = spark.createDataFrame(log, SCHEMA + ", ts timestamp_ntz, seq int")
    got = scd2_history(df, ["k"], ["a", "b"], "ts", "seq", bucket)
    want = spark.createDataFrame(
        expected_history(log), SCHEMA + ", eff_start_date timestamp_ntz, eff_end_date timestamp_ntz, is_current boolean"
    )
    assert rows(got) == rows(want)


def test_batches_leave_the_same_dimension_as_the_bulk_build(spark, rows):
    rnd = random.Random(11)
    state, log, snapshots = {}, [], []
    for n, ts in enumerate(T[:5]):
        for k in range(6):
            if rnd.random() < 0.5:
                state[k] = (rnd.choice(["x", "y", None]), rnd.choice(["p", None]))
        log += [(k, *v, ts, n) for k, v in state.items()]
        snapshots.append(snap(spark, *[(k, *v) for k, v in state.items()]))
    bulk = scd2_history(spark.createDataFrame(log, SCHEMA + ", ts timestamp_ntz, seq int"), ["k"], ["a", "b"], "ts", "seq")
    stepwise = replay(spark, snapshots).select("k", "a", "b", "eff_start_date", "eff_end_date", "is_current")
    assert rows(stepwise) == rows(bulk)
    live = stepwise.where("is_current").groupBy("k").count()
    assert live.where("count <> 1").count() == 0 and live.count() == len(state)


# Lookups --------------------------------------------------------------------


def test_lookups_equal_brute_force(spark, rows):
    log = random_log(400, 5, seed=5)
    dim_df = scd2_history(spark.createDataFrame(log, SCHEMA + ", ts timestamp_ntz, seq int"), ["k"], ["a", "b"], "ts", "seq")
    dim_df = dim_df.withColumn("hk", F.xxhash64("k", "eff_start_date"))
    rnd = random.Random(6)
    probes = [(i, rnd.randrange(7), dt.datetime(2023, 12, 30) + dt.timedelta(minutes=rnd.randrange(25 * 1440))) for i in range(600)]
    facts = spark.createDataFrame(probes, "id int, k bigint, at timestamp_ntz")
    vs = [r for r in dim_df.collect()]

    def brute(k, at):
        # Zero-length versions never match; the first other one covers the time before it; at most one matches.
        mine = [v for v in vs if v["k"] == k and (v["eff_end_date"] is None or v["eff_start_date"] < v["eff_end_date"])]
        begin = min((v["eff_start_date"] for v in mine), default=None)
        hits = [v["hk"] for v in mine if (v["eff_start_date"] in (begin,) or v["eff_start_date"] <= at) and (v["eff_end_date"] is None or at < v["eff_end_date"])]
        assert len(hits) <= 1
        return hits[0] if hits else None

    want = sorted((i, brute(k, at)) for i, k, at in probes)
    by_join = lookup(facts, dim_df, DIM, F.col("k"), {"hk": "key"}, F.col("at"))
    along = lookup_along_history(facts, dim_df, DIM, "at", "hk", "key")
    assert sorted((r["id"], r["key"]) for r in by_join.collect()) == want
    assert sorted((r["id"], r["key"]) for r in along.collect()) == want
    # The order of the dimension's rows plays no part.
    for seed in (1, 2, 3):
        shuffled = dim_df.orderBy(F.rand(seed)).repartition(3)
        again = lookup_along_history(facts, shuffled, DIM, "at", "hk", "key")
        assert sorted((r["id"], r["key"]) for r in again.collect()) == want


def test_lookup_takes_the_current_version_without_a_moment(spark, rows):
    table = replay(spark, [snap(spark, (1, "a", "x")), snap(spark, (1, "b", "x"))])
    facts = spark.createDataFrame([(1,), (2,), (None,)], "f bigint")
    assert rows(lookup(facts, table, DIM, F.col("f"), {"a": "a"})) == [(None, None), (1, "b"), (2, None)]


def test_orphans_counts_rows_and_values(spark, rows):
    facts = spark.createDataFrame([(1, 7), (1, 8), (9, None), (9, 7), (8, 7)], "x bigint, y bigint")
    parents = {"x": (spark.createDataFrame([(1,)], "id bigint"), "id"), "y": (spark.createDataFrame([(7,), (8,)], "id bigint"), "id")}
    assert rows(orphans(facts, parents)) == [("x", 3, 2), ("y", 0, 0)]


def test_orphans_with_text_keys(spark, rows):
    facts = spark.createDataFrame([("C1", 1), ("C9", 1), (None, 2)], "c string, n int")
    parents = {"c": (spark.createDataFrame([("C1",)], "id string"), "id"), "n": (spark.createDataFrame([(1,)], "id bigint"), "id")}
    assert rows(orphans(facts, parents)) == [("c", 1, 1), ("n", 1, 1)]


def test_match_audit_counts_pairs(spark, rows):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "a bigint")
    right = spark.createDataFrame([(1,), (1,), (1,), (3,), (None,)], "b bigint")
    assert rows(match_audit(left, right, [("a", "b")])) == [(1, 1, 6)]


def test_log_entries_without_key_or_time_are_returned(spark, rows):
    log = spark.createDataFrame([(1, "a", None, T[0], 1), (None, "a", None, T[0], 2), (2, "a", None, None, 3)], SCHEMA + ", ts timestamp_ntz, seq int")
    assert scd2_history(log, ["k"], ["a", "b"], "ts", "seq").count() == 1
    assert rows(without_place(log, ["k"], "ts"), "seq") == [(2,), (3,)]


def test_small_source_leaves_the_target_where_it_is(spark):
    target = spark.range(100_000).select(F.col("id").alias("k"), F.lit("a").alias("a"))
    source = spark.range(50_000, 150_000, 20).select(F.col("id").alias("k"), F.lit("b").alias("a"))
    merged = merge_upsert(target, source, ["k"], small_source=True)
    assert merged.count() == 102_500
    assert "Exchange hashpartitioning" not in merged._jdf.queryExecution().executedPlan().toString()


def test_source_that_is_not_small_is_not_broadcast(spark, rows, monkeypatch):
    target, source = snap(spark, (1, "a", "b"), (2, "c", None), (None, "n", "n")), snap(spark, (2, "C", "D"), (3, None, "E"), (None, "m", "m"))
    small = merge_upsert(target, source, ["k"], small_source=True)
    monkeypatch.setattr("larder.operators.merge.SMALL_SOURCE_BYTES", 100)
    large = merge_upsert(target, source, ["k"], small_source=True)
    assert rows(large) == rows(small) == rows(merge_upsert(target, source, ["k"]))
    assert "BroadcastExchange" in small._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in large._jdf.queryExecution().executedPlan().toString()


# Quality --------------------------------------------------------------------


def test_column_violations(spark, rows):
    df = snap(spark, (1, "long text", None), (2, None, "x"), (None, "ok", "x"))
    got = rows(column_violations(df, ["k", "a", "b"], {"a": 4}))
    assert got == [("a", "max_length_4", 1), ("a", "not_null", 1), ("b", "not_null", 1), ("k", "not_null", 1)]
    with pytest.raises(QualityError, match="k not_null: 1 rows"):
        require_clean(df, ["k"])
    assert require_clean(df.where("k is not null"), ["k"]).count() == 2


def test_duplicate_keys(spark, rows):
    assert rows(duplicate_keys(snap(spark, (1, "a", "b"), (1, "c", "d"), (2, "e", "f")), ["k"])) == [(1, 2)]


def test_quarantine_keeps_rows_without_id(spark, rows):
    df = spark.createDataFrame([("1",), ("2|x",), (None,)], "id string")
    kept, bad = quarantine(df, F.col("id").like("%|%"))
    assert rows(kept) == [(None,), ("1",)]
    assert rows(bad) == [("2|x",)]


def test_the_mark_of_first_versions_is_kept_and_used(spark):
    """With the mark a dated lookup gives what sorting the versions gives, and sorts nothing."""
    rows = [[(k, f"{k % 3}-{step % (k % 4 + 1)}", "x") for k in range(12) if k % 5 != step % 5] for step in range(5)]
    times = [T[0], T[1], T[1], T[2], T[3]]  # two loads at one moment: the version between them never lasts
    table = DIM.empty_like(snap(spark, *rows[0]), marked=True)
    for load, ts in zip(rows, times):
        table = apply_rows(table, snap(spark, *load), DIM, ts)
    plain = table.drop(FIRST)
    assert plain.columns == DIM.columns
    found, want = (sorted(map(str, lasting(t, DIM).select(*DIM.columns, FIRST).collect())) for t in (table, plain))
    assert found == want
    facts = spark.createDataFrame([(k, t - dt.timedelta(days=d)) for k in range(13) for t in T[:4] for d in (-1, 0, 1)], "fk long, at timestamp_ntz")
    take = {DIM.hash_key: "found", "a": "value"}
    results = [lookup(facts, t, DIM, F.col("fk"), take, F.col("at")) for t in (table, plain)]
    assert sorted(map(str, results[0].collect())) == sorted(map(str, results[1].collect()))
    flat = spark.createDataFrame(table.collect(), table.schema)
    plan = lookup(facts, flat, DIM, F.col("fk"), take, F.col("at"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
