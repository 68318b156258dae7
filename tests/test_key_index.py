"""Checks of batches against the checks of whole tables."""

import random

import pytest
from pyspark.sql import types as T

from larder.operators.lookup import orphans
from larder.operators.quality import duplicate_keys
from larder.streaming.key_index import RANGE, KeyIndex

ONE = T.StructType([T.StructField("id", T.LongType())])
TWO = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
ROW = "id bigint, name string"


@pytest.mark.parametrize("keys,how", [(ONE, {"span": 10}), (ONE, {"ranges": 7}), (TWO, {"ranges": 5})])
def test_batches_equal_the_whole(spark, tmp_path, keys, how):
    rng = random.Random(len(keys) + len(how))
    index, known, everything = KeyIndex(spark, str(tmp_path), keys, **how), {}, []
    for batch in range(4):
        data = [(rng.choice([None, *range(-40, 40)]), rng.choice([None, "a", "b", ""])) for _ in range(30)]
        rows = spark.createDataFrame(data, ROW)
        everything += data
        found = {tuple(r)[:-1]: r.n for r in index.duplicates(rows, batch).collect()}
        index.add(rows, batch)
        index.add(rows, batch)  # delivered again
        assert {tuple(r)[:-1]: r.n for r in index.duplicates(rows, batch).collect()} == found
        known |= found
        whole = duplicate_keys(spark.createDataFrame(everything, ROW), keys.names)
        assert known == {tuple(r)[:-1]: r.n for r in whole.collect()}


def test_only_touched_ranges_are_read(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), ONE, span=100)
    index.add(spark.range(0, 1000), 0)
    asked = index.counted(spark.range(250, 320))
    files = [p for p in index.meeting(asked)._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in p]
    assert files and all("_range" in p.split("PartitionFilters")[1] for p in files)
    # What the scan of those ranges gives, and no other.
    assert {r[0] for r in index.meeting(asked).select(RANGE).distinct().collect()} == {2, 3}
    assert index.meeting(asked).count() == 70


def test_references(spark, tmp_path):
    """Lines before and after their parents; what is open is asked again only."""
    parents, lines = KeyIndex(spark, str(tmp_path), ONE, span=3), []
    open_refs = spark.createDataFrame([], "value bigint, n bigint")
    arrived = []
    steps = [([1, 2, 2, None], []), ([7, -1], [1, 7]), ([2, 9], [8, 2]), ([], [9]), ([-1], [])]
    for batch, (refs, new) in enumerate(steps):
        parents.add(spark.createDataFrame([(n,) for n in new], "id bigint"), batch)
        arrived += new
        rows = spark.createDataFrame([(r,) for r in refs], "ref bigint")
        lines += refs
        late = parents.missing(open_refs, "value", batch)
        fresh = parents.missing(rows, "ref", batch)
        total = late.union(fresh).groupBy("value").sum("n").collect()
        open_refs = spark.createDataFrame([tuple(r) for r in total], "value bigint, n bigint")
        whole = orphans(
            spark.createDataFrame([(r,) for r in lines], "ref bigint"), {"ref": (spark.createDataFrame([(n,) for n in arrived], "id bigint"), "id")}
        ).first()
        assert (sum(r[1] for r in total), len(total)) == (whole.orphan_rows, whole.orphan_keys)
    assert {tuple(r) for r in total} == {(-1, 2)}


def test_half_written_batches_are_not_seen(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), ONE, span=10)
    rows = spark.createDataFrame([(1,)], "id bigint")
    index.add(rows, 5)
    assert index.duplicates(rows, 5).count() == 0 and index.duplicates(rows, 6).count() == 1
    assert index.missing(rows, "id", 4).count() == 1 and index.missing(rows, "id", 5).count() == 0


def test_empty_and_text_references(spark, tmp_path):
    index, none = KeyIndex(spark, str(tmp_path), ONE, span=10), spark.createDataFrame([], "id bigint")
    assert index.duplicates(none, 0).count() == 0 and index.missing(none, "id").count() == 0
    index.add(none, 0)
    assert index.rows().count() == 0
    index.add(spark.createDataFrame([(12,)], "id bigint"), 1)
    text = spark.createDataFrame([("12",), ("13",)], "ref string")
    assert [tuple(r) for r in index.missing(text, "ref").collect()] == [(13, 1)]


def test_span_needs_a_whole_number(spark, tmp_path):
    for keys, span in ((TWO, 5), (T.StructType([T.StructField("name", T.StringType())]), 5), (ONE, 0)):
        with pytest.raises(ValueError):
            KeyIndex(spark, str(tmp_path), keys, span=span)
