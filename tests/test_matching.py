import datetime as dt

from larder.streaming.matching import MatchLog, match_streams

T0 = dt.datetime(2024, 1, 1)
LEFT, RIGHT = "k long, item string, changed_at timestamp_ntz", "order_id long, status string, seen_at timestamp_ntz"


def at(hour):
    return T0 + dt.timedelta(hours=hour)


def test_pairs_whichever_comes_first_and_no_endless_state(spark, tmp_path):
    log = MatchLog(spark, str(tmp_path / "log"))
    runs = []

    def run(left, right):
        for name, rows, schema in (("left", left, LEFT), ("right", right, RIGHT)):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        sides = (spark.readStream.schema(s).parquet(str(tmp_path / n)) for n, s in (("left", LEFT), ("right", RIGHT)))
        pairs = match_streams(*sides, on=("k", "order_id"), times=("changed_at", "seen_at"), within="2 hours", late="1 hour")
        runs.append(log.run(pairs))
        got = log.pairs(pairs.schema)
        return sorted((r.k, r.item, r.status) for r in got.collect()), log.counts(pairs.schema, "order_id")

    # Order 1 waits for its lines, a line of 2 for its order; nulls wait for nothing.
    got, _ = run([(2, "c", at(0)), (None, "n", at(0)), (3, "t", None)], [(1, "new", at(0)), (None, "n", at(0)), (3, "t", at(0))])
    assert got == []
    got, counts = run([(1, "a", at(1)), (1, "b", at(2)), (1, "far", at(3))], [(2, "new", at(1)), (2, "done", at(2))])
    assert got == [(1, "a", "new"), (1, "b", "new"), (2, "c", "done"), (2, "c", "new")]
    assert sorted(map(tuple, counts.collect())) == [(1, 2), (2, 2)]
    # Time goes on; what is older than the watermark has left the state.
    run([(8, "x", at(50))], [(9, "y", at(50))])
    got, _ = run([(1, "too late", at(1))], [(8, "in time", at(51))])
    assert got == [(1, "a", "new"), (1, "b", "new"), (2, "c", "done"), (2, "c", "new"), (8, "x", "in time")]
    kept = runs[-1].lastProgress["stateOperators"][0]["numRowsTotal"]
    assert kept <= 4
    assert run([], [])[0] == got
