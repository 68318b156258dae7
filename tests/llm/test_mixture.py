import hashlib
import math
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from larder.llm.mixture import SEED, mixed_texts, mixture, targets

DOCS = "doc_id long, text string, source string, key string, taken int"


def plain_targets(sizes, weights, share, most):
    """source -> target by repeated sharing, in fractions."""
    full, budget = {}, sum(sizes.values()) * share
    while True:
        free = {s: w for s, w in weights.items() if s not in full and w > 0}
        left = budget - sum(full.values())
        got = {s: left * w / sum(free.values()) for s, w in free.items()}
        above = [s for s in free if got[s] > most * sizes[s]]
        if not above:
            return {s: full.get(s, got.get(s, Fraction(0))) for s in sizes}
        full |= {s: Fraction(most * sizes[s]) for s in above}


def plain_mix(rows, weights=(3, 1, 2), share=Fraction(3, 2), most=2):
    docs = []
    for i, t, s in rows:
        t = t or ""
        symbols = len(re.findall(r"[!-@\[-`{-~]", t)) / max(len(t), 1)
        name = f"{SEED}:{'' if i is None else i}:{hashlib.md5(t.encode()).hexdigest()}"
        u = (int(hashlib.sha256(name.encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
        docs.append((i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t)), -math.log(u) / max(0.05, 1 - 4 * symbols)))
    sizes = {}
    for _, s, n, _ in docs:
        sizes[s] = sizes.get(s, 0) + n
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    goal = plain_targets(sizes, {s: weights[k % len(weights)] for k, s in enumerate(order)}, share, most)
    out = []
    for s in order:
        epochs, rest = divmod(math.floor(goal[s]), sizes[s]) if sizes[s] else (0, 0)
        for i, _, n, _ in sorted((d for d in docs if d[1] == s), key=lambda d: (d[3], d[0] is None, d[0] or 0, d[2])):
            part = min(max(rest, 0), n)
            rest -= n
            out.append((i, n, sizes[s], float(goal[s]), epochs * n + part))
    return out


def as_key(row):
    return tuple(map(str, row))


def some_docs():
    rows = [(k, f"w{k} " * (1 + k * k % 37), f"s{k % 5}") for k in range(150)]
    rows += [(200 + k, "one two 3 4 5!", "hot") for k in range(200)]  # copies in a hot source
    rows += [(7, "seven", "s1")] * 3  # repeated rows
    rows += [(None, "no id", "s2"), (None, "no id", "s2"), (None, "other", None), (500, "no source at all", None), (501, None, None)]
    rows += [(600, "", "blank"), (601, " \n\t", "blank"), (602, None, "blank")]
    rows += [(700, "long " * 60_000, "é"), (701, "short", "é"), (702, "emoji 😀 x", "😀")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1) for r in rows], DOCS).repartition(6)


def test_mix_as_brute_force(spark):
    rows = some_docs()
    found = mixture(frame(spark, rows)).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(tuple, found), key=as_key) == sorted(plain_mix(rows), key=as_key)


def test_reruns_agree_and_many_sources_are_joined(spark, monkeypatch):
    rows = some_docs()
    docs = frame(spark, rows)
    first = sorted(map(tuple, mixture(docs).collect()), key=as_key)
    monkeypatch.setattr("larder.llm.mixture.BROADCAST_SOURCES", 0)
    assert sorted(map(tuple, mixture(docs.repartition(3)).collect()), key=as_key) == first


@pytest.mark.parametrize(("weights", "share", "most"), [((1,), Fraction(1, 3), 2), ((5, 0, 1), Fraction(3, 2), 3), ((1, 1), Fraction(5), 2), ((0,), Fraction(1), 1)])
def test_other_mixes(spark, weights, share, most):
    rows = some_docs()
    found = mixture(frame(spark, rows), weights, share, most).select("doc_id", "size", "source_size", "target", "taken").collect()
    if share == 5:  # more than all sources may give: each gives what it may
        assert all(r.taken == 2 * r.size for r in found)
    elif not any(weights):
        assert all(r.taken == 0 for r in found)
    else:
        assert sorted(map(tuple, found), key=as_key) == sorted(plain_mix(rows, weights, share, most), key=as_key)


def test_sources_by_name(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 100), ("c", 100), (None, 50)], "source string, source_size long")
    got = {r.source: (r.target, r.epochs, r.rest) for r in targets(sizes, {"a": 1, "b": 3}, Fraction(1)).collect()}
    assert got == {"a": (150.0, 1, 50), "b": (200.0, 2, 0), "c": (0.0, 0, 0), None: (0.0, 0, 0)}


def test_sums_meet_the_targets(spark):
    found = mixture(frame(spark, some_docs()))
    sums = found.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert all(r.taken == math.floor(r.target) for r in sums)
    assert found.where("taken > 2 * size").count() == 0


def test_better_documents_come_first(spark):
    """By given weights: of two kinds the one with ten times the weight is taken far more often."""
    docs = frame(spark, [(k, "word", "s") for k in range(2000)])
    weight = F.when(F.col("doc_id") < 1000, 10.0).otherwise(1.0)
    taken = mixture(docs, share=Fraction(1, 2), weight=weight).where("taken > 0")
    good = taken.where("doc_id < 1000").count()
    assert taken.count() == 1000 and 750 < good < 950
    odd = F.when(F.col("doc_id") % 3 == 0, float("nan")).when(F.col("doc_id") % 3 == 1, F.lit(None)).otherwise(1.0)
    assert mixture(docs, share=Fraction(1, 3), weight=odd).where("taken > 0 AND doc_id % 3 = 2").count() == 666


def test_texts_of_the_mix(spark):
    rows = some_docs()
    docs = frame(spark, rows)
    texts = mixed_texts(docs)
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    found = {(r.doc_id, r.source): r.n for r in texts.groupBy("doc_id", "source").agg(F.sum(words).alias("n")).collect()}
    want = {(r.doc_id, r.source): r.n for r in mixture(docs).groupBy("doc_id", "source").agg(F.sum("taken").alias("n")).where("n > 0").collect()}
    assert found == want
    whole = {(i, t) for i, t, _ in rows}
    assert sum((r.doc_id, r.text) not in whole for r in texts.collect()) <= 9  # one at most for each source


def test_empty_table_and_no_python(spark):
    empty = frame(spark, some_docs()).limit(0)
    assert mixture(empty).count() == 0 and mixed_texts(empty).count() == 0
    plan = mixture(frame(spark, some_docs()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
