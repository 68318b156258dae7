import hashlib
import math
import random

import numpy as np
import pytest

from larder.llm.clusters import cluster_digests, clusters
from larder.llm.vector_codes import Codebooks, code_digests, compressed, decoded, orchard

NAN, INF = float("nan"), float("inf")


def as_key(row):
    return tuple(map(str, row))


def whole(v, scale):
    return [math.floor(scale * x) for x in v]


def sound(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def plain_means(points, centres, rounds):
    """Nearest centre, ties to the smaller number, then floored means, in plain Python."""
    near = lambda p: min((sum((a - b) ** 2 for a, b in zip(p, c)), i) for i, c in enumerate(centres))
    for _ in range(rounds):
        groups = {}
        for p in points:
            groups.setdefault(near(p)[1], []).append(p)
        for i, members in groups.items():
            centres[i] = [sum(x) // len(members) for x in zip(*members)]
    return [near(p) for p in points], centres


def plain_codes(rows, parts, entries, rounds, scale):
    kept = by_id([(i, whole(v, scale), label) for i, v, label in rows if sound(v) and v and len(v) % parts == 0])
    length = len(kept[0][1]) if kept else 0
    kept = [r for r in kept if len(r[1]) == length]
    wide = length // parts
    found, books = [], []
    for p in range(parts):
        pieces = [v[p * wide:(p + 1) * wide] for _, v, _ in kept]
        near, centres = plain_means(pieces, [list(x) for x in pieces[:entries]], rounds)
        found.append(near)
        books += [x for c in centres for x in c]
    digest = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    errors = [sum(part[k][0] for part in found) for k in range(len(kept))]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    return [
        (kept[k][0], "".join(f"{part[k][1]:02x}" for part in found), errors[k], by_label[kept[k][2]], digest) for k in range(len(kept))
    ]


def plain_clusters(rows, k, rounds, scale, dims, seed=3):
    kept = [(i, whole(v, scale)) for i, v, _ in rows if sound(v) and len(v) == dims]
    mark = lambda r: (r[0] is None, r[0] is not None and hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])
    near, centres = plain_means([v for _, v in kept], [list(v) for _, v in sorted(kept, key=mark)[:k]], rounds)
    total = {}
    for d, c in near:
        total[c] = total.get(c, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, c, d, total[c], sum(total.values()), sha[c]) for (i, _), (d, c) in zip(kept, near)]


def some_rows(seed, n=120, dims=8):
    pick = random.Random(seed)
    rows = [(k, [pick.choice([-0.75, -0.1, 0.0, 0.3, pick.gauss(0, 1)]) for _ in range(dims)], pick.choice([None, 0, 1, 2])) for k in range(n)]
    same = rows[5][1]
    rows += [(1000 + k, same, 7) for k in range(30)]  # a group of copies
    rows += [rows[3], rows[3], (None, same, 1), (None, rows[9][1], None)]  # repeated rows and null ids
    rows += [(2000, None, 1), (2001, [None] * dims, 1), (2002, [0.1] * (dims - 1) + [NAN], 1), (2003, [INF] * dims, None)]
    rows += [(2004, [], 1), (2005, [0.5] * (dims + 1), 1), (-7, [0.5] * (dims - 1), 1)]
    pick.shuffle(rows)
    return rows


def frame(spark, rows, kind="float"):
    # Names that the operators use themselves.
    return spark.createDataFrame([(*r, "x", 1) for r in rows], f"vec_id long, embedding array<{kind}>, label int, v string, codes int").repartition(5)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_codes_as_brute_force(spark, kind):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in some_rows(1)]
    options = dict(parts=4, entries=5, rounds=3, scale=64)
    found = code_digests(frame(spark, rows, kind), **options)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, found.collect()), key=as_key) == sorted(plain_codes(rows, **options), key=as_key)


def test_few_or_no_vectors(spark):
    rows = some_rows(2)[:1] + [(1, [0.25] * 8, None), (2, [0.5] * 8, None)]
    options = dict(parts=2, entries=16, rounds=2, scale=4096)
    want = sorted(plain_codes(rows, **options), key=as_key)
    assert sorted(map(tuple, code_digests(frame(spark, rows), **options).collect()), key=as_key) == want
    for none in ([], [(1, None, 1), (2, [], 1)]):
        assert code_digests(frame(spark, none)).count() == 0
        assert cluster_digests(frame(spark, none)).count() == 0


def test_labels_may_have_any_name_and_number(spark, monkeypatch):
    rows = some_rows(3)
    options = dict(parts=4, entries=4, rounds=1, scale=64)
    named = frame(spark, rows).drop("codes", "v").withColumnsRenamed({"label": "error", "vec_id": "label", "embedding": "v"})
    monkeypatch.setattr("larder.llm.vector_codes.BROADCAST_LABELS", 0)
    found = code_digests(named, id_col="label", vec_col="v", label_col="error", **options).collect()
    assert sorted(map(tuple, found), key=as_key) == sorted(plain_codes([(i, v and [x and float(np.float32(x)) for x in v], c) for i, v, c in rows], **options), key=as_key)
    alone = code_digests(named, id_col="label", vec_col="v", label_col=None, **options)
    assert alone.select("label_error").distinct().count() == 1


def test_orchard_finds_the_first_nearest():
    pick = np.random.default_rng(4)
    for entries, wide, spread in ((1, 3, 5), (2, 1, 2), (16, 2, 3), (16, 8, 1000), (40, 4, 6)):
        books = Codebooks(pick.integers(-spread, spread, (3, entries, wide)))
        points = pick.integers(-spread, spread, (500, 3, wide))
        gaps = points[:, :, None, :] - books.entries[None]
        squares = (gaps * gaps).sum(3)
        best, distance = orchard(points, books)
        assert (best == squares.argmin(2)).all() and (distance == squares.min(2)).all()


def test_walks_are_short():
    """Far entries are left out: with clear clusters only some entries of a list are reached."""
    pick = np.random.default_rng(5)
    entries = np.arange(64)[None, :, None] * 1000 + np.zeros((1, 64, 4), np.int64)
    books = Codebooks(entries.astype(np.int64))
    points = entries[0, pick.integers(0, 64, 300)][:, None, :] + pick.integers(-3, 3, (300, 1, 4))
    _, squares = books.neighbours()
    best, distance = orchard(points, books)
    assert (squares[0, best[:, 0], 0] > 4 * distance[:, 0]).all()


def test_decoded_vectors_are_near(spark):
    rows = [(k, [x if x else 0.0 for x in v], label) for k, v, label in some_rows(6) if sound(v) and len(v) == 8]
    codes, books = compressed(frame(spark, rows, "double"), parts=4, entries=64, rounds=4)
    exact = {r.vec_id: r for r in codes.collect() if r.vec_id is not None}
    v = {i: x for i, x, _ in rows}
    for r in decoded(codes, books).where("vec_id IS NOT NULL").collect():
        off = sum((a - b) ** 2 for a, b in zip(r.v, v[r.vec_id]))
        assert math.sqrt(off) <= math.sqrt(exact[r.vec_id].error) / 4096 + 0.001


def test_components_out_of_range_stop_the_job(spark):
    with pytest.raises(Exception, match="out of range"):
        code_digests(frame(spark, [(1, [1e30] * 8, 1)])).collect()


def test_clusters_as_brute_force(spark):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in some_rows(7)]
    options = dict(k=6, rounds=4, scale=16, dims=8)
    found = cluster_digests(frame(spark, rows), k=6, rounds=4, scale=16, dimensions=8)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, found.collect()), key=as_key) == sorted(plain_clusters(rows, **options), key=as_key)


def test_empty_clusters_keep_their_centroid(spark):
    """Copies make equal centroids: the first of them gets all vectors, the others stay as they are."""
    rows = [(k, [1.0, 2.0], None) for k in range(20)] + [(99, [-5.0, 0.0], None)]
    placed, centroids = clusters(frame(spark, rows), k=4, rounds=3, scale=1, dimensions=2)
    assert len(centroids) == 4 and {tuple(c) for c in centroids} <= {(1, 2), (-5, 0)}
    assert placed.groupBy("cluster").count().count() == (2 if (-5, 0) in map(tuple, centroids) else 1)


def test_no_python_in_the_plan(spark):
    plan = clusters(frame(spark, some_rows(8)), dimensions=8, k=3, rounds=1)[0]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
