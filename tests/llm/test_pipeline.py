import hashlib
import os
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from larder.llm.decontaminate import align, contaminations, without_contaminated
from larder.llm.exact_dedup import ContentTable, drop_copies, exact_dedup, grace
from larder.llm.ngram_join import keep_one_of_similar
from larder.llm.quality import isotonic, keep_good, quality_scores, text_statistics
from larder.session import shared_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_exact(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((d, t or ""))
    out = []
    for content, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), float("inf") if m[0] is None else m[0]))
        sha = hashlib.sha256(content.encode()).hexdigest()
        done = False
        for m in members:
            kept = m == keep and not done
            done |= kept
            out.append((m[0], keep[0], len(members), kept, sha))
    return out


ROWS = [(1, "a b"), (2, "ab"), (3, "a  b"), (4, "a \t b"), (5, None), (6, ""), (7, " \n"), (8, "é b"), (9, "éb "), (None, "ab"), (None, "x"), (10, "x"), (11, "q"), (11, "q"), (12, "z " * 50_000)]


@pytest.mark.parametrize("limit", [64 << 20, 1])
def test_exact_as_brute_force(spark, limit):
    docs = spark.createDataFrame([(d, t, "h", 1) for d, t in ROWS], "doc_id long, text string, content string, n int").repartition(4)
    key = lambda r: tuple(map(str, r))
    found = sorted(map(tuple, exact_dedup(docs, limit).collect()), key=key)
    assert found == sorted(brute_exact(ROWS), key=key)
    kept = sorted((str(r.doc_id), r.text) for r in drop_copies(docs).collect())
    assert kept == sorted([("11", "q"), ("10", "x"), ("12", "z " * 50_000), ("4", "a \t b"), ("7", " \n"), ("8", "é b")])
    assert exact_dedup(docs.limit(0)).count() == 0


def test_drop_copies_with_clashing_names_and_ties(spark):
    extra = "_id int, _sha string, id int, sha int, row int, twin_id int, kept int, text_sha256 int"
    rows = [(d, t, k, "s", k, k, k, k, k, k) for k, (d, t) in enumerate(ROWS + [(11, "q "), (13, "q"), (None, "w"), (None, "w")])]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {extra}").repartition(3)
    found = drop_copies(docs)
    assert found.columns == docs.columns
    kept = sorted((str(r.doc_id), r.text) for r in found.collect())
    assert kept == sorted([("11", "q "), ("10", "x"), ("12", "z " * 50_000), ("4", "a \t b"), ("7", " \n"), ("8", "é b"), ("None", "w")])


def test_tables_go_when_nothing_reads_them(spark):
    before = set(os.listdir(shared_dir(spark)))
    docs = spark.createDataFrame([(k, f"one two three four five six {k % 3}") for k in range(9)], "doc_id long, text string")
    out = drop_copies(docs)
    assert {name.rsplit("-", 1)[0] for name in set(os.listdir(shared_dir(spark))) - before} == {"exact-gone"}
    assert out.count() == 3
    before = set(os.listdir(shared_dir(spark)))
    assert keep_one_of_similar(docs, shingle=5, percent=80).count() == 3  # the three texts, each once
    assert {name.rsplit("-", 1)[0] for name in set(os.listdir(shared_dir(spark))) - before} == {"ngram-gone"}


def test_tables_grow_and_spill():
    records = [(f"text {k % 700}".encode(), hash(f"{k % 700}") & ((1 << 127) - 1), (0, k), 1, k) for k in range(3000)]
    total = 0
    for limit in (1 << 30, 2000):
        sizes = []
        for table, members in grace(iter(records), limit):
            assert all(table.contents[k] == f"text {tag % 700}".encode() for tag, k in members)
            sizes += table.sizes
        assert len(sizes) == 700 and sum(sizes) == 3000
        total += 1
    table = ContentTable(2)
    assert [table.add(c, 1, (0, k), 1) for k, c in enumerate([b"a", b"b", b"a"])] == [0, 1, 0]  # one hash, other contents


def brute_align(a, b):
    best, rows = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, rows[j] + (2 if x == y else -1), rows[j + 1] - 1, new[j] - 1))
            best = max(best, new[-1])
        rows = new
    return best


def test_alignment_as_brute_force():
    import numpy as np

    pick = random.Random(4)
    for _ in range(200):
        a = [pick.randrange(4) for _ in range(pick.randint(1, 12))]
        b = [pick.randrange(5) for _ in range(pick.randint(1, 20))]
        score, low, high = align(np.array(a), np.array(b))
        assert score == brute_align(a, b)
        if score:
            assert brute_align(a, b[low:high]) == score


def test_contaminated_documents_go(spark):
    pick = random.Random(2)
    word = lambda: "".join(pick.choice("abcdefghi") for _ in range(5))
    items = [(k, " ".join(word() for _ in range(40))) for k in range(6)] + [(90, None), (91, ""), (92, "too short")]
    filler = lambda n: " ".join(word() for _ in range(n))
    rows, dirty = [], set()
    for k in range(60):
        if k % 3 == 0:
            w = items[k % 6][1].split()
            for _ in range(5):
                w[pick.randrange(40)] = word()
            rows.append((k, f"{filler(30)} {' '.join(w).upper()}. {filler(30)}"))
            dirty.add(k)
        else:
            rows.append((k, filler(100) + " " + " ".join(items[k % 6][1].split()[:8])))
    rows += [(100, None), (101, ""), (None, items[0][1]), (102, filler(30_000) + items[1][1])]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, item_id string, h int").repartition(4)
    tests = spark.createDataFrame(items, "item_id long, text string")
    found = contaminations(docs, tests, cell_bits=18).collect()
    assert {r.doc_id for r in found} == dirty | {102, None}
    assert all(0.6 <= r.score <= 1 and r.item_id in range(6) for r in found)
    kept = without_contaminated(docs, tests, cell_bits=18)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - dirty - {102, None}
    assert contaminations(docs, tests.limit(0), cell_bits=18).count() == 0
    assert contaminations(docs.limit(0), tests, cell_bits=18).count() == 0


def labelled(spark):
    pick = random.Random(3)
    rows, labels = [], []
    for k in range(600):
        good = pick.random() < 0.7
        w = ["".join(pick.choice("abcdefgh") for _ in range(pick.randint(2, 8))) for _ in range(60)]
        rows.append((k, " ".join(w) + "." if good else " ".join(x.upper() + "$$!" for x in w[:20]) * 3, "en", "s", 1))
        labels.append((k, int(good), 0))
    rows += [(1000, None, None, None, None), (1001, "", "", "", 0), (None, "plain text", "en", "s", 1), (1002, "w " * 60_000, "en", "s", 1)]
    return spark.createDataFrame(rows, DOCS).repartition(4), spark.createDataFrame(labels + [(5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    found = {r.doc_id: r for r in quality_scores(docs, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").collect()}
    held = [r for d, r in found.items() if r.held_out and d in truth]
    assert len(held) > 100
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found.values())
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and 300 < kept.count() < 520
    assert {r.score for r in quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_scores(docs.limit(0), labels).count() == 0
    assert len(set(map(len, map(text_statistics, [None, "", " \n", "é", "a b"])))) == 1


def test_isotonic():
    import numpy as np

    assert isotonic(np.array([1, 1, 2.0]), np.array([1, 0, 2.0])).tolist() == [0.5, 0.5, 1.0]


def test_stages_chain(spark, tmp_path):
    docs, labels = labelled(spark)
    docs.coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "some item of the test set that nobody has")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    before = now.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns, name
        now = now.checkpoint()
        assert 0 < now.count() <= before
        before = now.count()
    last = corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path))
    assert last.count() == before
    assert last.join(now, "doc_id").where(F.col("n_tokens") > 0).count() > 0
