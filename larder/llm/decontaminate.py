"""Benchmark passages in training documents: rare n-gram seeds, then local alignment.

A seed is an ordered pair of words next to each other or with one word between them. An alignment of k matched words and e
errors scores 2k - e. Between its matched words lie k - 1 steps, at most e / 2 of which hold two errors or more; every other
step is a seed on both sides. An alignment that scores ``t`` of an item of ``m`` words therefore has seeds at
``ceil(t m) - 1`` words of the item at least. So the most frequent seeds of an item can be left out, and the rest still has
to be met several times before anything is aligned; no alignment of that score is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.anchors import CELL_BITS, buffer_of, count_cells, mixed, signed, unsigned, words_of_bytes
from larder.llm.tables import NO_ID, batch_from, batch_of, keyed, plain, scratch, slices, written

BROADCAST_SEEDS = 500_000  # rows of item seeds; more are joined by a shuffle
SALTS = 16  # parts of a frequent seed in that shuffle
SCORE = 0.6
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_WORDS = 3
FIRST = 0x9E3779B97F4A7C15  # tells the first word of a seed from the second
U = np.uint64


def normalised(text):
    """Words in lower case, without punctuation."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")


def seeds(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and first word of each seed of a text column, and the number of words of each row."""
    buffer, offsets = buffer_of(column)
    words = words_of_bytes(buffer, offsets)
    first = mixed(words.hashes * U(FIRST))
    hashes, starts = [], []
    for step in (1, 2):
        at = np.arange(max(0, len(first) - step))
        row = np.searchsorted(words.offsets, at, "right") - 1
        at = at[at + step < words.offsets[row + 1]]
        hashes.append(mixed(first[at] + words.hashes[at + step]))
        starts.append(at)
    at = np.concatenate(starts)
    row = np.searchsorted(words.offsets, at, "right") - 1
    return np.concatenate(hashes), row, at - words.offsets[row], np.diff(words.offsets)


def bounds(m: np.ndarray, least_score: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For items of ``m`` words: how many rare words to seed from, how many of them a copy meets, and its drift.

    Drift: how far insertions and deletions can move the words of an alignment against each other, plus one.
    """
    sure = np.maximum(1, np.ceil(least_score * m - 1e-9).astype(np.int64) - 1)
    asked = (sure + 1) // 2
    return np.maximum(m - 1 - sure + asked, 1), asked, np.ceil(2 * m * (1 - least_score)).astype(np.int64) + 1


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman over words: the best score and the aligned part of the passage."""
    m = len(passage)
    steps = np.arange(m) * GAP
    above, above_start = np.zeros(m + 1, np.int64), np.arange(m + 1)
    best, low, high = 0, 0, 0
    for word in item:
        diagonal = above[:-1] + np.where(passage == word, MATCH, MISMATCH)
        upward = above[1:] + GAP
        here = np.maximum(np.maximum(diagonal, upward), 0)
        start = np.where(here == diagonal, above_start[:-1], above_start[1:])
        start = np.where(here == 0, np.arange(1, m + 1), start)
        # Gaps along the passage: the best cell to the left, less a gap for each step.
        slope = here - steps
        peak = np.maximum.accumulate(slope)
        at = np.maximum.accumulate(np.where(slope == peak, np.arange(m), 0))
        row = np.maximum(peak + steps, 0)
        start = np.where(row == 0, np.arange(1, m + 1), start[at])
        above, above_start = np.append(0, row), np.append(0, start)
        k = int(row.argmax()) if m else 0
        if m and row[k] > best:
            best, low, high = int(row[k]), int(start[k]), k + 1
    return best, low, high


ITEM_SEEDS = "h bigint, item_id bigint, line int, item_place int, rare int, asked int, drift int"
COUNTS = "h bigint, n bigint"
HITS = "h bigint, k1 bigint, k2 int, place int"
MATCHES = "k1 bigint, k2 int, doc_id bigint, item_id bigint, score double, first_word int, last_word int"


def contaminations(docs: DataFrame, items: DataFrame, least_score: float = SCORE, cell_bits: int = CELL_BITS) -> DataFrame:
    """doc_id, item_id, score, first_word, last_word: the best alignment of each item with each document that has it.

    ``items``: item_id, text. Words are runs of letters and digits in lower case; ``score`` is the alignment's share of
    what the whole item would score, and at least ``least_score``. The result is that of aligning all documents with all
    items, as long as ``least_score`` asks for more than one word of an item. Items of fewer than three words match
    nothing, like null and empty texts. A null doc_id comes back as null. Rows that repeat give equal rows once.
    """
    return matches(docs, items, least_score, cell_bits).drop("k1", "k2").distinct()


def matches(docs: DataFrame, items: DataFrame, least_score: float, cell_bits: int) -> DataFrame:
    """``contaminations`` with the keys of the rows."""
    rows = keyed(plain(docs)).withColumn("text", normalised(F.col("text")))
    texts = rows.select("k1", "k2", "text")
    tests = plain(items, "item_id").where("doc_id IS NOT NULL").select(F.col("doc_id").alias("item_id"), normalised(F.col("text")).alias("text"))

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = 0
        for batch in slices(batches, 1):
            h, row, place, m = seeds(batch.column(1))
            k = np.flatnonzero(m[row] >= LEAST_WORDS)
            h, row, place = h[k], row[k], place[k]
            sizes = [x[row] for x in bounds(m, least_score)]
            yield batch_from([signed(h), np.asarray(batch.column(0))[row], line + row, place, *sizes], ITEM_SEEDS)
            line += batch.num_rows

    # An item id may have several texts; ``line`` and the task tell them apart.
    every_seed = written(tests.mapInArrow(item_seeds, ITEM_SEEDS).withColumn("task", F.spark_partition_id()), "item-seeds")
    chosen = written(_rarest(every_seed, _counts(texts, every_seed, cell_bits)), "rare-seeds")
    cells = count_cells(chosen.select("h"), lambda batch: unsigned(batch.column(0)), cell_bits, 1)

    def document_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            h, row, place, _ = seeds(batch.column(2))
            k = np.flatnonzero(cells.has(h))
            k1, k2 = (np.asarray(batch.column(j))[row[k]] for j in (0, 1))
            yield batch_from([signed(h[k]), k1, k2, place[k]], HITS)

    hits = written(texts.mapInArrow(document_seeds, HITS), "seed-hits")
    # Words of one alignment lie less than ``drift`` apart in place - item_place. Stretches of twice that, one every
    # ``drift``, hold them together whatever they are.
    stretch = F.floor((F.col("place") - F.col("item_place")) / F.col("drift"))
    pairs = (
        _met(hits, chosen)
        .withColumn("stretch", F.explode(F.array(stretch, stretch - 1)))
        .groupBy("k1", "k2", "item_id", "task", "line", "stretch", "drift", "asked")
        .agg(F.size(F.collect_set("item_place")).alias("places"))
        .where("places >= asked")
        .groupBy("k1", "k2", "item_id")
        .agg(F.collect_set(F.struct((F.col("stretch") * F.col("drift")).alias("begin"), F.col("drift").cast("long").alias("drift"))).alias("starts"))
        .select("k1", "k2", "item_id", F.col("starts.begin").alias("begins"), F.col("starts.drift").alias("drifts"))
    )
    pairs = written(pairs, "seed-pairs")
    wanted = pairs.select("k1", "k2").distinct()
    passages = rows.join(wanted, ["k1", "k2"], "left_semi").select("k1", "k2", "doc_id", F.col("text").alias("document"))
    met = pairs.join(passages, ["k1", "k2"]).join(tests.withColumnRenamed("text", "item"), "item_id")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                found = _best(r["item"].split(), r["document"].split(), r["begins"], r["drifts"])
                if found and found[0] >= least_score:
                    out.append((r["k1"], r["k2"], r["doc_id"], r["item_id"], *found))
            yield batch_of(out, MATCHES)

    return met.select("k1", "k2", "doc_id", "item_id", "item", "document", "begins", "drifts").mapInArrow(score, MATCHES)


def _counts(texts: DataFrame, item_seeds: DataFrame, cell_bits: int) -> DataFrame:
    """(h, n): how often each seed of an item occurs in all documents; cells that others share only add rows."""
    cells = count_cells(item_seeds.select("h"), lambda batch: unsigned(batch.column(0)), cell_bits, 1)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            h = seeds(batch.column(2))[0]
            yield batch_from([*_signed_counts(h[cells.has(h)])], COUNTS)

    return texts.mapInArrow(inside, COUNTS).groupBy("h").agg(F.sum("n").alias("n"))


def _signed_counts(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, n = np.unique(h, return_counts=True)
    return signed(values), n


def _rarest(item_seeds: DataFrame, counts: DataFrame) -> DataFrame:
    """The seeds at the ``rare`` words of each item whose seeds occur least."""
    item = ["item_id", "task", "line"]
    words = item_seeds.join(counts, "h", "left").groupBy(*item, "item_place", "rare").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    ranked = words.withColumn("rank", F.row_number().over(Window.partitionBy(*item).orderBy("n", "item_place")))
    return item_seeds.join(ranked.where("rank <= rare").select(*item, "item_place"), [*item, "item_place"], "left_semi")


def _met(hits: DataFrame, chosen: DataFrame) -> DataFrame:
    """Each hit with the item words that have its seed. A seed's hits are spread where the items are many."""
    if chosen.count() <= BROADCAST_SEEDS:
        return hits.join(F.broadcast(chosen), "h")
    salted = chosen.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return hits.withColumn("salt", F.pmod(F.hash("k1", "k2", "place"), F.lit(SALTS))).join(salted, ["h", "salt"])


def _best(item: list[str], document: list[str], begins: list[int], drifts: list[int]) -> tuple[float, int, int] | None:
    """The best alignment in any of the stretches where enough seeds were met."""
    if len(item) < LEAST_WORDS:
        return None
    number = {w: k for k, w in enumerate(dict.fromkeys(item))}
    coded = np.array([number[w] for w in item])
    windows: list[list[int]] = []
    for begin, drift in sorted(zip(begins, drifts)):
        a, b = max(0, begin), min(len(document), begin + 2 * drift + len(item))
        if windows and a <= windows[-1][1] and b - windows[-1][0] <= 64 * len(item):
            windows[-1][1] = max(windows[-1][1], b)
        else:
            windows.append([a, b])
    best = None
    for a, b in windows:
        score, low, high = align(coded, np.array([number.get(w, -1) for w in document[a:b]]))
        if best is None or score > best[0]:
            best = (score, a + low, a + high)
    return best and (best[0] / (MATCH * len(item)), best[1], best[2])


def without_contaminated(docs: DataFrame, items: DataFrame, least_score: float = SCORE, cell_bits: int = CELL_BITS) -> DataFrame:
    """``docs`` without the rows whose text has a test item; all columns stay."""
    with scratch():
        found = written(matches(docs, items, least_score, cell_bits).select("k1", "k2").distinct(), "contaminated", outlives=True)
    k1 = F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID))
    k2 = F.hash(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(found, (k1 == found["k1"]) & (k2 == found["k2"]), "left_anti")
