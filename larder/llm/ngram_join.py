"""Similarity join on word n-grams with adaptive multi-match prefixes.

All shingles have one order, the rarest first by a sketch of their counts. Two documents that are similar enough share at
least ``l`` of the first ``n - ceil(t n) + l`` shingles of each. Every document picks its own ``l`` by estimated cost: a
longer prefix means more rows, but asks for more shared shingles before a pair is verified. Sizes and the rest behind the
prefixes bound what two sets can have in common; pairs that this rules out are not verified either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.anchors import CELL_BITS, SentCells, buffer_of, count_cells, mixed, signed, words_of_bytes
from larder.llm.links import linked_groups
from larder.llm.tables import batch_from, plain, scratch, slices, summed, written

SHINGLE = 4
PERCENT = 85
SKETCH_BITS = 20
MOST_MATCHES = 4
VERIFY_COST = 20
U = np.uint64


def shingle_sets(column: pa.Array, n: int, fold: bool = True) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles; with fewer than ``n`` words one of all words, without any none."""
    buffer, offsets = buffer_of(column)
    words = words_of_bytes(buffer, offsets, fold)
    h = words.hashes
    factors = mixed(np.arange(1, n + 1, dtype=U)) | U(1)
    m = max(0, len(h) - n + 1)
    grams = np.zeros(m, U)
    for j in range(n):
        grams += h[j : j + m] * factors[j]
    grams = mixed(grams)
    out = []
    for a, b in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            out.append(mixed(np.sum(h[a:b] * factors[: b - a], keepdims=True) + U(b - a)))
        else:
            out.append(np.zeros(0, U))
    return out


def digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    return int(np.sum(mixed(s + U(0x51)), dtype=U).view(np.int64)), int(np.bitwise_xor.reduce(mixed(s * U(0x2545F4914F6CDD1D)), initial=U(0)).view(np.int64))


class Order:
    """The common order of shingles and the choice of prefixes, from a sketch of counts."""

    def __init__(self, sketch: np.ndarray, percent: int):
        self.counts, self.percent = sketch, percent
        self.shift = U(64 - int(len(sketch)).bit_length() + 1)
        self.noise = float(sketch.mean())

    def prefix(self, s: np.ndarray) -> tuple[np.ndarray, int]:
        """The prefix of a set and how many of its members a partner has to share."""
        n = len(s)
        counts = self.counts[(s >> self.shift).astype(np.int64)]
        # Only what stands out of the cells' noise counts as frequent; the rest is ordered by hash alone.
        grade = np.maximum(0, np.log2(np.maximum(counts, 1) / (4 * self.noise + 16)).astype(np.int64) + 1)
        grade[counts < 4 * self.noise + 16] = 0
        order = np.lexsort((s, grade))
        base = n - (-(-self.percent * n // 100))
        longest = min(MOST_MATCHES, n - base)
        cost = np.cumsum(1 + np.maximum(0, counts[order[: base + longest]] - self.noise))
        lists = cost[base : base + longest]
        matches = np.arange(1, longest + 1)
        best = int(np.argmin(lists + VERIFY_COST * lists / matches**2)) + 1
        return s[order[: base + best]], best


SETS = "doc_id bigint, n bigint, d1 bigint, d2 bigint"
TOKENS = "token bigint, d1 bigint, v bigint, n int, l int"
PAIRS = "a bigint, b bigint"


def similar_documents(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, cell_bits: int = CELL_BITS, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """doc_id, n_shingles, component_id of each row.

    Lower-cases A to Z; words are runs without ASCII white space. Documents link when 100 * intersection >= ``percent`` *
    union of their shingle sets. ``component_id`` is the least doc_id that links reach. Null and empty texts have no
    shingles and link with nothing. A row without an id is counted but has no component; rows that share an id are one
    document. ``cell_bits`` and ``sketch_bits`` are sizes of statistics that don't change the result.
    """
    rows = plain(docs)
    texts = rows.select("doc_id", "text")

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            sets = shingle_sets(batch.column(1), shingle)
            marks = [digest(s) for s in sets]
            yield batch_from([batch.column(0), [len(s) for s in sets], [x for x, _ in marks], [y for _, y in marks]], SETS)

    sets = written(texts.mapInArrow(sizes, SETS), "ngram-sets")
    known = texts.where("doc_id IS NOT NULL")

    def counted(batch):
        total = np.zeros(1 << sketch_bits, np.int64)
        for part in slices([batch], 1):
            for s in shingle_sets(part.column(1), shingle):
                np.add.at(total, (s >> U(64 - sketch_bits)).astype(np.int64), 1)
        return total

    order = Order(summed(known, counted, (1 << sketch_bits,)).astype(np.float32), percent)

    def prefixes(batch) -> tuple[list, list]:
        found = shingle_sets(batch.column(1), shingle)
        return found, [order.prefix(s) if len(s) else (s, 0) for s in found]

    def all_tokens(batch):
        return np.concatenate([np.zeros(0, U), *(p for part in slices([batch], 1) for p, _ in prefixes(part)[1])])

    with scratch():
        buckets = _buckets(known, prefixes, count_cells(known, all_tokens, cell_bits))
        wanted = buckets.select(F.col("v").alias("doc_id")).distinct()
        members = written(known.join(wanted, "doc_id").select(F.col("doc_id").alias("v"), "text"), "ngram-texts")
        fits = 100 * F.least("n", "n2").cast("long") >= percent * F.greatest("n", "n2").cast("long")
        groups = written(linked_groups(buckets, fits, lambda pairs: _verified(pairs, members, shingle, percent), enough=lambda shared: _enough(shared, percent)), "ngram-groups", outlives=True)
    classes = sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2").agg(F.min("doc_id").alias("v"))
    named = classes.join(groups, "v", "left").select("d1", "d2", F.coalesce("c", "v").alias("c"))
    return sets.join(named, ["d1", "d2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("c")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _buckets(known: DataFrame, prefixes, cells: SentCells) -> DataFrame:
    """(token, v, n, l): prefix members that several different sets have. Equal sets go by their least id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            ids = np.asarray(batch.column(0), np.int64)
            sets, chosen = prefixes(batch)
            kept = [p[cells.has(p)] for p, _ in chosen]
            count = np.array([len(p) for p in kept], np.int64)
            marks = np.array([digest(s)[0] for s in sets], np.int64)
            size, least = np.array([len(s) for s in sets], np.int64), np.array([l for _, l in chosen], np.int64)
            tokens = signed(np.concatenate([np.zeros(0, U), *kept]))
            yield batch_from([tokens, *(np.repeat(x, count) for x in (marks, ids, size, least))], TOKENS)

    # Copies are merged before and after the shuffle, so a group of copies sends one row per task and token.
    single = known.mapInArrow(run, TOKENS).groupBy("token", "d1").agg(F.min("v").alias("v"), F.first("n").alias("n"), F.first("l").alias("l"))
    with scratch():
        single = written(single.select("token", "v", "n", "l"), "ngram-tokens")
        several = single.groupBy("token").agg(F.count("*").alias("k")).where("k > 1").select("token")
        return written(single.join(several, "token"), "ngram-buckets", outlives=True)


def _enough(shared: Column, percent: int) -> Column:
    """Whether two sets of n and n2 shingles that share ``shared`` of their prefixes can still link.

    Of the two prefixes one ends first in the common order. What its set has in common with the other up to there lies in
    both prefixes, so the sets share at most ``shared`` and all that follows its prefix. Which one it is doesn't matter if
    the longer rest is taken.
    """
    rest = F.greatest(*(F.ceil(F.lit(percent) * F.col(n).cast("long") / 100) - F.col(l) for n, l in (("n", "l"), ("n2", "l2"))))
    return (100 + percent) * (shared + rest) >= percent * (F.col("n").cast("long") + F.col("n2"))


def _verified(pairs: DataFrame, members: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs that link, by their whole sets. Texts of the side with fewer pairs for each travel first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3):
            one, two = (shingle_sets(batch.column(k), shingle) for k in (2, 3))
            good = []
            for s, t in zip(one, two):
                both = len(np.intersect1d(s, t, assume_unique=True))
                good.append(both > 0 and 100 * both >= percent * (len(s) + len(t) - both))
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    second = members.select(F.col("v").alias("b"), F.col("text").alias("text_b"))
    first = members.select(F.col("v").alias("a"), F.col("text").alias("text_a"))
    met = pairs.join(second, "b").join(first, "a").select("a", "b", "text_a", "text_b")
    return met.mapInArrow(run, PAIRS).distinct()


def keep_one_of_similar(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with only the document of the least id of each group of linked ones; rows without id or text stay."""
    with scratch():
        found = similar_documents(docs, **settings)
        gone = written(found.where("component_id < doc_id").select("doc_id").distinct(), "ngram-gone", outlives=True)
    return docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")
