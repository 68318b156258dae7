"""Repeats across documents: where equal windows meet.

Of each window of a fixed length one inner gram is the anchor: the one with the least hash, the leftmost of equal ones.
Equal windows have equal anchors, so after dealing windows out by the anchor's hash, all copies of a window are in one
shard. Consecutive windows with the same anchor are one segment, the unit that is shipped. A bitmap of fixed size tells
which anchors can have a partner at all; of the segments that pass, only hashes are shuffled until their anchors' partners
are counted exactly.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.tables import BLANKS, batch_from, batch_of, slices, width, written

CELL_BITS = 27
MOST_BITS = 29
HOT = 20_000
CHUNK = 1 << 18
HELD = 1 << 20  # keys or segments that a task merges before it sends them
U = np.uint64
MULT, STEP = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.zeros(0, U)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK + 1)
            for name, base in (("up", self.base), ("down", self.inverse)):
                ones = np.full(size, base, U)
                ones[0] = 1
                setattr(self, name, np.multiply.accumulate(ones))
        return self.up[:n], self.down[:n]


POWERS = (Powers(0xD6E8FEB86659FD93), Powers(0xA0761D6478BD642F))
LETTERS = [mixed(np.arange(1, 257, dtype=U) * U(m)) for m in (MULT, STEP)]


class Prefix:
    """Hashes of any substrings of a buffer from one running sum."""

    def __init__(self, values: np.ndarray, which: int = 0):
        self.up, self.down = POWERS[which].to(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, U)
        np.cumsum(values * self.up[:-1], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype(U) * U(MULT))

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return mixed((self.sums[k:] - self.sums[:-k]) * self.down[:n]) if n > 0 else np.zeros(0, U)


def least_of_windows(hashes: np.ndarray, w: int) -> np.ndarray:
    """For each window of ``w`` hashes the position of the least (by its upper half), the leftmost of equal ones."""
    n = len(hashes)
    if n < w:
        return np.zeros(0, np.int64)
    packed = (hashes & U(0xFFFFFFFF00000000)) | np.arange(n, dtype=U)
    full = np.full(-(-n // w) * w, U(0xFFFFFFFFFFFFFFFF))
    full[:n] = packed
    rows = full.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[: n - w + 1], ahead[w - 1 : n]) & U(0xFFFFFFFF)).astype(np.int64)


@dataclass
class Segments:
    """Runs of windows with a common anchor. Positions are in the units of the sequence, within its document."""

    doc: np.ndarray  # row of the batch
    start: np.ndarray  # first window
    n: np.ndarray  # windows
    anchor: np.ndarray  # place of the anchor, relative to the first window
    key: np.ndarray  # hash of the anchor gram
    content: np.ndarray  # hash of the whole segment
    low: np.ndarray  # place of the segment in the batch's sequence
    high: np.ndarray

    def take(self, which: np.ndarray) -> Segments:
        return Segments(*(getattr(self, f)[which] for f in self.__dataclass_fields__))


def segments(values: Callable, offsets: np.ndarray, window: int, gram: int) -> Segments:
    """``values(a, b)``: two arrays of random 64-bit values of the units from a to b. ``offsets``: where documents begin.

    Documents are taken in chunks, so that memory stays small; a document is never cut.
    """
    found, first = [], 0
    n_docs = len(offsets) - 1
    while first < n_docs:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1)
        a, b = int(offsets[first]), int(offsets[last])
        if b - a >= window:
            found.append(_chunk(*values(a, b), offsets[first : last + 1] - a, window, gram, first, a))
        first = last
    if not found:
        return Segments(*(np.zeros(0, U if f in ("key", "content") else np.int64) for f in Segments.__dataclass_fields__))
    return Segments(*(np.concatenate([getattr(s, f) for s in found]) for f in Segments.__dataclass_fields__))


def _chunk(one, two, offsets, window, gram, first_doc, base) -> Segments:
    n = len(one)
    prefix = Prefix(one)
    grams = prefix.grams(gram)
    place = least_of_windows(grams, window - gram + 1)
    # A window has to end within its document.
    sizes = np.diff(offsets)
    room = np.maximum(sizes - window + 1, 0)
    valid = np.zeros(n + 1, np.int32)
    np.add.at(valid, offsets[:-1], (room > 0).astype(np.int32))
    np.add.at(valid, offsets[:-1] + room, -(room > 0).astype(np.int32))
    starts = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
    at = place[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    # Windows of adjacent documents are never consecutive: the last ones of a document aren't valid, as window > 1.
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(starts)))
    low = starts[head]
    high = low + count - 1 + window
    doc = np.searchsorted(offsets, low, "right") - 1
    content = Prefix(two, 1).of(low, high)
    return Segments(doc + first_doc, low - offsets[doc], count, at[head] - low, grams[at[head]], content, low + base, high + base)


def byte_values(buffer: np.ndarray):
    return lambda a, b: (LETTERS[0][buffer[a:b]], LETTERS[1][buffer[a:b]])


IS_BLANK = np.zeros(256, bool)
IS_BLANK[list(BLANKS.encode())] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32


@dataclass
class Words:
    start: np.ndarray  # byte where each word begins
    stop: np.ndarray
    offsets: np.ndarray  # word where each document begins
    hashes: np.ndarray  # 64 bits of each word


def words_of_bytes(buffer: np.ndarray, offsets: np.ndarray, fold: bool = False) -> Words:
    """Words of all documents in a buffer: runs without ASCII white space. ``fold`` lower-cases A to Z."""
    starts, stops, hashes, first = [], [], [], 0
    n_docs = len(offsets) - 1
    while first < n_docs:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1)
        a, b = int(offsets[first]), int(offsets[last])
        if b > a:
            chunk = buffer[a:b]
            solid = ~IS_BLANK[chunk]
            edge = np.zeros(b - a + 1, bool)  # where a document begins, a word may begin too
            edge[offsets[first : last + 1] - a] = True
            before = np.concatenate([[False], solid[:-1]])
            after = np.concatenate([solid[1:], [False]])
            begin = np.flatnonzero(solid & (~before | edge[:-1]))
            end = np.flatnonzero(solid & (~after | edge[1:])) + 1
            hashes.append(Prefix(LETTERS[0][FOLD[chunk] if fold else chunk]).of(begin, end))
            starts.append(begin + a)
            stops.append(end + a)
        first = last
    none = np.zeros(0, np.int64)
    start = np.concatenate(starts) if starts else none
    stop = np.concatenate(stops) if stops else none
    return Words(start, stop, np.searchsorted(start, offsets), np.concatenate(hashes) if hashes else none.astype(U))


def word_values(words: Words):
    return lambda a, b: (words.hashes[a:b], mixed(words.hashes[a:b] * U(MULT) + U(STEP)))


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column without nulls, and where each text begins."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    buffer = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8)
    return buffer[offsets[0] : offsets[-1]], offsets - offsets[0]


def cell_of(key: np.ndarray, bits: int) -> np.ndarray:
    """Anchors are least hashes, thus not spread evenly; mixing them again spreads them."""
    return (mixed(key * U(STEP) + U(MULT)) >> U(64 - bits)).astype(np.int64)


@dataclass
class Cells:
    """Which keys were counted at least so many times, by a part of their hash. A key can pass by chance, none is lost."""

    bits: int
    marked: np.ndarray  # packed bits
    often: np.ndarray  # sorted cells

    def __getstate__(self):
        return self.bits, zlib.compress(self.marked.tobytes(), 1), self.often

    def __setstate__(self, state):
        self.bits, self.marked, self.often = state[0], np.frombuffer(zlib.decompress(state[1]), np.uint8), state[2]

    def has(self, key: np.ndarray) -> np.ndarray:
        cell = cell_of(key, self.bits)
        return (self.marked[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1

    def has_often(self, key: np.ndarray) -> np.ndarray:
        cell = cell_of(key, self.bits)
        if not len(self.often):
            return np.zeros(len(cell), bool)
        return self.often[np.minimum(np.searchsorted(self.often, cell), len(self.often) - 1)] == cell


class SentCells:
    """Cells as a broadcast variable: each executor gets them once, however many steps ask."""

    def __init__(self, context, cells: Cells):
        self.sent, self.any_often = context.broadcast(cells), len(cells.often) > 0

    def has(self, key: np.ndarray) -> np.ndarray:
        return self.sent.value.has(key)

    def has_often(self, key: np.ndarray) -> np.ndarray:
        return self.sent.value.has_often(key)


MOST = 65_535


def count_cells(rows: DataFrame, keys_of, bits: int = CELL_BITS, least: int = 2, often: int = MOST) -> SentCells:
    """Marks the cells, of 2**bits, that ``keys_of(batch)`` names at least ``least`` times over all batches.

    Those named more than ``often`` times, at most ``MOST``, are listed. What the driver gets and sends out has a fixed
    size: a bit for each cell, and a list as long as the rows allow for so frequent cells. With more data than cells they
    only filter less; results don't depend on them.
    """
    block_bits = min(16, bits)
    blocks = 1 << (bits - block_bits)
    often = min(often, MOST - 1)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _held((cell_of(keys_of(batch), bits),) for batch in batches):
            cell, count = np.unique(held[0], return_counts=True)
            cuts = np.searchsorted(cell >> block_bits, np.arange(blocks + 1)).tolist()
            rows = []
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a < b:
                    low = (cell[a:b] & ((1 << block_bits) - 1)).astype("<u2")
                    many = np.minimum(count[a:b], MOST).astype("<u2")
                    rows.append((k, b - a, zlib.compress(low.tobytes() + many.tobytes(), 1)))
            yield batch_of(rows, "block int, n int, data binary")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for r in batch.to_pylist():
                data, n = zlib.decompress(r["data"]), r["n"]
                total = totals.setdefault(r["block"], np.zeros(1 << block_bits, np.uint16))
                at = np.frombuffer(data, "<u2", n)
                more = total[at].astype(np.int64) + np.frombuffer(data, "<u2", n, 2 * n)
                total[at] = np.minimum(more, MOST)
        for k, total in totals.items():
            many = np.flatnonzero(total > often) + (k << block_bits)
            yield batch_of([(k, np.packbits(total >= least).tobytes(), many.tolist())], "block int, bits binary, often array<bigint>")

    spread = rows.mapInArrow(inside, "block int, n int, data binary").repartition(width(rows.sparkSession), "block")
    marked, many = np.zeros((1 << bits) // 8, np.uint8), []
    size = (1 << block_bits) // 8
    for r in spread.mapInArrow(across, "block int, bits binary, often array<bigint>").collect():
        marked[r.block * size : (r.block + 1) * size] = np.frombuffer(r.bits, np.uint8)
        many += r.often
    cells = Cells(bits, marked, np.sort(np.array(many, np.int64)))
    return SentCells(rows.sparkSession.sparkContext, cells)


def enough_bits(keys: int, bits: int) -> int:
    """Bits for sixteen cells to a key, ``bits`` at least and ``MOST_BITS`` at most."""
    return max(bits, min(MOST_BITS, (16 * keys).bit_length()))


def _held(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Joins equally long arrays of small parts to ones of about ``HELD``, none of them empty."""
    held, size = [], 0
    for part in parts:
        if len(part[0]):
            held.append(part)
            size += len(part[0])
        if size >= HELD:
            yield tuple(map(np.concatenate, zip(*held)))
            held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def unsigned(column) -> np.ndarray:
    return np.asarray(column, np.int64).view(U)


PLACES = "k1 bigint, k2 int, h bigint, c bigint, start bigint, windows int"
SHIPPED = "h bigint, c bigint, n bigint, first bigint, anchor int, windows int, data binary"
COVERS = "h bigint, c bigint, first bigint, low int, high int"


def _name(key: np.ndarray, content: np.ndarray, k1: np.ndarray) -> np.ndarray:
    """One hash for a segment in a document."""
    return mixed(mixed(key ^ mixed(content + U(MULT))) + mixed(k1.astype(np.int64).view(U) * U(STEP)))


@dataclass
class Repeats:
    """Segments that can have a partner.

    ``places``: where they are. ``alone``: classes of equal segments, (h, c, n, first), that share their anchor with no
    other class; ``n`` is their number, above one, and ``first`` the least document. ``shards``: the other classes with
    their content, dealt by anchor. ``often``: those whose anchor has very many classes.
    """

    places: DataFrame
    alone: DataFrame
    shards: DataFrame
    often: DataFrame | None


CLASSES = "h bigint, c bigint, n bigint, first bigint"


def repeats(texts: DataFrame, segments_of, cell_bits: int, hot: int) -> Repeats:
    """``texts``: k1, k2, text. ``segments_of(batch)`` gives Segments and a function from one of them to its content.

    Copies are merged before the shuffle; only the first document of each class sends its content, and only if the anchor
    has other classes too. Anchors with more than ``hot`` classes get no shard, see ``by_windows``.
    """
    spark = texts.sparkSession
    cells = count_cells(texts, lambda batch: np.concatenate([np.zeros(0, U), *(x.key for x, *_ in _parts(batch, segments_of))]), cell_bits)

    def find(*marked: SentCells):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for s, _, k1, k2 in _parts(batch, segments_of):
                    keep = np.flatnonzero(np.logical_and.reduce([m.has(s.key) for m in marked]))
                    s = s.take(keep)
                    yield batch_from([k1[s.doc], k2[s.doc], signed(s.key), signed(s.content), s.start, s.n], PLACES)

        return run

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                for s, _, k1, _ in _parts(batch, segments_of):
                    s = s.take(np.flatnonzero(cells.has(s.key)))
                    yield s.key, s.content, k1[s.doc]

        for key, content, k1 in _held(parts()):
            order = np.lexsort((k1, content, key))
            key, content, k1 = key[order], content[order], k1[order]
            heads = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (content[1:] != content[:-1])))
            yield batch_from([signed(key[heads]), signed(content[heads]), np.diff(np.append(heads, len(key))), k1[heads]], CLASSES)

    # Dealt by anchor, so that one shuffle serves to merge the classes and to count, exactly, those of each anchor. What
    # passed the bitmap by chance, a class that is alone and occurs once, ends here.
    classes = texts.mapInArrow(merge, CLASSES).repartition("h").groupBy("h", "c").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    classes = classes.withColumn("classes", F.count("*").over(Window.partitionBy("h"))).where("classes > 1 OR n > 1")
    classes = written(classes, "segment-classes")
    shared = F.col("classes").between(2, hot)
    total = classes.agg(F.count("*").alias("all"), F.count_if(shared).alias("several"), F.count_if(F.col("classes") > hot).alias("often")).first()
    several, alone, often = (classes.where(x).drop("classes") for x in (shared, "classes = 1", F.col("classes") > hot))

    def names(batch):
        return _name(unsigned(batch.column(0)), unsigned(batch.column(1)), np.asarray(batch.column(3)))

    wanted = count_cells(several, names, enough_bits(total["several"], cell_bits), 1)

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, content, k1, _ in _parts(batch, segments_of):
                s = s.take(np.flatnonzero(cells.has(s.key)))
                name = _name(s.key, s.content, k1[s.doc])
                name, once = np.unique(name, return_index=True)
                s = s.take(once[wanted.has(name)])
                m = len(s.n)
                none = np.full(m, np.iinfo(np.int64).max)
                data = [content(s, k) for k in range(m)]
                yield batch_from([signed(s.key), signed(s.content), np.zeros(m, np.int64), none, s.anchor, s.n, data], SHIPPED)

    contents = texts.mapInArrow(ship, SHIPPED)
    counts = several.select(
        "h", "c", "n", "first", *(F.lit(None).cast(kind).alias(x) for x, kind in (("anchor", "int"), ("windows", "int"), ("data", "binary")))
    )
    real = count_cells(classes.select("h"), lambda batch: unsigned(batch.column(0)), enough_bits(total["all"], cell_bits), 1)
    often = often if total["often"] else None
    return Repeats(texts.mapInArrow(find(cells, real), PLACES), alone, contents.union(counts).repartition(width(spark), "h"), often)


def _parts(batch: pa.RecordBatch, segments_of) -> Iterator[tuple]:
    """Segments, their content, k1 and k2 of slices of a batch."""
    for part in slices([batch], 2):
        yield *segments_of(part), np.asarray(part.column(0)), np.asarray(part.column(1))


@dataclass
class Shard:
    """The classes of equal segments whose anchors were dealt to one task."""

    key: np.ndarray
    content: np.ndarray
    n: np.ndarray
    first: np.ndarray  # least document
    anchor: np.ndarray
    windows: np.ndarray
    data: list[bytes]


def shard_of(batches: Iterator[pa.RecordBatch]) -> Shard | None:
    """Joins the counts of each class with its content."""
    tables = list(batches)
    if not tables:
        return None
    table = pa.Table.from_batches(tables)
    key, content, n = unsigned(table["h"]), unsigned(table["c"]), np.asarray(table["n"])
    has_data = ~np.asarray(table["data"].is_null())
    order = np.lexsort((~has_data, content, key))
    new = np.append(True, (key[order][1:] != key[order][:-1]) | (content[order][1:] != content[order][:-1]))
    heads = np.flatnonzero(new)
    total = np.add.reduceat(n[order], heads)
    first = np.minimum.reduceat(np.asarray(table["first"])[order], heads)
    keep = total > 0  # content of a class that wasn't asked for comes without a count
    rows = order[heads][keep]
    if not has_data[rows].all():
        raise RuntimeError("a class came without its content")
    data = table["data"].take(pa.array(rows)).to_pylist()
    anchor = np.asarray(table["anchor"].take(pa.array(rows)))
    return Shard(key[rows], content[rows], total[keep], first[keep], anchor, np.asarray(table["windows"])[rows], data)


def by_windows(found: Repeats, texts: DataFrame, segments_of, cell_bits: int, window_of, length: int, covered) -> DataFrame | None:
    """Covers for anchors of very many classes, without bringing those together: windows count by their digest.

    ``window_of(offset)`` is the column of the window at that offset, ``covered`` the condition on ``own`` (the class)
    and ``all`` (all its occurrences), each a struct of n and first. None where no anchor has so many.
    """
    often = found.often
    if often is None:
        return None
    cells = count_cells(often.select("h"), lambda batch: unsigned(batch.column(0)), cell_bits, 1)

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, content, _, _ in _parts(batch, segments_of):
                s = s.take(np.flatnonzero(cells.has(s.key)))
                s = s.take(np.unique(np.stack([s.key, s.content]), axis=1, return_index=True)[1])
                data = [content(s, k) for k in range(len(s.n))]
                yield batch_from([signed(s.key), signed(s.content), s.n, data], ddl)

    ddl = "h bigint, c bigint, windows int, data binary"
    contents = texts.mapInArrow(ship, ddl).groupBy("h", "c").agg(F.first("windows").alias("windows"), F.first("data").alias("data"))
    single = (
        often.join(contents, ["h", "c"])
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("windows") - 1)))
        .select("h", "c", "o", F.struct("n", "first").alias("own"), F.md5(window_of(F.col("o"))).alias("w"))
    )
    total = single.groupBy("w").agg(F.struct(F.sum("own.n").alias("n"), F.min("own.first").alias("first")).alias("all"))
    met = single.join(total, "w").withColumn("o", F.when(covered, F.col("o")))
    return met.groupBy("h", "c").agg(
        F.min("own.first").alias("first"),
        F.coalesce(F.min("o"), F.lit(0)).cast("int").alias("low"),
        F.coalesce(F.max("o") + length, F.lit(0)).cast("int").alias("high"),
    )


def with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``rows`` of doc_id, text, k1 and k2, with the list of (a, b) of each in ``spans``."""
    lists = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    return rows.join(lists, ["k1", "k2"], "left").select("doc_id", "text", "spans")


def merged(spans: list[dict] | None, limit: int) -> list[tuple[int, int]]:
    """Disjoint runs, ascending."""
    out: list[list[int]] = []
    for a, b in sorted((s["a"], min(s["b"], limit)) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        elif a < b:
            out.append([a, b])
    return [(a, b) for a, b in out]
