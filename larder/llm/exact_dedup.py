"""Exact deduplication by Grace hashing.

Records are dealt to buckets by hash until a bucket fits an open-addressing table that compares complete contents. The
first level of buckets are Spark's shuffle partitions; a partition above the memory limit deals its records to spill
files of the task, again and again with fresh hash bits. Copies that meet in one input partition are merged before the
shuffle, so a group of any size sends one record per input partition.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.tables import BLANKS, batch_of, plain, scratch, width, written

FAN_OUT = 16
BUCKET_BYTES = 64 << 20


class ContentTable:
    """Open addressing with linear probes; a slot matches only if the complete contents are equal."""

    def __init__(self, capacity: int = 1024):
        self.slots = [-1] * capacity
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.best: list[tuple] = []  # (-length, doc id or +inf, serial): the least stays
        self.sizes: list[int] = []

    def add(self, content: bytes, hashed: int, rank: tuple, size: int) -> int:
        if 3 * len(self.contents) >= 2 * len(self.slots):
            self._grow()
        mask = len(self.slots) - 1
        at = hashed & mask
        while (k := self.slots[at]) >= 0:
            if self.hashes[k] == hashed and self.contents[k] == content:
                self.sizes[k] += size
                if rank < self.best[k]:
                    self.best[k] = rank
                return k
            at = (at + 1) & mask
        self.slots[at] = k = len(self.contents)
        self.hashes.append(hashed)
        self.contents.append(content)
        self.best.append(rank)
        self.sizes.append(size)
        return k

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for k, hashed in enumerate(self.hashes):
            at = hashed & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = k


def content_hash(content: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(content, digest_size=16).digest(), "little")


def grace(records: Iterator[tuple], limit: int, level: int = 0) -> Iterator[tuple[ContentTable, list]]:
    """Tables over disjoint contents, each with its [(record tag, slot)].

    ``records``: (content, hash, rank, size, tag). Whatever exceeds ``limit`` bytes of content goes to spill files in the
    task's own scratch folder, which are gone when the task ends or is repeated elsewhere.
    """
    held, size = [], 0
    for record in records:
        held.append(record)
        size += len(record[0]) + 200
        if size > limit and level < 12:
            break
    else:
        table = ContentTable()
        yield table, [(tag, table.add(content, h, rank, n)) for content, h, rank, n, tag in held]
        return
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        paths = [os.path.join(folder, str(b)) for b in range(FAN_OUT)]
        files = [open(p, "wb") for p in paths]
        shift = 64 + 4 * level  # bits that neither the slots nor other levels use
        try:
            for source in (held, records):
                for record in source:
                    pickle.dump(record, files[(record[1] >> shift) & (FAN_OUT - 1)], protocol=5)
        finally:
            for f in files:
                f.close()
        held.clear()
        for path in paths:
            yield from grace(_spilled(path), limit, level + 1)
            os.remove(path)


def _spilled(path: str) -> Iterator[tuple]:
    with open(path, "rb") as f:
        while True:
            try:
                yield pickle.load(f)
            except EOFError:
                return


LOCAL = (
    "doc_id bigint, part int, serial bigint, rep bigint, "
    "n bigint, length bigint, best_id bigint, best_serial bigint, bucket bigint, content binary"
)
CLASSES = (
    "part int, rep bigint, keep_part int, keep_serial bigint, keep_id bigint, group_size bigint, text_sha256 string"
)


def _rank(length: int, doc_id: int | None, part: int, serial: int) -> tuple:
    return (-length, float("inf") if doc_id is None else doc_id, part, serial)


def _signed(v: int) -> int:
    v &= (1 << 64) - 1
    return v - (1 << 64) if v >> 63 else v


def _merge_inside(limit: int):
    """Classes of one input partition. One row of each carries its content, size and best row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        blanks = BLANKS.encode()

        def records():
            serial = 0
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    raw = text.as_buffer().to_pybytes()
                    content = raw.translate(None, blanks)
                    # Continuation bytes do not begin a code point.
                    length = len(raw) - int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) == 0x80))
                    yield content, content_hash(content), _rank(length, doc_id, part, serial), 1, (doc_id, serial)
                    serial += 1

        for table, members in grace(records(), limit):
            rep: dict[int, int] = {}
            rows, held = [], 0
            for (doc_id, serial), k in members:
                if k in rep:
                    rows.append((doc_id, part, serial, rep[k]) + (None,) * 6)
                else:
                    rep[k] = serial
                    minus_length, best_id, _, best_serial = table.best[k]
                    rows.append((
                        doc_id, part, serial, serial, table.sizes[k], -minus_length,
                        None if best_id == float("inf") else best_id, best_serial, _signed(table.hashes[k] >> 64),
                        table.contents[k],
                    ))
                    held += len(table.contents[k])
                if held > 8 << 20 or len(rows) >= 50_000:
                    yield batch_of(rows, LOCAL)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows, LOCAL)

    return run


def _merge_across(limit: int):
    """Classes of different input partitions, by complete contents again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for batch in batches:
                for r in batch.to_pylist():
                    rank = _rank(r["length"], r["best_id"], r["part"], r["best_serial"])
                    yield r["content"], content_hash(r["content"]), rank, r["n"], (r["part"], r["rep"])

        for table, members in grace(records(), limit):
            rows = []
            digests = [hashlib.sha256(c).hexdigest() for c in table.contents]
            for (part, rep), k in members:
                _, best_id, keep_part, keep_serial = table.best[k]
                keep_id = None if best_id == float("inf") else best_id
                rows.append((part, rep, keep_part, keep_serial, keep_id, table.sizes[k], digests[k]))
                if len(rows) >= 50_000:
                    yield batch_of(rows, CLASSES)
                    rows = []
            if rows:
                yield batch_of(rows, CLASSES)

    return run


def exact_dedup(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Contents are equal when identical after deleting ASCII white space. The longest original text stays, then the
    smallest doc_id; a null id comes after all others, and of rows that repeat in id and text exactly one is kept.
    Null text counts as empty, and all empty texts are copies of each other. Other columns are ignored.
    """
    spark = docs.sparkSession
    # Rows are named by partition and serial number, so what names them has to be read back, not computed again.
    local = written(plain(docs).mapInArrow(_merge_inside(bucket_bytes), LOCAL), "exact-local")
    classes = (
        local.filter(F.col("content").isNotNull())
        .repartition(width(spark), "bucket")
        .select("part", "rep", "n", "length", "best_id", "best_serial", "content")
        .mapInArrow(_merge_across(bucket_bytes), CLASSES)
    )
    # A key of this join is a class of one input partition, so no key is hotter than a partition is long.
    return (
        local.select("doc_id", "part", "serial", "rep")
        .join(classes, ["part", "rep"])
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            ((F.col("part") == F.col("keep_part")) & (F.col("serial") == F.col("keep_serial"))).alias("kept"),
            "text_sha256",
        )
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops; all columns stay. Of rows that repeat in id and content one stays."""
    with scratch():
        found = exact_dedup(docs)
        sums = found.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
        sums = written(sums.where("NOT kept OR n > 1"), "exact-gone", outlives=True)

    def named(rows: DataFrame) -> tuple[Column, Column]:
        text = F.regexp_replace(F.coalesce(rows["text"].cast("string"), F.lit("")), r"[\x20\x09-\x0D]", "")
        return rows["doc_id"].cast("long"), F.sha2(text.cast("binary"), 256)

    doc_id, content = named(docs)
    left = docs.join(sums, doc_id.eqNullSafe(sums["doc_id"]) & (content == sums["text_sha256"]), "left_anti")
    twins = sums.where("kept").select(F.col("doc_id").alias("twin_id"), "text_sha256")  # one row of that id and content stays
    if not twins.limit(1).count():
        return left
    # A row travels as one struct, so that its columns may have any names. The longest text stays, as among all copies.
    rows = docs.select(doc_id.alias("id"), content.alias("sha"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    met = rows.join(twins, F.col("id").eqNullSafe(F.col("twin_id")) & (F.col("sha") == F.col("text_sha256")))
    text = F.col("row").getField("text").cast("string")
    best = met.groupBy("id", "sha").agg(F.max_by("row", F.struct(F.length(text), text)).alias("row"))
    return left.union(best.select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
