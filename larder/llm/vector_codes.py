"""Vectors as short codes: product quantisation whose nearest entries are found by Orchard's search."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.tables import arrow_schema, written
from larder.llm.vectors import floor_mean, vectors, whole

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BROADCAST_LABELS = 100_000


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry, position]``: whole numbers, one codebook for each part of a vector."""

    entries: np.ndarray

    @property
    def length(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """For each entry the others of its codebook by distance, then index, and those squared distances."""
        gaps = self.entries[:, :, None, :] - self.entries[:, None, :, :]
        squares = (gaps * gaps).sum(3)
        itself = np.eye(squares.shape[1], dtype=bool)
        order = np.argsort(np.where(itself, -1, squares), axis=2, kind="stable")[:, :, 1:]
        return order, np.take_along_axis(squares, order, 2)


def orchard(points: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part of ``points[row, part, position]``, ties to the lower index, and its squared distance.

    Every point walks the neighbour list of its best entry so far, nearest neighbours first. An entry that improves on it
    becomes the best, and the walk goes on at the start of its list; visited entries are skipped. An entry farther from the
    best one than twice the point's distance to it cannot be nearer to the point, nor can the rest of the list, so the walk
    ends there. All points of a batch take a step at a time.
    """
    n, parts, _ = points.shape
    order, squares = books.neighbours()
    flat = points.reshape(n * parts, -1)
    part = np.tile(np.arange(parts), n)
    entries = order.shape[1]
    best = np.zeros(n * parts, np.int64)
    gap = flat - books.entries[part, 0]
    distance = (gap * gap).sum(1)
    visited = np.zeros((n * parts, entries), bool)
    visited[:, 0] = True
    place = np.zeros(n * parts, np.int64)
    walking = np.arange(n * parts if entries > 1 else 0)
    while walking.size:
        p, b, j = part[walking], best[walking], place[walking]
        reached = squares[p, b, j] <= 4 * distance[walking]
        walking, p, b, j = walking[reached], p[reached], b[reached], j[reached]
        other = order[p, b, j]
        place[walking] = j + 1
        fresh = ~visited[walking, other]
        at, to, of = walking[fresh], other[fresh], p[fresh]
        visited[at, to] = True
        gap = flat[at] - books.entries[of, to]
        found = (gap * gap).sum(1)
        better = (found < distance[at]) | ((found == distance[at]) & (to < best[at]))
        jump = at[better]
        best[jump], distance[jump], place[jump] = to[better], found[better], 0
        walking = walking[place[walking] < entries - 1]
    return best.reshape(n, parts), distance.reshape(n, parts)


def cut(batch: pa.RecordBatch, column: str, parts: int) -> np.ndarray:
    """A batch's vectors, all of one length, as ``[row, part, position]``."""
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(batch.num_rows, parts, -1)


def _first(rows: DataFrame, n: int) -> list[list[int]]:
    """The vectors of the ``n`` smallest ids, nulls last; equal ids by components."""
    least = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(n)
    return [r.v for r in least.orderBy(F.col("vec_id").asc_nulls_last(), "v").collect()]  # n rows at most


def divisible(rows: DataFrame, parts: int) -> tuple[DataFrame, int]:
    """The rows that can be cut: as long as the one with the smallest id whose length is a multiple of ``parts``."""
    fits = rows.where((F.size("v") > 0) & (F.size("v") % parts == 0))
    first = _first(fits, 1)
    length = len(first[0]) if first else 0
    return fits.where(F.size("v") == length), length


def fit_codebooks(rows: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks for ``rows`` (vec_id, v of whole numbers, all of ``length``) after ``rounds`` rounds over all of them.

    Each task adds up its own vectors by part and entry; what is shuffled and comes to the driver has the size of the
    codebooks. Sums are exact whatever the number of rows.
    """
    wide = length // parts
    first = _first(rows, entries)
    start = np.array(first, np.int64).reshape(len(first), parts, wide)
    books = Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)))
    for _ in range(rounds if first else 0):
        books = _next(rows.select("v"), books)
    return books


def _next(rows: DataFrame, books: Codebooks) -> Codebooks:
    parts, entries, wide = books.entries.shape
    ddl = "part int, entry int, n bigint, total array<bigint>"

    def inside(batches):
        total = np.zeros((parts, entries, wide), np.int64)
        count = np.zeros((parts, entries), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            points = cut(batch, "v", parts)
            best, _ = orchard(points, books)
            slot = (best + np.arange(parts) * entries).reshape(-1)
            np.add.at(total.reshape(-1, wide), slot, points.reshape(-1, wide))
            count += np.bincount(slot, minlength=parts * entries).reshape(parts, entries)
        used = np.argwhere(count)
        columns = [used[:, 0], used[:, 1], count[tuple(used.T)], list(total[tuple(used.T)])]
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, arrow_schema(ddl))], schema=arrow_schema(ddl))

    exact = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(wide)]
    sums = rows.mapInArrow(inside, ddl).groupBy("part", "entry").agg(F.sum("n").alias("n"), *exact)
    after = books.entries.copy()
    for r in sums.collect():  # one row for each entry in use
        after[r.part, r.entry] = floor_mean((r[f"s{i}"] for i in range(wide)), r.n)
    return Codebooks(after)


def encoded(rows: DataFrame, books: Codebooks, *more: str) -> DataFrame:
    """vec_id, codes (one entry for each part), error (squared distances of all parts) and the columns ``more``."""
    parts = books.entries.shape[0]
    kept = rows.select("vec_id", *more, "v")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "v")

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            best, distance = orchard(cut(batch, "v", parts), books)
            columns = [batch.column(k) for k, name in enumerate(batch.schema.names) if name != "v"]
            names = [name for name in batch.schema.names if name != "v"]
            columns += [pa.array(list(best.astype(np.int32)), pa.list_(pa.int32())), pa.array(distance.sum(1), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "codes", "error"])

    return kept.mapInArrow(assign, f"{fields}, codes array<int>, error bigint")


def decoded(codes: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """vec_id and v: the vector that ``codes`` stand for, each component in the middle of its step."""
    tables = F.array(*[F.array(*[F.array(*[F.lit(int(x)) for x in e]) for e in part]) for part in books.entries])
    pieces = F.transform("codes", lambda c, i: F.get(F.get(tables, i), c))
    values = F.transform(F.flatten(pieces), lambda x: (x.cast("double") + 0.5) / float(scale))
    return codes.select("vec_id", values.alias("v"))


def compressed(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str | None = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """Every sound vector as ``parts`` codebook indexes: (vec_id, label, codes, error) and the codebooks.

    Null vectors and those with a null, NaN or infinite component go; so do vectors that cannot be cut like the others:
    length not a multiple of ``parts``, or other than that of the smallest such id. Null ids stay and come last among the
    first entries; repeated rows count and return as often as they occur; equal distances go to the lower index. With fewer
    vectors than ``entries`` the codebooks are smaller; an empty table gives no rows. Other columns are not looked at. A
    component of more than 2^26 steps ends the job with an error.
    """
    # The label gets a name of its own, so that it may be called like any of the columns made here.
    label = F.lit(None).cast("int") if label_col is None else F.col(label_col)
    sure = vectors(df.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_v"), label.alias("label")), "_id", "_v", "label")
    fits, length = divisible(sure, parts)
    rows = fits.withColumn("v", whole("v", scale))
    books = fit_codebooks(rows, length, parts, entries, rounds)
    if not books.entries.size:
        return encoded(rows.where("false"), Codebooks(np.zeros((parts, 1, 1), np.int64)), "label"), books
    return encoded(rows, books, "label"), books


def code_digests(df: DataFrame, **options) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error (errors summed over equal labels) and the codebooks' digest.

    Rows are written once; a label's errors are added up in each task before they are shuffled. Few labels are broadcast,
    by their measured number; many are joined, and a hot label's rows are split by the runtime.
    """
    codes, books = compressed(df, **options)
    rows = written(codes, "codes")
    labels = written(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    side = labels.withColumnRenamed("label", "_label")
    if labels.count() <= BROADCAST_LABELS:
        side = F.broadcast(side)
    code = F.lower(F.concat_ws("", F.transform("codes", lambda c: F.lpad(F.hex(c), 2, "0"))))
    return rows.join(side, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", code.alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
