"""What the operators share: their input columns, row keys and tables written to the shared folder."""

from __future__ import annotations

import zlib
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.session import delete_folder, run_dir, shared_dir, shuffles_dropped  # noqa: F401

# The ASCII white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
NO_ID = (1 << 63) - 1  # stands for a null id: larger than all others


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def plain(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and text, so that other columns of any name cannot clash; null text is empty."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    )


def keyed(rows: DataFrame) -> DataFrame:
    """Adds what identifies a row of ``plain`` in joins: the id (nulls as ``NO_ID``) and a hash of the text.

    The hash only tells rows apart that share an id.
    """
    return rows.withColumn("k1", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("k2", F.hash("text"))


def hex_sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary") if isinstance(text, Column) else F.col(text).cast("binary"), 256)


_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_scopes: ContextVar[tuple[list[DataFrame], ...]] = ContextVar("scopes", default=())


def written(df: DataFrame, label: str, outlives: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: later readers see one result, whatever executors are lost.

    The folder goes when the session ends, or at the end of the innermost ``scratch`` block (``outlives``: of the one
    around it).
    """
    spark = df.sparkSession
    path = run_dir(spark, label)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _folders[table] = path
    scopes = _scopes.get()[:-1] if outlives else _scopes.get()
    if scopes:
        scopes[-1].append(table)
    return table


def deleted(*tables: DataFrame | None) -> None:
    """Deletes tables that ``written`` made and nothing will read again."""
    for table in tables:
        path = table is not None and _folders.pop(table, None)
        if path:
            delete_folder(table.sparkSession, path)


@contextmanager
def scratch():
    """Deletes at its end what ``written`` made inside; what is read later has to be written with ``outlives``."""
    tables: list[DataFrame] = []
    token = _scopes.set((*_scopes.get(), tables))
    try:
        yield
    finally:
        _scopes.reset(token)
        deleted(*tables)


def checkpointed(df: DataFrame) -> DataFrame:
    """Lineage cut in the shared folder, which is set here only where the session names none."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(),
    "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64()), "array<int>": pa.list_(pa.int32()),
}


def arrow_schema(ddl: str) -> pa.Schema:
    """``name type, ...`` as Arrow sees it; usable in tasks, where Spark's parser is out of reach."""
    return pa.schema([(name, ARROW[kind]) for name, kind in (field.split() for field in ddl.split(","))])


def batch_of(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = arrow_schema(ddl)
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def batch_from(columns: list, ddl: str) -> pa.RecordBatch:
    """A batch from arrays, one for each column."""
    schema = arrow_schema(ddl)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def slices(batches, text: int, limit: int = 4 << 20):
    """Slices of batches with about ``limit`` bytes of text in column ``text``, of one row at least; a text is never cut.

    Arrays made for a slice stay small, whatever the batches are. An empty batch gives nothing.
    """
    for batch in batches:
        sizes = np.cumsum(np.asarray(pc.binary_length(batch.column(text)), np.int64))
        start = 0
        while start < batch.num_rows:
            done = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def summed(df: DataFrame, of_batch, shape: tuple[int, ...], groups: int = 16) -> np.ndarray:
    """The sum of ``of_batch(batch)``, arrays of a fixed shape, over all batches of ``df``.

    Each task sends one array, ``groups`` tasks add those up as they come, and the driver adds the last few.
    """

    def inside(batches):
        total = np.zeros(shape)
        for batch in batches:
            total += of_batch(batch)
        yield batch_of([(TaskContext.get().partitionId() % groups, zlib.compress(total.tobytes(), 1))], "g int, data binary")

    def across(batches):
        total = np.zeros(shape)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total += np.frombuffer(zlib.decompress(data)).reshape(shape)
        yield batch_of([(zlib.compress(total.tobytes(), 1),)], "data binary")

    parts = df.mapInArrow(inside, "g int, data binary").repartition(groups, "g").select("data")
    total = np.zeros(shape)
    for r in parts.mapInArrow(across, "data binary").toLocalIterator():
        total += np.frombuffer(zlib.decompress(r.data)).reshape(shape)
    return total
