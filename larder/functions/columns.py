"""Groups of columns as one expression, and how much a table holds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    return f"`{name}`"


def listed(columns: Iterable[str], prefix: str = "") -> str:
    """Column names as SQL text, each behind ``prefix`` (such as ``_old.``)."""
    return ", ".join(prefix + quoted(c) for c in columns)


def pack(columns: Iterable[str], prefix: str = "") -> Column:
    """One struct of the named columns."""
    return F.expr(f"struct({listed(columns, prefix)})")


SMALL_BYTES = 32 << 20  # a broadcast passes through the driver


def row_bytes(df: DataFrame) -> int:
    """About what all rows take in memory, eight bytes for each column and the length of texts, summed up where they are read."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    size = sum((F.coalesce(F.octet_length(F.col(quoted(c))), F.lit(0)) for c in texts), F.lit(8 * (len(df.columns) + 1)))
    return df.agg(F.sum(size.cast("bigint"))).first()[0] or 0


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df``, which is read once to measure it, with a broadcast hint up to ``SMALL_BYTES``; a larger one as it is."""
    return F.broadcast(df) if row_bytes(df) <= SMALL_BYTES else df
