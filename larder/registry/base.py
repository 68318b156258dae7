"""Named queries over the retail tables, each with an equivalent SQL text where there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.plans.retail import TABLES, Retail


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Retail], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``."""

    def register(build: Callable[[Retail], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(name, build, named_tables(sql) if sql else None)
        return build

    return register


def named_tables(text: str) -> str:
    """``{orders}`` becomes ``orders``."""
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, because engines differ in the decimal widths they derive."""
    cols = [
        F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)
