"""Vectors as whole numbers: what both vector operators read."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Beyond this a sum of squared differences of some hundred components no longer fits 64 bits.
LARGEST = 1 << 26


def sound(vector: str) -> Column:
    """Neither null nor with a null, NaN or infinite component. An empty vector is sound."""
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & F.coalesce(fine, F.lit(False))


def whole(vector: str, scale: int) -> Column:
    """Components x as floor(scale * x); one beyond ``LARGEST`` ends the job, as its squares would not be exact."""

    def one(x: Column) -> Column:
        n = F.floor(x * F.lit(float(scale)))
        stop = F.raise_error(F.concat(F.lit("vector component out of range: "), x.cast("string"))).cast("bigint")
        return F.when(F.abs(n) <= LARGEST, n).otherwise(stop)

    return F.transform(vector, one)


def vectors(df: DataFrame, id_col: str, vec_col: str, *more: str) -> DataFrame:
    """vec_id, v (doubles) and the columns ``more`` of the sound rows only, so that other names cannot clash."""
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"), *more)
    return rows.where(sound("v"))


def floor_mean(total: Iterable[int], count: int) -> list[int]:
    return [int(t) // int(count) for t in total]
