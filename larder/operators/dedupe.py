"""One row per key out of a batch that may hold several."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the largest ``order_by`` values for each key.

    An aggregate, not a window: every task first reduces its own rows to one
    per key, so a key that holds a third of the input shuffles one row per
    task. Ties fall back to the remaining columns, which makes the choice
    repeatable. NULL order values lose against any value.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    best = F.max(F.struct(*order_by, *rest)).alias("_best")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])
