"""Uniqueness and references checked batch by batch, against an index of keys instead of whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.streaming.feed import existing

BATCH, RANGE = "_batch", "_range"


class KeyIndex:
    """How often a table has each value of a key, appended batch by batch and laid out by ranges of the key.

    A range is ``span`` consecutive values of a single whole-number key, or one of ``ranges`` hash ranges of any other key.
    Both belong to the index and stay. A check reads the ranges that the asked keys fall into, and confirms each key by its
    own value. Their numbers go through the driver: choose ``span`` so that the key space makes some thousands of ranges.

    A batch is one folder; the same batch again replaces it. ``duplicates`` and ``missing`` look at batches below or up to a
    given number, so a batch that broke off half-way is not seen. NULL in a key is a value for ``duplicates``, as in a
    grouping, and no reference for ``missing``.
    """

    def __init__(self, spark: SparkSession, root: str, keys: T.StructType, span: int | None = None, ranges: int = 256):
        if span is not None and (len(keys) != 1 or not isinstance(keys[0].dataType, T.IntegralType)):
            raise ValueError("span is for one whole-number key")
        if (span if span is not None else ranges) < 1:
            raise ValueError("span and ranges are 1 at least")
        self.spark, self.path, self.span, self.ranges = spark, f"{root.rstrip('/')}/keys", span, ranges
        self.types, self.keys = keys, keys.names
        self.schema = T.StructType(
            [*keys.fields, T.StructField("n", T.LongType()), T.StructField(BATCH, T.LongType()), T.StructField(RANGE, T.LongType())]
        )

    def range_of(self) -> Column:
        """The range of a row's key; a NULL is in range 0."""
        if self.span is not None:
            return F.coalesce(F.floor(F.col(self.keys[0]) / F.lit(self.span)).cast("bigint"), F.lit(0).cast("bigint"))
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.ranges)).cast("bigint")

    def counted(self, rows: DataFrame) -> DataFrame:
        """The keys of ``rows`` in the types of the index, and how often each occurs (``n``)."""
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.types.fields])
        return typed.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n"))

    def add(self, rows: DataFrame, batch: int) -> None:
        """Append the keys of a batch."""
        keys = self.counted(rows).withColumn(RANGE, self.range_of())
        # REBALANCE sizes the files: small ranges share tasks, a big one is split.
        keys.hint("rebalance", RANGE).write.mode("overwrite").partitionBy(RANGE).parquet(f"{self.path}/{BATCH}={batch}")

    def rows(self, upto: int | None = None) -> DataFrame:
        """Everything in the index, of batches up to ``upto`` if given."""
        found = existing(self.spark, self.path, self.schema)
        return found if upto is None else found.where(F.col(BATCH) <= upto)

    def meeting(self, keys: DataFrame, upto: int | None = None) -> DataFrame:
        """Index rows of ``keys``. Only their ranges are read, and of these only what lies between the least and the largest."""
        bounds = [F.struct(F.min(k).alias("low"), F.max(k).alias("high")).alias(f"b{i}") for i, k in enumerate(self.keys)]
        nulls = [F.max(F.col(k).isNull()).alias(f"null{i}") for i, k in enumerate(self.keys)]
        asked = keys.agg(F.collect_set(self.range_of()).alias("ranges"), *bounds, *nulls).first()
        found = self.rows(upto).where(F.col(RANGE).isin(asked["ranges"]))
        for i, k in enumerate(self.keys):
            low, high = asked[f"b{i}"]
            if low is not None and not asked[f"null{i}"]:
                found = found.where(F.col(k).between(low, high))
        same = [found[k].eqNullSafe(keys[k]) for k in self.keys]
        return found.join(keys.select(*self.keys), same, "left_semi")

    def duplicates(self, rows: DataFrame, batch: int) -> DataFrame:
        """Keys of a batch that occur more than once in it and all batches before it, with their count (``n``).

        Equals the check of the whole table where it concerns the batch; a key that no later batch names keeps its count.
        """
        here = self.counted(rows)
        before = self.meeting(here, batch - 1).select(*self.keys, "n")
        return here.unionByName(before).groupBy(*self.keys).agg(F.sum("n").alias("n")).where("n > 1")

    def missing(self, rows: DataFrame, column: str, upto: int | None = None) -> DataFrame:
        """``value`` and ``n``: what ``column`` refers to and the index does not have. For an index of one key.

        ``rows`` may count already (``n``), as the result of an earlier call does: asked again when the index has grown, it
        tells which references are still open, and reads no other ranges than theirs.
        """
        (key,) = self.types.fields
        count = F.sum("n") if "n" in rows.columns else F.count(F.lit(1))
        used = rows.select(F.col(column).cast(key.dataType).alias(key.name), *[c for c in ("n",) if c in rows.columns])
        used = used.where(F.col(key.name).isNotNull()).groupBy(key.name).agg(count.alias("n"))
        there = self.meeting(used, upto).select(key.name)
        return used.join(there, key.name, "left_anti").select(F.col(key.name).alias("value"), "n")
