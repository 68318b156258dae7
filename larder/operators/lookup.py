"""Dimension lookups: by key, by key and date, and along long histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.columns import broadcast_if_small
from larder.operators.scd2 import FIRST, Dimension


def lookup(
    facts: DataFrame,
    table: DataFrame,
    dim: Dimension,
    fact_key: Column,
    take: dict[str, str],
    at: Column | None = None,
    small: bool = False,
) -> DataFrame:
    """LEFT join to a dimension, bringing ``take`` (dimension column -> new name).

    With ``at`` the version valid at that moment is taken
    (``start <= at < end``), otherwise the current one. The first version of a
    key also covers the time before it: what is known of a key since its first
    load is the best there is for facts that are older. At most one version
    matches, so facts never multiply. Join keys are cast to the dimension's
    key type on the fact side. No hint is given: Spark measures the dimension
    and broadcasts it only below its threshold; beyond that it shuffles both
    sides and splits skewed fact partitions. A caller that expects a dimension
    of some megabytes under many facts can say ``small``: what is looked up is
    measured then and broadcast if it is (``broadcast_if_small``).
    """
    key = dim.keys[0]
    side = lasting(table, dim) if at is not None else table.where(F.col(dim.current))
    picked = side.select(
        F.col(key).alias("_k"),
        *([F.when(~F.col(FIRST), F.col(dim.start)).alias("_from"), F.col(dim.end).alias("_to")] if at is not None else []),
        *[F.col(c).alias(n) for c, n in take.items()],
    )
    if small:
        picked = broadcast_if_small(picked)
    on = fact_key.cast(table.schema[key].dataType) == F.col("_k")
    if at is not None:
        on = on & (F.col("_from").isNull() | (F.col("_from") <= at)) & (F.col("_to").isNull() | (at < F.col("_to")))
    return facts.join(picked, on, "left").drop("_k", "_from", "_to")


def lasting(table: DataFrame, dim: Dimension) -> DataFrame:
    """The versions that were valid at some time, those that begin a key's history marked in ``FIRST``.

    Two changes at one moment leave a version that ends where it starts. A table that carries the mark is only filtered;
    others are sorted per key to find it.
    """
    if FIRST in table.columns:
        return table.where(F.col(dim.end).isNull() | (F.col(dim.start) < F.col(dim.end)))
    history = Window.partitionBy(*dim.keys).orderBy(F.col(dim.start), F.col(dim.hash_key))
    valid = table.where(F.col(dim.end).isNull() | (F.col(dim.start) < F.col(dim.end)))
    return valid.withColumn(FIRST, F.row_number().over(history) == 1)


def lookup_along_history(
    facts: DataFrame,
    table: DataFrame,
    dim: Dimension,
    at: str,
    take: str,
    name: str,
    bucket: str = "hour",
) -> DataFrame:
    """As-of lookup for keys whose history is as long as their facts.

    A join would pair every fact with every version of its key. Here facts and
    version starts form one ordered timeline per key, cut into ``bucket``
    pieces like in ``scd2_history``; each fact takes the last version seen, so
    the work grows with rows, not pairs, and one hot key spreads over its
    pieces. ``facts`` carries the key columns under the dimension's names. As in
    ``lookup`` the first version covers the time before it.
    """
    keys = list(dim.keys)
    rest = [c for c in facts.columns if c not in keys]
    piece = [*keys, "_piece"]
    version = F.struct(F.col(take).alias("value"), F.col(dim.end).alias("until"))
    payload_type = facts.select(F.struct(*rest).alias("_f")).schema["_f"].dataType
    beginning = F.lit("0001-01-01").cast("timestamp_ntz")
    starts = lasting(table, dim).select(
        *keys, F.when(F.col(FIRST), beginning).otherwise(F.col(dim.start)).alias("_at"), F.lit(0).alias("_kind"),
        F.col(dim.hash_key).alias("_tie"), version.alias("_version"), F.lit(None).cast(payload_type).alias("_f"),
    )
    probes = facts.select(
        *keys, F.col(at).cast("timestamp_ntz").alias("_at"), F.lit(1).alias("_kind"),
        F.lit(None).cast(starts.schema["_tie"].dataType).alias("_tie"),
        F.lit(None).cast(starts.schema["_version"].dataType).alias("_version"), F.struct(*rest).alias("_f"),
    )
    line = starts.unionByName(probes).withColumn("_piece", F.date_trunc(bucket, "_at"))

    # Reads no fact columns, and each task reduces its rows to one per key and
    # piece before this small side is shuffled.
    across = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        line.groupBy(*piece).agg(F.max_by("_version", F.when(F.col("_kind") == 0, F.struct("_at", "_tie"))).alias("_last"))
        .select(*piece, F.last("_last", ignorenulls=True).over(across).alias("_carried"))
        .where(F.col("_carried").isNotNull())
    )
    so_far = (
        Window.partitionBy(*piece).orderBy("_at", "_kind", "_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    seen = F.coalesce(F.last("_version", ignorenulls=True).over(so_far), F.col("_carried"))
    valid = F.col("_seen.until").isNull() | (F.col("_at") < F.col("_seen.until"))
    return (
        line.join(carried, piece, "left")
        .withColumn("_seen", seen)
        .where(F.col("_kind") == 1)
        .select(
            *[F.col(c) if c in keys else F.col(f"_f.{c}").alias(c) for c in facts.columns],
            F.when(valid, F.col("_seen.value")).alias(name),
        )
    )


def orphans(facts: DataFrame, foreign_keys: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per foreign key, the number of fact rows and distinct values without a parent.

    One scan of the fact: each row yields its (constraint, value) pairs, which
    are counted before the shuffle, and only distinct values meet the parents.
    NULL means no reference, as in SQL. Values are compared in the type of the
    parent's column, so text keys are fine; they travel as text.
    """
    names = list(foreign_keys)

    def in_parent_type(n: str) -> Column:
        parent, column = foreign_keys[n]
        return F.col(n).cast(parent.schema[column].dataType).cast("string")

    pairs = F.inline(
        F.array(*[F.struct(F.lit(n).alias("fk"), in_parent_type(n).alias("value")) for n in names])
    )
    used = (
        facts.select(*names).select(pairs).where(F.col("value").isNotNull())
        .groupBy("fk", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    parents = None
    for n, (parent, column) in foreign_keys.items():
        side = parent.select(F.lit(n).alias("fk"), F.col(column).cast("string").alias("value"))
        parents = side if parents is None else parents.unionByName(side)
    lost = used.join(parents, ["fk", "value"], "left_anti")
    wanted = facts.sparkSession.createDataFrame([(n,) for n in names], "fk string")
    return (
        wanted.join(lost.groupBy("fk").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys")), "fk", "left")
        .select("fk", F.coalesce("rows", F.lit(0)).alias("orphan_rows"), F.coalesce("keys", F.lit(0)).alias("orphan_keys"))
    )


def match_audit(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Inner match of two change sets: the keys of both sides and in ``n`` how many pairs of rows have them.

    Each side is counted per key first, so a key with many rows on both sides is
    one row, not all their pairs.
    """
    one = left.groupBy(*[a for a, _ in on]).agg(F.count(F.lit(1)).alias("n"))
    two = right.groupBy(*[b for _, b in on]).agg(F.count(F.lit(1)).alias("n"))
    cond = [F.col(f"l.{a}") == F.col(f"r.{b}") for a, b in on]
    joined = one.alias("l").join(two.alias("r"), cond)
    pairs = (F.col("l.n") * F.col("r.n")).alias("n")
    return joined.select(*[F.col(f"l.{a}") for a, _ in on], *[F.col(f"r.{b}") for _, b in on], pairs)
