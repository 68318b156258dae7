"""Type 2 slowly changing dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.columns import pack, quoted
from larder.functions.dates import moment
from larder.functions.keys import hash_key
from larder.operators.change_set import ACTION, DELETE, INSERT, IS_UPDATE


# Optional column of a dimension: whether a version is the first of its key that lasts. Kept by ``apply_rows`` where a table
# has it, so that dated lookups need not look at the other versions of a key.
FIRST = "_first_version"


@dataclass(frozen=True)
class Dimension:
    """Column roles of a versioned dimension."""

    name: str
    hash_key: str
    keys: tuple[str, ...]
    attrs: tuple[str, ...]
    start: str = "eff_start_date"
    end: str = "eff_end_date"
    current: str = "is_current"
    # Columns the literal rules match on; only used by mode='as_written'.
    match_on: tuple[str, ...] | None = None

    @property
    def columns(self) -> list[str]:
        return [self.hash_key, *self.keys, *self.attrs, self.start, self.end, self.current]

    def columns_of(self, table: DataFrame) -> list[str]:
        """The columns of a dimension table, the mark of first versions included if it has one."""
        return [*self.columns, *([FIRST] if FIRST in table.columns else [])]

    def empty_like(self, snapshot: DataFrame, marked: bool = False) -> DataFrame:
        """A dimension without rows, typed after the snapshot that will feed it; ``marked`` adds ``FIRST``."""
        src = {f.name: f for f in snapshot.schema.fields}
        ts = T.TimestampNTZType()
        fields = [
            T.StructField(self.hash_key, T.LongType()),
            *[T.StructField(c, src[c].dataType, True, src[c].metadata) for c in (*self.keys, *self.attrs)],
            T.StructField(self.start, ts),
            T.StructField(self.end, ts),
            T.StructField(self.current, T.BooleanType()),
            *([T.StructField(FIRST, T.BooleanType())] if marked else []),
        ]
        return snapshot.sparkSession.createDataFrame([], T.StructType(fields))


def open_versions(rows: DataFrame, dim: Dimension, ts: datetime | Column, marked: bool = False) -> DataFrame:
    """One open version per row, starting at ``ts``; ``marked`` as the first of its key."""
    start = moment(ts)
    return rows.select(
        hash_key(*dim.keys, *dim.attrs, start).alias(dim.hash_key),
        *dim.keys,
        *dim.attrs,
        start.alias(dim.start),
        F.lit(None).cast("timestamp_ntz").alias(dim.end),
        F.lit(True).alias(dim.current),
        *([F.lit(True).alias(FIRST)] if marked else []),
    )


def apply_scd2(
    table: DataFrame,
    changes: DataFrame,
    dim: Dimension,
    ts: datetime | Column,
    mode: str = "corrected",
) -> DataFrame:
    """The dimension after one batch of change rows (see ``change_set``).

    ``corrected`` compares each incoming row with the current version of its
    key, NULLs counting as values: equal rows change nothing, others close the
    current version at ``ts`` and open a new one. A key that is only deleted
    keeps its open version. ``as_written`` follows the literal rules instead:
    match any version on key and attributes, close on the delete half of an
    update, insert when nothing matches.
    """
    if mode == "as_written":
        return _apply_literal(table, changes, dim, ts)
    if mode != "corrected":
        raise ValueError(f"unknown mode: {mode}")
    return apply_rows(table, changes.where(F.col(ACTION) == INSERT), dim, ts)


def apply_rows(table: DataFrame, rows: DataFrame, dim: Dimension, ts: datetime | Column) -> DataFrame:
    """The dimension after its keys took on the values in ``rows``, one row per key.

    The corrected rules of ``apply_scd2`` for input that is a state rather than
    a set of changes; rows equal to the current version change nothing, so the
    state need not be compared with its predecessor first.
    """
    columns, marked = dim.columns_of(table), FIRST in table.columns
    body = [c for c in columns if c not in dim.keys]
    types = {f.name: f.dataType for f in table.schema.fields}
    typed = rows.selectExpr(
        *[f"CAST({quoted(c)} AS {types[c].simpleString()}) AS {quoted(c)}" for c in (*dim.keys, *dim.attrs)]
    )
    fresh = open_versions(typed, dim, ts, marked).select(*dim.keys, pack(body).alias("_new"))
    current = table.where(F.col(dim.current)).select(*dim.keys, pack(body).alias("_cur"))
    history = table.where(~F.coalesce(F.col(dim.current), F.lit(False)))

    same = pack(dim.attrs, "_cur.").eqNullSafe(pack(dim.attrs, "_new."))
    opens = F.col("_new").isNotNull() & (F.col("_cur").isNull() | ~same)
    closing = {dim.end: "_at", dim.current: "false"}
    cur_after = ", ".join(
        f"IF(_opens, {closing[c]}, _cur.{quoted(c)}) AS {quoted(c)}" if c in closing else f"_cur.{quoted(c)}" for c in body
    )
    # A version that ends where it starts never lasts; the next one is the first then.
    first = f"_cur IS NULL OR (_cur.{quoted(FIRST)} AND _cur.{quoted(dim.start)} >= _at)"
    new_after = ", ".join(f"{first} AS {quoted(c)}" if c == FIRST else f"_new.{quoted(c)}" for c in body)
    both = f"array(CASE WHEN _cur IS NOT NULL THEN struct({cur_after}) END, CASE WHEN _opens THEN struct({new_after}) END)"
    live = (
        current.join(fresh, list(dim.keys), "full_outer")
        .withColumns({"_opens": opens, "_at": moment(ts)})
        .select(*dim.keys, F.expr(f"inline(array_compact({both}))"))
        .select(*columns)
    )
    return _keep_metadata(history.select(*columns).unionByName(live), table)


def _apply_literal(table: DataFrame, changes: DataFrame, dim: Dimension, ts) -> DataFrame:
    on = list(dim.match_on or (*dim.keys, *dim.attrs))
    gone = (
        changes.where((F.col(ACTION) == DELETE) & F.col(IS_UPDATE))
        .select(*on).distinct().withColumn("_gone", F.lit(True))
    )
    hit = F.coalesce(F.col("_gone"), F.lit(False))
    closed = table.join(gone, on, "left").select(
        *[c for c in dim.columns if c not in (dim.end, dim.current)],
        F.when(hit, moment(ts)).otherwise(F.col(dim.end)).alias(dim.end),
        F.when(hit, F.lit(False)).otherwise(F.col(dim.current)).alias(dim.current),
    )
    added = changes.where(F.col(ACTION) == INSERT).join(table.select(*on), on, "left_anti")
    return closed.select(*dim.columns).unionByName(open_versions(added, dim, ts))


def current_rows(table: DataFrame, dim: Dimension) -> DataFrame:
    return table.where(F.col(dim.current))


def scd2_history(
    log: DataFrame,
    keys: Sequence[str],
    attrs: Sequence[str],
    ts: str,
    seq: str,
    bucket: str = "hour",
) -> DataFrame:
    """All versions that replaying an ordered change log would leave behind.

    Each key's timeline is cut into ``bucket`` pieces (a ``date_trunc`` unit)
    and windows run inside a piece, so a key with a third of the log is spread
    over as many tasks as it has pieces. The last state of earlier pieces and
    the first change of later pieces come from summaries with one row per key
    and piece. Windows and summaries all read one shuffle of the log. Entries
    without a key or a time have no place on any timeline; ``without_place``
    returns them, so that none is lost unseen.
    """
    keys = list(keys)
    piece = [*keys, "_piece"]
    named = [F.col(ts).alias("_ts"), F.col(seq).alias("_seq"), F.date_trunc(bucket, ts).alias("_piece")]
    # The conditions spelled out are those the joins below imply; so all
    # branches have the same input and share its shuffle.
    present = reduce(and_, [F.col(c).isNotNull() for c in (*keys, ts)])
    rows = log.where(present).select(*keys, *attrs, *named).repartition(*piece)
    state = F.struct(*attrs)
    across = Window.partitionBy(*keys).orderBy("_piece")
    inside = Window.partitionBy(*piece).orderBy("_ts", "_seq")

    last_states = (
        rows.groupBy(*piece).agg(F.max_by(state, F.struct("_ts", "_seq")).alias("_last"))
        .select(*piece, F.lag("_last").over(across).alias("_carried"))
        .where(F.col("_carried").isNotNull())
    )
    versions = (
        rows.withColumn("_before", F.lag(state).over(inside))
        .join(last_states, piece, "left")
        .where(~state.eqNullSafe(F.coalesce("_before", "_carried")))
        .withColumn("_until", F.lead("_ts").over(inside))
    )
    next_starts = (
        versions.groupBy(*piece).agg(F.min("_ts").alias("_first"))
        .select(*piece, F.lead("_first").over(across).alias("_next"))
        .where(F.col("_next").isNotNull())
    )
    end = F.coalesce("_until", "_next")
    return versions.join(next_starts, piece, "left").select(
        *keys,
        *attrs,
        F.col("_ts").alias("eff_start_date"),
        end.alias("eff_end_date"),
        end.isNull().alias("is_current"),
    )


def without_place(log: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Entries of a log that ``scd2_history`` has to leave out: no key or no time."""
    return log.where(reduce(or_, [F.col(c).isNull() for c in (*keys, ts)]))


def _keep_metadata(df: DataFrame, like: DataFrame) -> DataFrame:
    for f in like.schema.fields:
        if f.metadata:
            df = df.withMetadata(f.name, f.metadata)
    return df
