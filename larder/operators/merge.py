"""Keyed upsert into a table that has no MERGE of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import listed, quoted

SMALL_SOURCE_BYTES = 16 << 20  # a broadcast passes through the driver


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    insert_cols: Sequence[str] | None = None,
    changed_on: Sequence[str] | None = None,
    small_source: bool = False,
) -> DataFrame:
    """The next version of ``target`` after upserting ``source``.

    * ``update_cols`` are overwritten on a key match; other columns stay.
    * ``insert_cols`` are filled for new keys; other columns are NULL.
    * ``changed_on`` leaves a matched row alone unless one of these columns
      differs, NULLs counting as values.

    Both default to every non-key column that ``source`` has. ``source`` holds
    one row per key (see ``latest_per_key``). Column names, types and tags are
    those of ``target``.

    By default both sides meet in one full outer join, one shuffle each. A caller
    that expects a small source (some megabytes) can say ``small_source``: the
    source is read once to measure it. Up to ``SMALL_SOURCE_BYTES`` it is
    broadcast and the target is read twice (the second time keys only) and not
    shuffled at all; a larger one takes the full outer join.
    """
    keys = list(keys)
    shared = [c for c in target.columns if c in source.columns and c not in keys]
    update_cols = set(shared if update_cols is None else update_cols)
    insert_cols = set(shared if insert_cols is None else insert_cols)
    rest = [c for c in target.columns if c not in keys]
    fields = {f.name: f for f in target.schema.fields}

    def cast(c: str, prefix: str = "") -> str:
        return f"CAST({prefix}{quoted(c)} AS {fields[c].dataType.simpleString()})"

    taken = "".join(f", {cast(c)} AS {quoted(c)}" for c in shared)
    incoming = source.selectExpr(*[f"{cast(k)} AS {quoted(k)}" for k in keys], f"struct(1 AS _side{taken}) AS _s")
    kept = target.selectExpr(*map(quoted, keys), f"struct(1 AS _side{''.join(', ' + quoted(c) for c in rest)}) AS _t")

    matched = "_t IS NOT NULL AND _s IS NOT NULL"
    if changed_on:
        matched += f" AND NOT (struct({listed(changed_on, '_t.')}) <=> struct({listed(changed_on, '_s.')}))"

    def next_value(c: str) -> str:
        new = f"_s.{quoted(c)}" if c in shared else "NULL"
        first = new if c in insert_cols else "NULL"
        updated = f"WHEN {matched} THEN {new}" if c in update_cols else ""
        value = f"CASE WHEN _t IS NULL THEN {first} {updated} ELSE _t.{quoted(c)} END"
        return f"CAST({value} AS {fields[c].dataType.simpleString()}) AS {quoted(c)}"

    def finish(joined: DataFrame) -> DataFrame:
        return joined.selectExpr(*[quoted(c) if c in keys else next_value(c) for c in target.columns])

    if small_source and _size(incoming) <= SMALL_SOURCE_BYTES:
        updated = finish(kept.join(F.broadcast(incoming), keys, "left"))
        # Never more keys than the source has.
        found = target.select(*keys).join(F.broadcast(incoming.select(*keys)), keys, "left_semi")
        fresh = incoming.join(F.broadcast(found), keys, "left_anti").withColumn("_t", F.lit(None).cast(kept.schema["_t"].dataType))
        merged = updated.unionByName(finish(fresh))
    else:
        merged = finish(kept.join(incoming, keys, "full_outer"))
    for c in target.columns:
        if fields[c].metadata:
            merged = merged.withMetadata(c, fields[c].metadata)
    return merged


def _size(df: DataFrame) -> int:
    """Bytes of all rows written out as text, summed up where they are read."""
    size = F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    return df.agg(F.sum(size.cast("bigint"))).first()[0] or 0


def insert_select(target: DataFrame, source: DataFrame) -> DataFrame:
    """Append ``source`` by column name, cast to the types of ``target``."""
    cols = [
        (F.col(f.name) if f.name in source.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema.fields
    ]
    return target.unionByName(source.select(*cols))
