"""Net changes between two snapshots of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import pack, quoted

ACTION = "_action"
IS_UPDATE = "_is_update"
INSERT = "INSERT"
DELETE = "DELETE"


def change_set(
    old: DataFrame, new: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None
) -> DataFrame:
    """Rows to delete from ``old`` and to insert to reach ``new``.

    An update is the old row as DELETE plus the new row as INSERT, both with
    ``_is_update`` set. ``compare`` names the columns that make a row count as
    changed (all non-key columns by default), so that audit columns can travel
    along without causing changes. Keys must be unique and filled on each
    side; columns are those of ``new``.
    """
    payload = [c for c in new.columns if c not in keys]
    compare = list(payload if compare is None else compare)
    # _side keeps a struct apart from a missing one even if all columns are NULL.
    side = f"struct(1 AS _side{''.join(', ' + quoted(c) for c in payload)})"
    before = old.select(*keys, F.expr(side).alias("_old"))
    after = new.select(*keys, F.expr(side).alias("_new"))
    compared = ["_side", *compare]

    def change(action: str, name: str) -> str:
        fields = "".join(f"{name}.{quoted(c)}, " for c in payload)
        tags = f"'{action}' AS {ACTION}, _old IS NOT NULL AND _new IS NOT NULL AS {IS_UPDATE}"
        return f"CASE WHEN {name} IS NOT NULL THEN struct({fields}{tags}) END"

    return (
        before.join(after, list(keys), "full_outer")
        .where(~pack(compared, "_old.").eqNullSafe(pack(compared, "_new.")))
        .select(*keys, F.expr(f"inline(array_compact(array({change(DELETE, '_old')}, {change(INSERT, '_new')})))"))
        .select(*new.columns, ACTION, IS_UPDATE)
    )
