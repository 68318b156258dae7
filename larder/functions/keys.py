"""Content hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELD_MARK = "\x1f"
NULL_MARK = "\x00"


def concat_columns(*cols: Column | str) -> Column:
    """All columns as one text; NULL if any of them is NULL."""
    return F.concat(*[_as_col(c).cast("string") for c in cols])


def key_text(*cols: Column | str) -> Column:
    """Columns joined so that neither NULLs nor neighbours can be confused."""
    return F.concat_ws(FIELD_MARK, *[F.coalesce(_as_col(c).cast("string"), F.lit(NULL_MARK)) for c in cols])


def hash_key(*cols: Column | str) -> Column:
    """60-bit number from the SHA-1 of the columns; the same on every engine.

    It is never NULL. Saying so lets Spark count keys without computing them.
    """
    number = F.conv(F.substring(F.sha1(key_text(*cols)), 1, 15), 16, 10).cast("bigint")
    return F.coalesce(number, F.lit(0).cast("bigint"))


def date_key(day: Column | str) -> Column:
    return hash_key(F.date_format(_as_col(day), "yyyy-MM-dd"))


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
