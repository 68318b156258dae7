"""Strict and tolerant conversions from staged text to typed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The timestamp layouts the source files use.
TS_SPACE = "yyyy-MM-dd HH:mm:ss"
TS_SPACE_FRACTION = "yyyy-MM-dd HH:mm:ss.SSSSSSSSS"
TS_T = "yyyy-MM-dd'T'HH:mm:ss"
TS_T_FRACTION = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSSS"
TS_US = "MM/dd/yyyy HH:mm:ss"
DATE_ISO = "yyyy-MM-dd"

AUTO_FORMATS = (TS_SPACE, TS_T, TS_SPACE_FRACTION, TS_T_FRACTION, TS_US, DATE_ISO)


def _text(c: Column | str) -> Column:
    return F.trim(F.col(c) if isinstance(c, str) else c)


def strict(c: Column | str, type_name: str) -> Column:
    """Cast that fails the job on bad text (ANSI mode)."""
    if type_name in ("bigint", "long"):
        return _text(c).cast("decimal(38,0)").cast("bigint")
    return _text(c).cast(type_name)


def try_long(c: Column | str) -> Column:
    """Whole number or NULL. Text such as ``12.6`` rounds half up instead of vanishing."""
    return _text(c).try_cast("decimal(38,0)").try_cast("bigint")


def try_decimal(c: Column | str, precision: int, scale: int) -> Column:
    return _text(c).try_cast(f"decimal({precision},{scale})")


def try_date(c: Column | str, fmt: str = DATE_ISO) -> Column:
    return F.to_date(F.try_to_timestamp(_text(c), F.lit(fmt)))


def try_timestamp(c: Column | str, *formats: str) -> Column:
    """First layout that parses wins; NULL when none does."""
    return F.coalesce(*[F.try_to_timestamp(_text(c), F.lit(f)) for f in formats or AUTO_FORMATS])


def strict_timestamp(c: Column | str, fmt: str = TS_SPACE) -> Column:
    return F.to_timestamp(_text(c), fmt)


def parse_boolean(c: Column | str) -> Column:
    """``true``/``false`` in any case; anything else is unknown."""
    low = F.lower(F.col(c) if isinstance(c, str) else c)
    return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))


def round_ratio(total: Column, count: Column, scale: int = 2) -> Column:
    """``total / count`` in decimal arithmetic, rounded half up."""
    return F.round(total / count.cast("decimal(20,0)"), scale)


def whole_units(c: Column) -> Column:
    """Round half up to a whole number without a width limit."""
    return c.cast("decimal(38,0)")
