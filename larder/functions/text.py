"""Display text for amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Currency sign and the text for a missing amount.
CURRENCY = "₹"
MISSING = "—"


def format_inr(amount: Column, decimals: int = 0) -> Column:
    return F.coalesce(F.concat(F.lit(CURRENCY), F.format_number(amount, decimals)), F.lit(MISSING))
