"""Error rates and their text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def error_rate(errors: Column, total: Column) -> Column:
    """Share of errors between 0 and 1; 0 for no requests."""
    return F.coalesce(F.try_divide(errors.cast("double"), total.cast("double")), F.lit(0.0))


def percent_text(percent: Column) -> Column:
    """``12.34%`` from 12.34..., rounded from the exact binary value, ties to even.

    Built-in formatting rounds the shortest decimal form half up, which gives
    3.13% for 1/32. Here the number is split in two halves whose products with
    200 are exact, so the side of the midpoint it lies on is known for certain.
    """
    scaled = percent * F.lit(134217729.0)  # 2**27 + 1
    high = scaled - (scaled - percent)
    low = percent - high
    below = F.floor(percent * F.lit(100.0))
    beyond_midpoint = (high * F.lit(200.0) - (below * 2 + 1)) + low * F.lit(200.0)
    hundredths = below + (
        F.when(beyond_midpoint > 0, F.lit(1)).when(beyond_midpoint < 0, F.lit(0)).otherwise(below % 2)
    )
    whole = F.floor(hundredths / F.lit(100))
    return F.concat(
        whole.cast("string"),
        F.lit("."),
        F.lpad((hundredths - whole * 100).cast("string"), 2, "0"),
        F.lit("%"),
    )
