"""Clock texts and sampling ticks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def now_iso() -> str:
    """Driver clock, once per batch, as it goes into alert records."""
    return datetime.now().isoformat()


def iso_text(moment: Column) -> Column:
    """ISO text to the second, without zone."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


def clock_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def tick_at_or_before(moment: Column, step_seconds: int) -> Column:
    """Last multiple of the step, in epoch seconds, that is not after ``moment``."""
    second = F.unix_seconds(moment)
    return second - F.pmod(second, F.lit(step_seconds))


def tick_at_or_after(moment: Column, step_seconds: int) -> Column:
    """First multiple of the step, in epoch seconds, that is not before ``moment``."""
    late = F.pmod(F.unix_micros(moment), F.lit(step_seconds * 1_000_000)) > 0
    return tick_at_or_before(moment, step_seconds) + F.when(late, step_seconds).otherwise(0)
