"""Error-rate report: one line per interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitwatch.functions.rates import percent_text
from hitwatch.functions.times import clock_text
from hitwatch.operators.parse import flag_report_errors
from hitwatch.schema import REPORT_EVERY


def _counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("total"), F.count_if("is_error").alias("errors")]


def _with_report_line(counted: DataFrame, moment: Column) -> DataFrame:
    line = F.concat(
        clock_text(moment),
        F.lit(", total="), F.col("total").cast("string"),
        F.lit(", errors="), F.col("errors").cast("string"),
        F.lit(", error_rate="), percent_text(F.col("error_rate")),
    )
    return (
        counted.filter(F.col("total") > 0)
        .withColumn("error_rate", F.col("errors") / F.col("total") * 100)
        .withColumn("line", line)
    )


def error_rate_report(lines: DataFrame, every: str = REPORT_EVERY) -> DataFrame:
    """Report per interval of arrival time, the column ``timestamp`` of a message.

    Every line counts, readable or not; intervals without lines give no row.
    """
    counted = (
        flag_report_errors(lines).groupBy(F.window("timestamp", every)).agg(*_counts())
    ).withColumn("reported_at", F.col("window.end"))
    return _with_report_line(counted.drop("window"), F.col("reported_at"))


def batch_report(lines: DataFrame, reported_at: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Report of one micro-batch, or of each part of it named by ``keys``; empty for an
    empty batch."""
    counted = flag_report_errors(lines).groupBy(*keys).agg(*_counts())
    return _with_report_line(counted.withColumn("reported_at", reported_at), F.col("reported_at"))
