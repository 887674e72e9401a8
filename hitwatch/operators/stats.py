"""Request and error counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitwatch.functions.rates import error_rate
from hitwatch.schema import ERROR_STATUS_FROM


def _counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") >= ERROR_STATUS_FROM).alias("errors"),
    ]


def batch_summary(parsed: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Total, errors and rate per batch; no row for no requests."""
    counted = parsed.groupBy(*keys).agg(*_counts()).filter(F.col("total") > 0)
    return counted.withColumn("rate", error_rate(F.col("errors"), F.col("total")))


def url_error_stats(parsed: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return parsed.groupBy(*keys, "url").agg(*_counts())


def ip_error_stats(parsed: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return parsed.groupBy(*keys, "ip").agg(*_counts())


def error_stats(parsed: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts for everything, per URL and per client from a single scan and shuffle.

    ``scope`` tells the three apart (``GLOBAL``, ``URL``, ``IP``): the empty URL of
    an unparsed line is a group of its own, so a null test would not do. A URL or
    client with very many requests is counted down to one row per task before the
    shuffle.
    """
    sets = [[*keys], [*keys, "url"], [*keys, "ip"]]
    scope = (
        F.when((F.grouping("url") == 1) & (F.grouping("ip") == 1), F.lit("GLOBAL"))
        .when(F.grouping("ip") == 1, F.lit("URL"))
        .otherwise(F.lit("IP"))
    )
    return parsed.groupingSets(sets, *keys, "url", "ip").agg(*_counts(), scope.alias("scope"))
