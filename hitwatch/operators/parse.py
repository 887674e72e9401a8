"""Log lines to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitwatch.functions.log_line import log_fields, log_time, quoted_status_is_error, status_code
from hitwatch.schema import ERROR_STATUS_FROM, MONITORING_SCHEMA


def parse_access_log(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``ip, timestamp, method, url, status`` from the column ``value``.

    ``value`` may be text or the bytes of a message. Lines that do not match stay,
    with empty texts and null status; a bad date alone only loses the timestamp.

    The fields go through an explode of a single element, which filters are not moved
    across. Otherwise Spark would repeat the regex in the conditions on status and
    timestamp, and the generated method would grow beyond what the JVM compiles.
    """
    found = log_fields(F.col("value").cast("string"))
    fields = lines.select(*keep, F.explode(F.array(found)).alias("fields"))
    ip, method, url, status, time = (F.get("fields", F.lit(i)) for i in range(5))
    return fields.select(
        *keep,
        ip.alias("ip"),
        log_time(time).alias("timestamp"),
        method.alias("method"),
        url.alias("url"),
        status_code(status).alias("status"),
    )


def error_requests(parsed: DataFrame) -> DataFrame:
    """Requests answered with an error status; unparsed lines have none."""
    return parsed.filter(F.col("status") >= ERROR_STATUS_FROM)


def flag_report_errors(lines: DataFrame) -> DataFrame:
    """Adds ``is_error`` by the lenient test used for the report."""
    return lines.withColumn("is_error", quoted_status_is_error(F.col("value").cast("string")))


def parse_monitoring_json(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns from the JSON records of the monitoring topic."""
    record = F.from_json(F.col("value").cast("string"), MONITORING_SCHEMA)
    return messages.select(*keep, record.alias("record")).select(*keep, "record.*")
