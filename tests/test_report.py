from __future__ import annotations

from pyspark.sql import functions as F

from hitwatch.operators.report import batch_report, error_rate_report
from tests.logs import line


def messages(spark, rows):
    return spark.createDataFrame(rows, "second int, value string").withColumn(
        "timestamp", F.timestamp_seconds(F.lit(1704067200) + F.col("second"))
    )


def test_report_lines(spark):
    rows = [(0, line(status=404)), (9, "junk"), (9, line(status=200)), (10, line(status=500)),
            (35, line(status=200))]
    got = error_rate_report(messages(spark, rows)).orderBy("reported_at").collect()
    assert [r["line"] for r in got] == [
        "2024-01-01 00:00:10, total=3, errors=1, error_rate=33.33%",
        "2024-01-01 00:00:20, total=1, errors=1, error_rate=100.00%",
        "2024-01-01 00:00:40, total=1, errors=0, error_rate=0.00%",
    ]


def test_batch_report(spark):
    rows = [(0, line(status=404)), (0, '1.1.1.1 - - [x] "GET / HTTP/2" 404 1'), (0, "junk")]
    moment = F.timestamp_seconds(F.lit(1704067205))
    got = batch_report(messages(spark, rows), moment).collect()
    assert [r["line"] for r in got] == ["2024-01-01 00:00:05, total=3, errors=2, error_rate=66.67%"]
    assert batch_report(messages(spark, []), moment).count() == 0
