from __future__ import annotations

import random

from pyspark.sql import functions as F

from hitwatch.functions.rates import error_rate, percent_text


def test_percent_text_as_python_formats_it(spark):
    """Every rate of up to 400 requests, as a ratio and as a percentage."""
    counts = (
        spark.range(1, 401)
        .withColumnRenamed("id", "total")
        .withColumn("errors", F.explode(F.sequence(F.lit(0), F.col("total"))))
    )
    rate = F.col("errors") / F.col("total")
    rows = counts.select("errors", "total", percent_text(rate * 100).alias("text")).collect()
    wrong = [r for r in rows if r["text"] != f"{r['errors'] / r['total']:.2%}"]
    assert len(rows) == 80600 and not wrong


def test_percent_text_near_midpoints(spark):
    rng = random.Random(3)
    values = [rng.randrange(0, 20001) / 200 for _ in range(3000)]
    values += [rng.random() * 100 for _ in range(3000)] + [0.0, 100.0, 0.125, 0.375, 3.125, 99.995]
    frame = spark.createDataFrame([(v,) for v in values], "percent double")
    rows = frame.select("percent", percent_text(F.col("percent")).alias("text")).collect()
    assert [r["text"] for r in rows] == [f"{r['percent']:.2f}%" for r in rows]


def test_rate_of_nothing(spark):
    row = spark.range(1).select(error_rate(F.lit(0), F.lit(0)).alias("r")).first()
    assert row["r"] == 0.0
