"""What running queries keep, read from their checkpoints."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from hitwatch.session import names_in


def open_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Windows that the query of :func:`~hitwatch.streaming.queries.window_metrics` at
    ``checkpoint`` has not closed yet, as of its last micro-batch or the given one.

    Append mode shows a window once it is closed; until then it is rows of the state store,
    which Spark reads as a table, in as many tasks as the state has partitions. The clients
    are counted from the sketch that lies in the state.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    if not names_in(spark, f"{checkpoint}/state"):  # no micro-batch has run yet
        schema = "window struct<start: timestamp, end: timestamp>, status int, count_error long, count_distinct_ip long"
        return spark.createDataFrame([], schema)
    state = reader.load(checkpoint)
    count, sketch = state.schema["value"].dataType.names
    return state.select(
        "key.window", "key.status",
        F.col(f"value.{count}").alias("count_error"),
        F.hll_sketch_estimate(F.col(f"value.{sketch}")).alias("count_distinct_ip"),
    )


def late_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark, in milliseconds, that rows of a micro-batch are late at: Spark drops by
    the one that it noted for the micro-batch before. 0 as long as there is none."""
    if batch_id == 0:
        return 0
    noted = spark.read.text(f"{checkpoint}/offsets/{batch_id - 1}", wholetext=True).first()
    for text in noted.value.splitlines():
        if text.startswith("{") and "batchWatermarkMs" in text:
            return json.loads(text)["batchWatermarkMs"]
    raise ValueError(f"no watermark is noted for micro-batch {batch_id - 1} in {checkpoint}")


def note_deliveries(
    spark: SparkSession, checkpoint: str, batch_id: int, found: Callable[[int], DataFrame], least_ms: int
) -> tuple[DataFrame, DataFrame]:
    """The watermarks of the deliveries of a micro-batch, and of all deliveries so far, a row each.

    ``found`` makes the first from the watermark that the micro-batches before have reached,
    ``least_ms`` or more. They are noted beside the checkpoint; a micro-batch that runs again
    replaces its own.
    """
    at = f"{checkpoint}/deliveries"
    own = found(least_ms)
    schema, dated = own.schema, StructType([*own.schema, StructField("batch", LongType())])
    if names_in(spark, at):
        noted = spark.read.schema(dated).parquet(at)
        reached = noted.filter(F.col("batch") < batch_id).agg(F.max("reached_ms")).first()[0]
        own = found(max(least_ms, reached or 0))
    own.write.mode("overwrite").parquet(f"{at}/batch={batch_id}")
    return (
        spark.read.schema(schema).parquet(f"{at}/batch={batch_id}"),
        spark.read.schema(dated).parquet(at).filter(F.col("batch") <= batch_id).drop("batch"),
    )
