"""Log lines from sockets and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_SCHEMAS = {
    "events": (
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
        "props string"
    )
}


# Where lines are served.
SOCKET_HOST, SOCKET_PORT = "localhost", 9999


def socket_stream(
    spark: SparkSession, host: str = SOCKET_HOST, port: int = SOCKET_PORT
) -> DataFrame:
    """Lines from a socket; Spark cannot replay them after a failure."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def line_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def line_file_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Lines of the files that appear in a folder."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table by name; a known schema saves Spark the look into the files."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{folder}/{name}.parquet")


def table_stream(
    spark: SparkSession, folder: str, name: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A table as a stream of its files; the table may be a folder or a single file.

    A stream takes a plain path for a folder; as a pattern, though it has one match
    only, the path may be a file too.
    """
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{folder}/{{{name}}}.parquet")
