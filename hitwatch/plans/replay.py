"""Tables replayed as streams, part after part.

Rows behind the watermark of a query do not count, and the files of a table are in no order
of time. So the rows are landed in parts first, one folder each, and one run of the query
takes them in the order of their numbers: a part is moved to the folder that the query
watches once all parts before it have been worked on. That needs no file times, which
object stores do not keep.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hitwatch.session import make_folder, move, names_in, state_partitions
from hitwatch.streaming.lifecycle import running

#: Rows of a part, and with it of a micro-batch, and state partitions of a query.
ROWS_PER_PART, STATE_PARTITIONS = 2_000_000, 16

_PART = "part"


def land_by_range(rows: DataFrame, at: str, rows_per_part: int, *order: Column | str) -> None:
    """Parts of about so many rows each, in ascending order of the columns, of which the last
    should tell rows of the same time apart."""
    parts = max(1, -(-rows.count() // rows_per_part))
    numbered = rows.repartitionByRange(parts, *order).withColumn(_PART, F.spark_partition_id())
    numbered.write.partitionBy(_PART).parquet(f"{at}/landing")


def land_by_number(rows: DataFrame, at: str, number: Column) -> None:
    """Parts by a number of the caller's from 0 on, which should hold bounded numbers of rows."""
    rows.withColumn(_PART, number.cast("long")).repartition(_PART).write.partitionBy(_PART).parquet(f"{at}/landing")


def feed(
    spark: SparkSession, at: str, schema: str, start: Callable[[DataFrame], StreamingQuery]
) -> StreamingQuery:
    """Runs the query that ``start`` makes of the stream of all landed parts to their end; it
    must not end by itself. No parts are a stream too."""
    watched = f"{at}/fed"
    make_folder(spark, watched)
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(watched)
    prefix = f"{_PART}="
    numbers = sorted(
        int(name.removeprefix(prefix)) for name in names_in(spark, f"{at}/landing") if name.startswith(prefix)
    )
    with state_partitions(spark, STATE_PARTITIONS):
        query = start(stream)
    with running(query):
        query.processAllAvailable()
        for number in numbers:
            move(spark, f"{at}/landing/{prefix}{number}", f"{watched}/{number:012}")
            query.processAllAvailable()
    return query
