"""Running several queries together."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery


@contextmanager
def running(*queries: StreamingQuery) -> Iterator[tuple[StreamingQuery, ...]]:
    """The queries, stopped on the way out however that happens."""
    try:
        yield queries
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def until_done(*queries: StreamingQuery) -> None:
    """Wait for queries that end by themselves; the first failure is raised."""
    with running(*queries):
        for query in queries:
            query.awaitTermination()


def until_any_ends(spark: SparkSession, *queries: StreamingQuery) -> None:
    """Wait until one of the queries ends, then stop the others; its failure is raised.

    The session also remembers queries that ended before, and those do not count.
    """

    def all_active() -> bool:
        return all(query.isActive for query in queries)

    with running(*queries):
        while all_active():
            spark.streams.resetTerminated()
            if all_active():
                spark.streams.awaitAnyTermination()
        for query in queries:
            if not query.isActive:
                query.awaitTermination()
