"""Rates of topic partitions while messages come in."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hitwatch.operators.throughput import SCRAPE_SECONDS, SERIES
from hitwatch.schema import WATERMARK

CHANGES = "topic string, partition int, sample_sec long, change long"
#: Last closed tick and the offset there, differences of the ticks the range reaches back to
#: (null as long as no tick is closed), and ticks that are not closed yet.
STATE = "closed long, reached long, recent array<long>, ticks array<long>, offsets array<long>"


def live_increases(steps: DataFrame, seconds: int = 60, step: int = SCRAPE_SECONDS) -> DataFrame:
    """What :func:`~hitwatch.operators.throughput.increase` gives, from a stream of offset steps:
    a row per series and tick, as soon as the watermark has passed the tick.

    A series starts at the tick at or before its first message. Its state is the offset at the
    last closed tick, the differences of as many ticks as the range has, and the steps that
    are not closed; a timer at the next tick sees to ticks without messages. There is an
    input row per series and tick of a micro-batch, not per message.
    """
    reach = -(-seconds // step)

    def closed(now: int, state: list) -> Iterator[tuple[int, int | None]]:
        """Ticks up to ``now``, with the change over the range; moves the state on."""
        last, reached, recent, pending = state
        while last + step <= now:
            last += step
            offset = pending.pop(last, reached)
            if recent is None:  # the first sample of a series has none before it
                recent = []
                yield last, None
            else:  # a falling offset is a fresh start
                recent = [*recent, offset - reached if offset >= reached else offset][-reach:]
                yield last, sum(recent)
            reached = offset
        state[:] = last, reached, recent, pending

    def follow(key: tuple, parts: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        rows: list[tuple[int, int | None]] = []
        if held.exists:
            last, reached, recent, ticks, offsets = held.get
            state = [last, reached, None if recent is None else list(recent), dict(zip(ticks, offsets, strict=True))]
        else:
            state = [None, 0, None, {}]
        if not held.hasTimedOut:
            news = pd.concat(parts)
            if state[2] is None:  # what comes in any order before the first tick is closed
                opened = int(news["opened"].min()) - step
                state[0] = opened if state[0] is None else min(opened, state[0])
            for tick, offset in zip(news["tick"].tolist(), news["offset_after"].tolist(), strict=True):
                if tick > state[0]:
                    state[3][tick] = max(offset, state[3].get(tick, 0))
        now = held.getCurrentWatermarkMs() // 1000
        rows += closed(now - now % step, state)
        last, reached, recent, pending = state
        held.update((last, reached, recent, list(pending), list(pending.values())))
        # timers go off when the watermark is beyond them
        held.setTimeoutTimestamp(max((last + step) * 1000 - 1, held.getCurrentWatermarkMs() + 1))
        if rows:
            yield pd.DataFrame({
                "topic": key[0], "partition": key[1],
                "sample_sec": [tick for tick, _ in rows],
                "change": pd.array([change for _, change in rows], "Int64"),
            })

    return (
        steps.select(*SERIES, "tick", "offset_after", "opened", F.timestamp_seconds("tick").alias("moment"))
        .withWatermark("moment", WATERMARK)
        .groupBy(*SERIES)
        .applyInPandasWithState(follow, CHANGES, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )


def rates_of(changes: DataFrame, seconds: int = 60) -> DataFrame:
    """Messages per second and topic from the rows of :func:`live_increases`."""
    return changes.groupBy("sample_sec", "topic").agg((F.sum("change") / seconds).alias("value"))
