"""Topic throughput from message offsets.

Input is a messages table ``(topic, partition, offset, timestamp, ...)`` as the
Kafka source gives it, ``timestamp`` being the append time. Messages are first
counted down to one row per series and sampling step, in the map tasks, so what is
shuffled and windowed afterwards depends on the time span and the number of topic
partitions but not on the number of messages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitwatch.functions.times import tick_at_or_after, tick_at_or_before

# Fixed values of the monitored deployment.
SCRAPE_SECONDS = 15
RULE_SECONDS = 60
INTERNAL_TOPICS = ("__consumer_offsets", "--kafka")
SCRAPE_JOB = "kafka-exporter"
SCRAPE_INSTANCE = "kafka-exporter:9308"
NEW_ALERT_SUMMARY = "New alert message detected"
NEW_ALERT_SEVERITY = "critical"
FIRING, NORMAL, NO_DATA = "Alerting", "Normal", "NoData"

SERIES = ["topic", "partition"]
SERIES_SCHEMA = "topic string, partition int"

#: Seconds of messages in a folder of an archive, a day.
ARCHIVE_SECONDS = 86_400

#: Ticks of a series that one task and one array hold at most.
BLOCK_TICKS = 1024


def offset_steps(messages: DataFrame, step: int = SCRAPE_SECONDS) -> DataFrame:
    """Where each topic partition stands at the ticks that see new messages.

    ``topic, partition, tick, offset_after`` and ``opened``, the tick at or before the
    first of these messages. A tick sees the messages up to and including its own
    second. This is the one pass over the messages; everything else works on its rows,
    which are worth storing. Steps of parts of the messages, such as micro-batches, add
    up by :func:`merged_steps`.
    """
    return (
        messages.select(
            *SERIES, "offset",
            tick_at_or_before(F.col("timestamp"), step).alias("opened"),
            tick_at_or_after(F.col("timestamp"), step).alias("tick"),
        )
        .groupBy(*SERIES, "tick")
        .agg((F.max("offset") + 1).alias("offset_after"), F.min("opened").alias("opened"))
    )


def merged_steps(parts: DataFrame) -> DataFrame:
    """One step per series and tick from the steps of any parts of the messages, however
    late some of them came."""
    return parts.groupBy(*SERIES, "tick").agg(
        F.max("offset_after").alias("offset_after"), F.min("opened").alias("opened")
    )


def recent_steps(messages: DataFrame, since: int, step: int = SCRAPE_SECONDS) -> DataFrame:
    """Steps after the tick ``since``, and before them one step per series for where it
    stood then. Only messages of the range are counted by tick, so their time can be
    pushed into the scan; the others take part in one small aggregate."""
    moment = F.timestamp_seconds(F.lit(since))
    before = (
        messages.filter(F.col("timestamp") <= moment)
        .groupBy(*SERIES)
        .agg(F.max(F.struct("timestamp", "offset")).alias("last"))
        .select(
            *SERIES, F.lit(since).cast("long").alias("tick"),
            (F.col("last.offset") + 1).alias("offset_after"), F.lit(since).cast("long").alias("opened"),
        )
    )
    return before.unionByName(offset_steps(messages.filter(F.col("timestamp") > moment), step))


def archive(messages: DataFrame, path: str, seconds: int = ARCHIVE_SECONDS) -> None:
    """Writes messages as a table below ``path`` with a folder for each span of so many seconds,
    and where each topic partition stands at the end of the spans it has messages in.

    A range of time then opens the files of its own spans and, for what came before it, a row per
    series and span, however long ago the archive begins.
    """
    spanned = messages.withColumn("span", F.floor(F.unix_seconds("timestamp") / seconds))
    # ranges of time, so that a task writes to few folders
    spanned.repartitionByRange("timestamp").write.partitionBy("span").parquet(f"{path}/messages")
    written = spanned.sparkSession.read.schema(spanned.schema).parquet(f"{path}/messages")
    written.groupBy(*SERIES, "span").agg(
        (F.max("offset") + 1).alias("offset_after"),
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last"),
    ).write.parquet(f"{path}/reached")


def archived_range(spark: SparkSession, path: str, step: int = SCRAPE_SECONDS) -> tuple[int, int]:
    """As :func:`covered_range`, from the ends of the spans; opens no messages."""
    return covered_range(spark.read.parquet(f"{path}/reached").agg(
        tick_at_or_before(F.min("first"), step).alias("opened"), tick_at_or_after(F.max("last"), step).alias("tick")
    ))


def archived_steps(
    spark: SparkSession, path: str, since: int, seconds: int = ARCHIVE_SECONDS, step: int = SCRAPE_SECONDS
) -> DataFrame:
    """As :func:`recent_steps`, from an archive: reads the spans from ``since`` on, and of those
    before it where the series stood at their end."""
    span = since // seconds
    own = spark.read.schema(f"{SERIES_SCHEMA}, offset long, timestamp timestamp, span long").parquet(f"{path}/messages")
    ended = spark.read.parquet(f"{path}/reached").filter(F.col("span") < span)
    before = ended.groupBy(*SERIES).agg(F.max("offset_after").alias("offset_after")).select(
        *SERIES, F.lit(since).cast("long").alias("tick"), "offset_after", F.lit(since).cast("long").alias("opened")
    )
    recent = recent_steps(own.filter(F.col("span") >= span).drop("span"), since, step)
    return merged_steps(before.unionByName(recent))


def covered_range(steps: DataFrame) -> tuple[int, int]:
    """First and last tick of the whole table, both 0 if it is empty; runs a job."""
    first, last = steps.agg(F.min("opened"), F.max("tick")).first()
    return first or 0, last or 0


def _spread(rows: DataFrame, name: str, low: Column, high: Column, step: int) -> DataFrame:
    """A row for every ``step`` from ``low`` to ``high``, in two stages so that no array is
    longer than a block."""
    far = step * BLOCK_TICKS
    return (
        rows.withColumns({"_low": low, "_high": high})
        .filter("_low <= _high")
        .withColumn("_low", F.explode(F.sequence("_low", "_high", F.lit(far))))
        .withColumn(
            name,
            F.explode(F.sequence("_low", F.least(F.col("_low") + (far - step), "_high"), F.lit(step))),
        )
        .drop("_low", "_high")
    )


def _block(second: Column, step: int) -> Column:
    return F.floor(second / (step * BLOCK_TICKS))


def offset_samples(
    steps: DataFrame, first: int, last: int, step: int = SCRAPE_SECONDS
) -> DataFrame:
    """Current offset of every topic partition at every tick from ``first`` to ``last``.

    Columns ``sample_sec, topic, partition, current_offset``. Ticks without new
    messages carry the offset on, and before its first message a partition stands at 0.
    Time is cut into blocks of ``BLOCK_TICKS`` ticks: each block of a series is filled on
    its own, from the offset at its start, which comes from a table of one row per series
    and block. So neither a task nor a cell holds more than a block.
    """
    span = step * BLOCK_TICKS
    lowest, highest = first // span, last // span
    # what came before the range is one block
    own = steps.filter(F.col("tick") <= last).select(
        *SERIES, "tick", "offset_after",
        F.greatest(_block(F.col("tick"), step), F.lit(lowest - 1)).alias("block"),
    )
    by_block = Window.partitionBy(*SERIES).orderBy("block")
    reached = own.groupBy(*SERIES, "block").agg(F.max_by("offset_after", "tick").alias("reached"))
    starts = reached.select(
        *SERIES, "block", "reached",
        F.lag("block").over(by_block).isNull().alias("is_first"),
        F.coalesce(F.lead("block").over(by_block), F.lit(highest)).alias("until"),
    )
    later = _spread(starts, "of", F.col("block") + 1, F.col("until"), 1)
    before = _spread(starts.filter("is_first"), "of", F.lit(lowest), F.col("block"), 1)
    opening = later.select(*SERIES, "of", F.col("reached").alias("offset_after")).unionByName(
        before.select(*SERIES, "of", F.lit(0).cast("long").alias("offset_after"))
    ).select(*SERIES, (F.col("of") * span).alias("tick"), "offset_after", F.col("of").alias("block"))
    rows = opening.withColumn("step", F.lit(0)).unionByName(
        own.filter(F.col("block") >= lowest).withColumn("step", F.lit(1))
    )
    in_block = Window.partitionBy(*SERIES, "block").orderBy("tick", "step")
    end = F.coalesce(F.lead("tick").over(in_block), (F.col("block") + 1) * span) - step
    filled = rows.withColumn("end", end).withColumns({
        "begin": F.greatest("tick", F.lit(first)), "end": F.least("end", F.lit(last)),
    }).filter("begin <= end")
    return filled.select(
        F.explode(F.sequence("begin", "end", F.lit(step))).alias("sample_sec"),
        *SERIES,
        F.col("offset_after").alias("current_offset"),
    )


def with_scrape_labels(
    samples: DataFrame, job: str = SCRAPE_JOB, instance: str = SCRAPE_INSTANCE
) -> DataFrame:
    """Labels a scraper adds to every series."""
    return samples.withColumn("job", F.lit(job)).withColumn("instance", F.lit(instance))


def matching(rows: DataFrame, **labels: str) -> DataFrame:
    """Rows whose labels match the given patterns as a whole."""
    for label, pattern in labels.items():
        rows = rows.filter(F.col(label).rlike(rf"\A(?:{pattern})\z"))
    return rows


def _range_sum(
    samples: DataFrame, seconds: int, resets: bool, step: int = SCRAPE_SECONDS
) -> DataFrame:
    """Adds ``change``: sum of the differences to the previous sample over
    ``(t - seconds, t]``; null where there is none. With ``resets`` a falling offset
    counts as a fresh start from 0. Works by blocks of time; samples at the end of a block
    are repeated in those after it whose sums reach back to them."""
    home = _block(F.col("sample_sec"), step)
    last = _block(F.col("sample_sec") + (seconds + step - 1), step)
    copied = samples.withColumn("home", home).withColumn("block", F.explode(F.sequence("home", last)))
    in_block = Window.partitionBy(*SERIES, "block").orderBy("sample_sec")
    change: Column = F.col("current_offset") - F.lag("current_offset").over(in_block)
    if resets:
        change = F.when(change < 0, F.col("current_offset")).otherwise(change)
    return (
        copied.withColumn("step", change)
        .withColumn("change", F.sum("step").over(in_block.rangeBetween(1 - seconds, 0)))
        .filter("block = home")
        .drop("block", "home")
    )


def increase(samples: DataFrame, seconds: int) -> DataFrame:
    return _range_sum(samples, seconds, resets=True)


def delta(samples: DataFrame, seconds: int) -> DataFrame:
    return _range_sum(samples, seconds, resets=False)


def rate_by_topic(samples: DataFrame, seconds: int = 60) -> DataFrame:
    """Messages per second over the range, summed over a topic's partitions."""
    return (
        increase(samples, seconds)
        .groupBy("sample_sec", "topic")
        .agg((F.sum("change") / seconds).alias("value"))
    )


def delta_by_topic(
    samples: DataFrame, seconds: int = 300, divisor: int = 5, keys: Sequence[str] = ("topic",)
) -> DataFrame:
    """Offset change over the range divided by ``divisor`` (per minute by default)."""
    return (
        delta(samples, seconds)
        .groupBy("sample_sec", *keys)
        .agg((F.sum("change") / divisor).alias("value"))
    )


def delta_by_consumer(samples: DataFrame, seconds: int = 300, divisor: int = 5) -> DataFrame:
    """As :func:`delta_by_topic` with the consumer group, a label offsets do not carry."""
    labelled = samples.withColumn("consumergroup", F.lit(None).cast("string"))
    return delta_by_topic(labelled, seconds, divisor, ("consumergroup", "topic"))


def partitions_per_topic(messages: DataFrame) -> DataFrame:
    return messages.groupBy("topic").agg(F.count_distinct("partition").alias("partitions"))


def label_values(rows: DataFrame, label: str, without: Sequence[str] = ()) -> DataFrame:
    """Distinct values of a label, sorted."""
    if without:
        rows = rows.filter(~F.col(label).isin(*without))
    return rows.select(label).distinct().orderBy(label)


def legend(series: DataFrame, keys: Sequence[str] = ("topic",)) -> DataFrame:
    """Last value and maximum per topic, or per other labels."""
    known = F.col("value").isNotNull()
    return series.groupBy(*keys).agg(
        F.max_by("value", F.when(known, F.col("sample_sec"))).alias("last_value"),
        F.max("value").alias("max_value"),
    )


def new_message_rule(samples: DataFrame, every: int = RULE_SECONDS) -> DataFrame:
    """Evaluations, on full minutes, at which messages were added in the minute before."""
    return (
        increase(samples, every)
        .filter((F.col("sample_sec") % every == 0) & (F.col("change") > 0))
        .select(
            "sample_sec",
            *SERIES,
            F.col("change").alias("increase"),
            F.lit(NEW_ALERT_SUMMARY).alias("summary"),
            F.lit(NEW_ALERT_SEVERITY).alias("severity"),
        )
    )


def rule_states(samples: DataFrame, first: int, last: int, every: int = RULE_SECONDS) -> DataFrame:
    """What the rule on new messages says of each series at the full minutes from ``first`` to
    ``last``: it fires at once where messages were added in the minute before, and has no data
    where there is no sample, or none before it to compare with."""
    series = samples.select(*SERIES).distinct()
    low, high = -(-first // every) * every, last // every * every
    minutes = _spread(series, "sample_sec", F.lit(low).cast("long"), F.lit(high).cast("long"), every)
    change = F.col("change")
    state = F.when(change.isNull(), NO_DATA).when(change > 0, FIRING).otherwise(NORMAL)
    return minutes.join(
        increase(samples, every).select(*SERIES, "sample_sec", "change"), [*SERIES, "sample_sec"], "left"
    ).select(*SERIES, "sample_sec", state.alias("state"))


def rule_spans(states: DataFrame, every: int = RULE_SECONDS) -> DataFrame:
    """The longest stretches of evaluations with the same state, series by series:
    ``topic, partition, state, since_sec, until_sec, evaluations``.

    Stretches are found in blocks of ``BLOCK_TICKS`` evaluations, each on its own. What a block
    takes over from those before it is one row: the state at their end and where the stretch
    began that is in it, which may be many blocks ago. Only a table of one row per series and
    block is ordered by series.
    """
    in_block = Window.partitionBy(*SERIES, "block").orderBy("sample_sec")
    turned = F.coalesce((F.col("state") != F.lag("state").over(in_block)).cast("int"), F.lit(1))
    pieces = (
        states.withColumn("block", F.floor(F.col("sample_sec") / (every * BLOCK_TICKS)))
        .withColumn("turned", turned)
        .withColumn("stretch", F.sum("turned").over(in_block))
        .groupBy(*SERIES, "block", "stretch", "state")
        .agg(
            F.min("sample_sec").alias("since"), F.max("sample_sec").alias("until_sec"),
            F.count(F.lit(1)).alias("evaluations"),
        )
    )
    by_block = Window.partitionBy(*SERIES).orderBy("block")
    blocks = pieces.groupBy(*SERIES, "block").agg(
        F.min_by("state", "stretch").alias("state_first"), F.max_by("state", "stretch").alias("state_last"),
        F.max("since").alias("since_last"), F.max("stretch").alias("stretches"),
    ).withColumn("before", F.lag("state_last").over(by_block))
    goes_on = F.coalesce(F.col("before") == F.col("state_first"), F.lit(False))
    # where the stretch at the end of a block began: in it, or where that of the blocks before did
    began = F.when((F.col("stretches") > 1) | ~goes_on, F.col("since_last"))
    carried = (
        blocks.withColumn("goes_on", goes_on).withColumn("began", F.last(began, True).over(by_block))
        .withColumn("from_before", F.when(F.col("goes_on"), F.lag("began").over(by_block)))
        .select(*SERIES, "block", F.lit(1).cast("long").alias("stretch"), "from_before")
    )
    return (
        pieces.join(carried, [*SERIES, "block", "stretch"], "left")
        .groupBy(*SERIES, "state", F.coalesce("from_before", "since").alias("since_sec"))
        .agg(F.max("until_sec").alias("until_sec"), F.sum("evaluations").alias("evaluations"))
    )


def latest_messages(messages: DataFrame, n: int, topic: str, partition: int = 0) -> DataFrame:
    """The last ``n`` messages of one topic partition."""
    return (
        messages.filter((F.col("topic") == topic) & (F.col("partition") == partition))
        .orderBy(F.col("offset").desc())
        .limit(n)
    )
