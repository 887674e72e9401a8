"""Copies of documents such that sources have given shares of all words.

**Targets.** Sources share the words of the table by weight; none gets more than
``MOST_COPIES`` times its own, and what it leaves is shared among the others by weight.

**Rates by entropy balancing.** Each source's documents get the rates ``r`` between 0 and
``MOST_COPIES`` that are closest to 1 by ``sum r (log r - 1)`` under ``sum size r = target``.
The convex dual has one number a source, and the rates are the exponential tilts
``min(MOST_COPIES, exp(dual * size / scale))``. Newton's method on the logarithm of the
constraint solves all duals at once, one grouped sum over the table of sizes a step;
a step that leaves the interval known to hold the dual is replaced by its middle.

**Copies.** A document has the whole part of its rate and, for the rest, one more copy or
not. Documents of a source are dealt into classes of about equal size and within a class
into buckets of ascending (hash - rest); a class takes buckets from the front as far as its
words ask for, and hands what is left over or short to the next smaller class. So errors of
long documents are made good by short ones, and no documents are ordered one by one: only
counts by bucket are.

Everything is a DataFrame function. Duals, targets and cuts are a row per source and stay
tables; the driver sees totals and the number of open sources. Sums of doubles are taken as
decimals, so results do not depend on the order of rows, and runs agree.

Rows: a null text has size 0 and takes nothing; null is a source of its own, ordered last.
Repeated rows each count, and equal rows get equal copies. A source without words has target
0. An empty table gives an empty result. Sizes are of whole texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitwatch.llm.common import stored

#: Weights of the sources in order, over and over.
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Relative error of a target at which its dual is solved, and steps after which it is taken
#: as it is: bisection alone would have it to full precision by then.
CLOSE = 1e-10
STEPS = 100
BUCKETS = 1024

_SPACE = "\t\n\x0b\x0c\r "
_CAP = math.log(MOST_COPIES)
_EXACT = "decimal(38,9)"


def n_words(text: Column) -> Column:
    """Runs of characters other than blanks and control characters 9 to 13."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE))
    # every word with the blanks after it becomes one letter
    return F.length(F.regexp_replace(inner, r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")).cast("long")


def _ordered(sources: DataFrame) -> DataFrame:
    """The sources with their place in code point order, null last: a distributed sort, and
    places from the number of rows in the partitions before."""
    placed = stored(
        sources.orderBy(F.col("source").isNull(), "source").withColumn("_id", F.monotonically_increasing_id()),
        "sources",
    ).withColumn("_part", F.shiftright("_id", 33))
    # a row for each partition of the sort
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("_part").agg(F.count("*").alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    within = F.col("_id").bitwiseAND((1 << 33) - 1)
    return placed.join(F.broadcast(before), "_part").withColumn("place", F.col("_before") + within).drop(
        "_id", "_part", "_before"
    )


def _wide(value: Column | int) -> Column:
    return (F.lit(value) if isinstance(value, int) else value).cast("decimal(38,0)")


def _with_targets(sources: DataFrame) -> DataFrame:
    """Targets by weight, at most ``MOST_COPIES`` times the size.

    A round finds the sources that are full at the level of the round before. Levels only
    rise, and the words that are still to be shared at least halve every few rounds.
    """
    weights = F.array(*(F.lit(weight) for weight in WEIGHTS))
    weight = F.element_at(weights, (F.col("place") % len(WEIGHTS)).cast("int") + 1)
    weighed = sources.withColumns({"weight": weight, "most": MOST_COPIES * F.col("source_size")})
    words, shares = weighed.agg(F.sum(_wide(F.col("source_size"))), F.sum(_wide(F.col("weight")))).first()
    left, over, full_words = int(words or 0), int(shares or 1), -1
    while True:
        # full: most < weight * left / over, in whole numbers
        full = _wide(F.col("most")) * _wide(over) < _wide(F.col("weight")) * _wide(left)
        row = weighed.agg(
            F.sum(F.when(full, _wide(F.col("most")))), F.sum(F.when(~full, _wide(F.col("weight"))))
        ).first()
        taken = int(row[0] or 0)
        if taken == full_words:
            break
        full_words, left, over = taken, int(words or 0) - taken, int(row[1] or 1)
    target = F.when(full, F.col("most").cast("double")).otherwise(
        (_wide(F.col("weight")) * _wide(left)).cast("double") / F.lit(float(over))
    )
    return weighed.withColumns({"target": target, "full": full}).drop("weight", "most", "place")


def _rate(dual: Column, size: Column, scale: Column) -> Column:
    return F.when(dual * size / scale >= _CAP, F.lit(float(MOST_COPIES))).otherwise(F.exp(dual * size / scale))


def _solved(sources: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds ``dual`` and ``scale``, so that rates meet the targets; ``sizes(key, size, n)`` has the
    positive sizes of each source."""
    mean = sizes.groupBy("key").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"), F.min("size").alias("_least")
    )
    none = F.lit(None).cast("double")
    duals = sources.join(mean, "key", "left")
    # at this dual the shortest document, and with it every one, has the highest rate; a little
    # more, as products of doubles are rounded
    highest = F.lit(_CAP * (1 + 1e-9)) * F.col("scale") / F.col("_least")
    duals = stored(duals.select(
        *sources.columns, "scale", none.alias("low"), highest.alias("high"),
        F.when(F.col("full"), highest).otherwise(0.0).alias("dual"),
        (F.col("full") | F.col("scale").isNull()).alias("closed"),
    ), "duals")
    steps = 0
    while duals.filter("not closed").limit(1).count():
        steps += 1
        open_ = duals.filter("not closed").select("key", "dual", "scale")
        rated = sizes.join(open_, "key").withColumn("_rate", _rate(F.col("dual"), F.col("size"), F.col("scale")))
        part = F.col("n") * F.col("size") * F.col("_rate")
        slope = F.when(F.col("_rate") < MOST_COPIES, part * F.col("size") / F.col("scale")).otherwise(0.0)
        sums = rated.groupBy("key").agg(
            F.sum(part.cast(_EXACT)).cast("double").alias("_words"), F.sum(slope.cast(_EXACT)).cast("double").alias("_slope")
        )
        dual, words = F.col("dual"), F.col("_words")
        above = words > F.col("target")
        low, high = F.when(above, F.col("low")).otherwise(dual), F.when(above, dual).otherwise(F.col("high"))
        # Newton on log(words / target); words of 0 (all rates underflow) leave the interval
        step = dual - F.try_divide(F.ln(words / F.col("target")) * words, F.col("_slope"))
        middle = F.coalesce((low + high) / 2, dual * 2 - 1)
        inside = (step > F.coalesce(low, F.lit(-math.inf))) & (step < high)
        close = (F.abs(words - F.col("target")) <= CLOSE * F.col("target")) | (high - low <= 1e-15 * F.abs(dual)) | F.lit(steps >= STEPS)
        close = F.coalesce(close, F.lit(False))
        closed = F.col("closed") | close
        fresh = F.when(inside, step).otherwise(middle)
        duals = stored(duals.join(sums, "key", "left").select(
            *sources.columns, "scale",
            F.when(closed, F.col("low")).otherwise(low).alias("low"),
            F.when(closed, F.col("high")).otherwise(high).alias("high"),
            F.when(closed, dual).otherwise(fresh).alias("dual"),
            closed.alias("closed"),
        ), "duals")
    return duals.drop("low", "high", "closed", "full")


def _with_cuts(sources: DataFrame, rated: DataFrame) -> DataFrame:
    """Adds ``cuts``: for each class of sizes the last bucket whose documents get one more copy."""
    cells = (
        rated.filter(F.col("rest") > 0).groupBy("key", "class", "bucket")
        .agg(F.sum("size").alias("words"), F.sum((F.col("size") * F.col("rest")).cast(_EXACT)).alias("asked"))
    )
    classes = cells.groupBy("key", "class").agg(
        F.sort_array(F.collect_list(F.struct("bucket", F.col("words").cast("double").alias("words")))).alias("buckets"),
        F.sum("asked").cast("double").alias("asked"),
    )
    # at most 63 classes of BUCKETS cells, whatever the size of a source
    folded = classes.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct(-F.col("class"), "asked", "buckets", "class"))).alias("classes")
    )

    def fill(state: Column, cell: Column, budget: Column) -> Column:
        # a bucket is taken if the sum comes nearer to the budget by it
        fits = state["open"] & (state["sum"] + cell["words"] / 2 <= budget)
        return F.struct(
            F.when(fits, state["sum"] + cell["words"]).otherwise(state["sum"]).alias("sum"),
            F.when(fits, cell["bucket"]).otherwise(state["cut"]).alias("cut"),
            fits.alias("open"),
        )

    def next_class(state: Column, group: Column) -> Column:
        budget = state["carry"] + group["asked"]
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(-1).alias("cut"), F.lit(True).alias("open"))
        end = F.aggregate(group["buckets"], start, lambda inner, cell: fill(inner, cell, budget))
        return F.struct(
            (budget - end["sum"]).alias("carry"),
            F.concat(state["cuts"], F.array(F.struct(group["class"].alias("k"), end["cut"].alias("v")))).alias("cuts"),
        )

    start = F.struct(F.lit(0.0).alias("carry"), F.array().cast("array<struct<k:int,v:int>>").alias("cuts"))
    cuts = folded.select("key", F.map_from_entries(F.aggregate("classes", start, next_class)["cuts"]).alias("cuts"))
    return sources.join(cuts, "key", "left")


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies, taken`` for every row of
    ``docs(doc_id, text, source)``."""
    rows = stored(docs.select(
        "doc_id", "source",
        # null joins like any other source
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key"),
        n_words(F.col("text")).alias("size"),
        F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 34).cast("int").alias("draw"),
    ), "sizes")
    sizes = stored(rows.groupBy("source", "key", "size").agg(F.count("*").alias("n")), "size-counts")
    sources = sizes.groupBy("source", "key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    sources = _with_targets(_ordered(sources)).drop("source")
    solved = _solved(sources, sizes.filter("size > 0").drop("source"))

    rate = F.when(F.col("size") > 0, _rate(F.col("dual"), F.col("size"), F.col("scale"))).otherwise(0.0)
    rated = rows.join(solved, "key").withColumn("rate", rate).withColumns({
        "whole": F.floor("rate"),
        "rest": F.col("rate") - F.floor("rate"),
        "class": (F.length(F.bin("size")) - 1).cast("int"),
    })
    ahead = F.col("draw") / F.lit(float(1 << 30)) - F.col("rest")
    rated = rated.withColumn("bucket", F.least(F.lit(BUCKETS - 1), F.floor((ahead + 1) * (BUCKETS // 2))).cast("int"))
    cuts = stored(_with_cuts(solved.select("key"), rated), "cuts")
    more = (F.col("rest") > 0) & (F.col("bucket") <= F.coalesce(F.try_element_at("cuts", F.col("class")), F.lit(-1)))
    copies = F.col("whole") + F.when(more, 1).otherwise(0)
    return rated.join(cuts, "key").select(
        "doc_id", "source", "size", "source_size", "target", "rate",
        copies.alias("copies"), (F.col("size") * copies).alias("taken"),
    )
