"""How far the word use of each source is from other sources of its language.

A table of 256 bytes lowers A-Z and blanks separators in one pass over a text's bytes, a
split yields its terms, and a counter per document its frequencies. Arrow sums the counters
of a run of documents, Spark those of all runs: one row for each language, source and term
with the number of occurrences and of documents, and one with an empty term for the source
itself. All that follows works on these counts, in whole numbers.

A language keeps the terms of at least ``LEAST_DOCUMENTS`` of its rows. A source's share of a
term is smoothed and counted in billionths, so a term that a source lacks has the same
positive share as all others it lacks; these are never listed but multiplied.

Differences of all pairs of sources are the result asked for; they are worked out by tiles
of ``TILE`` sources by ``TILE`` sources and about ``SLICE`` terms. A tile is a group of bounded
size, however frequent a term, however large a source, and however many sources there are.

Spark takes the compressed files of a table for its size, which may be a thirtieth of what it has
in memory. So joins do not go by that: a table of sources is broadcast if it measures few bytes,
and all else is merged.

Rows: null text, language and source count as empty strings. Repeated rows count each time,
whatever their ids, which are not looked at. Texts without terms make their source appear.
A language that keeps no term has pairs of value 0 and no term rows, and a source alone in its
language no pairs. Ties are ordered by term or source. An empty table gives an empty result.
Texts are read whole; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitwatch.llm.common import runs, stored

LEAST_DOCUMENTS = 30
#: Shares are counted in parts of one over this, after adding so many occurrences to each term.
PARTS = 1_000_000_000
SMOOTHING = 5
#: Terms listed for a source.
TOP_TERMS = 50

#: Sources and terms of a tile.
TILE = 64
SLICE = 4096
#: Bytes of text whose counters are summed before they leave the task.
COUNT_BYTES = 4_000_000
#: A table of sources is broadcast up to so many bytes, names and this for the rest of a row.
BROADCAST_BYTES, SOURCE_BYTES = 16 << 20, 150

_TABLE = bytes(
    code + 32 if 65 <= code <= 90 else code if 97 <= code <= 122 or code >= 128 else 32
    for code in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """Runs of letters, where every byte outside ASCII is a letter; A-Z lowered."""
    return text.translate(_TABLE).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece, texts in runs(batches, "text", COUNT_BYTES):
        groups: dict[tuple[str, str], int] = {}
        where, words, numbers = [], [], []
        for lang, source, text in zip(piece["lang"].to_pylist(), piece["source"].to_pylist(), texts, strict=True):
            group = groups.setdefault((lang, source), len(groups))
            frequency = Counter(terms(text or b""))
            frequency[b""] = 0  # the source itself, also where the text has no term
            where.append(np.full(len(frequency), group))
            words.extend(frequency.keys())
            numbers.extend(frequency.values())
        table = pa.table({
            "group": pa.array(np.concatenate(where)),
            "term": pa.array(words, pa.binary()),
            "count": pa.array(numbers, pa.int64()),
        })
        summed = table.group_by(["group", "term"]).aggregate([("count", "sum"), ("count", "count")])
        keys = list(groups)
        group = summed["group"].combine_chunks()
        out = pa.table({
            "lang": pa.array([lang for lang, _ in keys], pa.string()).take(group),
            "source": pa.array([source for _, source in keys], pa.string()).take(group),
            "term": summed["term"],
            "n": summed["count_sum"],
            "docs": summed["count_count"],
        })
        yield from out.combine_chunks().to_batches(max_chunksize=50_000)


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of each term, and rows that have it; a row
    with an empty term and ``n`` 0 for every source."""
    read = docs.select(
        *(F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("lang", "source")),
        F.col("text").cast("binary").alias("text"),
    )
    counted = read.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long")
    return (
        counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .withColumn("term", F.col("term").cast("string"))
    )


def share(count: Column, total: Column, kept: Column) -> Column:
    """Smoothed share of a term in ``PARTS``, exactly; 0 where no term is kept."""
    wide = "decimal(38,0)"
    above = F.lit(PARTS).cast(wide) * (count + SMOOTHING).cast("decimal(20,0)")
    below = (total + SMOOTHING * kept).cast("decimal(20,0)")
    whole = F.call_function("div", above.cast(wide), F.when(kept > 0, below.cast(wide)))
    return F.coalesce(whole + 1, F.lit(0).cast("long"))


def _pair_sums(key: tuple, rows: pa.Table) -> pa.Table:
    """Summed differences of one tile: a row for each pair of its sources, of which ``left`` and
    ``right`` are the first numbers of the two sides."""
    left, right = key[1].as_py(), key[2].as_py()
    number = rows["number"].to_numpy()
    term = rows["term"].combine_chunks().dictionary_encode()
    code = term.indices.fill_null(-1).to_numpy()
    value = rows["p"].to_numpy()
    own = code < 0  # a row without term has the share of the terms its source lacks
    sources = np.unique(number[own])
    shares = np.empty((len(sources), len(term.dictionary)), np.int64)
    shares[np.searchsorted(sources, number[own])] = value[own][:, None]
    shares[np.searchsorted(sources, number[~own]), code[~own]] = value[~own]
    out: list[tuple[int, int, int]] = []
    second = np.flatnonzero(sources >= right)
    for a in second if left == right else np.flatnonzero(sources < right):
        later = second[sources[second] > sources[a]]
        differences = np.abs(shares[later] - shares[a]).sum(axis=1)
        out += zip([int(sources[a])] * len(later), sources[later].tolist(), differences.tolist(), strict=True)
    a, b, sums = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({
        "lang": pa.array([key[0].as_py()] * len(a), pa.string()),
        "a": pa.array(a, pa.int64()),
        "b": pa.array(b, pa.int64()),
        "differences": pa.array(sums, pa.int64()),
        "seen": pa.array([len(term.dictionary)] * len(a), pa.int64()),
    })


def _numbered(groups: DataFrame) -> DataFrame:
    """The sources with their number in their language, and its tiles and slices."""
    by_lang = Window.partitionBy("lang")
    return groups.withColumns({
        "number": F.row_number().over(by_lang.orderBy("source")) - 1,
        "tiles": F.ceil(F.count("*").over(by_lang) / TILE),
        "slices": F.greatest(F.lit(1), F.ceil(F.col("kept") / SLICE)),
    })


def _beside(groups: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Makes a side of a join from columns of the sources: broadcast if they measure few bytes,
    else merged, whatever Spark takes them for."""
    width = F.octet_length("lang") + F.octet_length("source") + SOURCE_BYTES
    few = (groups.agg(F.sum(width.cast("long"))).first()[0] or 0) <= BROADCAST_BYTES
    return F.broadcast if few else lambda side: side.hint("merge")


def _pairs(shares: DataFrame, groups: DataFrame, beside: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``lang, source, item, value`` for all ordered pairs of sources of a language."""
    listed = shares.select("lang", "number", "tiles", "term", "p", F.pmod(F.xxhash64("term"), "slices").alias("slice"))
    lacking = groups.select(
        "lang", "number", "tiles", F.lit(None).cast("string").alias("term"), F.col("lacking").alias("p"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"),
    )
    own = F.floor(F.col("number") / TILE)
    tiled = (
        listed.unionByName(lacking)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        .select("lang", (F.least(own, "other") * TILE).alias("left"), (F.greatest(own, "other") * TILE).alias("right"),
                "slice", F.col("number").cast("long"), "term", "p")
    )
    sums = (
        tiled.groupBy("lang", "left", "right", "slice")
        .applyInArrow(_pair_sums, "lang string, a long, b long, differences long, seen long")
        .groupBy("lang", "a", "b").agg(F.sum("differences").alias("differences"), F.sum("seen").alias("seen"))
    )
    first = groups.select("lang", F.col("number").alias("a"), F.col("source").alias("source_a"),
                          F.col("lacking").alias("lacking_a"), "kept")
    second = groups.select("lang", F.col("number").alias("b"), F.col("source").alias("source_b"),
                           F.col("lacking").alias("lacking_b"))
    # terms that neither source has differ by the same amount each
    value = F.col("differences") + (F.col("kept") - F.col("seen")) * F.abs(F.col("lacking_a") - F.col("lacking_b"))
    ways = F.array(
        F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
        F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item")),
    )
    return (
        sums.join(beside(first), ["lang", "a"]).join(beside(second), ["lang", "b"])
        .select("lang", value.alias("value"), F.explode(ways).alias("way"))
        .select("lang", "way.source", "way.item", "value")
    )


def divergence(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: the summed differences of term shares to each other source of the language;
    part ``term``: the source's terms that are most above their share in the language.
    """
    counts = stored(term_counts(docs), "term-counts")
    kept = (
        counts.filter("term != ''").groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        .filter(F.col("docs") >= LEAST_DOCUMENTS).drop("docs")
    )
    listed = stored(counts.join(kept.hint("merge"), ["lang", "term"]).drop("docs"), "kept-terms")
    langs = (
        listed.dropDuplicates(["lang", "term"]).groupBy("lang")
        .agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    )
    totals = listed.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = (
        counts.filter("term = ''").select("lang", "source")
        .join(totals.hint("merge"), ["lang", "source"], "left").join(langs.hint("merge"), "lang", "left")
        .withColumns({name: F.coalesce(F.col(name), zero) for name in ("total", "kept", "lang_total")})
        .withColumn("lacking", share(zero, F.col("total"), F.col("kept")))
    )
    groups = stored(_numbered(groups), "sources")
    beside = _beside(groups)
    shares = listed.join(beside(groups), ["lang", "source"]).select(
        "lang", "source", "term", "number", "tiles", "slices",
        share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = (
        shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP_TERMS)
        .withColumn("part", F.lit("term"))
    )
    pairs = (
        _pairs(shares, groups, beside)
        .withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    )
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(columns).unionByName(above.select(columns))


def oracle() -> str:
    """The same rows in SQL, over all kept terms of all sources."""
    upper, lower = (bytes(range(first, first + 26)).decode() for first in (65, 97))
    def p(count: str, total: str) -> str:
        return (f"1 + cast({PARTS}::hugeint * ({count} + {SMOOTHING}) // ({total} + {SMOOTHING} * kept) as bigint)")
    return rf"""
        with docs as (
            select coalesce(lang, '') as lang, coalesce(source, '') as source,
                regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as words
            from documents
        ), kept_terms as (
            select lang, term from (select lang, unnest(list_distinct(words)) as term from docs)
            group by all having count(*) >= {LEAST_DOCUMENTS}
        ), counts as (
            select lang, source, term, count(*) as n
            from (select lang, source, unnest(words) as term from docs) semi join kept_terms using (lang, term)
            group by all
        ), sources as (
            select lang, source, coalesce(total, 0) as total, coalesce(lang_total, 0) as lang_total, coalesce(kept, 0) as kept
            from (select distinct lang, source from docs)
            left join (select lang, source, sum(n) as total from counts group by all) using (lang, source)
            left join (select lang, sum(n) as lang_total, count(distinct term) as kept from counts group by all) using (lang)
        ), shares as (
            select lang, source, term, coalesce(n, 0) as n,
                {p("coalesce(n, 0)", "total")} as p, {p("lang_n", "lang_total")} as q
            from sources join kept_terms using (lang) left join counts using (lang, source, term)
            join (select lang, term, sum(n) as lang_n from counts group by all) using (lang, term)
        ), pairs as (
            select a.lang, a.source, b.source as item, coalesce(value, 0) as value
            from sources a join sources b on a.lang = b.lang and a.source <> b.source
            left join (
                select x.lang, x.source, y.source as item, sum(abs(x.p - y.p)) as value
                from shares x join shares y on x.lang = y.lang and x.term = y.term and x.source <> y.source
                group by all
            ) d on d.lang = a.lang and d.source = a.source and d.item = b.source
        ), ranked as (
            select lang, source, 'pair' as part, item, value from pairs
            union all
            select lang, source, 'term', term, p - q from shares where n > 0 and p > q
        ), placed as (
            select *, row_number() over (partition by lang, source, part order by value desc, item) as place from ranked
        )
        select lang, source, part, item, cast(value as bigint) as value, cast(place as integer) as rank
        from placed where part = 'pair' or place <= {TOP_TERMS}
    """
