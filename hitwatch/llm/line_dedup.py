"""Near-duplicate lines across all documents, by an exact set-similarity join.

A line is the set of its lower-cased words. A line goes if an earlier one, by document id
and then by place, has a Jaccard similarity of ``SIMILARITY`` or more with it; whether the
earlier one goes itself does not matter. Only DataFrame functions are used.

1. Words are ordered by rarity: how often they occur is counted into a table of fixed size
   by hash, and a line is the sorted array of (rarity class, hash) of its words. Two
   similar lines share one of their first few words (prefix filter), leave room for
   enough common words behind it (positional filter), have similar sizes (length filter)
   and differ in few bits of a parity word of their hashes. These go into a table, a row
   a line.
2. Equal lines are found by their hash; all but the first go, and no longer take part.
3. Every line is held against few earlier ones that share a word of its prefix and its size:
   the first such line and the two before it, for a few words that do not depend on how rare
   they are. The likeliest of these is verified. One is enough for a line to go, so that large
   groups of near copies are settled by pairs in proportion to their lines.
4. Lines not settled are joined to all earlier ones on the words of the prefix.
5. Whatever passes is verified on the whole sets of words.

Words are told apart by 57 bits of their hash.

Edge cases: lines without words, empty and null texts never go and match nothing; ids may
repeat, and rows with equal id and text share all decisions, while equal ids with other
texts are documents of their own; a null id comes before all others; an empty table gives
no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitwatch.llm.common import join_hot_keys, sized, stored

SIMILARITY = 0.8
#: Entries of the table of word counts, a small number each on the way to the tasks.
RARITY_BUCKETS = 1 << 16
#: Words of a line's prefix by which it is held against single earlier lines.
LEADING_WORDS = 4
HASH_BITS = 57
#: What parts words besides blanks.
SPACES = "\t\r\x0b\x0c"

KEY = ["doc", "version", "line"]


def several_texts(docs: DataFrame) -> DataFrame | None:
    """Ids that have more than one text, as ``_id``, None if there are none."""
    several = stored(
        docs.groupBy(F.col("doc_id").alias("_id"))
        .agg(F.min(F.xxhash64("text")).alias("least"), F.max(F.xxhash64("text")).alias("most"))
        .filter("least != most").select("_id"),
        "several-texts",
    )
    count = several.count()
    return sized(several, count) if count else None


def versioned(docs: DataFrame, several: DataFrame | None) -> DataFrame:
    """The rows with ``_version``: the hash of the text if its id has several, else 0."""
    none = F.lit(0).cast("long")
    if several is None:
        return docs.withColumn("_version", none)
    version = F.when(F.col("_several"), F.xxhash64("text")).otherwise(none)
    return docs.join(
        several.withColumn("_several", F.lit(True)), docs["doc_id"].eqNullSafe(several["_id"]), "left"
    ).withColumn("_version", version).drop("_id", "_several")


def lines(docs: DataFrame, several: DataFrame | None) -> DataFrame:
    """``doc, version, line, value``: the lines of every text, numbered from 0. ``version``
    tells texts under one id apart and is 0 where there is only one."""
    return versioned(docs, several).select(
        F.col("doc_id").alias("doc"),
        F.col("_version").alias("version"),
        F.posexplode(F.split("text", "\n")).alias("line", "value"),
    )


def _words(value: Column) -> Column:
    # few texts have blanks of other kinds, and looking for them is cheaper than replacing them
    other = F.lit(False)
    for space in SPACES:
        other = other | F.contains(value, F.lit(space))
    return F.split(F.lower(F.when(other, F.translate(value, SPACES, " " * len(SPACES))).otherwise(value)), " ")


def rarity(rows: DataFrame) -> list[int]:
    """For every bucket of word hashes its rarity class, twice the logarithm of its count."""
    word = rows.select(F.explode(_words(F.col("value"))).alias("word")).filter("word != ''")
    counts = (
        word.groupBy(F.xxhash64("word").bitwiseAND(RARITY_BUCKETS - 1).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()  # one row per bucket
    )
    classes = [0] * RARITY_BUCKETS
    for row in counts:
        classes[row.bucket] = min(63, int(2 * math.log2(row.n)))
    return classes


def word_set(value: Column, classes: list[int]) -> Column:
    """The different words of a line, rarest first, as longs."""
    table = F.split(F.lit(",".join(map(str, classes))), ",").cast("array<bigint>")  # a constant
    none = F.lit(0).cast("long")  # keeps the array free of nulls, which are slow to sort
    hashes = F.transform(F.array_remove(_words(value), ""), lambda word: F.xxhash64(word))
    return F.sort_array(F.array_distinct(F.transform(
        hashes,
        lambda word: F.shiftleft(
            F.coalesce(F.get(table, word.bitwiseAND(RARITY_BUCKETS - 1).cast("int")), none), HASH_BITS
        ).bitwiseOR(F.shiftrightunsigned(word, 64 - HASH_BITS)),
    )))


def _once(value: Column) -> Column:
    """A column that is computed once: as the output of a generator it is not copied into
    the expressions that use it."""
    return F.explode(F.array(value))


def _parity(words: Column, half: int) -> Column:
    """For each of 64 places whether an odd number of the words fall on it, of the words that
    a bit of their hash puts into this half: 128 places in two halves do not fill up before
    lines have some hundred words."""
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    return F.aggregate(
        words, none,
        lambda bits, word: bits.bitwiseXOR(F.when(
            word.bitwiseAND(64) == 64 * half, F.call_function("shiftleft", one, word.bitwiseAND(63).cast("int"))
        ).otherwise(none)),
    )


def _needed(a: Column, b: Column) -> Column:
    """Common words that sets of sizes ``a`` and ``b`` must have: the smallest whole number
    from ``s / (1 + s)`` of their sum."""
    return F.ceil((a + b) * F.lit(SIMILARITY / (1 + SIMILARITY)) - 1e-9)


def prefixes(rows: DataFrame, classes: list[int]) -> DataFrame:
    """``doc, version, line, a, b, size, even, odd, prefix`` of every line that has words; ``a``
    and ``b`` are hashes that equal lines share, ``even`` and ``odd`` parities."""
    plain = F.lower(F.trim("value"))
    # two hashes of 64 bits; the number comes first, as the hash of a column is the seed of
    # the next one's
    sets = rows.select(
        *KEY, F.xxhash64(plain).alias("a"), F.xxhash64(F.lit(1), plain).alias("b"),
        _once(word_set(F.col("value"), classes)).alias("words"),
    )
    size = F.size("words")
    length = size - F.ceil(size * SIMILARITY - 1e-9).cast("int") + 1
    return sets.filter("size(words) > 0").select(
        *KEY, "a", "b", size.alias("size"), _parity(F.col("words"), 0).alias("even"), _parity(F.col("words"), 1).alias("odd"),
        # 31 bits of a hash do here: what meets by chance is found out on the whole sets
        F.transform(F.slice("words", F.lit(1), length), lambda word: word.bitwiseAND(0x7FFFFFFF).cast("int")).alias("prefix"),
    )


def _apart(a: str, b: str) -> Column:
    """Places in which the parities of two lines differ: no more than words they differ on."""
    return sum(
        (F.bit_count(F.col(f"{a}.{name}").bitwiseXOR(F.col(f"{b}.{name}"))) for name in ("even", "odd")), F.lit(0)
    )


def _alike(a: str, b: str, size_a: Column, size_b: Column) -> Column:
    """Length and parity filters: of the words on which two lines differ an odd number
    falls on each place in which their parities do."""
    return (
        (F.least(size_a, size_b) >= F.greatest(size_a, size_b) * SIMILARITY - 1e-9)
        & (_apart(a, b) <= size_a + size_b - 2 * _needed(size_a, size_b))
    )


def _order(of: str) -> Column:
    return F.struct(*(F.col(f"{of}.{name}") for name in ("doc", "line", "version")))


def _pairs(joined: DataFrame, later: str, earlier: str) -> DataFrame:
    return joined.select(
        *(F.col(f"{later}.{name}").alias(name) for name in KEY),
        *(F.col(f"{earlier}.{name}").alias(f"{name}_e") for name in KEY),
    ).distinct()


def distinct_lines(table: DataFrame) -> DataFrame:
    """One row for each group of equal lines, under the key of the first: equal but for case and
    outer spaces, so that all else is the same."""
    return table.groupBy("a", "b").agg(
        F.min(F.struct("doc", "line", "version")).alias("first"), F.count(F.lit(1)).alias("n"),
        *(F.first(name).alias(name) for name in ("size", "even", "odd", "prefix")),
    ).select("a", "b", "n", "first.doc", "first.version", "first.line", "size", "even", "odd", "prefix")


def equal_lines(table: DataFrame, distinct: DataFrame) -> DataFrame:
    """Keys of the lines that repeat an earlier one."""
    repeated = stored(
        distinct.filter("n > 1").select(
            F.col("a").alias("k_a"), F.col("b").alias("k_b"), F.struct("doc", "line", "version").alias("first"), "n"
        ),
        "equal",
    )
    total = repeated.agg(F.sum("n")).first()[0] or 0
    return (
        join_hot_keys(table.select(*KEY, "a", "b"), repeated, ["a", "b"], total)
        .filter(F.struct("doc", "line", "version") > F.col("first"))
        .select(*KEY)
        .distinct()
    )


def _with(rows: DataFrame, keys: DataFrame, count: int) -> DataFrame:
    side = sized(keys.select(*(F.col(name).alias(f"k_{name}") for name in KEY)), count)
    same = F.lit(True)
    for name in KEY:
        same = same & rows[name].eqNullSafe(side[f"k_{name}"])
    return rows.join(side, same, "left_semi")


def verified(pairs: DataFrame, rows: DataFrame, classes: list[int]) -> DataFrame:
    """Keys of the later lines of the pairs that are similar enough."""
    early = [f"{name}_e" for name in KEY]
    mentioned = stored(
        pairs.select(*KEY).unionByName(pairs.select(*(F.col(e).alias(n) for e, n in zip(early, KEY, strict=True))))
        .groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")),
        "mentioned",
    )
    count = mentioned.count()
    sets = stored(
        _with(rows, mentioned, count).select(*KEY, word_set(F.col("value"), classes).alias("words")).distinct(),
        "sets",
    )
    total = pairs.count()
    names = {name: f"k_{name}" for name in KEY}
    late = sets.select(*(F.col(n).alias(k) for n, k in names.items()), F.col("words").alias("words_l"))
    same = F.lit(True)
    for name in KEY:
        same = same & pairs[name].eqNullSafe(late[f"k_{name}"])
    with_late = pairs.join(late, same).drop(*names.values())
    weights = pairs.groupBy(*early).agg(F.count(F.lit(1)).alias("n"))
    same = F.lit(True)
    for name in KEY:
        same = same & weights[f"{name}_e"].eqNullSafe(late[f"k_{name}"])
    by_early = weights.join(late, same).select(
        *(F.col(e).alias(f"k_{e}") for e in early), F.col("words_l").alias("words_e"), "n"
    )
    both = join_hot_keys(with_late, stored(by_early, "earlier"), early, total)
    common = F.size(F.array_intersect("words_l", "words_e"))
    return both.filter(common >= _needed(F.size("words_l"), F.size("words_e"))).select(*KEY).distinct()


def _likely(table: DataFrame) -> DataFrame:
    """For every line that has one, an earlier line that may well be similar: of the first line
    and the two lines before it that share a word and the class of sizes, the one with the
    fewest differing parities among those that pass the filters. The words are those of the
    prefix with the smallest hashes: similar lines agree on most of them, and words that only
    one line has, such as slips of the pen, are no more often among them than others."""
    marks = F.struct(*KEY, "size", "even", "odd")
    held = table.select(
        marks.alias("l"), F.floor(F.log("size") / math.log(1 / SIMILARITY)).alias("sizes"),
        F.explode(F.slice(F.sort_array("prefix"), 1, LEADING_WORDS)).alias("word"),
    )
    group = Window.partitionBy("word", "sizes").orderBy("l.doc", "l.line", "l.version")
    before = {"e0": F.first("l").over(group), "e1": F.lag("l", 1).over(group), "e2": F.lag("l", 2).over(group)}
    near = held.withColumns(before).select("l", F.explode(F.array(*before)).alias("e")).filter(F.col("e").isNotNull())
    passing = near.filter((_order("l") > _order("e")) & _alike("l", "e", F.col("l.size"), F.col("e.size")))
    return _pairs(
        passing.groupBy(*(F.col(f"l.{name}").alias(name) for name in KEY))
        .agg(F.min_by("e", F.struct(_apart("l", "e"), _order("e"))).alias("e"))
        .select(F.struct(*KEY).alias("l"), "e"),
        "l", "e",
    )


def similar_lines(table: DataFrame, rows: DataFrame, classes: list[int]) -> DataFrame:
    """Keys of the lines of ``table``, different ones, that are similar to an earlier one."""
    likely = stored(_likely(table), "likely")
    settled = stored(verified(likely, rows, classes), "settled")

    # all others against all earlier ones; both sides are the same table with the same
    # columns, shuffled once, and the condition on one side names the other so that it
    # stays in the join
    settled_keys = sized(
        settled.select(*(F.col(name).alias(f"k_{name}") for name in KEY), F.lit(0).alias("open")), settled.count()
    )
    same = F.lit(True)
    for name in KEY:
        same = same & table[name].eqNullSafe(settled_keys[f"k_{name}"])
    size_and_place = F.shiftleft(F.col("size").cast("long"), 32).bitwiseOR(F.col("place").cast("long"))
    words = (
        table.join(settled_keys, same, "left")
        .select(*KEY, "size", "even", "odd", F.coalesce("open", F.lit(1)).alias("open"), F.posexplode("prefix").alias("place", "word"))
        .select(*KEY, "even", "odd", "word", (size_and_place * 2 + F.col("open")).alias("packed"))
    )
    later, earlier = words.alias("l"), words.alias("e")

    def unpacked(of: str) -> tuple[Column, Column, Column]:
        packed = F.col(f"{of}.packed")
        return (
            F.shiftright(packed, 33).cast("int"),
            F.shiftright(packed, 1).bitwiseAND((1 << 32) - 1).cast("int"),
            packed.bitwiseAND(1),
        )

    (size_l, place_l, open_l), (size_e, place_e, _) = unpacked("l"), unpacked("e")
    joined = later.join(
        earlier,
        (F.col("l.word") == F.col("e.word"))
        & (open_l >= F.least(size_e, F.lit(1)))
        & (F.least(size_l - place_l, size_e - place_e) >= _needed(size_l, size_e))
        & _alike("l", "e", size_l, size_e)
        & (_order("l") > _order("e")),
    )
    rest = verified(stored(_pairs(joined, "l", "e"), "pairs"), rows, classes)
    return settled.unionByName(rest)


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``doc, version, line`` of every line that goes."""
    return _repeated_lines(docs, several_texts(docs))


def _repeated_lines(docs: DataFrame, several: DataFrame | None) -> DataFrame:
    classes = rarity(docs.select(F.replace("text", F.lit("\n"), F.lit(" ")).alias("value")))
    rows = lines(docs, several)
    table = stored(prefixes(rows, classes), "prefixes")
    distinct = stored(distinct_lines(table), "distinct-lines")
    return equal_lines(table, distinct).unionByName(similar_lines(distinct, rows, classes))


def edited_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, n_removed, text`` of every row, ``text`` being without the lines that go,
    and the row itself as ``row``. Texts that lose all lines are empty."""
    several = several_texts(docs)
    gone = stored(_repeated_lines(docs.select("doc_id", "text"), several), "repeated-lines")
    by_text = gone.groupBy(F.col("doc").alias("_doc"), F.col("version").alias("_gone_version")).agg(
        F.collect_set("line").alias("_gone")  # no more than the text has lines
    )
    side = sized(by_text, gone.count())
    own = versioned(docs.select("doc_id", "text", F.struct("*").alias("row")), several)
    joined = own.join(
        side, own["doc_id"].eqNullSafe(side["_doc"]) & (own["_version"] == side["_gone_version"]), "left"
    )
    parts = F.when(F.col("_gone").isNotNull(), F.split("text", "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_parts") - 1), F.col("_gone"))
    text = F.array_join(F.transform(kept, lambda at: F.get("_parts", at)), "\n")
    return joined.select("*", _once(parts).alias("_parts")).select(
        "doc_id",
        F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long").alias("n_removed"),
        F.when(F.col("_gone").isNull(), F.col("text")).otherwise(text).alias("text"),
        "row",
    )


def without_repeated_lines(docs: DataFrame, length: str = "n_chars") -> DataFrame:
    """The rows, with all their columns, without the lines that go; where a text has changed
    and there is a column ``length``, it is counted anew."""
    def column(name: str) -> Column:
        old = F.col(f"row.`{name}`")
        if name == "text":
            return F.col("text")
        if name == length:
            new = F.length("text").cast(docs.schema[name].dataType)
            return F.when(F.col("n_removed") > 0, new).otherwise(old).alias(name)
        return old.alias(name)

    return edited_lines(docs).select(*map(column, docs.columns))
