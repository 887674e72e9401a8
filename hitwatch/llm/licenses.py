"""License scans: notices in documents, found by MinHash bands over text windows.

Templates are words without punctuation, and their shingles runs of three. Documents are
cut into windows of several sizes, each overlapping the next by three quarters, so that a
notice lies whole in a window of at most about twice its size. Windows without any shingle
of a template are left out: nothing can be contained in them. The MinHash of the others is
one minimum per band, ``BANDS`` bands; window and template share a band with probability
``1 - (1 - J) ** BANDS``. A notice that just passes has a Jaccard similarity J of at least
a quarter with its window, and so is missed with a probability below 0.0002 in one window,
and it lies in up to four. What a shared band retrieves is verified: the share of the
template's shingles that the window contains must reach ``CONTAINMENT``.

A long template, such as the text of a whole license, is cut into parts of ``PART_WORDS`` words
that overlap by a quarter. Each part is matched like a notice, and a document has the license
with as many ``parts`` as it holds: a text with the disclaimer alone has some of them.

Only DataFrame functions are used. Nothing is gathered by document before the matches are.

Edge cases: null and empty texts have no matches, nor have texts of fewer than three words;
rows with equal ids count as one document; a null id is an id like any other; a document
has one row per template at most; an empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE_WORDS = 3
CONTAINMENT = 0.8
BANDS = 32
WINDOWS = (4, 8, 16, 32, 64)  # words; a template has the first size of which it is at most 3/4
PART_WORDS = 48

#: Notices as licenses word them.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-grant": (
        "you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at"
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, "
        "are permitted provided that the following conditions are met"
    ),
    "cc-by": "licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc0": "No rights reserved. Dedicated to the public domain under CC0 1.0",
    "gpl-2": "under the terms of the GNU General Public License, version 2",
    "gpl-3": "This work is licensed under the GNU General Public License, version 3",
    "lgpl": "under the terms of the GNU Lesser General Public License",
    "mit": "Released under the MIT License",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of "
        "this software and associated documentation files"
    ),
    "mpl-2.0": "subject to the terms of the Mozilla Public License, v. 2.0",
    "reserved": "All rights reserved",
}

#: License texts as they stand in files.
WHOLE_TEXTS = {
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License."
    ),
    "bsd-3-text": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. 3. Neither the name of the copyright holder nor "
        "the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE "
        "COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
        "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
        "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS "
        "OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE."
    ),
    "gpl-3-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details. You should have received a copy of the GNU "
        "General Public License along with this program."
    ),
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
        "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
}

#: What a document is held against.
LICENSES = TEMPLATES | WHOLE_TEXTS

_MARKS = ".,;:!?()[]{}<>\"'`*#/|&-_=+%$\\\t\r\n\x0b\x0c"


def _once(value: Column) -> Column:
    """A column that is computed once: as the output of a generator it is not copied into
    the expressions that use it."""
    return F.explode(F.array(value))


def plain_words(text: str) -> list[str]:
    return re.split(" +", text.lower().translate({ord(c): " " for c in _MARKS}).strip())


def _words(text: Column) -> Column:
    marks = F.translate(F.lower(text), _MARKS, " " * len(_MARKS))
    return F.array_remove(F.split(marks, " "), "")


def _shingles(words: Column) -> Column:
    """All runs of words, as texts."""
    last = F.size(words) - SHINGLE_WORDS
    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda at: F.array_join(F.slice(words, at + 1, F.lit(SHINGLE_WORDS)), " "),
    )
    return F.when(last >= 0, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def _signature(shingles: Column) -> Column:
    """The smallest hash of any shingle, for each band."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda band: F.array_min(F.transform(shingles, lambda s: F.xxhash64(band, s))),
    )


def window_size(words: int) -> int:
    for size in WINDOWS:
        if 4 * words <= 3 * size:
            return size
    raise ValueError(f"no window holds a notice of {words} words; cut it")


def parts(texts: dict[str, str]) -> list[tuple[str, int, int, list[str]]]:
    """``(license, part, window, shingles)`` of every template, long ones cut."""
    out = []
    for name, text in texts.items():
        words = plain_words(text)
        if len(words) < SHINGLE_WORDS:
            raise ValueError(f"{name} is shorter than a shingle")
        last = max(0, len(words) - PART_WORDS)
        for number, start in enumerate([*range(0, last, PART_WORDS * 3 // 4), last]):
            own = words[start : start + PART_WORDS]
            found = {" ".join(own[k : k + SHINGLE_WORDS]) for k in range(len(own) - SHINGLE_WORDS + 1)}
            out.append((name, number, window_size(len(own)), sorted(found)))
    return out


def templates(spark: SparkSession, texts: dict[str, str] = LICENSES) -> DataFrame:
    """``license, part, window, notice``: shingles and window sizes of the templates' parts."""
    return spark.createDataFrame(parts(texts), "license string, part int, window int, notice array<string>")


def windows(docs: DataFrame, texts: dict[str, str] = LICENSES) -> DataFrame:
    """``doc_id, window, start, words``: windows that hold a shingle of a template of their
    size, by size and first word."""
    sizes: dict[int, set[str]] = {}
    for _, _, size, found in parts(texts):
        sizes.setdefault(size, set()).update(found)
    known = sorted(set().union(*sizes.values()))
    rows = docs.select("doc_id", _once(_words(F.col("text"))).alias("words"))

    def shingle(at: Column) -> Column:
        words = F.col("words")
        return F.concat_ws(" ", *(F.get(words, at + k) for k in range(SHINGLE_WORDS)))

    places = F.filter(
        F.sequence(F.lit(0), F.size("words") - SHINGLE_WORDS), lambda at: shingle(at).isin(known)
    )
    found = (
        rows.filter(F.size("words") >= SHINGLE_WORDS)
        .select("doc_id", "words", _once(places).alias("places"))
        .filter(F.size("places") > 0)
    )

    def around(size: int) -> Column:
        """Starts of the windows that hold one of the places."""
        step = size // 4
        own = F.filter("places", lambda at: shingle(at).isin(sorted(sizes[size])))
        starts = F.flatten(F.transform(own, lambda at: F.transform(
            F.sequence(
                F.greatest(F.lit(0), F.ceil((at + (SHINGLE_WORDS - size)) / step)).cast("int"),
                F.floor(at / step).cast("int"),
            ),
            lambda k: k * step,
        )))
        return F.transform(
            F.array_distinct(starts),
            lambda start: F.struct(F.lit(size).alias("window"), start.alias("start")),
        )

    return (
        found.withColumn("w", F.explode(F.concat(*(around(size) for size in sorted(sizes)))))
        .select(
            "doc_id", "w.window", "w.start",
            _once(F.slice("words", F.col("w.start") + 1, F.col("w.window"))).alias("words"),
        )
    )


def licenses(docs: DataFrame, texts: dict[str, str] = LICENSES) -> DataFrame:
    """``doc_id, license, parts, containment, start``: the licenses in every document, with the
    number of parts it holds, the best containment of one in a window, and the first word of the
    first window that passes."""
    known = templates(docs.sparkSession, texts)
    by_band = known.select(
        "license", "part", "window", "notice", F.posexplode(_signature(F.col("notice"))).alias("band", "least")
    )
    by_window = windows(docs, texts).select(
        "doc_id", "window", "start", _once(_shingles(F.col("words"))).alias("shingles")
    )
    banded = by_window.select(
        "doc_id", "window", "start", "shingles", F.posexplode(_signature(F.col("shingles"))).alias("band", "least")
    )
    # one row per part of a template and band
    hits = banded.join(F.broadcast(by_band), ["window", "band", "least"])
    common = F.size(F.array_intersect("shingles", "notice")) / F.size("notice")
    return (
        hits.select("doc_id", "license", "part", "start", common.alias("containment"))
        .filter(F.col("containment") >= CONTAINMENT)
        .groupBy("doc_id", "license")
        .agg(
            # different parts are few
            F.count_distinct("part").alias("parts"),
            F.max("containment").alias("containment"), F.min("start").cast("long").alias("start"),
        )
    )


def oracle(texts: dict[str, str] = LICENSES) -> str:
    """The same matches in SQL, by containment in every window."""
    rows = [
        f"('{name}', {number}, {size}, {len(found)}, '{shingle}')"
        for name, number, size, found in parts(texts) for shingle in found
    ]
    marks = _MARKS.replace("'", "''")
    spaces = " " * len(_MARKS)
    return f"""
        with template(license, part, size, total, shingle) as (values {", ".join(rows)}),
        words as (
            select doc_id, list_filter(string_split(translate(lower(text), '{marks}', '{spaces}'), ' '),
                lambda x: x <> '') as w
            from documents where text is not null
        ), shingles as (
            select doc_id, unnest(range(0, len(w) - 2)) as pos, w from words where len(w) >= 3
        ), placed as (
            select doc_id, pos, array_to_string(list_slice(w, pos + 1, pos + 3), ' ') as shingle from shingles
        ), hits as (
            select doc_id, pos, license, part, size, total, shingle from placed join template using (shingle)
        ), windowed as (
            select doc_id, license, part, size, total, shingle, unnest(range(
                greatest(0, cast(ceil((pos + 3 - size) / (size / 4)) as bigint)),
                cast(floor(pos / (size / 4)) as bigint) + 1)) * (size // 4) as start
            from hits
        ), contained as (
            select doc_id, license, part, start, count(distinct shingle) / any_value(total) as containment
            from windowed group by doc_id, license, part, start
        )
        select doc_id, license, count(distinct part) as parts, max(containment) as containment, min(start) as start
        from contained where containment >= {CONTAINMENT} group by doc_id, license
    """
