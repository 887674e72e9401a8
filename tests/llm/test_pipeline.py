from __future__ import annotations

import corpus_pipeline
from hitwatch.llm import decontaminate, simhash
from hitwatch.llm.common import read, stored

NAMES = ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]


def test_stages_on_what_the_one_before_kept(spark, small):
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    docs = read(spark, small, "documents")
    columns, kept = docs.columns, {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = kept[name] = stored(stage(spark, docs, small), name)
        if name != "packing":
            assert docs.columns == columns
    ids = {name: {r.doc_id for r in rows.select("doc_id").collect()} for name, rows in kept.items()}
    assert ids["toxicity"] < ids[""] and ids["line_dedup"] == ids["toxicity"]
    # one of each group, and no more to find
    found = simhash.near_duplicates(kept["line_dedup"])
    assert ids["near_duplicates"] == {r.doc_id for r in found.filter("doc_id = component_id").collect()}
    assert kept["near_duplicates"].count() == len(ids["near_duplicates"]) < len(ids["line_dedup"])
    benchmark = read(spark, small, "benchmark")
    dirty = {r.doc_id for r in decontaminate.contaminated(kept["near_duplicates"], benchmark).collect()}
    assert ids["decontamination"] == ids["near_duplicates"] - dirty and dirty
    assert ids["packing"] == ids["decontamination"]
    assert {r.doc_id for r in corpus_pipeline.run(spark, small).collect()} == ids["packing"]


def test_all_stages_on_awkward_and_no_rows(spark, small, awkward, empty):
    for docs in (awkward, empty):
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, small), "awkward")
    assert docs.count() == 0
