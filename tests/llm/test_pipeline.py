import collections

import corpus_pipeline
from courtline.llm import minhash, pii
from courtline.llm.common import stored, table
from llm_util import empty, odd_documents

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), name)
        seen[name] = (docs, out)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        docs = out
    before, after = ({r["doc_id"]: r["text"] for r in d.collect()} for d in seen["near_duplicates"])
    groups = {r["doc_id"]: r["component_id"] for r in minhash.classes(seen["near_duplicates"][0]).collect()}
    assert set(after) == set(groups.values())
    before, after = ({r["doc_id"]: r["text"] for r in d.collect()} for d in seen["personal_data"])
    assert set(before) == set(after)
    assert all(not any(s[0] == "email" for s in pii.base_spans(t)) for t in after.values())
    pieces = collections.Counter(r["doc_id"] for r in seen["packing"][1].filter("piece = 0").collect())
    assert pieces == collections.Counter(r["doc_id"] for r in seen["packing"][0].collect())


def test_run_and_odd_tables(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100
    for docs in (odd_documents(spark).select("doc_id", "text", "lang", "source", "n_chars"), empty(spark).select("doc_id", "text", "lang", "source", "n_chars")):
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF), name)
        assert docs.columns[:2] == ["doc_id", "piece"]
