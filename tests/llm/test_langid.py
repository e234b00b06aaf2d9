import zlib

from pyspark.sql import functions as F

from courtline.llm import langid
from courtline.llm.common import table
from llm_util import collected, empty, odd_documents

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_held_out_documents_are_not_used(spark):
    from pyspark.sql import functions as F

    docs = table(spark, "/root/testdata/sf0.001", "documents")
    false = docs.withColumn("lang", F.when(langid.held_out(), "xx").otherwise(F.col("lang")))
    a, b = (collected(langid.identify(d), "doc_id") for d in (docs, false))
    assert a == b


def test_odd_rows(spark):
    rows = collected(langid.identify(odd_documents(spark)), "doc_id")
    assert len(rows) == 13
    for r in rows:
        if r["doc_id"] in (3, 4, 5, 6):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in ("en", "de")
    assert [r for r in rows if r["doc_id"] is None][0]["held_out"] is False
    assert langid.identify(empty(spark)).count() == 0


def test_filter_keeps_columns_and_clean_rows(spark):
    docs = odd_documents(spark)
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [1, 2, 2, 7, 8, 9, 11]
    assert langid.keep_known(empty(spark)).count() == 0


def test_kernel_is_shared_ngrams_over_norms():
    import numpy as np

    seen = np.zeros(langid.ORDERS * langid.BUCKETS, bool)
    texts = ["banana", "bandana band", "zzz", "anna"]
    grams = [langid.ngrams(t, seen) for t in texts]
    assert not seen.any()
    model = langid.train([(str(i), g) for i, g in enumerate(grams)], 1)
    model.weights = np.eye(4, dtype=np.float32)
    plain = [{t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)} for t in texts]
    want = [[len(a & b) / (len(a) * len(b)) ** 0.5 for b in plain] for a in plain]
    assert np.allclose(model.scores(grams), want, atol=1e-5)


def test_filter_keeps_texts_where_nothing_could_be_learned(spark):
    docs = odd_documents(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [1, 2, 2, 7, 8, 9, 11]
