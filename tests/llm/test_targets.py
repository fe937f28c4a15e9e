"""Target marks by bitmaps equal those of a join."""

from pyspark.sql import functions as F

from lossloom.llm import quality


def test_marked_targets(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "x") for i in [*range(-70000, 70000, 7), None, 2**62, 0, 1, -1, 32768, 32769]], "doc_id long, text string")
    ids = spark.createDataFrame([(i,) for i in [*range(-70000, 70000, 21), None, 2**62, 1, 1, 32768]], "doc_id long")
    marked = quality.mark_targets(docs, ids)
    assert marked.count() == docs.count()
    found = sorted(r["doc_id"] for r in marked.filter("target = 1").collect())
    wanted = {r["doc_id"] for r in ids.collect()} - {None}
    assert found == sorted(r["doc_id"] for r in docs.collect() if r["doc_id"] in wanted)
    monkeypatch.setattr(quality, "MAX_BITMAPS", 1)
    joined = quality.mark_targets(docs, ids)
    assert sorted(r["doc_id"] for r in joined.filter(F.col("target") == 1).collect()) == found
    assert quality.mark_targets(docs, ids.limit(0)).filter("target = 1").isEmpty()
