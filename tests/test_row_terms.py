"""Frequent terms are counted alike inside the row and by a join."""

import numpy as np
from conftest import SF_DIR
from pyspark.sql import functions as F

from __spark_entry__ import queries
from lossloom.operators import terms as V
from lossloom.session import file_parts


def test_listed_terms_are_counted_inside_the_row(spark, monkeypatch):
    docs = spark.createDataFrame([(["b", "a", "a"],), (["a", "c"],), ([],), (None,), (["c", "d", "c"],)], "terms array<string>")
    want = [("a", 2, 3), ("c", 2, 3), ("b", 1, 1)]
    plan = V.vocabulary(docs, "terms", 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect" in plan
    assert [(r.term, r.df, r.tf) for r in V.vocabulary(docs, "terms", 3).collect()] == want
    monkeypatch.setattr(V, "ROW_TERMS", 0)
    assert [(r.term, r.df, r.tf) for r in V.vocabulary(docs, "terms", 3).collect()] == want
    assert V.vocabulary(docs.filter(F.lit(False)), "terms", 3).count() == 0


def test_stem_table_cuts_texts_once(spark):
    plan = queries()["stem_table"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan


def test_terms_are_counted_in_tasks_that_grow_with_the_files(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(V, "TERM_BYTES", 20)
    rows = [(i % 40, ["a", f"t{i % 7}", "a"] if i % 5 else None) for i in range(60)]
    spark.createDataFrame(rows, "doc_id int, terms array<string>").coalesce(1).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    wanted = max(8, file_parts(docs, 20))
    found = V.vocabulary(V.in_pieces(docs, "doc_id"), "terms", by="piece")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert wanted > 8 and plan.count(f", {wanted})") == 2 and plan.count("Exchange") == 2
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in V.vocabulary(docs, "terms").collect()}


def test_topic_queries_cut_texts_once(spark, monkeypatch):
    from lossloom.operators import topics as P

    read = []
    monkeypatch.setattr(P, "fit_factors", lambda vectors, *a, **k: read.append(vectors) or P.TopicFactors(np.ones((10, 500)), 2))
    monkeypatch.setattr(P, "fit_lda", lambda vectors, *a, **k: read.append(vectors) or P.TopicModel(np.ones((5, 500)), np.ones(5)))
    frames = [queries()[n](spark, SF_DIR) for n in ("nmf_topics", "lda_topics")]
    for df in frames + read:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "split(" not in plan and "__counts" not in plan
