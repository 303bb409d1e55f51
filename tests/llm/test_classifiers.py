from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality, toxicity
from tidemark.llm.shared import fold_of, table

DATA = "/root/testdata/sf0.01"


@pytest.mark.skipif(not Path(DATA).is_dir(), reason="no driver tables")
@pytest.mark.parametrize(("score", "label", "folds", "held", "least"), [(quality.score_quality, "quality", 5, 0, 0.95), (toxicity.score_toxicity, "toxic", 3, 1, 0.75)])
def test_held_out_ranking(spark, score, label, folds, held, least):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    rows = score(docs, labels, ["doc_id"]).join(labels, "doc_id").where(fold_of("doc_id", folds) == held).select("score", label).collect()
    good, bad = [r.score for r in rows if r[label] == 1], [r.score for r in rows if r[label] == 0]
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)) > least


@pytest.mark.parametrize(("score", "label"), [(quality.score_quality, "quality"), (toxicity.score_toxicity, "toxic")])
def test_odd_tables(spark, score, label):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a " * 9000), (3, "a b"), (None, "x")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(2, 1), (2, 0), (3, None), (None, 1)], f"doc_id long, {label} int")
    for some in (labels, labels.limit(0)):
        out = score(docs, some, ["doc_id"]).collect()
        assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert score(docs.limit(0), labels, ["doc_id"]).collect() == []
