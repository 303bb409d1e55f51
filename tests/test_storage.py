import numpy as np

from pyspark.sql import functions as F

from tidemark.operators.storage import sampled_indices, upload_actions, verified


def test_sampled_indices_are_those_of_linspace(spark):
    clips = spark.createDataFrame([(c, c) for c in [0, 1, 2, 3, 15, 16, 17, 100, 9973]], "clip long, n long")
    for n in (1, 2, 7, 16):
        got = {}
        for r in sampled_indices(clips, "n", n).orderBy("clip", "k").collect():
            got.setdefault(r.clip, []).append(r.frame)
        assert got == {c: np.linspace(0, c - 1, n).astype(int).tolist() for c in [1, 2, 3, 15, 16, 17, 100, 9973]}


def test_unknown_hashes_are_conflicts(spark):
    schema = "key string, size_bytes long, sha256 string"
    objects = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), ("c", 1, "x"), ("d", 1, None)], schema)
    target = spark.createDataFrame([("a", 1, "x"), ("b", 1, None), ("d", 1, None)], schema)
    assert {r.key: r.action for r in upload_actions(objects, target, "key").collect()} == {"a": "noop", "b": "conflict", "c": "write", "d": "conflict"}


def test_nulls_are_not_verified(spark):
    df = spark.createDataFrame([(b"ab", 2), (b"ab", 3), (None, 0)], "c binary, n long")
    good = F.sha2(F.lit(b"ab"), 256)
    assert [r[0] for r in df.select(verified(F.col("c"), F.col("n"), good)).collect()] == [True, False, False]
