"""Spans from a stream equal those of the whole timeline, whatever the batches."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators import timeline
from tidemark.streaming import spans

BASE = 1_700_000_000.0


def batches(data, cuts, seed):
    """Samples (clip, i, t, value, ts) of clips in the order of i, dealt over batches at random."""
    rnd, queue = random.Random(seed), {c: list(enumerate(x)) for c, x in data.items()}
    out = []
    while any(queue.values()):
        batch = []
        for c, rows in queue.items():
            take = rnd.randint(0, cuts)
            batch += [(c, i, i / 2, v, BASE + i / 2) for i, v in rows[:take]]
            del rows[:take]
        rnd.shuffle(batch)
        if batch:
            out.append(batch)
    return out


def streamed(spark, parts, make):
    folder, schema = tempfile.mkdtemp(prefix="spark-"), "clip long, i long, t double, v boolean, ts double"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in").withColumn("ts", F.timestamp_seconds("ts")).withWatermark("ts", "60 seconds") if write(spark, folder, parts, schema) else None
    got, (key, value) = [], spans.STORE
    spark.conf.set(key, value)
    try:
        q = make(stream).writeStream.outputMode("append").option("checkpointLocation", f"{folder}/at").foreachBatch(lambda df, _: got.extend(df.collect())).trigger(availableNow=True).start()
        q.awaitTermination(200)
        assert q.exception() is None
    finally:
        spark.conf.unset(key)
    return got


def write(spark, folder, parts, schema):
    import time

    for n, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{folder}/tmp{n}")
        import glob
        import os
        import shutil

        os.makedirs(f"{folder}/in", exist_ok=True)
        shutil.move(glob.glob(f"{folder}/tmp{n}/part-*.parquet")[0], f"{folder}/in/{n:04d}.parquet")
        os.utime(f"{folder}/in/{n:04d}.parquet", (time.time() - 1000 + n, time.time() - 1000 + n))
    return True


@pytest.mark.parametrize("kind", ["covered", "idle"])
def test_spans_equal_the_whole_timeline(spark, kind):
    rnd = random.Random(8)
    known = (True, False) if kind == "covered" else (True, False, None)
    data = {c: [rnd.choices(known, (8, 2, 1)[: len(known)])[0] for _ in range(rnd.choice([1, 2, 4, 12, 25]))] for c in range(12)}
    data |= {50: [True], 51: [True] * 9, 52: [False] * 5}
    parts = batches(data, 6, 1) + [[(99, 0, 0.0, False, BASE + 10_000)], [(99, 1, 0.5, False, BASE + 20_000)]]
    rows = [(c, i, i / 2, v) for c, x in data.items() for i, v in enumerate(x)]
    whole = spark.createDataFrame(rows, "clip long, i long, t double, v boolean")
    if kind == "covered":
        want, make = timeline.covered_spans(whole, "clip", "v", 4, 0.75, 0.5), lambda s: spans.covered_spans(s, "clip", "v", "ts", 4, 0.75, 0.5, 30)
    else:
        want, make = timeline.qualified_runs(whole, "clip", "v", 1.5), lambda s: spans.qualified_runs(s, "clip", "v", "ts", 1.5, 30)
    want = sorted((str(r.clip), kind, r.start_seconds, r.end_seconds, r.n_samples) for r in want.collect())
    got = sorted(tuple(r) for r in streamed(spark, parts, make))
    assert got == want and len(want) > 5


def test_late_samples_are_refused(spark):
    s = lambda i, v, at=None: (1, i, i / 2, v, BASE + (i / 2 if at is None else at))
    parts = [[s(0, True), s(1, True), s(3, True)], [s(2, False), s(4, True)], [(9, 0, 0.0, False, BASE + 9_000)], [(9, 1, 0.5, False, BASE + 9_001)], [s(5, True, 9_500)]]
    got = sorted(tuple(r) for r in streamed(spark, parts, lambda x: spans.qualified_runs(x, "clip", "v", "ts", 1.0, 30)))
    assert got == [("1", "idle", 0.0, 2.5, 4), ("1", "late", 1.0, 1.0, 1), ("1", "late", 2.5, 2.5, 1)]
