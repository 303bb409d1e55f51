from pyspark.sql import functions as F

from tidemark.operators import boxes, telemetry

BOX = "struct<x1:double,y1:double,x2:double,y2:double,score:double>"


def overlap(a, b):
    w, h = (max(0.0, min(a[i + 2], b[i + 2]) - max(a[i], b[i])) for i in (0, 1))
    union = sum((v[2] - v[0]) * (v[3] - v[1]) for v in (a, b)) - w * h
    return w * h / union if union > 0 else 0.0


def test_greedy_matching_and_parity(spark):
    old = [(0.0, 0.0, 10.0, 10.0, 0.9), (0.0, 0.0, 9.0, 10.0, 0.8), (50.0, 50.0, 60.0, 60.0, 0.7)]
    new = [(0.0, 0.0, 9.5, 10.0, 0.85), (0.0, 0.0, 10.0, 10.0, 0.88), (50.0, 50.0, 60.0, 61.0, 0.7)]
    cases = [(0, old, new), (1, old, new[:1]), (2, [], new), (3, old[:1], [])]
    df = spark.createDataFrame(cases, f"frame int, old array<{BOX}>, new array<{BOX}>")
    out = df.select("frame", (F.size("old") == F.size("new")).alias("count_match"), boxes.greedy_matches(F.col("old"), F.col("new")).alias("matches"))
    for row, (_, o, n) in zip(out.orderBy("frame").collect(), cases):
        left, want = list(n), []
        for box in o:
            if left:
                best = max(range(len(left)), key=lambda i: overlap(box, left[i]))
                want.append((overlap(box, left[best]), abs(box[4] - left.pop(best)[4])))
        assert [(round(m.iou, 9), round(m.score_delta, 9)) for m in row.matches] == [(round(a, 9), round(b, 9)) for a, b in want]
    row = boxes.parity(out.where("frame = 0"), 0.9, 0.05).first()
    assert row.passed and row.matched_boxes == 3
    assert not boxes.parity(out, 0.9, 0.05).first().passed
    assert not boxes.parity(out.where("false"), 0.9, 0.05).first().passed


def test_telemetry_without_samples(spark):
    s = spark.createDataFrame([("a", None, 3.0)], "k string, gpu double, cpu double")
    row = telemetry.system_load(s, ["k"], "gpu", "cpu").first()
    assert (row.samples, row.mean_gpu, row.peak_gpu, row.mean_cpu) == (1, None, None, 3.0)
    d = spark.createDataFrame([("a", 5, 0.0, False), ("a", 9, 1.0, True)], "k string, size long, s double, reused boolean")
    row = telemetry.transfers(d, ["k"], "size", "s", "reused").first()
    assert (row.bytes, row.bytes_per_second) == (5, None)
