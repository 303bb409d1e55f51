"""Statistics and folds against plain sequential versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions.arrays import before
from tidemark.operators import boxes, journal, report, rules, statistics, timeline


def series(seed, clips=25):
    rnd = random.Random(seed)
    return {c: [None if rnd.random() < 0.15 else round(rnd.random() * 5, 3) for _ in range(rnd.choice([0, 1, 3, 40, 90]))] for c in range(clips)}


def table(spark, data, kind="double"):
    rows = [(c, i, i / 2, v) for c, x in data.items() for i, v in enumerate(x)]
    return spark.createDataFrame(rows, f"clip long, i long, t double, v {kind}").repartition(3)


@pytest.mark.parametrize("statistic", ["mean", "p95"])
def test_seeded_bootstrap_equals_a_loop(spark, statistic):
    data = series(1) | {100: [None, None], 101: [2.5]}
    got = {r.clip: r for r in statistics.bootstrap(table(spark, data), "clip", "v", statistic, 4.0, 2.0, 150, job="job-1", salt=statistics.SALTS["idle"]).collect()}
    for clip, values in data.items():
        if not values:
            continue
        x, r = np.array([v for v in values if v is not None]), got[clip]
        of = (lambda a: float(np.mean(a))) if statistic == "mean" else (lambda a: float(np.quantile(a, 0.95)))
        if not len(x):
            assert (r.point, r.low, r.high) == (0, 0, 1) and all(v is None or np.isnan(v) for v in r.samples)
            continue
        size = max(1, min(8, max(1, len(x) // 4)))
        rng, out = np.random.default_rng(statistics.clip_seed("job-1", str(clip)) ^ 0xA71A5), []
        for _ in range(150):
            if len(x) == 1:
                out.append(of(x))
                continue
            chosen = rng.choice(np.arange(len(x) - size + 1), size=-(-len(x) // size), replace=True)
            out.append(of(np.concatenate([x[s : s + size] for s in chosen])[: len(x)]))
        assert np.allclose(r.samples, out) and np.allclose([r.point, r.low, r.high], [of(x), *np.quantile(out, [0.025, 0.975])])


def test_repetition_equals_a_loop(spark):
    data = series(2) | {50: [0.1, 0.5, 0.9, 0.5] * 30, 51: np.random.default_rng(8).random(120).tolist(), 52: [1.0] * 60}
    got = {r.clip: r.score for r in statistics.repetition(table(spark, data), "clip", "v", 2.0, 1.5, 8.0, 20.0).collect()}
    for clip, values in data.items():
        if not values:
            continue
        runs, now = [], []
        for v in [*values, None]:
            if v is None:
                runs.append(now)
                now = []
            else:
                now.append(v)
        best = np.array(max(runs, key=len))
        want = 0.0
        if len(best) >= 40:
            d = np.diff(best)
            if d.std() > 1e-9:
                z = (d - d.mean()) / d.std()
                want = max([float(np.mean(z[:-k] * z[k:])) for k in range(3, 17) if len(z) - k >= max(12, k)] or [0.0])
        assert got[clip] == pytest.approx(min(1, max(0, want)), abs=1e-9)
    assert got[50] > 0.9 and got[51] < 0.85 and got[52] == 0


def test_covered_and_idle_spans_equal_loops(spark):
    rnd = random.Random(3)
    data = {c: [rnd.random() < 0.8 for _ in range(rnd.choice([1, 4, 30, 60]))] for c in range(30)}
    tri = {c: [None if rnd.random() < 0.1 else v for v in x] for c, x in data.items()}
    covered = {(r.clip, r.start_seconds, r.end_seconds) for r in timeline.covered_spans(table(spark, data, "boolean"), "clip", "v", 5, 0.8, 0.5).collect()}
    want = set()
    for c, x in data.items():
        marked = [any(sum(x[s : s + 5]) >= 4 for s in range(max(0, i - 4), min(i, len(x) - 5) + 1)) for i in range(len(x))]
        for i in range(len(x)):
            if marked[i] and (i == 0 or not marked[i - 1]):
                j = i
                while j + 1 < len(x) and marked[j + 1]:
                    j += 1
                want.add((c, i / 2, j / 2 + 0.5))
    assert covered == want
    idle = {(r.clip, r.start_seconds, r.end_seconds) for r in timeline.qualified_runs(table(spark, tri, "boolean"), "clip", "v", 2.0).collect()}
    want = set()
    for c, x in tri.items():
        step = 0.5 if len(x) > 1 else 2.0
        i = 0
        while i < len(x):
            j = i
            while j < len(x) and x[j]:
                j += 1
            if j > i and (j - 1) / 2 + step - i / 2 >= 2.0:
                want.add((c, i / 2, (j - 1) / 2 + step))
            i = max(j, i + 1)
    assert idle == want


def test_suppression_equals_a_loop(spark):
    rnd = random.Random(4)
    frames = []
    for f in range(40):
        frames.append((f, [(rnd.uniform(0, 50), rnd.uniform(0, 50), rnd.uniform(50, 100), rnd.uniform(50, 100), rnd.choice([0.2, 0.5, 0.5, 0.9]), rnd.randint(0, 1)) for _ in range(rnd.randint(0, 9))]))
    df = spark.createDataFrame(frames, "f int, d array<struct<x1:double,y1:double,x2:double,y2:double,score:double,class_id:int>>")

    def overlap(a, b):
        w, h = max(0, min(a[2], b[2]) - max(a[0], b[0])), max(0, min(a[3], b[3]) - max(a[1], b[1]))
        return w * h / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h + 1e-9)

    def greedy(d, same_class):
        kept = []
        for b in [x for _, x in sorted(enumerate(d), key=lambda x: (-x[1][4], -x[0]))]:
            if not any(overlap(k, b) > 0.45 and (not same_class or k[5] == b[5]) for k in kept):
                kept.append(b)
        return kept

    rows = {r.f: r for r in df.select("f", C.suppressed(F.col("d"), 0.45).alias("a"), boxes.suppressed_by_class(F.col("d"), 0.45).alias("b")).collect()}
    for f, d in frames:
        assert [tuple(x) for x in rows[f].a] == greedy(d, False) and [tuple(x) for x in rows[f].b] == greedy(d, True)
    fixed = [(0, 0, 100, 100, 0.9, 0), (5, 5, 98, 98, 0.8, 0), (200, 200, 250, 250, 0.7, 0)]
    one = spark.createDataFrame([([tuple(map(float, x[:5])) + (0,) for x in fixed],)], "d array<struct<x1:double,y1:double,x2:double,y2:double,score:double,class_id:int>>")
    assert [x.score for x in one.select(C.suppressed(F.col("d"), 0.5).alias("a")).first().a] == [0.9, 0.7]


def test_cohorts_equal_a_loop(spark):
    rnd = random.Random(5)
    rows = [(j, k, rnd.randint(1, 10)) for j in range(20) for k in range(rnd.randint(1, 30))]
    got = {(r.j, r.k): r.cohort for r in journal.cohorts(spark.createDataFrame(rows, "j int, k int, n long"), "j", "k", "n", 10).collect()}
    for j in range(20):
        at = held = 0
        for _, k, n in sorted(r for r in rows if r[0] == j):
            if held and held + n > 10:
                at, held = at + 1, 0
            held += n
            assert got[j, k] == at


def test_folds_of_what_is_before(spark):
    df = spark.createDataFrame([([],), ([3],), (list(range(1, 400)),)], "x array<int>")
    for r in df.select("x", before(F.col("x"), F.lit(0), lambda a, b: a + b).alias("s"), before(F.col("x"), F.lit(0), lambda a, b: F.greatest(a, b)).alias("m")).collect():
        assert r.s == [sum(r.x[:i]) for i in range(len(r.x))] and r.m == [max([0, *r.x[:i]]) for i in range(len(r.x))]


def test_probability_from_samples(spark):
    nan = float("nan")
    rows = [(0, [0.7, 0.5, 0.9], [0.1, 0.2, 0.9, 0.3], True), (1, [nan, nan], [0.1, 0.1], True), (2, [0.9], [0.1], False), (3, [], [0.1], True), (4, [0.9], [0.1], None)]
    df = spark.createDataFrame(rows, "k int, h array<double>, i array<double>, ok boolean")
    got = [r.p for r in df.select("k", report.good_probability_of_samples(F.col("h"), F.col("i"), F.col("ok"), rules.DEFAULT_RULES).alias("p")).orderBy("k").collect()]
    assert got == [pytest.approx(1 / 3), 0, 0, 0, 0]


def test_probability_follows_the_rules(spark):
    rule = lambda signal, op, t, severity="reject": (0, "r", signal, op, t, False, severity)
    h, i = "hand.visibility_fraction", "idle.fraction"
    rng = np.random.default_rng(4)
    hand, idle = rng.random(300).round(2).tolist() + [float("nan")], rng.random(320).round(2).tolist()
    df = spark.createDataFrame([(hand, idle, True), (hand, idle, None), ([], idle, True), (None, idle, True)], "h array<double>, i array<double>, ok boolean")
    tests = {">=": np.greater_equal, ">": np.greater, "<=": np.less_equal, "<": np.less}
    for own in ([rule(h, ">=", 0.5)], [rule(h, ">", 0.5), rule(h, "<", 0.9), rule(i, "<=", 0.25)], [rule(h, "<", 0.5, "warn"), rule(i, "==", 0.5), rule("camera.blur_fraction", "<=", 0.1)], []):
        met = np.ones(301, bool)
        for _, _, signal, op, t, _, severity in own:
            if severity == "reject" and op in tests and signal in (h, i):
                met &= tests[op](np.array({h: hand, i: idle}[signal][:301]), t)
        got = [r.p for r in df.select(report.good_probability_of_samples(F.col("h"), F.col("i"), F.col("ok"), own).alias("p")).collect()]
        assert got == [pytest.approx(met.mean()), 0, 0, 0]


def test_repetition_rounds_its_least_number_of_samples(spark):
    data = {1: [0.1, 0.5, 0.9, 0.5] * 10, 2: ([0.1, 0.5, 0.9, 0.5] * 10)[:39], 3: [0.0, 1.0, 0.0]}
    score = lambda seconds: {r.clip: r.score for r in statistics.repetition(table(spark, data), "clip", "v", 2.0, 1.5, 8.0, seconds).collect()}
    assert score(20.1)[1] > 0.9 and score(20.1)[2] == 0 and score(20.4)[1] == 0 and score(0.5)[3] == 0


def test_bootstrap_by_hash_equals_a_loop(spark):
    data = series(6) | {100: [None, 1.0], 101: [2.5]}
    import hashlib

    for statistic, of in (("mean", np.mean), ("p95", lambda a: np.quantile(a, 0.95))):
        got = {r.clip: r for r in statistics.bootstrap_by_hash(table(spark, data), "clip", "v", 4.0, 2.0, 130, 5, statistic).collect()}
        assert set(got) == {c for c, x in data.items() if any(v is not None for v in x)}
        for clip, r in got.items():
            x = np.array([v for v in data[clip] if v is not None])
            size = max(1, min(8, max(1, len(x) // 4)))
            draw = lambda k, b: int(hashlib.sha256(f"5|{clip}|{k}|{b}".encode()).hexdigest()[:8], 16) % (len(x) - size + 1)  # noqa: B023, E731
            want = [of(np.concatenate([x[draw(k, b) : draw(k, b) + size] for b in range(-(-len(x) // size))])[: len(x)]) for k in range(130)]
            assert np.allclose(r.samples, want) and np.allclose([r.point, r.low, r.high], [of(x), *np.quantile(want, [0.025, 0.975])])


def python_steps(df):
    return df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")


def test_replicates_are_worked_out_once(spark):
    """both bootstraps are one step, in the report too."""
    from tidemark.queries import QUERIES

    for name in ("a06_a04_results_by_rules", "a06_a07_a08_a09_a10_a11_run_report"):
        assert python_steps(QUERIES[name](spark, "/root/testdata/sf0.001")) == 1, name


def test_replicates_of_rows_without_values_and_of_long_clips(spark, monkeypatch):
    """F8: draws by blocks of any number, in pieces or not, are the same; an empty or null array has no replicates."""
    rows = [("a", [float(k * k % 17) for k in range(50)]), ("b", []), ("c", None), ("d", [2.0])]
    df = spark.createDataFrame(rows, "clip string, held array<double>")
    got = {}
    for most in (1 << 17, 64):
        monkeypatch.setattr(statistics, "CHUNK_VALUES", most)
        out = df.select("clip", statistics.hash_replicates(F.col("clip"), F.col("held"), 4.0, 2.0, 70, 5, "p95").alias("b"))
        got[most] = {r.clip: r.b for r in out.collect()}
    assert got[64] == got[1 << 17] and got[64]["b"] is None and got[64]["c"] is None and set(got[64]["d"].samples) == {2.0}
    assert len(got[64]["a"].samples) == 70 and got[64]["a"].low <= got[64]["a"].high


def test_spread_of_clips_is_not_joined_by_bytes(spark):
    df = spark.createDataFrame([(k, 0, 1.0) for k in range(40)], "clip long, i int, v double")
    out = statistics.bootstrap_by_hash(df, "clip", "v", 4.0, 2.0, 10, 5)
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 1
