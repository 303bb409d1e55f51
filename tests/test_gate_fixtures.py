"""What the reference's tests pin, restated: manifests, rules, policies, frames, evidence, the journal and stores."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import boxes, evidence, journal, pixels, policy, report, rules, signals, storage, telemetry
from tidemark.sources import frames, manifest, policies
from tidemark.streaming.journal import retry_states

BASE = {
    "hand.visibility_fraction": 0.8, "idle.fraction": 0.2, "hand.motion_speed_p95": 0.1, "motion.repetition_score": 0.1, "camera.corrupt": 0.0, "camera.black_covered": 0.0, "camera.blur_fraction": 0.0,
    "camera.exposure_fraction": 0.0, "camera.shake_p95_translation": 0.0, "camera.shake_p95_rotation": 0.0,
}
EDGE = {"hand.motion_speed_p95": 0.75, "motion.repetition_score": 0.85, "camera.shake_p95_translation": 0.03, "camera.shake_p95_rotation": 5.0}
H, I, S = "hand.visibility_fraction", "idle.fraction", "hand.motion_speed_p95"
CASES = [
    ("good", {}, {H: (0.7, 0.9), I: (0.1, 0.3)}, "good", ""), ("bad", {H: 0.3}, {H: (0.2, 0.4), I: (0.1, 0.3)}, "bad", "hands-visible"), ("unsure", {H: 0.6}, {H: (0.55, 0.65), I: (0.1, 0.3)}, "uncertain", "hands-visible"),
    ("warn", {"camera.blur_fraction": 0.9}, {H: (0.7, 0.9), I: (0.1, 0.3)}, "good", "blur-warning"), ("boundary", EDGE, {H: (0.7, 0.9), I: (0.1, 0.3), S: (0.70, 0.75)}, "good", ""), ("speed", EDGE | {S: 0.76}, {}, "bad", "hand-speed"),
    ("repetition", EDGE | {"motion.repetition_score": 0.86}, {}, "bad", "repetitive-motion"), ("rotation", EDGE | {"camera.shake_p95_rotation": 5.01}, {}, "bad", "rotation-shake"), ("hidden", {H: 0.0, I: 0.0}, {H: (0.0, 0.0), I: (0.0, 1.0)}, "bad", "hands-visible"),
]


def rows_of(cases):
    return [(name, s, v, s in signals.BOOLEAN, *ends.get(s, (None, None))) for name, change, ends, *_ in cases for s, v in (BASE | change).items()]


SIGNALS = "clip string, signal string, value double, is_bool boolean, low double, high double"


def test_verdicts_and_reasons(spark):
    df = spark.createDataFrame(rows_of(CASES), SIGNALS)
    got = {r.clip: (r.verdict, r.reasons) for r in rules.verdicts(rules.rule_results(df, rules.DEFAULT_RULES, "clip"), "clip").collect()}
    assert got == {name: (verdict, reasons) for name, _, _, verdict, reasons in CASES}


def test_an_absent_signal_fails(spark):
    df = spark.createDataFrame([r for r in rows_of(CASES[:1]) if r[1] != I], SIGNALS)
    with pytest.raises(Exception, match="no signal idle.fraction"):
        rules.rule_results(df, rules.DEFAULT_RULES, "clip").collect()
    with pytest.raises(Exception, match="missing numeric metric idle.fraction"):
        policy.context(df, "clip").collect()


def test_a_boolean_value_ignores_its_interval(spark):
    df = spark.createDataFrame([("a", H, 1.0, True, 0.0, 0.1), ("b", H, 1.0, False, 0.0, 0.1)], SIGNALS)
    got = {r.clip: r.outcome for r in rules.rule_results(df, rules.DEFAULT_RULES[:1], "clip").collect()}
    assert got == {"a": "pass", "b": "fail"}


def test_corrupt_clips(spark):
    measured = spark.createDataFrame(rows_of(CASES[:1]), SIGNALS)
    items = spark.createDataFrame([("good",), ("broken",)], "clip string")
    got = {r.clip: (r.verdict, r.reasons) for r in rules.verdicts(rules.rule_results(signals.with_corrupt(measured, items, "clip"), rules.DEFAULT_RULES, "clip"), "clip").collect()}
    assert got == {"good": ("good", ""), "broken": ("bad", "hands-visible,corrupt-video")}


CONTEXT = {"covered": False, "hands": 95.0, "idle": 10.0, "translation": 1.0, "rotation": 1.0, "repetition": 0.2, "blur": 5.0, "exposure": 5.0, "hands_low": 90.0, "hands_high": 98.0, "idle_low": 5.0, "idle_high": 20.0}
NA = "not_applicable"
POLICY = [
    ({"hands": 63.0, "hands_low": 61.0, "hands_high": 70.0}, "good", {"hands_check": "pass"}), ({"hands": 30.0, "hands_low": 20.0, "hands_high": 40.0}, "bad", {"hands_check": "fail", "idle_check": NA, "repetition_check": NA}),
    ({"hands": 63.0, "hands_low": 45.0, "hands_high": 81.0}, "uncertain", {"hands_check": "uncertain"}), ({"covered": True}, "bad", {"hands_check": NA, "idle_check": NA, "repetition_check": NA, "blur_warning": NA, "exposure_warning": NA}),
    ({"blur": 21.0, "exposure": 100.0}, "good", {"blur_warning": "fail", "exposure_warning": "fail"}), ({"idle": 50.0, "idle_low": 40.0, "idle_high": 50.0, "translation": 3.0, "rotation": 5.0, "repetition": 0.85}, "good", {"idle_check": "pass", "steady_check": "pass"}),
    ({"rotation": 5.01}, "bad", {"steady_check": "fail"}),
]


def gated(spark):
    rows = [(i, *(CONTEXT | change).values()) for i, (change, *_) in enumerate(POLICY)]
    return rules.gate(spark.createDataFrame(rows, "clip int, camera_covered boolean, " + ", ".join(f"{c} double" for c in list(CONTEXT)[1:])))


def test_policy_verdicts(spark):
    for r in gated(spark).collect():
        _, verdict, checks = POLICY[r.clip]
        assert r.verdict == verdict and {c: r[c] for c in checks} == checks


def test_checks_as_rule_results(spark):
    out = policy.rule_results(gated(spark), "clip", rules.STANDARD)
    by = {}
    for r in out.collect():
        by.setdefault(r.clip, {})[r.rule_id] = (r.outcome, r.value, r.low, r.high)
    assert by[0]["hands-visible"] == ("pass", 0.63, 0.61, 0.7) and by[0]["translation-shake"] == ("pass", 0.01, None, None)
    assert sorted(by[3]) == ["black-covered", "rotation-shake", "translation-shake"] and by[6]["rotation-shake"][0] == "fail" and by[6]["translation-shake"][0] == "pass"
    reasons = policy.failed_reasons(policy.check_rows(gated(spark), "clip"), "clip").where("clip = 6").collect()
    assert sorted(r.reason for r in reasons) == ["rotation-shake", "translation-shake"]


def test_policy_files(spark, tmp_path):
    document = {"version": 1, "name": "standard", "checks": {"camera_covered": {"reject_after_seconds": 5}, "hands_visible": {"minimum_percent": 60}, "worker_idle": {"maximum_percent": 50, "minimum_segment_seconds": 10}, "camera_steadiness": {"maximum_translation_percent": 3, "maximum_rotation_degrees_per_second": 5}, "repetitive_motion": {"maximum_score": 0.85}}, "warnings": {"blurry": {"maximum_percent": 20}, "bad_exposure": {"maximum_percent": 20}}}
    with pytest.raises(ValueError, match="no policies"):
        policies.read_policies(spark, str(tmp_path))
    for name, hands in (("a", 60), ("b", 70)):
        text = json.dumps(document | {"checks": document["checks"] | {"hands_visible": {"minimum_percent": hands}}})
        for kind in ("yaml", "json"):
            (tmp_path / f"{name}.{kind}").write_text(text)
    row = policies.read_policies(spark, str(tmp_path)).collect()
    assert [(r.name, r.hands, r.repetition) for r in row] == [("standard", 70.0, 0.85)]
    compiled = policy.compiled(policies.read_policies(spark, str(tmp_path))).collect()
    assert len(compiled) == 9 and {r.rule_id: r.threshold for r in compiled}["hands-visible"] == 0.7
    for broken in ({**document, "version": 2}, {**document, "extra": 1}, {**document, "warnings": {"blurry": {"maximum_percent": 101}, "bad_exposure": {"maximum_percent": 20}}}):
        with pytest.raises(ValueError):
            policies.policy_row(broken)


def test_manifest(spark, tmp_path):
    item = {"item_id": "clip-1", "key": " /a/b.mp4", "size_bytes": 5, "etag": '"abc"'}
    document = {"schema_version": "qc-job-v1", "job_id": "job-1", "source": {"bucket": "in", "items": [item, {**item, "item_id": "clip 2", "key": "../secret", "duration_seconds": 0}]}, "target": {"bucket": "out", "prefix": "reports"}, "detector": {"optimal_batch_size": 40}}
    (tmp_path / "job.json").write_text(json.dumps(document, indent=1))
    (tmp_path / "odd.json").write_text(json.dumps({**document, "speed": 1, "rules": [{"id": "r", "signal": "nope", "operator": ">=", "threshold": 1, "severity": "reject"}], "source": {"bucket": "in", "items": [{**item, "colour": 1}]}}))
    jobs = manifest.job_checks(manifest.settings(manifest.parsed(manifest.read_manifests(spark, str(tmp_path / "*.json")))))
    first, odd = sorted(jobs.collect(), key=lambda r: r.path)
    assert first.prefix == "reports/" and first.settings.sampling.hand_fps == 2.0 and first.settings.runtime.max_staging_bytes == 60 * 1024**3
    assert first.invalid_settings == ["detector.optimal_batch_size"] and (first.version_ok, first.job_id_ok, first.items_ok, first.prefix_ok, first.rules_ok, first.keys_ok, first.settings_ok) == (True,) * 6 + (False,)
    assert odd.unknown_keys == ["item.colour", "speed"] and not odd.rules_ok and not odd.keys_ok
    one, two = manifest.item_checks(manifest.items(jobs.where("path like '%job.json'"), "path"), "path").orderBy("position").collect()
    assert (one.key, one.etag, one.valid) == ("a/b.mp4", "abc", True) and (two.id_ok, two.key_ok, two.duration_ok, two.valid) == (False,) * 4
    with pytest.raises(Exception):
        manifest.parsed(spark.createDataFrame([("{not json",)], "text string")).select("job.job_id").collect()


def test_frames_that_are_black_or_noise(spark):
    import numpy as np

    noise = np.random.default_rng(7).integers(20, 235, (180, 320, 3), dtype=np.uint8)
    rows = [(0, 180, 320, bytes(180 * 320 * 3)), (1, 180, 320, noise.tobytes()), (2, 2, 2, bytes(range(12)))]
    df = spark.createDataFrame(rows, "k int, h int, w int, bgr binary").withColumn("g", pixels.gray_small(F.col("h"), F.col("w"), F.col("bgr"), 90))
    got = {r.k: (r.g, r.q) for r in df.select("k", "g", pixels.frame_quality(F.col("g.gray"), F.col("g.width")).alias("q")).collect()}
    assert got[0][1].blackish and got[0][1].exposure_bad and not got[1][1].blackish and not got[1][1].exposure_bad
    assert (got[1][0].width, got[1][0].height) == (90, 51)
    g = np.array(got[1][0].gray, float).reshape(51, 90)
    p = np.pad(g, 1, mode="reflect")
    lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g
    share = np.unique(g, return_counts=True)[1] / g.size
    q = got[1][1]
    assert np.allclose([q.mean_luminance, q.entropy, q.laplacian_variance], [g.mean(), -(share * np.log2(share)).sum(), lap.var()])
    assert got[2][0].gray == [round(0.114 * a + 0.587 * (a + 1) + 0.299 * (a + 2)) for a in (0, 3, 6, 9)]


def test_raw_clips(spark, tmp_path):
    path = tmp_path / "a.y4m"
    frames_ = [bytes([i] * 24) + bytes([128] * 12) for i in range(10)]
    path.write_bytes(b"YUV4MPEG2 W6 H4 F10:1 Ip C420\n" + b"".join(b"FRAME\n" + f for f in frames_))
    (tmp_path / "b.y4m").write_bytes(b"RIFF")
    got = {r.path.rsplit("/", 1)[1]: r for r in frames.probe(spark, str(tmp_path)).collect()}
    assert (got["a.y4m"].width, got["a.y4m"].height, got["a.y4m"].fps, got["a.y4m"].frame_count, got["a.y4m"].duration_seconds, got["a.y4m"].valid) == (6, 4, 10.0, 10, 1.0, True) and not got["b.y4m"].valid
    rows = frames.read_frames(spark, [str(path)], 5.0).orderBy("sample").collect()
    assert [(r.sample, r.t, r.luma[0], len(r.luma)) for r in rows] == [(k, k / 5, 2 * k, 24) for k in range(5)]
    with pytest.raises(Exception, match="isn't a clip"):
        frames.read_frames(spark, [str(tmp_path / "b.y4m")], 5.0).collect()


def test_evidence_selection(spark):
    rows = [("r", i, float(t), s, f"{t}".encode()) for i, (t, s) in enumerate([(0, 0.1), (1, 0.9), (2, 0.2), (3, 0.4)])] + [("same", 0, 1.0, 0.5, b"x"), ("same", 1, 1.0, 0.7, b"x")]
    out = evidence.named(report.evidence_by_image(spark.createDataFrame(rows, "reason string, seq int, t double, score double, image binary"), ["reason"]).withColumn("clip", F.lit(1)), "clip")
    got = sorted((r.reason, r.slot, r.t, r.name) for r in out.collect())
    assert got == [("r", 0, 0.0, "00-r-0.000.jpg"), ("r", 1, 1.0, "01-r-1.000.jpg"), ("r", 2, 3.0, "02-r-3.000.jpg"), ("same", 0, 1.0, "03-same-1.000.jpg")]
    names = spark.createDataFrame([("../../second/artifacts/evidence",), ("00-idle-1.000",), ("..",), (None,)], "n string")
    assert [r.ok for r in names.select(C.safe_artifact_id(F.col("n")).alias("ok")).collect()] == [False, True, False, False]


def test_journal_and_retries(spark, tmp_path):
    events = spark.createDataFrame([(0, "one", "pending"), (1, "one", "freed"), (2, "two", "failed-retryable")], "seq long, item_id string, status string")
    assert {r.item_id: r.status for r in journal.latest(events).collect()}["one"] == "freed"
    assert telemetry.sorted_counts(journal.latest(events), "status").first().counts == {"failed-retryable": 1, "freed": 1}
    rows = [(k, "a", s, e) for k, (s, e) in enumerate([("attempting", None), ("failed", "MediaError")] * 4)] + [(20, "b", "attempting", None), (21, "b", "failed", "SourceConflict"), (22, "b", "attempting", None)]
    schema = "seq long, item_id string, status string, error_type string"
    batch = sorted((r.item_id, r.seq, r.status, r.attempts) for r in journal.retried(spark.createDataFrame(rows, schema), 3).collect())
    assert [s for i, _, s, _ in batch if i == "a"] == ["attempting", "failed-retryable", "attempting", "failed-retryable", "attempting", "quarantined"] and batch[-1] == ("b", 21, "conflict", 1)
    for k, part in enumerate((rows[:3], rows[3:])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = retry_states(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in")), 3)
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination(120)
    assert sorted((r.item_id, r.seq, r.status, r.attempts) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == batch


def test_create_only_uploads_and_guarded_reads(spark, tmp_path):
    objects = lambda *rows: spark.createDataFrame([(k, v.encode()) for k, v in rows], "key string, content binary")
    target = str(tmp_path / "target")
    counts = lambda df: {r.action: r.objects for r in df.collect()}
    assert counts(storage.upload(objects(("a", "1"), ("b", "2")), target)) == {"write": 2}
    assert counts(storage.upload(objects(("a", "1"), ("c", "3")), target)) == {"noop": 1, "write": 1}
    with pytest.raises(ValueError, match="b is there"):
        storage.upload(objects(("b", "other"), ("d", "4")), target)
    assert sorted(r.key for r in spark.read.parquet(target).collect()) == ["a", "b", "c"]
    (tmp_path / "files" / "x").mkdir(parents=True)
    (tmp_path / "files" / "x" / "one.bin").write_bytes(b"hello")
    folder = str(tmp_path / "files")
    assert [(r.key, r.size_bytes) for r in storage.inventory(spark, folder).collect()] == [("x/one.bin", 5)]
    want = lambda key, digest: spark.createDataFrame([(key, 5, hashlib.sha256(digest).hexdigest())], "key string, size_bytes long, sha256 string")
    assert [bytes(r.content) for r in storage.guarded_read(spark, folder, want("x/one.bin", b"hello")).collect()] == [b"hello"]
    for bad in (want("x/one.bin", b"jello"), want("x/two.bin", b"hello")):
        with pytest.raises(Exception, match="not as expected"):
            storage.guarded_read(spark, folder, bad).collect()


def test_report_round_trip(spark, tmp_path):
    results = spark.createDataFrame([("a", "good", 7200.0, 10.0), ("b", "odd", 3600.0, 5.0)], "item_id string, verdict string, duration_seconds double, elapsed_seconds double")
    row = report.rollup(results.withColumn("job", F.lit("j")), ["job"])
    report.write_report(row.groupBy("job").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("verdict", "hours")))).alias("hours")), str(tmp_path / "r"))
    back = spark.read.schema("job string, hours map<string,double>").json(str(tmp_path / "r")).first()
    assert back.hours == {"good": 2.0, "error": 1.0}
    with pytest.raises(Exception):
        report.write_report(row, str(tmp_path / "r"))


def test_addresses_and_urls(spark):
    rows = [("10.1.2.3", False), ("172.32.0.1", True), ("172.31.255.255", False), ("8.8.8.8", True), ("256.1.1.1", None), ("host", None), ("0.0.0.0", False), ("224.0.0.1", True)]
    df = spark.createDataFrame(rows, "a string, want boolean")
    assert all(r.got == r.want for r in df.select("want", C.public_ipv4(F.col("a")).alias("got")).collect())


def test_merged_tiles_and_confidence(spark):
    kind = "array<struct<x1:double,y1:double,x2:double,y2:double,score:double,class_id:int>>"
    full = [(10.0, 10.0, 100.0, 100.0, 0.9, 0), (12.0, 12.0, 98.0, 98.0, 0.8, 0), (150.0, 20.0, 220.0, 100.0, 0.2, 0)]
    df = spark.createDataFrame([(0, full, full), (1, [], full)], f"f int, a {kind}, b {kind}")
    got = {r.f: (r.m, r.c) for r in df.select("f", boxes.merged_with_tiles(F.col("a"), F.col("b"), 0.45).alias("m"), C.suppressed(boxes.confident(F.col("b"), 0.3), 0.45).alias("c")).collect()}
    assert [len(got[f][0]) for f in (0, 1)] == [3, 2] and [x.score for x in got[0][1]] == [0.9]
