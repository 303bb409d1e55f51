import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import report
from tidemark.sources import objects, results
from tidemark.sources.objects import DestinationConflict, _Creating, _Listing


def put(folder, files):
    for key, data in files.items():
        (folder / key).parent.mkdir(parents=True, exist_ok=True)
        (folder / key).write_bytes(data)


def test_listing_by_prefix_and_size(spark, tmp_path):
    files = {"a/x.bin": b"123", "a/deep/er/y.bin": b"12345", "ab/z.bin": b"1", "top.bin": b"", "b/.unfinished-1": b"9"}
    put(tmp_path, files)
    rows = {r.key: r.size_bytes for r in objects.listing(spark, str(tmp_path)).collect()}
    assert rows == {k: len(v) for k, v in files.items() if "unfinished" not in k}
    assert [r.key for r in objects.listing(spark, str(tmp_path), "a/").where("size_bytes < 4").collect()] == ["a/x.bin"]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    try:
        found = objects.listing(spark, f"file://{tmp_path}").where(F.col("key").startswith("a/") & (F.col("size_bytes") >= 4))
        assert [r.key for r in found.collect()] == ["a/deep/er/y.bin"]
        assert [r.key for r in objects.listing(spark, str(tmp_path)).where("key = 'ab/z.bin'").collect()] == ["ab/z.bin"]
        assert objects.listing(spark, str(tmp_path)).where(F.col("key").startswith("none/")).count() == 0
        assert objects.listing(spark, str(tmp_path / "absent")).count() == 0
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_a_prefix_decides_which_folders_are_listed(tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan, StringStartsWith

    put(tmp_path, {f"{d}/{e}/f.bin": b"12" for d in ("2023", "2024") for e in ("01", "02")})
    reader = _Listing(str(tmp_path))
    assert [type(f) for f in reader.pushFilters([StringStartsWith(("key",), "2024/0"), GreaterThan(("size_bytes",), 1), EqualTo(("modified",), 3)])] == [EqualTo]
    parts = reader.partitions()
    assert sorted(p.path[len(str(tmp_path)) :] for p in parts) == ["/2024", "/2024/01", "/2024/02"]
    assert sorted(k for p in parts for k, *_ in reader.read(p)) == ["2024/01/f.bin", "2024/02/f.bin"]
    both = _Listing(str(tmp_path))
    assert list(both.pushFilters([StringStartsWith(("key",), "2023"), StringStartsWith(("key",), "2024")])) == [] and not [r for p in both.partitions() for r in both.read(p)]


def test_expected_objects_and_contents(spark, tmp_path):
    put(tmp_path, {"a/1": b"xx", "a/2": b"yyy"})
    expected = spark.createDataFrame([("a/1", 2), ("a/2", 9), ("a/3", 1), ("a/2", None)], "key string, size_bytes long")
    got = objects.checked(expected, objects.listing(spark, str(tmp_path))).withColumn("content", objects.content(str(tmp_path), F.col("key")))
    rows = sorted(((r.key, r.size_bytes, r.state, r.content) for r in got.collect()), key=repr)
    assert rows == sorted([("a/1", 2, "same", b"xx"), ("a/2", 9, "size", b"yyy"), ("a/3", 1, "absent", None), ("a/2", None, "same", b"yyy")], key=repr)


def left_over(folder):
    return [f for _, _, names in os.walk(folder) for f in names if "unfinished" in f]


def test_keys_are_created_once(spark, tmp_path):
    rows = [(f"r/{k}.json", bytearray(f"{k}".encode())) for k in range(20)]
    df = spark.createDataFrame(rows, "key string, content binary").repartition(4)
    objects.create_objects(df, str(tmp_path))
    objects.create_objects(df, str(tmp_path))  # the same bytes: nothing to do
    assert {r.key: r.size_bytes for r in objects.listing(spark, str(tmp_path)).collect()} == {k: len(d) for k, d in rows}
    other = spark.createDataFrame([("new/1", bytearray(b"n")), ("r/3.json", bytearray(b"other"))], "key string, content binary").coalesce(1)
    with pytest.raises(Exception, match="r/3.json"):
        objects.create_objects(other, str(tmp_path))
    assert (tmp_path / "r/3.json").read_bytes() == b"3" and not (tmp_path / "new/1").exists() and not left_over(tmp_path)


@pytest.mark.parametrize("key", ["../x", "/x", "", "a/../../x", "a/"])
def test_unsafe_keys_are_refused(spark, tmp_path, key):
    with pytest.raises(Exception, match="safe key"):
        objects.create_objects(spark.createDataFrame([("fine", bytearray(b"1")), (key, bytearray(b"2"))], "key string, content binary").coalesce(1), str(tmp_path))
    assert not left_over(tmp_path) and not (tmp_path / "fine").exists()


def writer(folder):
    from pyspark.sql.types import StructType

    return _Creating(str(folder), StructType().add("key", "string").add("content", "binary"))


def test_of_two_writers_of_a_key_one_wins(tmp_path):
    a, b, c = writer(tmp_path), writer(tmp_path), writer(tmp_path)
    first, second, same = (w.write(iter([{"key": "k", "content": d}, {"key": m, "content": b"m"}])) for w, d, m in ((a, b"one", "p"), (b, b"two", "q"), (c, b"one", "p")))
    a.commit([first])
    with pytest.raises(DestinationConflict, match="k"):
        b.commit([second])
    c.commit([same])
    assert (tmp_path / "k").read_bytes() == b"one" and sorted(os.listdir(tmp_path)) == ["k", "p"]


def test_a_lost_task_and_an_abort_leave_nothing(tmp_path):
    w = writer(tmp_path)

    def rows():
        yield {"key": "a", "content": b"1"}
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        w.write(rows())
    assert os.listdir(tmp_path) == []
    w.abort([w.write(iter([{"key": "b", "content": b"2"}])), None])
    assert os.listdir(tmp_path) == []
    with pytest.raises(ValueError, match="hard links"):
        writer("s3://bucket")


def result(item, **more):
    base = {"item_id": item, "source_key": f"clips/{item}.mp4", "duration_seconds": 3600.0, "verdict": "good", "reason_codes": [], "metrics": {"hand.visibility_fraction": 0.9, "camera.corrupt": False, "automated_good_probability": 1.0, "none": None}, "intervals": {"idle.fraction": {"low": 0.1, "high": 0.2, "confidence": 0.95, "method": "m"}}, "rule_results": [{"rule_id": "hands-visible", "signal": "s", "severity": "reject", "outcome": "pass", "value": 0.9}], "failure_intervals": [{"reason": "extended-idle", "start_seconds": 0.0, "end_seconds": 2.0, "severity": "reject"}], "evidence": [{"rule_id": "r", "timestamp_seconds": 1.0, "bucket": "b", "key": "k", "sha256": "00", "size_bytes": 5, "annotation": {"x": [1]}}], "provenance": {"elapsed_seconds": 600.0, "deep": {"a": 1}}}
    return base | more


def test_a_report_from_journal_and_results(spark, tmp_path):
    docs = {
        "good": result("good"), "bad": result("bad", verdict="bad", duration_seconds=1800.0, provenance={"elapsed_seconds": 300}, metrics={}), "swapped": result("other"), "extra": result("extra", more=1), "negative": result("negative", duration_seconds=-1),
        "verdict": result("verdict", verdict="fine"), "outcome": result("outcome", rule_results=[{"rule_id": "r", "signal": "s", "severity": "reject", "outcome": "maybe", "value": 1}]), "span": result("span", failure_intervals=[{"reason": "r", "start_seconds": 1.0, "end_seconds": None, "severity": "reject"}]),
        "evidence": result("evidence", evidence=[{"rule_id": "r", "timestamp_seconds": 1, "bucket": "b", "key": "k", "sha256": "0", "size_bytes": 0}]),
    }
    files = {f"qc/{k}/result.json": json.dumps(v).encode() for k, v in docs.items()} | {"qc/cut/result.json": json.dumps(result("cut")).encode()[:-9], "qc/list/result.json": b"[1]", "qc/lacks/result.json": json.dumps({k: v for k, v in result("lacks").items() if k != "verdict"}).encode(), "qc/stray/result.json": b"never named"}
    put(tmp_path, files)
    events = [(k, n, s, {"result_key": f"qc/{k}/result.json"} if s == "freed" else {}) for k in (*docs, "cut", "list", "lacks", "absent") for n, s in ((0, "attempting"), (1, "freed"))]
    events += [("again", 0, "freed", {"result_key": "qc/good/result.json"}), ("again", 1, "failed-retryable", {}), ("nokey", 0, "freed", {})]
    journal = spark.createDataFrame(events, "item_id string, seq long, status string, details map<string,string>").repartition(3)
    got = {r.item_id: r for r in results.read_results(journal, str(tmp_path)).collect()}
    assert {k: r.error for k, r in got.items()} == {
        "good": None, "bad": None, "swapped": "item_id", "extra": "unknown: more", "negative": "duration_seconds", "verdict": "verdict", "outcome": "rule_results", "span": "failure_intervals", "evidence": "evidence", "cut": "not a JSON object", "list": "not a JSON object",
        "lacks": "missing: verdict", "absent": "no result", "nokey": "no result",
    }
    assert got["good"].result.metrics == {"hand.visibility_fraction": "0.9", "camera.corrupt": "false", "automated_good_probability": "1.0", "none": None}
    assert got["good"].result.intervals["idle.fraction"].high == 0.2 and json.loads(got["good"].result.evidence[0].annotation) == {"x": [1]} and got["cut"].result is None
    items = spark.createDataFrame([("good", None), ("bad", 900.0), ("later", 7200.0)], "item_id string, duration_seconds double")
    one = report.summary(items, results.run_results(journal, str(tmp_path)), "item_id", 7500.0, 100, 3).collect()
    assert len(one) == 1
    r = one[0]
    assert (r.captured_clips, r.captured_hours, r.processed_clips, r.processed_hours, r.good_clips, r.good_hours, r.bad_clips, r.bad_hours, r.error_clips, r.status) == (3, 3.25, 2, 1.5, 1, 1.0, 1, 0.5, 0, "partial")
    assert (r.good_hours_low, r.good_hours_high, r.source_xrt, r.projected_hours) == (1.0, 1.0, 6.0, 1250.0)
    assert {r.status: r["items"] for r in results.unread(journal, str(tmp_path)).collect()} == {"freed": 2, "unreadable": 12, "failed-retryable": 1}


def test_a_report_without_results(spark, tmp_path):
    none = spark.createDataFrame([], "item_id string, seq long, status string, details map<string,string>")
    items = spark.createDataFrame([("a", 3600.0)], "item_id string, duration_seconds double")
    r = report.summary(items, results.run_results(none, str(tmp_path)), "item_id", 7500.0, 100, 3).collect()[0]
    assert (r.captured_clips, r.processed_clips, r.good_hours_low, r.source_xrt, r.projected_hours, r.status) == (1, 0, None, 0.0, None, "error")
