import pytest

from tidemark.operators.journal import latest, status_counts
from tidemark.sources.journal import append_batch, read_journal
from tidemark.streaming.journal import journal_sink, latest_states, status_feed

SCHEMA = "timestamp string, item_id string, status string, details map<string,string>, seq long"
FIRST = [("1", "a", "attempting", {"size": "3"}, 1), ("2", "b", "attempting", None, 2), ("3", "a", "freed", {}, 3)]
SECOND = [("4", "b", "failed-retryable", {"reason": "x"}, 4), ("5", "b", "attempting", None, 5), ("5", "c", None, None, 6)]
LATEST = {"a": ("freed", 1), "b": ("attempting", 2), "c": (None, 0)}


def as_dict(df):
    return {r.item_id: (r.status, r.attempts) for r in df.collect()}


def test_scan_keeps_line_order_and_skips_blank_lines(spark, tmp_path):
    (tmp_path / "j.jsonl").write_text('{"timestamp":"9","item_id":"a","status":"attempting","size":3}\n\n  \n{"timestamp":"1","item_id":"a","status":"freed","more":{"x":[1]}}\n')
    events = read_journal(spark, str(tmp_path / "j.jsonl"))
    assert [(r.timestamp, r.status, r.details) for r in events.orderBy("seq").collect()] == [("9", "attempting", {"size": "3"}), ("1", "freed", {"more": '{"x":[1]}'})]
    assert as_dict(latest(events)) == {"a": ("freed", 1)}


def test_bad_line_fails_and_empty_file_is_empty(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text('{"item_id":"a","status":"freed"}\n{"item_id":\n')
    with pytest.raises(Exception, match="not an event"):
        read_journal(spark, str(tmp_path / "bad.jsonl")).collect()
    (tmp_path / "empty.jsonl").write_text("")
    assert read_journal(spark, str(tmp_path / "empty.jsonl")).count() == 0


def test_batches_round_trip_and_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "journal")
    for batch, rows in ((0, FIRST), (1, SECOND), (1, SECOND)):
        append_batch(spark.createDataFrame(rows, SCHEMA).coalesce(1), batch, path)
    events = read_journal(spark, path)
    assert events.count() == 6
    assert as_dict(latest(events)) == LATEST


def test_streams_agree_with_the_batch_operators(spark, tmp_path):
    source = str(tmp_path / "in")
    for rows in (FIRST, SECOND):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    changed, feed = {}, {}

    def run(make, name):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        query = make(stream).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        query.awaitTermination(120)

    run(lambda s: latest_states(s, lambda df, _: changed.update(as_dict(df))), "c1")
    assert changed == LATEST

    def keep(df, _):
        feed.clear()
        feed.update({r.status: r["items"] for r in df.collect()})

    run(lambda s: status_feed(s, keep), "c2")
    batch = status_counts(spark.createDataFrame(FIRST + SECOND, SCHEMA))
    assert feed == {r.status: r["items"] for r in batch.collect()} == {"freed": 1, "attempting": 1, "unknown": 1}
    run(lambda s: journal_sink(s.drop("seq"), str(tmp_path / "journal")), "c3")
    assert read_journal(spark, str(tmp_path / "journal")).count() == 6
