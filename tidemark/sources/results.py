"""Results of items read back: at the keys that the journal names, strictly by their schema, with what is wrong as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.journal import latest
from tidemark.sources.objects import content

_INTERVAL = "struct<low: double, high: double, confidence: double, method: string>"
#: A result document. Metrics are numbers, booleans or null, as text; free-form parts are JSON text.
RESULT = (
    "struct<item_id: string, source_key: string, duration_seconds: double, verdict: string, reason_codes: array<string>, metrics: map<string, string>, "
    f"intervals: map<string, {_INTERVAL}>, rule_results: array<struct<rule_id: string, signal: string, severity: string, outcome: string, value: string, interval: {_INTERVAL}>>, "
    "failure_intervals: array<struct<reason: string, start_seconds: double, end_seconds: double, severity: string>>, "
    "evidence: array<struct<rule_id: string, timestamp_seconds: double, bucket: string, key: string, sha256: string, size_bytes: bigint, annotation: string>>, provenance: map<string, string>, error: string>"
)
#: Fields that a result must have, all that it may have, and its verdicts, outcomes and severities.
NEEDED = ("item_id", "source_key", "duration_seconds", "verdict")
ALLOWED = (*NEEDED, "reason_codes", "metrics", "intervals", "rule_results", "failure_intervals", "evidence", "provenance", "error")
VERDICTS, OUTCOMES, SEVERITIES = ("good", "bad", "uncertain", "error"), ("pass", "fail", "uncertain"), ("reject", "warn")


def result_error(text: Column, item: Column) -> Column:
    """What is wrong with a result document, null if nothing: the first of what is looked at."""
    keys = F.json_object_keys(text)
    r = F.from_json(text, RESULT, {"mode": "PERMISSIVE"})
    bad = lambda rows, fault: F.exists(F.coalesce(rows, F.array()), fault)
    several = lambda given: F.concat_ws(", ", F.array_sort(given))
    span = lambda x: x["start_seconds"].isNull() | x["end_seconds"].isNull() | (x["start_seconds"] < 0) | (x["end_seconds"] < 0) | ~F.coalesce(x["severity"].isin(*SEVERITIES), F.lit(False))
    return (
        F.when(text.isNull(), "no result")
        .when(keys.isNull(), "not a JSON object")
        .when(F.size(F.array_except(keys, F.array(*map(F.lit, ALLOWED)))) > 0, F.concat(F.lit("unknown: "), several(F.array_except(keys, F.array(*map(F.lit, ALLOWED))))))
        .when(F.size(F.array_except(F.array(*map(F.lit, NEEDED)), keys)) > 0, F.concat(F.lit("missing: "), several(F.array_except(F.array(*map(F.lit, NEEDED)), keys))))
        .when(r["duration_seconds"].isNull() | F.isnan(r["duration_seconds"]) | (r["duration_seconds"] < 0), "duration_seconds")
        .when(~F.coalesce(r["verdict"].isin(*VERDICTS), F.lit(False)), "verdict")
        .when(r["source_key"].isNull(), "source_key")
        .when(~r["item_id"].eqNullSafe(item), "item_id")
        .when(bad(r["rule_results"], lambda x: ~F.coalesce(x["outcome"].isin(*OUTCOMES) & x["severity"].isin(*SEVERITIES), F.lit(False)) | x["rule_id"].isNull()), "rule_results")
        .when(bad(r["failure_intervals"], span), "failure_intervals")
        .when(bad(r["evidence"], lambda x: F.coalesce(x["size_bytes"] < 1, F.lit(True)) | x["key"].isNull() | x["sha256"].isNull()), "evidence")
    )


def parsed_results(documents: DataFrame) -> DataFrame:
    """documents(item_id, key, text) to (item_id, key, result, error): either is null."""
    checked = documents.withColumn("error", result_error(F.col("text"), F.col("item_id")))
    return checked.select("item_id", "key", F.when(F.col("error").isNull(), F.from_json("text", RESULT)).alias("result"), "error")


def read_results(events: DataFrame, folder: str) -> DataFrame:
    """Results of the items that the journal has as freed, at the ``result_key`` of that event: (item_id, key, result, error). An item without a
    key, an object or a whole document is a row with what is wrong."""
    keyed = events.groupBy("item_id").agg(F.max_by(F.struct("status", F.col("details")["result_key"].alias("key")), "seq").alias("last")).where("last.status = 'freed'")
    return parsed_results(keyed.select("item_id", "last.key").repartition("item_id").withColumn("text", F.decode(content(folder, F.col("key")), "UTF-8")))


def run_results(events: DataFrame, folder: str) -> DataFrame:
    """What the report's summary takes: (item_id, verdict, duration_seconds, elapsed_seconds, probability) of results that could be read."""
    r, number = F.col("result"), lambda m, k: F.coalesce(m[k].try_cast("double"), F.lit(0.0))
    good = read_results(events, folder).where("error is null")
    return good.select("item_id", r["verdict"].alias("verdict"), r["duration_seconds"].alias("duration_seconds"), number(r["provenance"], "elapsed_seconds").alias("elapsed_seconds"), number(r["metrics"], "automated_good_probability").alias("probability"))


def unread(events: DataFrame, folder: str) -> DataFrame:
    """(status, items): items by their latest state, freed ones whose result can't be read as ``unreadable``."""
    wrong = read_results(events, folder).where("error is not null").select("item_id", F.lit(True).alias("wrong"))
    state = F.when(F.col("wrong"), "unreadable").otherwise(F.col("status"))
    return latest(events).join(wrong, "item_id", "left").groupBy(state.alias("status")).agg(F.count("*").alias("items"))
