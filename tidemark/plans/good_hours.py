"""Queries on the hours of a corpus that are good. A user of ``events`` is a clip, its events are replicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import report
from tidemark.plans.gate import query
from tidemark.plans.tables import read

_P = "WITH p AS (SELECT user_id, CASE WHEN user_id % 7 <> 0 THEN avg(CASE WHEN value >= 20e0 AND event_id % 100 <= 60 THEN 1e0 ELSE 0e0 END) ELSE 0e0 END AS probability, count(*) / 4e0 AS hours FROM events GROUP BY user_id)"


def _probabilities(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", "value", (F.col("event_id") % 100).cast("double").alias("idle"), (F.col("user_id") % 7 != 0).alias("eligible"))
    return report.good_probability(e, "user_id", "value", "idle", "eligible", 20.0, 60.0)


@query(_P + " SELECT user_id, round(probability, 8) AS probability FROM p")
def a06_good_probability(spark, sf_dir):
    return _probabilities(spark, sf_dir).select("user_id", F.round("probability", 8).alias("probability"))


@query(_P + """, d AS (SELECT r, CASE WHEN ('0x' || substr(sha256(concat_ws('|', 11, user_id, r)), 1, 8))::BIGINT / 4294967296e0 < probability THEN hours ELSE 0e0 END AS h FROM p, unnest(range(0, 1000)) AS x(r)),
t AS (SELECT r, sum(h) AS h FROM d GROUP BY r) SELECT round(quantile_cont(h, 0.025), 6) AS low, round(quantile_cont(h, 0.975), 6) AS high FROM t""")
def a07_good_hours(spark, sf_dir):
    hours = read(spark, sf_dir, "events").groupBy("user_id").agg((F.count("*") / 4.0).alias("hours"))
    items = _probabilities(spark, sf_dir).join(hours, "user_id")
    return report.good_hours(items, "user_id", "probability", "hours", 1000, 11).select(F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))
