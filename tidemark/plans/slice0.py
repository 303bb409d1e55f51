"""The flagship: clips from events, two signals a clip, threshold rules, verdicts and their rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.timeline import numbered
from tidemark.plans.tables import read


def verdict_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = numbered(read(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], 5.0)
    seen = (F.col("event_type") != "error").cast("double")
    speed = F.when(F.col("event_type") != "error", F.col("value") / 500)
    signals = samples.groupBy("user_id").agg(F.avg(seen).alias("visible"), F.percentile(speed, F.lit(0.95)).alias("p95"), F.count("*").alias("n"))
    verdict = F.when((F.col("visible") < 0.75) | (F.col("p95") > 0.35), "bad").when(F.col("visible") < 0.80, "uncertain").otherwise("good")
    return signals.withColumn("verdict", verdict).groupBy("verdict").agg(F.count("*").alias("clips"), F.sum("n").alias("samples"))


SQL = """
WITH c AS (SELECT user_id, avg(CASE WHEN event_type <> 'error' THEN 1e0 ELSE 0e0 END) AS visible,
  quantile_cont(CASE WHEN event_type <> 'error' THEN value / 500 END, 0.95) AS p95, count(*) AS n FROM events GROUP BY user_id)
SELECT CASE WHEN visible < 75e-2 OR p95 > 35e-2 THEN 'bad' WHEN visible < 80e-2 THEN 'uncertain' ELSE 'good' END AS verdict,
  count(*) AS clips, CAST(sum(n) AS BIGINT) AS samples FROM c GROUP BY 1
"""
