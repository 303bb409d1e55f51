"""Figures about a run: stage times, machine load, transfers and batching. Each is one partial aggregation by its key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stage_times(calls: DataFrame, stage: str, seconds: str) -> DataFrame:
    """Seconds (negative ones as 0) and calls by stage."""
    return calls.groupBy(stage).agg(F.sum(F.greatest(F.col(seconds), F.lit(0.0))).alias("seconds"), F.count("*").alias("calls"))


def system_load(samples: DataFrame, by: list[str], gpu: str, cpu: str) -> DataFrame:
    """Mean and peak of what was sampled, null where nothing was; the samples are those of the series that has more."""
    return samples.groupBy(*by).agg(
        F.greatest(F.count(gpu), F.count(cpu)).alias("samples"), F.avg(gpu).alias("mean_gpu"), F.max(gpu).alias("peak_gpu"), F.avg(cpu).alias("mean_cpu")
    )


def transfers(downloads: DataFrame, by: list[str], size: str, seconds: str, reused: str) -> DataFrame:
    """Bytes, seconds and their rate (null without seconds) over downloads that weren't reused."""
    fresh = downloads.where(~F.coalesce(F.col(reused), F.lit(False))).groupBy(*by)
    out = fresh.agg(F.sum(F.coalesce(F.col(size), F.lit(0))).alias("bytes"), F.sum(F.coalesce(F.col(seconds), F.lit(0.0))).alias("elapsed_seconds"))
    return out.withColumn("bytes_per_second", F.try_divide("bytes", "elapsed_seconds"))


def batching(batches: DataFrame, by: list[str], frames: str, wait_seconds: str) -> DataFrame:
    """Batches, frames, mean batch size and the mean wait of a frame in milliseconds; 0 without frames."""
    out = batches.groupBy(*by).agg(F.count("*").alias("batches"), F.sum(frames).alias("frames"), F.sum(wait_seconds).alias("waited"))
    ratio = lambda top: F.coalesce(F.try_divide(top, F.col("frames")), F.lit(0.0))
    return out.select(*by, "batches", "frames", (F.col("frames") / F.col("batches")).alias("mean_batch_size"), ratio(F.col("waited") * 1000.0).alias("mean_queue_wait_ms"))


def counter_load(samples: DataFrame, by: str, order: str, total: str, idle: str) -> DataFrame:
    """(by, order, percent): load between consecutive readings of growing counters; pairs without progress are skipped."""
    w = Window.partitionBy(by).orderBy(order)
    d = samples.withColumns({"_t": F.col(total) - F.lag(total).over(w), "_i": F.col(idle) - F.lag(idle).over(w)}).where("_t > 0")
    return d.select(by, order, (100.0 * (1.0 - F.col("_i") / F.col("_t"))).alias("percent"))


def chunks(samples: DataFrame, index: str, size: int) -> DataFrame:
    """Adds ``chunk``, the number of the fixed-size piece that a sample belongs to."""
    return samples.withColumn("chunk", F.floor(F.col(index) / size).cast("long"))


def request_slices(requests: DataFrame, frames: str, most: int) -> DataFrame:
    """Requests of more than ``most`` frames as slices in order: adds ``slice``, ``first`` and ``size``. A request without frames has none."""
    cut = F.sequence(F.lit(0), F.greatest(F.ceil(F.col(frames) / most) - 1, F.lit(0)).cast("int"))
    sliced = requests.where(F.col(frames) > 0).withColumn("slice", F.explode(cut)).withColumn("first", F.col("slice") * most)
    return sliced.withColumn("size", F.least(F.lit(most), F.col(frames) - F.col("first")))


#: What a worker needs before it takes jobs (column, value it must have, what is said otherwise), in the order looked at.
READY = (("provider", "TensorRTNative", "TensorRTNative is required"), ("video_backend", "nvdec", "nvdec is required"), ("decoder", True, "NVDEC runtime and FFmpeg h264_cuvid decoder are required"))


def readiness(workers: DataFrame) -> DataFrame:
    """workers(provider, video_backend, decoder, ...) with ``ready`` and ``error``, the first thing that is missing."""
    missing = [F.when(~F.coalesce(F.col(c) == F.lit(v), F.lit(False)), F.lit(said)) for c, v, said in READY]
    return workers.withColumn("error", F.coalesce(*missing)).withColumn("ready", F.col("error").isNull())


def missing_settings(settings: Column, required: list[str]) -> Column:
    """Names among ``required`` that a map of settings lacks or has empty."""
    given = F.map_keys(F.map_filter(settings, lambda _, v: F.coalesce(v != "", F.lit(False))))
    return F.array_except(F.array(*map(F.lit, required)), given)


def sorted_counts(rows: DataFrame, key: str) -> DataFrame:
    """One row: the counts by key as a map in the order of its keys."""
    counts = rows.groupBy(F.coalesce(F.col(key), F.lit("unknown")).alias("k")).agg(F.count("*").alias("n"))
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias("counts"))
