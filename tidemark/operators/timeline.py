"""Clip timelines: numbering, decimation, steps, windowed conditions and runs.

A timeline is a table with a clip key and a dense sample index ``i``; every operator here partitions by the clip alone, so
that one shuffle serves a chain of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(events: DataFrame, clip: str, order: list[str], rate: float) -> DataFrame:
    """Adds the dense index ``i`` and the clip-relative time ``t`` in seconds."""
    w = Window.partitionBy(clip).orderBy(*order)
    return events.withColumn("i", F.row_number().over(w) - 1).withColumn("t", F.col("i") / F.lit(float(rate)))


def decimated(samples: DataFrame, clip: str, rate: float, t: str = "t") -> DataFrame:
    """Marks in ``selected`` the samples that a greedy reader at ``rate`` takes (rate up to the sampling rate)."""
    w = Window.partitionBy(clip).orderBy("i")
    due = lambda c: F.floor((c + F.lit(1e-6)) * F.lit(float(rate)))
    return samples.withColumn("selected", F.coalesce(due(F.col(t)) > due(F.lag(t).over(w)), F.lit(True)))


def effective_step(samples: DataFrame, clip: str, rate: float) -> DataFrame:
    """``dt`` since the selected sample before, at least one period; null for the first."""
    w = Window.partitionBy(clip).orderBy("i")
    return samples.withColumn("dt", F.greatest(F.col("t") - F.lag("t").over(w), F.lit(1.0 / rate)))


def with_previous_selected(samples: DataFrame, clip: str, selected: str, columns: list[str]) -> DataFrame:
    """Every sample with ``previous``: ``columns`` of the last selected sample before it; null where there is none."""
    before = Window.partitionBy(clip).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    return samples.withColumn("previous", F.last(F.when(F.col(selected), F.struct(*columns)), ignorenulls=True).over(before))


def differences(samples: DataFrame, clip: str, value: str) -> DataFrame:
    """``d``, the value less the one before."""
    return samples.withColumn("d", F.col(value) - F.lag(value).over(Window.partitionBy(clip).orderBy("i")))


def _islands(samples: DataFrame, clip: str, on: Column) -> DataFrame:
    """``island``: equal for samples of one unbroken run of ``on``."""
    w = Window.partitionBy(clip).orderBy("i")
    return samples.withColumn("island", F.sum(F.when(on, 0).otherwise(1)).over(w))


def covered_spans(samples: DataFrame, clip: str, flag: str, window: int, share: float, step: float) -> DataFrame:
    """Spans of samples that lie in a full window of ``window`` samples of which ``share`` or more have the flag."""
    order = Window.partitionBy(clip).orderBy("i")
    ahead = order.rowsBetween(0, window - 1)
    full = (F.count("*").over(ahead) == window) & (F.avg(F.col(flag).cast("double")).over(ahead) >= share)
    marked = samples.withColumn("_full", full.cast("int")).withColumn("_on", F.max("_full").over(order.rowsBetween(-(window - 1), 0)) == 1)
    runs = _islands(marked, clip, F.col("_on")).where("_on")
    return runs.groupBy(clip, "island").agg(F.min("t").alias("start_seconds"), (F.max("t") + step).alias("end_seconds"), F.count("*").alias("n_samples")).drop("island")


def qualified_runs(samples: DataFrame, clip: str, state: str, least_seconds: float) -> DataFrame:
    """Unbroken runs of true (null and false both break) that last ``least_seconds``; a run ends one first step after its last sample.

    A timeline of one sample takes ``least_seconds`` as its step.
    """
    order = Window.partitionBy(clip).orderBy("i")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    step = F.coalesce(F.nth_value("t", 2).over(whole) - F.first("t").over(whole), F.lit(float(least_seconds)))
    runs = _islands(samples.withColumn("_step", step), clip, F.coalesce(F.col(state), F.lit(False))).where(state)
    spans = runs.groupBy(clip, "island").agg(F.min("t").alias("start_seconds"), (F.max("t") + F.max("_step")).alias("end_seconds"), F.count("*").alias("n_samples"))
    return spans.where(F.col("end_seconds") - F.col("start_seconds") >= least_seconds).drop("island")


def longest_run(samples: DataFrame, clip: str, value: str) -> DataFrame:
    """The samples of each clip's first longest run of known values, renumbered by ``k``."""
    runs = _islands(samples, clip, F.col(value).isNotNull()).where(F.col(value).isNotNull())
    sized = runs.withColumn("_n", F.count("*").over(Window.partitionBy(clip, "island")))
    best = sized.withColumn("_best", F.max(F.struct("_n", (-F.col("island")).alias("island"))).over(Window.partitionBy(clip)))
    kept = best.where(-F.col("island") == F.col("_best.island"))
    return kept.withColumn("k", F.row_number().over(Window.partitionBy(clip).orderBy("i")) - 1).drop("_n", "_best", "island")
