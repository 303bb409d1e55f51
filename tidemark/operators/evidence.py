"""Which samples of a clip are candidates for evidence, and with which score, by reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import black_deficit, evidence_name


def camera_candidates(frames: DataFrame, clip: str, black_mean: float = 8.0, entropy: float = 1.0, blur: float = 80.0, translation: float = 0.03, rotation: float = 5.0) -> DataFrame:
    """frames(clip, t, quality, translation, rotation) to (clip, reason, t, score): dark, blurred, badly exposed and shaken frames, in one pass."""
    q = F.col("quality")
    reasons = (
        ("black-covered", q["blackish"], black_deficit(q["mean_luminance"], q["entropy"], black_mean, entropy)), ("blur-warning", q["blurry"], blur - q["laplacian_variance"]),
        ("exposure-warning", q["exposure_bad"], q["clipped_fraction"]), ("translation-shake", F.col("translation") > translation, F.col("translation")),
        ("rotation-shake", F.col("rotation") > rotation, F.col("rotation")),
    )
    return _rows(frames, clip, reasons)


def hand_candidates(samples: DataFrame, clip: str, speed_limit: float | None, hand_fps: float, least_speed: float = 0.05) -> DataFrame:
    """samples(clip, i, t, visible, inactive, activity, speed) to (clip, reason, t, score): no hands, idle (by lack of activity), fast hands (with
    a limit), and every so many seconds a moving hand that may repeat itself."""
    stride = max(1, round(hand_fps * 10.0))
    number = F.row_number().over(Window.partitionBy(clip).orderBy("i"))
    limit = F.lit(float("inf") if speed_limit is None else float(speed_limit))
    reasons = (
        ("hands-visible", ~F.col("visible"), F.lit(1.0)), ("extended-idle", F.col("inactive"), 1.0 - F.col("activity")), ("hand-speed", F.col("speed") > limit, F.col("speed")),
        ("repetitive-motion", (F.col("speed") >= least_speed) & (F.col("_number") % stride == 0), F.col("speed")),
    )
    return _rows(samples.withColumn("_number", number), clip, reasons)


def _rows(samples: DataFrame, clip: str, reasons: tuple[tuple[str, Column, Column], ...]) -> DataFrame:
    held = F.array_compact(F.array(*(F.when(F.coalesce(on, F.lit(False)), F.struct(F.lit(name).alias("reason"), score.cast("double").alias("score"))) for name, on, score in reasons)))
    return samples.select(clip, "t", F.explode(held).alias("x")).select(clip, "x.reason", "t", "x.score")


def named(evidence: DataFrame, clip: str) -> DataFrame:
    """Evidence (clip, reason, slot, t, ...) with its file ``name``, numbered by reason and slot within the clip."""
    place = F.row_number().over(Window.partitionBy(clip).orderBy("reason", "slot")) - 1
    return evidence.withColumn("name", evidence_name(place.cast("int"), F.col("reason"), F.col("t")))


def failure_intervals(covered: DataFrame, idle: DataFrame, clip: str) -> DataFrame:
    """Spans of both kinds in one table, covered ones first: (clip, reason, start_seconds, end_seconds, severity)."""
    of = lambda spans, reason: spans.select(clip, F.lit(reason).alias("reason"), "start_seconds", "end_seconds", F.lit("reject").alias("severity"))
    return of(covered, "black-covered").unionByName(of(idle, "extended-idle"))
