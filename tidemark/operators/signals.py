"""A clip's ten signals as rows, with the intervals that some of them have, and what a clip that can't be read counts as."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The signals of a clip, which of them are booleans, and what a corrupt clip has (value, low, high).
BOOLEAN = ("camera.corrupt", "camera.black_covered")
CORRUPT = {
    "hand.visibility_fraction": (0.0, 0.0, 0.0), "hand.motion_speed_p95": (0.0, 0.0, 0.0), "idle.fraction": (0.0, 0.0, 1.0), "motion.repetition_score": (0.0, None, None),
    "camera.corrupt": (1.0, None, None), "camera.black_covered": (0.0, None, None), "camera.blur_fraction": (0.0, None, None), "camera.exposure_fraction": (0.0, None, None),
    "camera.shake_p95_translation": (0.0, None, None), "camera.shake_p95_rotation": (0.0, None, None),
}


def signal_rows(clips: DataFrame, clip: str, values: dict[str, Column]) -> DataFrame:
    """One row per clip to one row per signal: (clip, signal, value, is_bool). An unknown shake (no pair of frames) is 0."""
    default = lambda name, c: F.coalesce(c.cast("double"), F.lit(0.0)) if "shake" in name else c.cast("double")
    rows = F.array(*(F.struct(F.lit(n).alias("signal"), default(n, c).alias("value"), F.lit(n in BOOLEAN).alias("is_bool")) for n, c in values.items()))
    return clips.select(clip, F.explode(rows).alias("x")).select(clip, "x.*")


def signal_map(values: dict[str, Column], intervals: dict[str, tuple[Column, Column]]) -> Column:
    """A clip's signals in its own row: a map to (value, is_bool, low, high), without an interval null."""
    none = (F.lit(None), F.lit(None))
    entries = ((n, *(x.cast("double").alias(k) for k, x in zip(("value", "low", "high"), (c, *intervals.get(n, none))))) for n, c in values.items())
    return F.create_map(*(x for n, value, low, high in entries for x in (F.lit(n), F.struct(value, F.lit(n in BOOLEAN).alias("is_bool"), low, high))))


def with_intervals(signals: DataFrame, intervals: DataFrame, clip: str) -> DataFrame:
    """signals(clip, signal, ...) with low and high of intervals(clip, signal, low, high), null where a signal has none."""
    return signals.join(intervals.select(clip, "signal", "low", "high"), [clip, "signal"], "left")


def corrupt_rows(clips: DataFrame, clip: str) -> DataFrame:
    """Signals and intervals of clips that can't be read: (clip, signal, value, is_bool, low, high)."""
    null = lambda v: F.lit(v).cast("double")
    rows = F.array(*(F.struct(F.lit(n).alias("signal"), null(v).alias("value"), F.lit(n in BOOLEAN).alias("is_bool"), null(lo).alias("low"), null(hi).alias("high")) for n, (v, lo, hi) in CORRUPT.items()))
    return clips.select(clip, F.explode(rows).alias("x")).select(clip, "x.*")


def with_corrupt(signals: DataFrame, items: DataFrame, clip: str) -> DataFrame:
    """Signals of all ``items``: those that were measured, and the fixed ones of clips that weren't."""
    unread = items.select(clip).join(signals.select(clip).distinct(), clip, "left_anti")
    return signals.select(clip, "signal", "value", "is_bool", "low", "high").unionByName(corrupt_rows(unread, clip))


def wide(signals: DataFrame, clip: str) -> DataFrame:
    """(clip, held): a map from signal to (value, is_bool, low, high)."""
    return signals.groupBy(clip).agg(F.map_from_entries(F.collect_list(F.struct("signal", F.struct("value", "is_bool", "low", "high")))).alias("held"))
