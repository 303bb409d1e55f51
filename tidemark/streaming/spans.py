"""Spans of a clip's timeline as its samples arrive: windowed conditions and runs, with a clip's open span as state.

The results are those of ``timeline.covered_spans`` and ``timeline.qualified_runs``. A clip keeps what can still change: the flags of the last window, or
one open run. A span is given out when no later sample can change it: when one breaks it, or by a timer, when the watermark is
``quiet`` past a clip's last sample. The watermark's delay must cover how far clips
are behind each other, as Spark drops what is older. Samples of a clip must arrive in the order of ``i`` over batches (within one they are sorted); one that comes after a
later one was taken, or after the clip was closed, changes nothing and is given out as ``late``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SPANS = "clip string, kind string, start_seconds double, end_seconds double, n_samples long"
_COLUMNS = ["clip", "kind", "start_seconds", "end_seconds", "n_samples"]
#: The state store that timers need.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Spans(StatefulProcessor):
    def __init__(self, quiet_ms: int):
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("clip", "held string")

    def _held(self) -> dict:
        return json.loads(self.state.get()[0]) if self.state.exists() else {"next": -1, "closed": False} | self.empty()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held, out = self._held(), []
        for s in pd.concat(list(rows)).sort_values("i").itertuples():
            if held["closed"] or s.i < held["next"]:
                out.append(("late", s.t, s.t, 1))
                continue
            held["next"] = int(s.i) + 1
            out += self.take(held, int(s.i), float(s.t), None if pd.isna(s.value) else bool(s.value))
            held["until"] = max(held.get("until", 0), int(s.ms))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if not held["closed"]:
            self.handle.registerTimer(held["until"] + self.quiet_ms)
        self.state.update((json.dumps(held),))
        yield self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = self._held()
        out = self.end(held)
        self.state.update((json.dumps({"next": held["next"], "closed": True} | self.empty()),))
        yield self._frame(key, out)

    @staticmethod
    def _frame(key: tuple, out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *r) for r in out], columns=_COLUMNS)

    def close(self) -> None:
        pass


class CoveredSpans(_Spans):
    """Samples that lie in a full window of ``window`` samples of which ``share`` or more have the flag."""

    def __init__(self, window: int, share: float, step: float, quiet_ms: int):
        super().__init__(quiet_ms)
        self.window, self.share, self.step = window, share, step

    def empty(self) -> dict:
        return {"n": 0, "ring": [], "open": None}  # ring: (time, flag) of the last window; open: first and last sample and their times

    def take(self, held: dict, i: int, t: float, value: bool | None) -> list[tuple]:
        out, ring, at = [], held["ring"], held["n"]
        held["n"] += 1
        ring.append((t, value))
        del ring[: -self.window]
        first, known = at - self.window + 1, [f for _, f in ring if f is not None]
        span = held["open"]
        if len(ring) == self.window and known and sum(known) / len(known) >= self.share:
            if span and first <= span[1] + 1:
                held["open"] = [span[0], at, span[2], t]
            else:
                out += self.end(held)
                held["open"] = [first, at, ring[0][0], t]
        elif span and first > span[1]:
            out += self.end(held)
        return out

    def end(self, held: dict) -> list[tuple]:
        span, held["open"] = held["open"], None
        return [("covered", span[2], span[3] + self.step, span[1] - span[0] + 1)] if span else []


class QualifiedRuns(_Spans):
    """Unbroken runs of true that last ``least_seconds``; a run ends one first step of its clip after its last sample."""

    def __init__(self, least_seconds: float, quiet_ms: int):
        super().__init__(quiet_ms)
        self.least = least_seconds

    def empty(self) -> dict:
        return {"times": [], "open": None}  # the clip's first two times; open: first and last time and the number of samples

    def take(self, held: dict, i: int, t: float, value: bool | None) -> list[tuple]:
        out = []
        if value:
            run = held["open"] or [t, t, 0]
            held["open"] = [run[0], t, run[2] + 1]
        else:
            out = self.end(held) if len(held["times"]) > 1 or not held["open"] else self.end(held, t)
        if len(held["times"]) < 2:
            held["times"].append(t)
        return out

    def end(self, held: dict, second: float | None = None) -> list[tuple]:
        run, held["open"] = held["open"], None
        if not run:
            return []
        times = held["times"] + ([second] if second is not None else [])
        to = run[1] + (times[1] - times[0] if len(times) > 1 else self.least)
        return [("idle", run[0], to, run[2])] if to - run[0] >= self.least else []


def _spans(samples: DataFrame, clip: str, value: str, time: str, processor: _Spans) -> DataFrame:
    """samples with a watermark on ``time``, i and t, to SPANS."""
    key, value_ = F.col(clip).cast("string").alias("clip"), F.col(value).cast("boolean").alias("value")
    rows = samples.select(key, F.col("i").cast("long").alias("i"), F.col("t").cast("double").alias("t"), value_, F.unix_millis(time).alias("ms"), time)
    return rows.groupBy("clip").transformWithStateInPandas(processor, SPANS, "append", "eventTime")


def covered_spans(samples: DataFrame, clip: str, flag: str, time: str, window: int, share: float, step: float, quiet_seconds: float) -> DataFrame:
    return _spans(samples, clip, flag, time, CoveredSpans(window, share, step, round(quiet_seconds * 1000)))


def qualified_runs(samples: DataFrame, clip: str, state: str, time: str, least_seconds: float, quiet_seconds: float) -> DataFrame:
    return _spans(samples, clip, state, time, QualifiedRuns(least_seconds, round(quiet_seconds * 1000)))
