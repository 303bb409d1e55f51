"""Clip statistics: fractions, quantiles, moving-block bootstrap, repetition."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.timeline import longest_run


def known_fraction(flag: Column) -> Column:
    """Share of true among known values; 0 where none is known."""
    return F.coalesce(F.avg(flag.cast("double")), F.lit(0.0))


def block_length(n: Column, block_seconds: float, rate: float) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(int(round(block_seconds * rate))), F.greatest(F.lit(1), F.floor(n / 4)))).cast("long")


def dealt(clips: DataFrame, clip: str) -> DataFrame:
    """Rows of one clip each over as many partitions as the session shuffles into: the work on a row is far more than its bytes say, by which partitions
    would be joined. By a hash of the clip, as a shuffle by the clip itself would be left out where one came before, and that one's partitions joined."""
    return clips.repartition(int(clips.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(clip))


def in_order(value: Column, order: str = "i") -> Column:
    """An aggregate: a group's known values in order, one array."""
    pairs = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(F.col(order).alias("i"), value.cast("double").alias("v")))))
    return F.transform(pairs, lambda x: x["v"])


def hash_replicates(name: Column, held: Column, block_seconds: float, rate: float, replicates: int, seed: int, statistic: str = "mean", confidence: float = 0.95) -> Column:
    """Values in order (an array) to struct(point, low, high, samples): the mean or the p95 by moving blocks whose starts are drawn from a hash of the
    clip's name; null without values.

    Replicates are worked out in Arrow batches, CHUNK_VALUES values at a time, so nothing is copied by replicate and no draw is shuffled. For the mean a
    block's sum is a difference of two prefix sums; the p95 is a selection from the replicate's values. A clip is as long as a recording: its
    array is a bounded number of samples.
    """
    tail = (1 - confidence) / 2

    @F.arrow_udf("struct<point double, low double, high double, samples array<double>>")
    def run(names: pa.Array, lengths: pa.Array, values: pa.Array) -> pa.Array:
        known = [v.is_valid and len(v) > 0 for v in values]
        bounds, drawn, at, ends = np.zeros((3, len(known))), np.empty((sum(known), replicates)), 0, {}
        for k, (name, length, v) in enumerate(zip(names.to_pylist(), lengths.to_pylist(), values)):
            if not known[k]:
                continue
            x = np.asarray(v.values)
            blocks = -(-len(x) // length)
            if blocks not in ends:  # what a draw's text ends in is the same for all clips of so many blocks
                if len(ends) == MOST_ENDS:
                    ends.clear()
                ends[blocks] = [f"{r}|{b}".encode() for r in range(replicates) for b in range(blocks)] if replicates * blocks <= CHUNK_VALUES else None
            drawn[at] = _replicates(f"{seed}|{name}|", x, length, replicates, statistic, ends[blocks])
            bounds[0, k] = x.mean() if statistic == "mean" else np.quantile(x, 0.95)
            bounds[1:, k] = np.quantile(drawn[at], [tail, 1 - tail])
            at += 1
        offsets = np.concatenate(([0], np.cumsum(known))) * replicates
        parts = [pa.array(c) for c in bounds] + [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(drawn.ravel()))]
        return pa.StructArray.from_arrays(parts, names=["point", "low", "high", "samples"], mask=pa.array([not k for k in known], pa.bool_()))

    return run(name, block_length(F.size(held), block_seconds, rate), held)


def _replicates(head: str, x: np.ndarray, length: int, replicates: int, statistic: str, ends: list[bytes] | None) -> np.ndarray:
    """The statistic of each replicate. ``ends``: the draws' texts after ``head``, where they are few enough to be kept."""
    n, blocks = len(x), -(-len(x) // length)
    sums, sizes = np.concatenate(([0.0], np.cumsum(x))), np.minimum(length, n - length * np.arange(blocks))
    copy, drawn = hashlib.sha256(head.encode()).copy, np.empty(replicates)
    step = max(1, CHUNK_VALUES // n)
    for first in range(0, replicates, step):
        rows, digests = range(first, min(first + step, replicates)), []
        for end in ends[rows.start * blocks : rows.stop * blocks] if ends else (f"{r}|{b}".encode() for r in rows for b in range(blocks)):
            h = copy()
            h.update(end)
            digests.append(h.digest())
        starts = np.frombuffer(b"".join(digests), ">u4")[::8].astype(np.int64).reshape(len(rows), blocks) % (n - length + 1)
        if statistic == "mean":
            drawn[rows.start : rows.stop] = (sums[starts + sizes] - sums[starts]).sum(1) / n
        else:
            drawn[rows.start : rows.stop] = np.quantile(x[(starts[:, :, None] + np.arange(length)).reshape(len(rows), -1)[:, :n]], 0.95, axis=1)
    return drawn


def bootstrap_by_hash(samples: DataFrame, clip: str, value: str, block_seconds: float, rate: float, replicates: int, seed: int, statistic: str = "mean", confidence: float = 0.95) -> DataFrame:
    """``hash_replicates`` of a clip's known values, in order: (clip, point, low, high, samples); clips without any are left out."""
    held = dealt(samples.where(F.col(value).isNotNull()).groupBy(clip).agg(in_order(F.col(value)).alias("held")), clip)
    b = hash_replicates(F.col(clip).cast("string"), F.col("held"), block_seconds, rate, replicates, seed, statistic, confidence)
    return held.select(clip, b.alias("b")).select(clip, "b.*")


#: What a clip's seed is combined with for each metric.
SALTS = {"hand": 0, "idle": 0xA71A5, "speed": 0x5EED5}
#: Replicates that are held as samples at once; values that draws by hash hold at once; numbers of blocks whose draws' texts are kept.
CHUNK, CHUNK_VALUES, MOST_ENDS = 64, 1 << 17, 16


def clip_seed(job: str, clip: str) -> int:
    """The first eight bytes of the SHA-256 of both, joined by a zero byte."""
    return int.from_bytes(hashlib.sha256(f"{job}\0{clip}".encode()).digest()[:8], "big")


def bootstrap(samples: DataFrame, clip: str, value: str, statistic: str, block_seconds: float, rate: float, replicates: int = 1000, confidence: float = 0.95, job: str = "", salt: int = 0) -> DataFrame:
    """Moving-block bootstrap of a clip's mean or p95 with NumPy's generator, seeded by job, clip and salt: (clip, point, low, high, samples).

    No known value: point 0, interval [0, 1] and null samples; one: the value itself. One task handles a clip, CHUNK replicates at
    a time; the draws are those of one generator in order, so that seeds give the same numbers everywhere.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("i")[value].dropna().astype(float).to_numpy()
        of = (lambda a: a.mean(-1)) if statistic == "mean" else (lambda a: np.quantile(a, 0.95, axis=-1))
        n, name = len(x), pdf[clip].iloc[0]
        if n < 2:
            point, low, high = (0.0, 0.0, 1.0) if not n else (x[0], x[0], x[0])
            drawn = np.full(replicates, x[0] if n else np.nan)
        else:
            size = max(1, min(max(1, round(block_seconds * rate)), max(1, n // 4)))
            rng = np.random.default_rng(clip_seed(job, str(name)) ^ salt)
            parts = []
            for at in range(0, replicates, CHUNK):
                starts = rng.integers(0, n - size + 1, (min(CHUNK, replicates - at), -(-n // size)))
                taken = (starts[:, :, None] + np.arange(size)).reshape(len(starts), -1)[:, :n]
                parts.append(of(x[taken]))
            drawn, point = np.concatenate(parts), of(x)
            low, high = np.quantile(drawn, [(1 - confidence) / 2, 1 - (1 - confidence) / 2])
        return pd.DataFrame({clip: [name], "point": [point], "low": [low], "high": [high], "samples": [drawn]})

    kind = samples.schema[clip].dataType.simpleString()
    return samples.select(clip, "i", F.col(value).cast("double").alias(value)).groupBy(clip).applyInPandas(run, f"{clip} {kind}, point double, low double, high double, samples array<double>")


def repetition(samples: DataFrame, clip: str, value: str, rate: float, least_period: float, most_period: float, least_seconds: float) -> DataFrame:
    """(clip, score): the largest lagged correlation of the differences of the longest known run, cut to [0, 1]. The run is one array in one row,
    and lags are slices of it."""
    run = longest_run(samples, clip, value).groupBy(clip).agg(F.array_sort(F.collect_list(F.struct("k", F.col(value).cast("double").alias("v")))).alias("held"))
    steps = run.select(clip, F.transform("held", lambda x: x["v"]).alias("v")).select(clip, F.zip_with(F.slice("v", F.lit(2), F.greatest(F.size("v") - 1, F.lit(0))), F.slice("v", F.lit(1), F.greatest(F.size("v") - 1, F.lit(0))), lambda b, a: b - a).alias("d"))
    total = lambda a, f: F.aggregate(a, F.lit(0.0), lambda acc, x: acc + f(x))
    n = F.size("d")
    sized = steps.where((n >= 3) & (n + 1 >= max(4, round(least_seconds * rate)))).withColumn("m", total("d", lambda x: x) / n).withColumn("sd", F.sqrt(total("d", lambda x: (x - F.col("m")) * (x - F.col("m"))) / n))
    z = sized.where("sd > 1e-9").select(clip, F.transform("d", lambda x: (x - F.col("m")) / F.col("sd")).alias("z"))
    lags = F.array(*(F.lit(k) for k in range(max(1, round(least_period * rate)), round(most_period * rate) + 1)))

    def correlation(lag: Column) -> Column:
        overlap = F.size("z") - lag
        products = F.zip_with(F.slice("z", F.lit(1), F.greatest(overlap, F.lit(0))), F.slice("z", lag + 1, F.greatest(overlap, F.lit(0))), lambda a, b: a * b)
        return F.when(overlap >= F.greatest(F.lit(12), lag), total(products, lambda x: x) / overlap)

    scores = z.select(clip, F.array_max(F.transform(lags, correlation)).alias("r"))
    return samples.select(clip).distinct().join(scores, clip, "left").select(clip, F.coalesce(F.least(F.lit(1.0), F.greatest(F.lit(0.0), "r")), F.lit(0.0)).alias("score"))
