"""Queries on motion. An embedding draws a picture of 64 waves; the next frame shows it after a turn and shift that its id decides, with a patch
that moves besides, so SQL knows what must be found."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.operators import motion
from tidemark.plans.gate import query
from tidemark.plans.tables import read, spread

WIDTH, HEIGHT, STEP = 160, 120, 0.5
#: Where the patch is on the first frame.
PATCH = (48, 30, 112, 86)


def _picture(waves: np.ndarray, turn: complex, shift: complex) -> np.ndarray:
    """The picture at turn * z + shift for a frame's places z. A wave of a row's and a column's part is two products of theirs, so all waves are one product of matrices."""
    k = np.arange(len(waves))
    across, along = 0.12 + 0.09 * (k % 8), 0.11 * (k // 8) - 0.38
    waves = waves / max(float(np.sqrt((waves**2).sum())), 1e-9)
    x = np.outer(across * turn.real + along * turn.imag, np.arange(WIDTH)).astype(np.float32)
    y = (np.outer(np.arange(HEIGHT), along * turn.real - across * turn.imag) + (across * shift.real + along * shift.imag + k * k % 7)).astype(np.float32)
    waves = waves.astype(np.float32)
    value = np.hstack((waves * np.sin(y), waves * np.cos(y))) @ np.vstack((np.cos(x), np.sin(x)))
    return np.clip(np.rint(128 + 55 * value), 0, 255).astype(np.uint8)


def _drawn(waves: pa.Array, dx: pa.Array, dy: pa.Array, degrees: pa.Array, besides: pa.Array) -> pa.Array:
    out = []
    for e, right, down, turn, more in zip(waves.to_pylist(), dx.to_pylist(), dy.to_pylist(), degrees.to_pylist(), besides.to_pylist()):
        e, back = np.array(e, float), complex(np.exp(-1j * np.radians(turn)))
        before = _picture(e, 1 + 0j, 0j)
        after = _picture(e, back, -complex(right, down) * back)
        left, top, end, bottom = PATCH
        patch = _picture(e[::-1], 0.5 + 0j, 0j)[top:bottom, left:end]
        before[top:bottom, left:end] = patch
        # the camera takes the patch along, by its middle, and it moves by ``more`` to the right
        middle = complex((left + end) / 2, (top + bottom) / 2)
        to = middle * np.exp(1j * np.radians(turn)) + complex(right + more, down) - middle
        ox, oy = round(to.real), round(to.imag)
        after[top + oy : bottom + oy, left + ox : end + ox] = patch
        out.append({"before": before.tobytes(), "after": after.tobytes()})
    return pa.array(out, pa.struct([("before", pa.binary()), ("after", pa.binary())]))


def _drawn_by_few(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """Of a batch of narrow rows a few are drawn at a time: 10,000 pairs of frames at once are 400 MB and more on the way."""
    for columns in batches:
        for first in range(0, len(columns[0]), motion.PAIRS):
            yield _drawn(*(c.slice(first, motion.PAIRS) for c in columns))


def _pairs(spark, sf_dir, degrees):
    k = F.col("vec_id")
    planted = (k % 7 - 3, k % 5 - 2, degrees, k % 3 + 4)
    frames = F.arrow_udf(_drawn_by_few, "struct<before binary, after binary>")
    vectors = spread(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id")
    drawn = vectors.select("vec_id", frames("embedding", *(c.cast("double") for c in planted)).alias("f"))
    frames = drawn.select("vec_id", F.posexplode(F.array("f.before", "f.after")).alias("sample", "gray"))
    frames = frames.withColumns({"t": F.col("sample") * STEP, "width": F.lit(WIDTH)})
    return motion.paired(frames, "vec_id", STEP).where("previous_gray is not null")


#: A pair's frames, their widths and the time between them, as the operators take them.
PAIR = ("previous_gray", "previous_width", "gray", "width", "dt")


@query("SELECT vec_id, vec_id % 7 - 3 AS dx, vec_id % 5 - 2 AS dy, vec_id % 3 - 1 AS degrees, 2 * abs(vec_id % 3 - 1) AS rotation FROM embeddings")
def v03_stabilised_motion(spark, sf_dir):
    """Camera motion found between two frames, to the pixel and degree; the patch and what it covers aren't the camera's."""
    m = _pairs(spark, sf_dir, F.col("vec_id") % 3 - 1).select("vec_id", motion.camera_motion(*map(F.col, PAIR)).alias("m"))
    whole = lambda c: F.round(c).cast("long").alias(c.split(".")[1])
    return m.select("vec_id", whole("m.dx"), whole("m.dy"), whole("m.degrees"), whole("m.rotation"))


@query("SELECT vec_id, vec_id % 4 <> 0 AS seen, CASE WHEN vec_id % 4 <> 0 THEN true END AS moved, CASE WHEN vec_id % 4 <> 0 THEN false END AS inactive FROM embeddings")
def v04_hand_speed(spark, sf_dir):
    """Speed of a patch that moves besides the camera, where a box says that it is a hand: at least what was planted, as the quantile of the
    corners' speeds also has those at the patch's edge, which are followed less well."""
    left, top, right, bottom = PATCH
    k = F.col("vec_id")
    sides = zip(("x1", "y1", "x2", "y2"), (left + 15 + k % 7 - 3, top + 12 + k % 5 - 2, right - 9 + k % 7 - 3, bottom - 12 + k % 5 - 2))
    held = F.when(k % 4 != 0, F.array(F.struct(*(c.cast("double").alias(n) for n, c in sides))))
    seen = _pairs(spark, sf_dir, F.lit(0)).select("vec_id", motion.hand_activity(*map(F.col, PAIR), held, F.lit(HEIGHT), F.lit(WIDTH), expansion=0.0).alias("o"))
    pixels = F.col("o.speed") * STEP * float(np.hypot(WIDTH, HEIGHT))
    return seen.select("vec_id", F.col("o.inactive").isNotNull().alias("seen"), (pixels >= k % 3 + 3.5).alias("moved"), F.col("o.inactive").alias("inactive"))
