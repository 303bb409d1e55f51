"""Clips of raw video (``.y4m``): what a file holds, and its frames at a fixed rate.

A probe reads a file's first line. Frames are dealt out in ranges of RANGE, each planned from the probe and read by whichever task gets it, so that one
long clip is read by many; a task seeks to the frames that it returns and reads nothing else. Frames of other containers need a decoder that isn't
here: a table of frames (path, sample, t, width, height, luma) from elsewhere takes the place of these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio
from tidemark.sources.media import MARK, Ranges, frame_bytes, probed_clips

RANGE = 256
SCHEMA = "path string, sample int, t double, width int, height int, luma binary"
_COLOUR = f"{SCHEMA}, bgr binary"


def probe(spark: SparkSession, path: str) -> DataFrame:
    """Files below a path with what their index or header says (``media.INFO``) and ``valid``. The listing is all that Spark reads of them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return probed_clips(files.select("path", "length"))


def probed(files: DataFrame) -> DataFrame:
    """files(path, length, head) of raw video by the text of their first bytes and their lengths."""
    line = F.regexp_extract("head", r"^(YUV4MPEG2[^\n]*)\n", 1)
    part = lambda letter: F.regexp_extract(line, rf" {letter}([^ \n]+)", 1)
    number = lambda c: F.coalesce(c.try_cast("int"), F.lit(0))
    out = files.select("path", "length", line.alias("line"), number(part("W")).alias("width"), number(part("H")).alias("height"), ratio(F.replace(part("F"), F.lit(":"), F.lit("/"))).alias("fps"))
    body = F.col("length") - F.length("line") - 1
    count = F.when((F.col("width") > 0) & (F.col("height") > 0), F.floor(body / (len(MARK) + _frame_bytes(F.col("width"), F.col("height"))))).otherwise(0)
    out = out.withColumn("frame_count", count.cast("long")).withColumn("duration_seconds", F.coalesce(F.try_divide("frame_count", "fps"), F.lit(0.0)))
    return out.withColumn("valid", (F.col("width") > 0) & (F.col("height") > 0) & (F.col("duration_seconds") > 0)).drop("length", "line")


def _frame_bytes(width: Column, height: Column) -> Column:
    half = lambda v: F.floor((v + 1) / 2)
    return width * height + 2 * half(width) * half(height)


def area_weights(n: int, m: int) -> np.ndarray:
    """m by n: the share that each of n pixels has in each of m means over equal areas."""
    edges = np.linspace(0, n, m + 1)
    cover = np.minimum(edges[1:, None], np.arange(1, n + 1)) - np.maximum(edges[:-1, None], np.arange(n))
    return np.clip(cover, 0, None) * m / n


def _colour(luma: np.ndarray, chroma: bytes) -> np.ndarray:
    """Blue, green, red of studio-range BT.601 with chroma of half the size."""
    height, width = luma.shape
    half_h, half_w = (height + 1) // 2, (width + 1) // 2
    u, v = (np.repeat(np.repeat(p, 2, 0), 2, 1)[:height, :width] - 128.0 for p in np.frombuffer(chroma, np.uint8).reshape(2, half_h, half_w))
    y = 1.164 * (luma - 16.0)
    return np.stack((y + 2.017 * u, y - 0.392 * u - 0.813 * v, y + 1.596 * v), 2)


def _read(most_width: int | None, colour: bool):
    def small(image: np.ndarray, width: int, height: int) -> bytes:
        if image.shape[:2] != (height, width):
            rows, columns = area_weights(image.shape[0], height), area_weights(image.shape[1], width)
            image = np.einsum("ij,jk...,lk->il...", rows, image, columns, optimize=True)
        return np.clip(np.rint(image), 0, 255).astype(np.uint8).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                width, height = r["width"], r["height"]
                size = len(MARK) + frame_bytes(width, height)
                to_w = min(most_width or width, width)
                to_h = max(1, round(to_w * height / width)) if to_w < width else height
                rows = []
                with Ranges(r["path"]) as file:
                    for k in range(r["first"], r["last"]):
                        at = min(r["frame_count"] - 1, round(k * r["fps"] / r["rate"]))
                        raw = file.at(r["header_bytes"] + at * size, size if colour else len(MARK) + width * height)
                        if raw[: len(MARK)] != MARK or len(raw) < len(MARK) + width * height:
                            raise ValueError(f"{r['path']}: no whole frame {at}")
                        luma = np.frombuffer(raw, np.uint8, width * height, len(MARK)).reshape(height, width)
                        row = [r["path"], k, k / r["rate"], to_w, to_h, small(luma, to_w, to_h)]
                        rows.append(row + [small(_colour(luma, raw[len(MARK) + width * height :]), to_w, to_h)] if colour else row)
                        if len(rows) * to_w * to_h > 1 << 23:
                            yield _batch(rows, colour)
                            rows = []
                if rows:
                    yield _batch(rows, colour)

    return run


def _batch(rows: list[list], colour: bool) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()][: 6 + colour]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["path", "sample", "t", "width", "height", "luma", "bgr"][: 6 + colour])


def sampled_frames(clips: DataFrame, fps: float, most_width: int | None = None, colour: bool = False) -> DataFrame:
    """clips as ``probe`` has them to frames at ``fps`` or the clip's own rate if that is lower: SCHEMA, with ``bgr`` if ``colour``. Frames are
    scaled to ``most_width`` columns at most, by means over areas. What isn't whole raw video fails the query."""
    whole = (F.col("container") == "y4m") & F.col("valid") & ((F.col("length") - F.col("header_bytes")) % (len(MARK) + _frame_bytes(F.col("width"), F.col("height"))) == 0)
    said = F.concat(F.col("path"), F.lit(" isn't a clip of whole raw frames"))
    kept = clips.withColumn("length", F.when(F.coalesce(whole, F.lit(False)), F.col("length")).otherwise(F.raise_error(said).cast("long"))).where("length > 0")
    rate = F.least(F.lit(float(fps)), F.col("fps"))
    samples = F.greatest(F.lit(1), F.ceil(F.floor(F.col("frame_count") * rate * 1000) / F.floor(F.col("fps") * 1000)))
    ranges = kept.select("path", "width", "height", "fps", "frame_count", "header_bytes", rate.alias("rate"), samples.alias("samples"))
    ranges = ranges.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("samples") - 1, F.lit(RANGE).cast("long")))).withColumn("last", F.least(F.col("first") + RANGE, "samples"))
    return ranges.repartition("path", "first").mapInArrow(_read(most_width, colour), _COLOUR if colour else SCHEMA)


def read_frames(spark: SparkSession, paths: list[str], fps: float, most_width: int | None = None, colour: bool = False) -> DataFrame:
    """``sampled_frames`` of these files."""
    files = spark.read.format("binaryFile").load(paths).select("path", "length")
    return sampled_frames(probed_clips(files), fps, most_width, colour)
