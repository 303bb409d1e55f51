"""Detection boxes of frames: structs of x1, y1, x2, y2 and a score, as expressions on columns and on a frame's array of boxes.

Nothing here shuffles. A frame's boxes are one array, as detectors give a bounded number for each frame.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import iou

_MATCHES = "array<struct<iou:double,score_delta:double>>"


def _box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def expanded(box: Column, share: float, scale_x: float, scale_y: float, width: int, height: int) -> Column:
    """The box grown by ``share`` of its sides at each side, scaled to a grid, clipped to it and truncated to whole numbers."""
    dx, dy = (box["x2"] - box["x1"]) * share, (box["y2"] - box["y1"]) * share
    low = lambda v: F.greatest(F.lit(0.0), v).cast("int")
    high = lambda v, most: F.least(F.lit(float(most)), v).cast("int")
    return _box(low((box["x1"] - dx) * scale_x), low((box["y1"] - dy) * scale_y), high((box["x2"] + dx) * scale_x, width), high((box["y2"] + dy) * scale_y, height))


def unscaled(box: Column, ratio: float, width: Column, height: Column) -> Column:
    """A box of the detector's input back on the frame that was scaled by ``ratio``, clipped to it."""
    clip = lambda v, most: F.least(F.greatest(v / ratio, F.lit(0.0)), most.cast("double"))
    return _box(clip(box["x1"], width), clip(box["y1"], height), clip(box["x2"], width), clip(box["y2"], height))


def tiles(width: Column, height: Column, overlap: float) -> Column:
    """Four corner tiles (x, y, w, h) that overlap in the middle; sizes are rounded half to even."""
    w, h = (F.least(v, F.bround(v * (0.5 + overlap / 2.0)).cast("int")) for v in (width, height))
    tile = lambda x, y: F.struct(x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h"))
    return F.array(*(tile(x, y) for y in (F.lit(0), height - h) for x in (F.lit(0), width - w)))


def on_frame(box: Column, tile: Column) -> Column:
    """A tile's box in its frame's coordinates."""
    return _box(box["x1"] + tile["x"], box["y1"] + tile["y"], box["x2"] + tile["x"], box["y2"] + tile["y"])


def greedy_matches(old: Column, new: Column) -> Column:
    """Each old box, in order, takes the box of best IoU among the new ones that are left; the first of equals. Boxes carry a score."""

    def take(state: Column, box: Column) -> Column:
        left = state["left"]
        ious = F.transform(left, lambda c: iou(box, c, 0))
        at = F.array_position(ious, F.array_max(ious)).cast("int") - 1
        match = F.struct(F.get(ious, at).alias("iou"), F.abs(box["score"] - F.get(left, at)["score"]).alias("score_delta"))
        after = F.struct(F.filter(left, lambda _, i: i != at).alias("left"), F.concat(state["matches"], F.array(match)).cast(_MATCHES).alias("matches"))
        return F.when(F.size(left) == 0, state).otherwise(after)

    return F.aggregate(old, F.struct(new.alias("left"), F.array().cast(_MATCHES).alias("matches")), take, lambda s: s["matches"])


def parity(frames: DataFrame, least_iou: float, most_delta: float) -> DataFrame:
    """frames(count_match, matches) to one row: how far two detectors agree, and whether that passes."""
    all_of = lambda f: F.aggregate("matches", F.lit(None).cast("double"), f)
    per_frame = frames.select(
        F.col("count_match").cast("int").alias("same"), F.size("matches").cast("long").alias("k"),
        all_of(lambda acc, m: F.least(acc, m["iou"])).alias("low"), all_of(lambda acc, m: F.greatest(acc, m["score_delta"])).alias("delta"),
        F.aggregate("matches", F.lit(0.0), lambda acc, m: acc + m["iou"]).alias("total"),
    )
    out = per_frame.agg(
        F.count("*").alias("frames"), F.avg("same").alias("count_match_fraction"), F.coalesce(F.sum("k"), F.lit(0)).alias("matched_boxes"),
        F.coalesce(F.min("low"), F.lit(1.0)).alias("min_iou"), F.coalesce(F.try_divide(F.sum("total"), F.sum("k")), F.lit(1.0)).alias("mean_iou"),
        F.coalesce(F.max("delta"), F.lit(0.0)).alias("max_score_delta"),
    )
    good = (F.col("count_match_fraction") == 1) & (F.col("min_iou") >= least_iou) & (F.col("max_score_delta") <= most_delta)
    return out.withColumn("passed", F.coalesce(good, F.lit(False)))


def confident(detections: Column, least: float) -> Column:
    return F.filter(detections, lambda d: d["score"] >= least)


def anchors(width: int, height: int, strides: tuple[int, ...] = (8, 16, 32)) -> list[tuple[int, int, int]]:
    """(x, y, stride) of a detector's grid cells in the order of its output rows: by stride, row and column."""
    return [(x, y, s) for s in strides for y in range(height // s) for x in range(width // s)]


def decoded(rows: Column, grid: list[tuple[int, int, int]], ratio: Column) -> Column:
    """A detector's encoded output rows (cx, cy, w, h, objectness, class scores ...) of each grid cell to boxes on the frame, with the best class and its
    score; the first of equal classes. The grid is one constant array of numbers, which the optimiser works out once, so that no row is joined or shuffled."""
    cells = F.from_json(F.lit(json.dumps(grid)), "array<array<double>>")

    def box(p: Column, at: Column) -> Column:
        cx, cy = (p[0] + at[0]) * at[2], (p[1] + at[1]) * at[2]
        w, h = F.exp(p[2]) * at[2], F.exp(p[3]) * at[2]
        scores = F.transform(F.slice(p, F.lit(6), F.size(p) - 5), lambda c: c * p[4])
        best = F.array_max(scores)
        corners = ((cx - w / 2, "x1"), (cy - h / 2, "y1"), (cx + w / 2, "x2"), (cy + h / 2, "y2"))
        return F.struct(*((v / ratio).alias(n) for v, n in corners), best.alias("score"), (F.array_position(scores, best) - 1).cast("int").alias("class_id"))

    return F.zip_with(rows, cells, box)


def end_to_end(rows: Column, ratio: Column) -> Column:
    """Output rows of (x1, y1, x2, y2, score) to boxes on the frame, all of class 0."""
    return F.transform(rows, lambda p: F.struct(*((p[i] / ratio).alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))), p[4].alias("score"), F.lit(0).alias("class_id")))


def suppressed_by_class(detections: Column, threshold: float) -> Column:
    """Greedy suppression within each class, best first (the later of equals); what is kept, best first over all classes."""
    key = lambda d, i: F.struct((-d["score"]).alias("s"), (-i).alias("i"), d.alias("d"))
    ranked = F.transform(F.array_sort(F.transform(detections, key)), lambda x: x["d"])
    rival = lambda kept, d: F.exists(kept, lambda k: (k["class_id"] == d["class_id"]) & (iou(k, d) > threshold))
    return F.aggregate(ranked, F.filter(detections, lambda _: F.lit(False)), lambda kept, d: F.when(rival(kept, d), kept).otherwise(F.concat(kept, F.array(d))))


def clipped_detections(detections: Column, width: Column, height: Column) -> Column:
    clip = lambda v, most: F.least(F.greatest(v, F.lit(0.0)), most.cast("double"))
    sides = (("x1", width), ("y1", height), ("x2", width), ("y2", height))
    return F.transform(detections, lambda d: F.struct(*(clip(d[n], most).alias(n) for n, most in sides), d["score"].alias("score"), d["class_id"].alias("class_id")))


def merged_with_tiles(full: Column, tiled: Column, threshold: float) -> Column:
    """A frame's detections and, where it has none, those of its tiles, then suppressed once over all classes. Each frame by itself."""
    from tidemark.functions.columns import suppressed

    return F.when(F.size(full) > 0, full).otherwise(suppressed(tiled, threshold))


def in_any_box(x: Column, y: Column, held: Column) -> Column:
    """Whether a grid point lies in one of the boxes; left and top edges belong to a box, right and bottom ones don't."""
    return F.exists(held, lambda b: (x >= b["x1"]) & (x < b["x2"]) & (y >= b["y1"]) & (y < b["y2"]))
