"""Measures of grey frames: an array of whole numbers 0-255, row by row, and the frame's width.

All work on a frame's own row, of any size: nothing is exploded or shuffled. ``frame_quality`` and ``region_activity`` are expressions on arrays, for
small grids; ``measured_quality`` and ``measured_activity`` are the same on bytes, in Arrow batches, for frames of full size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def mean(gray: Column) -> Column:
    return F.aggregate(gray, F.lit(0).cast("long"), lambda acc, g: acc + g) / F.size(gray)


def entropy(gray: Column) -> Column:
    """Bits of the histogram of 256 bins. Runs of the sorted pixels are the bins."""

    def of(s: Column) -> Column:
        n = F.size(s)
        ends = F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (F.get(s, i) != F.get(s, i - 1)))
        share = lambda e, k: (F.get(e, k) - F.when(k > 0, F.get(e, k - 1)).otherwise(0)) / n
        return _let(ends, lambda e: -F.aggregate(F.transform(e, lambda _, k: share(e, k)), F.lit(0.0), lambda acc, p: acc + p * F.log2(p)))

    return _let(F.array_sort(gray), of)


def clipped_fraction(gray: Column, low: int, high: int) -> Column:
    return F.aggregate(gray, F.lit(0), lambda acc, g: acc + F.when((g <= low) | (g >= high), 1).otherwise(0)) / F.size(gray)


def laplacian(gray: Column, width: Column) -> Column:
    """Each pixel's four neighbours less four times itself; beyond an edge the pixel on its other side counts (no edge pixel twice)."""

    def of(g: Column) -> Column:
        height = (F.size(g) / width).cast("int")
        mirrored = lambda i, n: F.when(n == 1, F.lit(0)).when(i < 0, -i).when(i >= n, 2 * n - 2 - i).otherwise(i)
        at = lambda x, y: F.get(g, (mirrored(y, height) * width + mirrored(x, width)).cast("int"))

        def one(v: Column, i: Column) -> Column:
            x, y = i % width, F.floor(i / width)
            return at(x - 1, y) + at(x + 1, y) + at(x, y - 1) + at(x, y + 1) - 4 * v

        return F.transform(g, one)

    return _let(gray, of)


def variance(values: Column) -> Column:
    """Of the whole population."""

    def of(v: Column) -> Column:
        total = lambda f: F.aggregate(v, F.lit(0.0), lambda acc, x: acc + f(x.cast("double")))
        return _let(total(lambda x: x) / F.size(v), lambda m: total(lambda x: (x - m) * (x - m)) / F.size(v))

    return _let(values, of)


def frame_quality(gray: Column, width: Column, black_mean: float = 8.0, least_entropy: float = 1.0, blur: float = 80.0, clipped: float = 0.6, low: int = 5, high: int = 250) -> Column:
    """mean_luminance, entropy, laplacian_variance, clipped_fraction and the flags blackish, blurry and exposure_bad."""
    measured = F.struct(
        mean(gray).alias("mean_luminance"), entropy(gray).alias("entropy"), variance(laplacian(gray, width)).alias("laplacian_variance"),
        clipped_fraction(gray, low, high).alias("clipped_fraction"),
    )

    def flagged(q: Column) -> Column:
        numbers = [q[n].alias(n) for n in ("mean_luminance", "entropy", "laplacian_variance", "clipped_fraction")]
        black = (q["mean_luminance"] <= black_mean) | (q["entropy"] <= least_entropy)
        return F.struct(*numbers, black.alias("blackish"), (q["laplacian_variance"] < blur).alias("blurry"), (q["clipped_fraction"] >= clipped).alias("exposure_bad"))

    return _let(measured, flagged)


def _share(flags: Column, where) -> Column:
    """Share of true flags among the places (flag, i) that ``where`` names; 0 where there is none."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("on"))
    add = lambda acc, x: F.struct((acc["n"] + F.when(x["in"], 1).otherwise(0)).alias("n"), (acc["on"] + F.when(x["in"] & x["on"], 1).otherwise(0)).alias("on"))
    placed = F.transform(flags, lambda f, i: F.struct(f.alias("on"), where(i).alias("in")))
    return F.aggregate(placed, zero, add, lambda acc: F.coalesce(F.try_divide(acc["on"], acc["n"]), F.lit(0.0)))


def region_activity(residual: Column, width: Column, boxes: Column, delta: int = 12) -> Column:
    """hand and workspace: shares of pixels that changed by ``delta`` or more within any box of the grid, and in the rows below the first
    tenth and the columns between a tenth and nine tenths."""
    from tidemark.operators.boxes import in_any_box

    def of(r: Column) -> Column:
        changed = F.transform(r, lambda v: v >= delta)
        height = (F.size(r) / width).cast("int")
        x, y = (lambda i: i % width), (lambda i: F.floor(i / width))
        inner = lambda i: (y(i) >= F.floor(height * 0.1)) & (x(i) >= F.floor(width * 0.1)) & (x(i) < F.floor(width * 0.9))
        return F.struct(_share(changed, lambda i: in_any_box(x(i), y(i), boxes)).alias("hand"), _share(changed, inner).alias("workspace"))

    return _let(residual, of)


def idle_state(has_hands: Column, activity: Column, hand: float = 0.01, workspace: float = 0.005) -> Column:
    """Whether a frame is inactive: neither region reaches its threshold; null without hands, which says nothing."""
    return F.when(has_hands, (activity["hand"] < hand) & (activity["workspace"] < workspace))


_QUALITY = "struct<mean_luminance double, entropy double, laplacian_variance double, clipped_fraction double, blackish boolean, blurry boolean, exposure_bad boolean>"


def quality_of(gray: np.ndarray, black_mean: float, least_entropy: float, blur: float, clipped: float, low: int, high: int) -> tuple:
    """The values of ``frame_quality`` of one frame."""
    mean = float(gray.mean())
    share = np.bincount(gray.ravel(), minlength=256) / gray.size
    share = share[share > 0]
    entropy = float(-(share * np.log2(share)).sum())
    v = gray.astype(np.int32)
    mirrored = lambda n: (np.abs(np.arange(-1, n - 1)), (n - 1) - np.abs(n - 1 - np.arange(1, n + 1))) if n > 1 else (np.zeros(1, int),) * 2
    (up, down), (left, right) = mirrored(v.shape[0]), mirrored(v.shape[1])
    sharp = float((v[up] + v[down] + v[:, left] + v[:, right] - 4 * v).var())
    cut = float(((gray <= low) | (gray >= high)).mean())
    return mean, entropy, sharp, cut, mean <= black_mean or entropy <= least_entropy, sharp < blur, cut >= clipped


def _gray(raw: pa.Scalar, width: int | None) -> np.ndarray | None:
    if not raw.is_valid or not width or not len(data := raw.as_buffer()) or len(data) % width:
        return None
    return np.frombuffer(data, np.uint8).reshape(-1, width)


def measured_quality(gray: Column, width: Column, black_mean: float = 8.0, least_entropy: float = 1.0, blur: float = 80.0, clipped: float = 0.6, low: int = 5, high: int = 250) -> Column:
    """``frame_quality`` of whole frames, one byte a pixel, worked out on arrays in Arrow batches; null where a frame isn't whole."""
    kinds = [pa.float64()] * 4 + [pa.bool_()] * 3
    names = [x.split()[0] for x in _QUALITY[7:-1].split(", ")]

    @F.arrow_udf(_QUALITY)
    def run(frames: pa.Array, widths: pa.Array) -> pa.Array:
        out = []
        for raw, w in zip(frames, widths.to_pylist()):
            frame = _gray(raw, w)
            out.append(None if frame is None else dict(zip(names, quality_of(frame, black_mean, least_entropy, blur, clipped, low, high))))
        return pa.array(out, pa.struct(list(zip(names, kinds))))

    return run(gray, width)


def measured_activity(residual: Column, width: Column, boxes: Column, delta: int = 12) -> Column:
    """``region_activity`` of whole residual frames, one byte a pixel: struct(hand, workspace); null where a frame isn't whole."""

    @F.arrow_udf("struct<hand double, workspace double>")
    def run(frames: pa.Array, widths: pa.Array, held: pa.Array) -> pa.Array:
        out = []
        for raw, w, rows in zip(frames, widths.to_pylist(), held.to_pylist()):
            frame = _gray(raw, w)
            if frame is not None:
                changed, mask = frame >= delta, np.zeros(frame.shape, bool)
                for b in rows or []:
                    mask[max(0, b["y1"]) : max(0, b["y2"]), max(0, b["x1"]) : max(0, b["x2"])] = True
                inner = changed[int(frame.shape[0] * 0.1) :, int(w * 0.1) : int(w * 0.9)]
                frame = {"hand": float(changed[mask].mean()) if mask.any() else 0.0, "workspace": float(inner.mean()) if inner.size else 0.0}
            out.append(frame)
        return pa.array(out, pa.struct([("hand", pa.float64()), ("workspace", pa.float64())]))

    return run(residual, width, boxes)


def gray_small(height: Column, width: Column, bgr: Column, most: int = 360):
    """A column: the frame (rows of blue, green, red bytes) as a grey array of at most ``most`` columns, by means over areas: struct(width, height, gray).

    Frames go to Python in Arrow batches, as means over areas of fractional pixels are sums over two weight matrices.
    """

    def weights(n: int, m: int) -> np.ndarray:
        edges = np.linspace(0, n, m + 1)
        cover = np.minimum(edges[1:, None], np.arange(1, n + 1)) - np.maximum(edges[:-1, None], np.arange(n))
        return np.clip(cover, 0, None) * m / n

    @F.arrow_udf("struct<width int, height int, gray array<int>>")
    def run(h: pa.Array, w: pa.Array, frame: pa.Array) -> pa.Array:
        out = []
        for rows, columns, raw in zip(h.to_pylist(), w.to_pylist(), frame):
            if not raw.is_valid or not rows or not columns:
                out.append(None)
                continue
            image = np.frombuffer(raw.as_buffer(), np.uint8).reshape(rows, columns, 3).astype(float)
            to_w = min(most, columns)
            to_h = max(2, round(to_w * rows / columns))
            small = np.rint(np.einsum("ij,jkc,lk->ilc", weights(rows, to_h), image, weights(columns, to_w), optimize=True))
            gray = np.rint(small @ (0.114, 0.587, 0.299)).astype(int)
            out.append({"width": to_w, "height": to_h, "gray": gray.ravel().tolist()})
        return pa.array(out, pa.struct([("width", pa.int32()), ("height", pa.int32()), ("gray", pa.list_(pa.int32()))]))

    return run(height, width, bgr)
