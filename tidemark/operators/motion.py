"""Motion between two frames of a clip: what the camera did, what moved besides, and how fast hands were.

Frames are grey, one byte a pixel, row by row. A pair of frames is one row, so work is spread by rows whatever clip they are of; a function
takes pairs in Arrow batches and works on each with arrays. Nothing is compiled or bound to a vision library.

The camera's motion is a similarity (turn, scale and shift) that most tracked corners agree on: corners of the earlier frame
by the smaller eigenvalue of their gradients' covariance, followed through an image pyramid by least squares on windows. What
remains when the earlier frame is warped by it is the residual.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Corners (how many, least share of the best score, distance, window of the covariance), inlier distance, corners that a
#: motion needs, least side of a region and least response of its correlation, quantile of speeds.
MOST_CORNERS, CORNER_QUALITY, CORNER_DISTANCE, CORNER_WINDOW = 200, 0.01, 8, 5
INLIER_PIXELS, LEAST_TRACKED = 3.0, 6
LEAST_SIDE, LEAST_RESPONSE, SPEED_QUANTILE = 8, 0.01, 0.95
#: Share of the squares that a correlation's peak leaves under which another shift takes its place.
MATCH_SHARE = 0.25
#: Window, levels above the whole image, steps and least step of the tracker; pairs of corners that motions are tried from.
WINDOW, LEVELS, STEPS, LEAST_STEP, TRIES = 21, 3, 30, 0.01, 400
#: Sides of the block of pixels between which a window's values are, and how long a window is whose rows are as far apart.
SIDE, LONG = WINDOW + 1, WINDOW * (WINDOW + 1) - 1
#: Points whose windows are made at once, so that they stay in the processor's cache.
POINTS = 128
#: How far a motion may turn or scale before its windows are followed again.
LEAST_TURN = 0.01
#: Frames of a clip in one piece of ``paired``.
PIECE = 256
#: Pairs whose motion, with the frames that it holds, a task keeps at once; those of them that are followed together.
PAIRS, TOGETHER = 32, 16


def _sampled(image: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Values between pixels, bilinear; outside, the nearest edge pixel's."""
    h, w = image.shape
    x, y = np.clip(x, 0, w - 1), np.clip(y, 0, h - 1)
    left, top = np.minimum(x.astype(np.intp), max(w - 2, 0)), np.minimum(y.astype(np.intp), max(h - 2, 0))
    fx, fy, flat = x - left, y - top, image.ravel()
    at, right, down = top * w + left, int(w > 1), w * int(h > 1)
    upper = flat[at] * (1 - fx) + flat[at + right] * fx
    return upper * (1 - fy) + (flat[at + down] * (1 - fx) + flat[at + down + right] * fx) * fy


def _padded(images: np.ndarray, reach: int | tuple[int, int], mode: str, **more: float) -> np.ndarray:
    up, across = reach if isinstance(reach, tuple) else (reach, reach)
    return np.pad(images, ((0, 0), (up, up), (across, across)), mode, **more)


def _blocks(images: np.ndarray) -> np.ndarray:
    """A view of all blocks of SIDE by SIDE pixels of images that their edge pixels go on around; see ``_taken``."""
    return np.lib.stride_tricks.sliding_window_view(_padded(images, WINDOW, "edge"), (SIDE, SIDE), (1, 2))


def _taken(blocks: np.ndarray, of: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The block around each whole point in image ``of``, one row a point. Beyond WINDOW // 2 + 1 from an image all pixels are its edge's, wherever a point is."""
    half = WINDOW // 2
    most = np.array(blocks.shape[2:0:-1]) - WINDOW + half - 1
    x, y = (np.minimum(np.maximum(low, -half - 1), most).astype(np.intp) + (WINDOW - half)).T
    return blocks[of, y, x].reshape(len(low), SIDE * SIDE)


def _windows(blocks: np.ndarray, of: np.ndarray, at: np.ndarray) -> np.ndarray:
    """WINDOW by WINDOW values around each point, one row a point; rows of a window are SIDE apart, and what is between them has no meaning. A window's places
    share their fractions, so whole pixels are taken once."""
    low = np.floor(at)
    taken, fractions = _taken(blocks, of, low), (at - low).astype(np.float32)
    if not fractions.any():
        return taken[:, :LONG]
    fx, fy = fractions.T[:, :, None]
    across = taken[:, :-1] * (1 - fx)
    across += taken[:, 1:] * fx
    out = across[:, :LONG] * (1 - fy)
    out += across[:, SIDE:] * fy
    return out


def _smoothed(images: np.ndarray, taps: tuple[float, ...], every: int = 1) -> np.ndarray:
    """Both ways by the same odd filter, at each ``every``-th pixel; edges mirror without their own pixel."""
    reach = len(taps) // 2
    for axis in (1, 2):
        n = images.shape[axis]
        wide = _padded(images, (reach, 0) if axis == 1 else (0, reach), "reflect" if n > reach else "edge")
        images = sum(t * (wide[:, k : k + n : every] if axis == 1 else wide[:, :, k : k + n : every]) for k, t in enumerate(taps))
    return images


def _gradients(images: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = _padded(images, 1, "edge")
    across = (wide[:, :, 2:] - wide[:, :, :-2]) / 2
    along = (wide[:, 2:, :] - wide[:, :-2, :]) / 2
    # smoothed the other way, by 3-10-3 sixteenths, which keeps directions true
    return 0.1875 * across[:, :-2] + 0.625 * across[:, 1:-1] + 0.1875 * across[:, 2:], 0.1875 * along[:, :, :-2] + 0.625 * along[:, :, 1:-1] + 0.1875 * along[:, :, 2:]


def corners(images: np.ndarray) -> list[np.ndarray]:
    """Of each image up to MOST_CORNERS points (x, y), best first, CORNER_DISTANCE apart at least."""
    gx, gy = _gradients(images)
    box = (1.0 / CORNER_WINDOW,) * CORNER_WINDOW
    xx, yy, xy = _smoothed(gx * gx, box), _smoothed(gy * gy, box), _smoothed(gx * gy, box)
    scores = (xx + yy) / 2 - np.sqrt(((xx - yy) / 2) ** 2 + xy * xy)
    around = _padded(scores, 1, "constant", constant_values=-np.inf)
    around = np.maximum(np.maximum(around[:, :-2], around[:, 1:-1]), around[:, 2:])
    around = np.maximum(np.maximum(around[:, :, :-2], around[:, :, 1:-1]), around[:, :, 2:])
    reach = np.arange(-CORNER_DISTANCE + 1, CORNER_DISTANCE)
    disk = reach[:, None] ** 2 + reach**2 < CORNER_DISTANCE**2
    found = []
    for score, highest in zip(scores, around):
        ys, xs = np.nonzero((score >= highest) & (score > max(CORNER_QUALITY * score.max(), 1e-9)))
        order = np.argsort(-score[ys, xs], kind="stable")
        taken, out = np.zeros((score.shape[0] + 2 * CORNER_DISTANCE, score.shape[1] + 2 * CORNER_DISTANCE), bool), []
        for x, y in zip(xs[order].tolist(), ys[order].tolist()):
            if not taken[y + CORNER_DISTANCE, x + CORNER_DISTANCE]:
                out.append((x, y))
                if len(out) == MOST_CORNERS:
                    break
                taken[y + 1 : y + 2 * CORNER_DISTANCE, x + 1 : x + 2 * CORNER_DISTANCE] |= disk
        found.append(np.array(out, float).reshape(-1, 2))
    return found


def tracked(previous: np.ndarray, current: np.ndarray, points: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Where points of each earlier image are in the later one, and which of them were followed. Points of all pairs take their steps together.

    A step is the product of a window's gradients with what it differs from. Between four pixels that is bilinear in the place, so it is worked out at
    the four and again only when a point leaves them: most steps take a few numbers a point.
    """
    pyramid = [(previous, current)]
    while len(pyramid) <= LEVELS and min(pyramid[-1][0].shape[1:]) >= 2 * WINDOW:
        pyramid.append(tuple(_smoothed(i, (0.0625, 0.25, 0.375, 0.25, 0.0625), 2) for i in pyramid[-1]))
    start, of = np.concatenate(points), np.repeat(np.arange(len(points)), [len(p) for p in points])
    n = len(start)
    moved, good = np.zeros_like(start), np.ones(n, bool)
    slopes, middle, own = np.empty((n, 2, LONG), np.float32), np.empty((n, 1), np.float32), np.empty((n, 2))
    for level in range(len(pyramid) - 1, -1, -1):
        before, after = pyramid[level]
        at = start / 2**level
        moved *= 2 if level < len(pyramid) - 1 else 1
        blocks, (across, along) = _blocks(after), map(_blocks, _gradients(before))
        before = _blocks(before)
        for first in range(0, n, POINTS):
            k = slice(first, first + POINTS)
            window, slopes[k, 0], slopes[k, 1] = (_windows(b, of[k], at[k]) for b in (before, across, along))
            slopes[k, :, WINDOW::SIDE] = 0
            middle[k] = window.mean(1, keepdims=True)  # taken off both sides, so that products are small
            own[k] = np.vecdot(slopes[k], (window - middle[k])[:, None])
        xx, xy, yy = (np.vecdot(slopes[:, i], slopes[:, j]).astype(float) for i, j in ((0, 0), (0, 1), (1, 1)))
        flat = (xx + yy) / 2 - np.sqrt(((xx - yy) / 2) ** 2 + xy * xy) < 1e-4 * WINDOW**2
        if level == 0:
            good &= ~flat
        solved = np.stack((yy, xy, xx)) / np.where(flat, 1.0, xx * yy - xy * xy)
        open_, cell = ~flat, np.full((n, 2), np.nan)
        parts = np.zeros((4, 2, n))  # of a step: at no fraction, and what fractions to the right, down and both add
        for _ in range(STEPS):
            if not open_.any():
                break
            place = at + moved
            low = np.floor(place)
            left = np.flatnonzero((low != cell).any(1) & open_)
            cell[left] = low[left]
            for first in range(0, len(left), POINTS):
                k = left[first : first + POINTS]
                block, g = (_taken(blocks, of[k], low[k]) - middle[k])[:, None], slopes[k]
                none, right, down, both = ((own[k] - np.vecdot(g, block[:, :, d : d + LONG])).T for d in (0, 1, SIDE, SIDE + 1))
                ex, ey = np.stack((none, right - none, down - none, none - right - down + both), 1)
                parts[:, 0, k], parts[:, 1, k] = solved[0, k] * ex - solved[1, k] * ey, solved[2, k] * ey - solved[1, k] * ex
            fx, fy = (place - low).T
            step = parts[0] + fx * parts[1] + fy * (parts[2] + fx * parts[3])
            moved += (np.minimum(np.maximum(step, -WINDOW), WINDOW) * open_).T
            open_ &= np.hypot(*step) >= LEAST_STEP
    to = start + moved
    good &= (to >= 0).all(1) & (to <= np.array(current.shape[:0:-1]) - 1).all(1)
    return [(to[of == k], good[of == k]) for k in range(len(points))]


def agreed_motion(before: np.ndarray, after: np.ndarray) -> tuple[complex, complex] | None:
    """Turn-and-scale and shift (z to turn * z + shift, points as x + yi) that most points agree on; None without any."""
    z, w = before @ (1, 1j), after @ (1, 1j)
    rng = np.random.default_rng(len(z))
    i, j = rng.integers(0, len(z), TRIES), rng.integers(0, len(z) - 1, TRIES)
    j += j >= i
    apart = z[i] - z[j]
    turn = (w[i] - w[j]) / np.where(apart == 0, 1, apart)
    shift = w[i] - turn * z[i]
    ones = np.ones(len(turn))
    left = np.stack((turn.real, -turn.imag, shift.real, -ones), 1) @ np.stack((z.real, z.imag, np.ones(len(z)), w.real))
    down = np.stack((turn.imag, turn.real, shift.imag, -ones), 1) @ np.stack((z.real, z.imag, np.ones(len(z)), w.imag))
    near = left * left + down * down < INLIER_PIXELS**2
    agreeing = np.where(apart == 0, 0, near.sum(1))
    best = int(agreeing.argmax())
    if agreeing[best] < 2:
        return None
    turn, shift = turn[best], shift[best]
    for narrow in (False, False, False, True, True, True):  # least squares over those that agree, at last over those that agree best
        left = np.abs(turn * z + shift - w)
        inside = left < INLIER_PIXELS
        if narrow and inside.any():
            inside &= left <= max(4 * np.median(left[inside]), 0.02)
        mz, mw = z[inside].mean() if inside.any() else 0, w[inside].mean() if inside.any() else 0
        spread = (np.abs(z[inside] - mz) ** 2).sum()
        if inside.sum() < 2 or not spread:
            break
        turn = (np.conj(z[inside] - mz) * (w[inside] - mw)).sum() / spread
        shift = mw - turn * mz
    return complex(turn), complex(shift)


def _mirrored(v: np.ndarray, n: int) -> np.ndarray:
    """Places beyond an edge fold back, the edge pixel counted twice."""
    v = np.mod(v + 0.5, 2 * n)
    return np.clip(np.where(v > n, 2 * n - v, v) - 0.5, 0, n - 1)


def warped(image: np.ndarray, turn: complex, shift: complex, shape: tuple[int, int]) -> np.ndarray:
    """The image as the motion leaves it."""
    y, x = np.arange(shape[0], dtype=float)[:, None], np.arange(shape[1], dtype=float)
    if turn:
        x, y, back = x - shift.real, y - shift.imag, 1 / turn
        x, y = x * back.real - y * back.imag, x * back.imag + y * back.real
    else:
        x, y = np.broadcast_arrays(x, y)
    out = _sampled(image, _mirrored(x, image.shape[1]), _mirrored(y, image.shape[0]))
    return np.rint(out).astype(np.uint8)


def camera_motions(previous: np.ndarray, current: np.ndarray) -> list[tuple[complex, complex, np.ndarray, np.ndarray]]:
    """Of each pair of one size its turn and shift, corners that were followed and where they are now. Without LEAST_TRACKED corners the camera counts as still."""
    points, none = corners(previous), np.empty((0, 2))
    out = [(1 + 0j, 0j, none, none)] * len(points)
    pairs, turned = [k for k, p in enumerate(points) if len(p) >= LEAST_TRACKED], []
    if pairs:
        for k, (to, good) in zip(pairs, tracked(previous[pairs], current[pairs], [points[k] for k in pairs])):
            if good.sum() >= LEAST_TRACKED:
                found = agreed_motion(points[k][good], to[good])
                out[k] = (*(found or out[k][:2]), points[k][good], to[good])
                if found and abs(found[0] - 1) > LEAST_TURN:
                    turned.append(k)
    if turned:  # windows that turned are followed once more from where the motion puts them
        placed = [out[k][0] * (out[k][2] @ (1, 1j)) + out[k][1] for k in turned]
        moved = np.stack([warped(previous[k], *out[k][:2], current.shape[1:]) for k in turned]).astype(np.float32)
        for k, (to, good) in zip(turned, tracked(moved, current[turned], [np.stack((p.real, p.imag), 1) for p in placed])):
            if good.sum() >= LEAST_TRACKED:
                points, at = out[k][2][good], to[good]
                out[k] = (*(agreed_motion(points, at) or out[k][:2]), points, at)
    return out


def measured(previous: np.ndarray, current: np.ndarray, dt: float) -> dict:
    """One pair: the values of ``MOTION``."""
    return measured_together([(previous, current, dt)])[0]


def measured_together(pairs: list[tuple[np.ndarray, np.ndarray, float]]) -> list[dict]:
    """The values of ``MOTION`` of each pair; those of one size are followed together."""
    scaled, sizes, out = [], {}, [None] * len(pairs)
    for k, (previous, current, _) in enumerate(pairs):
        if previous.shape != current.shape:
            (h, w), (ch, cw) = previous.shape, current.shape
            y, x = (np.arange(h) + 0.5) * ch / h - 0.5, (np.arange(w) + 0.5) * cw / w - 0.5
            current = np.rint(_sampled(current.astype(float), *np.meshgrid(x, y))).astype(np.uint8)
        scaled.append(current)
        sizes.setdefault(previous.shape, []).append(k)
    for own in sizes.values():
        for first in range(0, len(own), TOGETHER):
            some = own[first : first + TOGETHER]
            a, b = (np.stack(i).astype(np.float32) for i in ([pairs[k][0] for k in some], [scaled[k] for k in some]))
            for k, image, motion in zip(some, a, camera_motions(a, b)):
                out[k] = _as_motion(image, scaled[k], pairs[k][2], *motion)
    return out


def _as_motion(image: np.ndarray, current: np.ndarray, dt: float, turn: complex, shift: complex, points: np.ndarray, at: np.ndarray) -> dict:
    diagonal, speed = float(np.hypot(*current.shape)), np.empty(0)
    if len(at):
        left = at @ (1, 1j) - (turn * (points @ (1, 1j)) + shift)
        speed = np.abs(left) / max(diagonal * dt, 1e-6)
    aligned = warped(image, turn, shift, current.shape)
    residual = np.abs(aligned.astype(np.int16) - current).astype(np.uint8)
    degrees = float(np.degrees(np.angle(turn)))
    return {
        "dx": shift.real, "dy": shift.imag, "degrees": degrees, "translation": abs(shift) / max(diagonal, 1.0), "rotation": abs(degrees) / max(dt, 1e-6),
        "aligned": aligned.tobytes(), "residual": residual.tobytes(), "current": current.tobytes(), "width": current.shape[1],
        "points": [{"x": x, "y": y, "speed": s} for (x, y), s in zip(at.tolist(), speed.tolist())],
    }


#: dx, dy: the motion's shift at the frame's corner, in pixels; degrees: its turn; translation: the shift as a share of the diagonal; rotation: degrees
#: a second; aligned, residual, current: frames of ``width`` columns; points: corners where they are now, with their speed besides the camera's
#: in diagonals a second.
MOTION = pa.struct([
    ("dx", pa.float64()), ("dy", pa.float64()), ("degrees", pa.float64()), ("translation", pa.float64()), ("rotation", pa.float64()), ("aligned", pa.binary()),
    ("residual", pa.binary()), ("current", pa.binary()), ("width", pa.int32()), ("points", pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64()), ("speed", pa.float64())]))),
])
CAMERA = pa.struct(list(MOTION)[:5])
_MOTION = "struct<dx double, dy double, degrees double, translation double, rotation double, aligned binary, residual binary, current binary, width int, points array<struct<x double, y double, speed double>>>"


def _frame(raw: pa.Scalar, width: int | None) -> np.ndarray | None:
    if not raw.is_valid or not width or not len(data := raw.as_buffer()) or len(data) % width:
        return None
    return np.frombuffer(data, np.uint8).reshape(-1, width)


def _measured_rows(previous: pa.Array, previous_width: pa.Array, current: pa.Array, width: pa.Array, dt: pa.Array) -> list[dict | None]:
    columns = zip(previous, previous_width.to_pylist(), current, width.to_pylist(), dt.to_pylist())
    pairs = [(_frame(x, wx), _frame(y, wy), t) for x, wx, y, wy, t in columns]
    whole = [k for k, pair in enumerate(pairs) if all(v is not None for v in pair)]
    out = [None] * len(pairs)
    for k, motion in zip(whole, measured_together([pairs[k] for k in whole])):
        out[k] = motion
    return out


def _few(columns: tuple[pa.Array, ...]) -> Iterator[tuple[pa.Array, ...]]:
    """What a pair gives is larger than its frames: a few at a time are worked on and leave the task."""
    for first in range(0, len(columns[0]), PAIRS):
        yield tuple(c.slice(first, PAIRS) for c in columns)


def stabilised_motion(previous: Column, previous_width: Column, current: Column, width: Column, dt: Column) -> Column:
    """A pair of grey frames to ``MOTION``; null where a frame is missing, empty or not a rectangle."""

    @F.arrow_udf(_MOTION)
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for columns in batches:
            for some in _few(columns):
                yield pa.array(_measured_rows(*some), MOTION)

    return run(previous, previous_width, current, width, dt)


def camera_motion(previous: Column, previous_width: Column, current: Column, width: Column, dt: Column) -> Column:
    """The numbers of ``stabilised_motion`` alone, where no later step reads its frames and corners, which are larger than the pair."""

    @F.arrow_udf("struct<dx double, dy double, degrees double, translation double, rotation double>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for columns in batches:
            for some in _few(columns):
                yield pa.array(_measured_rows(*some), CAMERA)

    return run(previous, previous_width, current, width, dt)


def phase_shift(before: np.ndarray, after: np.ndarray) -> tuple[float, float, float]:
    """(dx, dy, response) between two regions of one size: the peak of their phase correlation, by its centroid over 5 by 5 places, and the
    share of all that lies there."""
    cross = np.conj(np.fft.fft2(before)) * np.fft.fft2(after)
    size = np.abs(cross)
    plane = np.fft.fftshift(np.fft.ifft2(np.where(size > 1e-9, cross / np.where(size > 1e-9, size, 1), 0)).real)
    y, x = np.unravel_index(int(plane.argmax()), plane.shape)
    ys, xs = np.arange(max(0, y - 2), min(plane.shape[0], y + 3)), np.arange(max(0, x - 2), min(plane.shape[1], x + 3))
    peak = plane[np.ix_(ys, xs)]
    total = peak.sum()
    if total <= 0:
        return 0.0, 0.0, 0.0
    return float((peak.sum(0) * xs).sum() / total - plane.shape[1] // 2), float((peak.sum(1) * ys).sum() / total - plane.shape[0] // 2), float(total)


def region_shift(before: np.ndarray, after: np.ndarray) -> tuple[float, float, float]:
    """(dx, dy, response) as ``phase_shift``, but where another whole shift of up to half the sides leaves less than MATCH_SHARE of the squares that its
    peak leaves, that one: what enters and leaves at a smooth region's edges draws the peak towards none."""
    (h, w), size = before.shape, tuple(2 * n for n in before.shape)
    a, b, ones = (np.fft.rfft2(i, size) for i in (before, after, np.ones((h, w))))
    squares = [np.fft.rfft2(i.astype(float) ** 2, size) for i in (before, after)]
    meets = lambda u, v: np.fft.irfft2(np.conj(u) * v, size)
    left = meets(squares[0], ones) + meets(ones, squares[1]) - 2 * meets(a, b)
    ys, xs = np.arange(-(h // 2), h // 2 + 1), np.arange(-(w // 2), w // 2 + 1)
    left = np.maximum(left[np.ix_(ys, xs)], 0) / ((h - np.abs(ys))[:, None] * (w - np.abs(xs)))
    dx, dy, response = phase_shift(before, after)
    found = left[int(np.clip(round(dy) + h // 2, 0, len(ys) - 1)), int(np.clip(round(dx) + w // 2, 0, len(xs) - 1))]
    y, x = np.unravel_index(int(left.argmin()), left.shape)
    return (float(xs[x]), float(ys[y]), response) if left[y, x] < MATCH_SHARE * found - 1e-6 else (dx, dy, response)


_IDLE = "struct<hand double, workspace double, activity double, speed double, inactive boolean>"
_IDLE_ARROW = pa.struct([("hand", pa.float64()), ("workspace", pa.float64()), ("activity", pa.float64()), ("speed", pa.float64()), ("inactive", pa.bool_())])


def hands_observed(motion: dict, boxes: list[dict], source: tuple[int, int], dt: float, delta: int, least_hand: float, least_workspace: float, expansion: float) -> dict:
    """One pair: the values of ``idle_observation``."""
    width = motion["width"]
    residual = np.frombuffer(motion["residual"], np.uint8).reshape(-1, width)
    height = residual.shape[0]
    if not boxes:
        return {"hand": 0.0, "workspace": 0.0, "activity": 0.0, "speed": None, "inactive": None}
    mask = np.zeros(residual.shape, bool)
    for b in boxes:
        more_x, more_y = (b["x2"] - b["x1"]) * expansion, (b["y2"] - b["y1"]) * expansion
        kx, ky = width / source[1], height / source[0]
        left, top = int(max(0, (b["x1"] - more_x) * kx)), int(max(0, (b["y1"] - more_y) * ky))
        right, bottom = int(min(width, (b["x2"] + more_x) * kx)), int(min(height, (b["y2"] + more_y) * ky))
        mask[top : max(bottom, 0), left : max(right, 0)] = True
    changed = residual >= delta
    hand = float(changed[mask].mean()) if mask.any() else 0.0
    inner = changed[int(0.1 * height) :, int(0.1 * width) : int(0.9 * width)]
    workspace, speed = float(inner.mean()) if inner.size else 0.0, None
    if motion["points"]:
        at = np.array([(p["x"], p["y"]) for p in motion["points"]])
        held = mask[np.clip(at[:, 1].astype(int), 0, height - 1), np.clip(at[:, 0].astype(int), 0, width - 1)]
        if held.any():
            speed = float(np.quantile(np.array([p["speed"] for p in motion["points"]])[held], SPEED_QUANTILE))
    if mask.any():
        rows, columns = np.flatnonzero(mask.any(1)), np.flatnonzero(mask.any(0))
        region = np.s_[rows[0] : rows[-1] + 1, columns[0] : columns[-1] + 1]
        if mask[region].shape[0] >= LEAST_SIDE and mask[region].shape[1] >= LEAST_SIDE:
            images = (np.frombuffer(motion[k], np.uint8).reshape(-1, width)[region].astype(float) for k in ("aligned", "current"))
            dx, dy, response = region_shift(*images)
            if response > LEAST_RESPONSE:
                speed = max(speed or 0.0, float(np.hypot(dx, dy)) / max(float(np.hypot(height, width)) * dt, 1e-6))
    return {"hand": hand, "workspace": workspace, "activity": max(hand, workspace), "speed": speed, "inactive": not (hand >= least_hand or workspace >= least_workspace)}


def idle_observation(motion: Column, boxes: Column, source_height: Column, source_width: Column, dt: Column, delta: int = 12, least_hand: float = 0.01, least_workspace: float = 0.005, expansion: float = 0.25) -> Column:
    """Of a pair's motion and the hands on the later frame (x1, y1, x2, y2 in its own pixels): shares of changed pixels near hands and in the
    workspace, the larger of both, the hands' speed (the 95 % quantile of corners' speeds there, or the region's own shift if it is faster) in
    diagonals a second, and whether nothing moved. Without hands there is no speed and nothing is known."""

    @F.arrow_udf(_IDLE)
    def run(m: pa.Array, b: pa.Array, h: pa.Array, w: pa.Array, step: pa.Array) -> pa.Array:
        out = []
        for motion, held, height, width, t in zip(m, b.to_pylist(), h.to_pylist(), w.to_pylist(), step.to_pylist()):
            out.append(hands_observed(motion.as_py(), held or [], (height, width), t, delta, least_hand, least_workspace, expansion) if motion.is_valid and t is not None else None)
        return pa.array(out, _IDLE_ARROW)

    return run(motion, boxes, source_height, source_width, dt)


def hand_activity(previous: Column, previous_width: Column, current: Column, width: Column, dt: Column, boxes: Column, source_height: Column, source_width: Column, delta: int = 12, least_hand: float = 0.01, least_workspace: float = 0.005, expansion: float = 0.25) -> Column:
    """``idle_observation`` of ``stabilised_motion`` in one step, where nothing else reads the motion: its frames and corners, larger than the pair, don't leave the task."""

    @F.arrow_udf(_IDLE)
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for columns in batches:
            for some in _few(columns):
                rows = zip(_measured_rows(*some[:5]), *(c.to_pylist() for c in some[4:]))
                yield pa.array([m and hands_observed(m, held or [], (h, w), t, delta, least_hand, least_workspace, expansion) for m, t, held, h, w in rows], _IDLE_ARROW)

    return run(previous, previous_width, current, width, dt, boxes, source_height, source_width)


def paired(frames: DataFrame, clip: str, period: float) -> DataFrame:
    """frames(clip, sample, t, width, gray, ...), samples numbered from 0, with the frame before: previous_gray, previous_width and ``dt``, the time
    between both, ``period`` at least. First frames have none.

    A clip is cut into pieces of PIECE samples, whose last frame also begins the next, so a long clip is the work of many tasks. There are as many
    partitions as the session shuffles into: a pair's work is far more than its bytes say, by which partitions would be joined.
    """
    piece = F.floor(F.col("sample") / PIECE)
    ends = (F.col("sample") + 1) % PIECE == 0
    dealt = frames.withColumn("_piece", F.explode(F.when(ends, F.array(piece, piece + 1)).otherwise(F.array(piece))))
    dealt = dealt.repartition(int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions")), clip, "_piece")
    w = Window.partitionBy(clip, "_piece").orderBy("sample")
    step = F.greatest(F.col("t") - F.lag("t").over(w), F.lit(float(period)))
    out = dealt.withColumns({"previous_gray": F.lag("gray").over(w), "previous_width": F.lag("width").over(w), "dt": step})
    return out.where(F.floor(F.col("sample") / PIECE) == F.col("_piece")).drop("_piece")
