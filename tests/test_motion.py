import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import motion


def texture(width, height, turn=0.0, dx=0.0, dy=0.0, seed=0):
    """A smooth picture, and the same one after a turn about its corner (degrees) and a shift."""
    rng = np.random.default_rng(seed)
    waves = rng.uniform(-0.45, 0.45, (40, 2)), rng.uniform(0, 6.28, 40), rng.uniform(0.3, 1, 40)
    y, x = np.mgrid[:height, :width]
    z = (x + 1j * y - complex(dx, dy)) * np.exp(-1j * np.radians(turn))
    value = sum(a * np.sin(k[0] * z.real + k[1] * z.imag + p) for k, p, a in zip(*waves))
    return np.clip(128 + 22 * value, 0, 255).round().astype(np.uint8)


@pytest.mark.parametrize("turn,dx,dy", [(0, 0, 0), (0, 3.4, -2.3), (0, -17, 11.5), (1.7, 2, 5), (-4, 6.25, 1), (0.3, 0, 0)])
def test_planted_motion_is_found_within_a_tenth(turn, dx, dy):
    m = motion.measured(texture(320, 180), texture(320, 180, turn, dx, dy), 0.5)
    assert abs(m["dx"] - dx) < 0.1 and abs(m["dy"] - dy) < 0.1 and abs(m["degrees"] - turn) < 0.1
    assert abs(m["translation"] - np.hypot(dx, dy) / np.hypot(320, 180)) < 0.1 / 360 and abs(m["rotation"] - abs(turn) * 2) < 0.2
    inner = np.frombuffer(m["residual"], np.uint8).reshape(180, 320)[30:-30, 40:-40]
    assert np.quantile(inner, 0.95) <= 4  # what the warp leaves is rounding


def test_camera_and_a_patch_that_moves_by_itself():
    a, b = texture(320, 180), texture(320, 180, 0, 4, 2)
    patch = texture(90, 70, seed=9)
    a[50:120, 100:190] = patch
    b[50 + 2 + 3 : 120 + 2 + 3, 100 + 4 + 8 : 190 + 4 + 8] = patch
    m = motion.measured(a, b, 0.5)
    assert abs(m["dx"] - 4) < 0.1 and abs(m["dy"] - 2) < 0.1
    got = motion.hands_observed(m, [{"x1": 130, "y1": 75, "x2": 180, "y2": 105}], (180, 320), 0.5, 12, 0.01, 0.005, 0.0)
    want = np.hypot(8, 3) / (np.hypot(320, 180) * 0.5)
    assert got["speed"] == pytest.approx(want, rel=0.05) and got["inactive"] is False and got["hand"] > 0.3


def test_moving_foreground_on_black():
    """The pinned case: a white square that jumps by 40 pixels; its corners can't be followed, its region's shift can."""
    a, b = np.zeros((180, 320), np.uint8), np.zeros((180, 320), np.uint8)
    a[60:120, 80:140] = 255
    b[60:120, 120:180] = 255
    got = motion.hands_observed(motion.measured(a, b, 0.5), [{"x1": 115, "y1": 55, "x2": 185, "y2": 125}], (180, 320), 0.5, 12, 0.01, 0.005, 0.25)
    assert got["speed"] is not None and got["speed"] > 0.05


@pytest.mark.parametrize("dx,dy", [(0, 0), (5, -3), (-12, 7), (3, 0)])
def test_phase_correlation_finds_shifts_of_a_region(dx, dy):
    wide = np.random.default_rng(5).integers(0, 256, (120, 160)).astype(float)
    x, y, response = motion.phase_shift(wide[20:84, 30:126], wide[20 - dy : 84 - dy, 30 - dx : 126 - dx])
    assert abs(x - dx) < 0.1 and abs(y - dy) < 0.1 and response > 0.3


def test_flat_and_tiny_frames_are_still():
    for shape in ((1, 1), (2, 3), (40, 1), (30, 50)):
        flat = np.full(shape, 7, np.uint8)
        m = motion.measured(flat, flat, 0.5)
        assert (m["dx"], m["dy"], m["rotation"], m["points"]) == (0, 0, 0, []) and not any(m["residual"])


def test_frames_of_another_size_are_scaled():
    m = motion.measured(texture(160, 90), np.repeat(np.repeat(texture(160, 90), 2, 0), 2, 1), 1.0)
    assert m["width"] == 160 and abs(m["dx"]) < 0.5 and abs(m["dy"]) < 0.5


def test_columns_and_pairs_across_pieces(spark, monkeypatch):
    monkeypatch.setattr(motion, "PIECE", 3)
    rows = [(c, k, k * 0.4, 96, bytearray(texture(96, 72, 0, 2 * k, k * c).tobytes())) for c in (0, 1) for k in range(8)]
    rows += [(2, 0, 0.0, 96, None), (2, 1, 0.4, 96, bytearray(texture(96, 72).tobytes()))]
    frames = spark.createDataFrame(rows, "clip long, sample int, t double, width int, gray binary").repartition(4)
    pairs = motion.paired(frames, "clip", 0.5)
    assert pairs.count() == len(rows)
    box = F.array(F.struct(*(F.lit(float(v)).alias(n) for n, v in (("x1", 20), ("y1", 20), ("x2", 60), ("y2", 50)))))
    m = motion.stabilised_motion(F.col("previous_gray"), F.col("previous_width"), F.col("gray"), F.col("width"), F.col("dt"))
    got = pairs.withColumn("m", m).withColumn("o", motion.idle_observation(F.col("m"), box, F.lit(72), F.lit(96), F.col("dt")))
    for r in got.select("clip", "sample", "dt", "m.dx", "m.dy", "o.*").collect():
        if r.sample == 0 or r.clip == 2:
            assert r.dx is None and r.inactive is None
        else:
            assert abs(r.dx - 2) < 0.25 and abs(r.dy - r.clip) < 0.25 and r.dt == 0.5 and r.speed < 0.05


def test_smooth_region_without_corners_has_its_own_shift():
    """a patch of long waves, no corner in the box: the correlation's peak alone lies at less than half of the shift."""
    import pyarrow as pa

    from tidemark.plans.motion import HEIGHT, PATCH, WIDTH, _drawn

    k, waves = 2265, np.random.default_rng(2265).normal(size=64).tolist()
    planted = k % 7 - 3, k % 5 - 2, 0, k % 3 + 4
    drawn = _drawn(pa.array([waves]), *(pa.array([float(v)]) for v in planted)).to_pylist()[0]
    m = motion.measured(*(np.frombuffer(drawn[n], np.uint8).reshape(HEIGHT, WIDTH) for n in ("before", "after")), 0.5)
    left, top, right, bottom = PATCH
    box = {"x1": left + 15 + planted[0], "y1": top + 12 + planted[1], "x2": right - 9 + planted[0], "y2": bottom - 12 + planted[1]}
    got = motion.hands_observed(m, [box], (HEIGHT, WIDTH), 0.5, 12, 0.01, 0.005, 0.0)
    assert got["speed"] * 0.5 * np.hypot(WIDTH, HEIGHT) == pytest.approx(planted[3], abs=0.5)


@pytest.mark.parametrize("dx,dy", [(0, 0), (5, -3), (0, 4)])
def test_region_shift_of_still_noise_and_planted_shifts(dx, dy):
    rng = np.random.default_rng(6)
    wide = rng.integers(0, 256, (120, 160)).astype(float)
    x, y, _ = motion.region_shift(wide[20:84, 30:126], wide[20 - dy : 84 - dy, 30 - dx : 126 - dx] + rng.normal(0, 5, (64, 96)))
    assert abs(x - dx) < 0.1 and abs(y - dy) < 0.1


def test_frames_are_drawn_a_few_at_a_time():
    """however many narrow rows a batch has, no more pairs of frames than PAIRS are held."""
    import pyarrow as pa

    from tidemark.plans.motion import _drawn_by_few

    n = motion.PAIRS + 5
    batch = pa.array([[1.0] * 64] * n), *(pa.array([0.0] * n) for _ in range(4))
    assert [len(a) for a in _drawn_by_few(iter([batch]))] == [motion.PAIRS, 5]


def test_windows_at_and_beyond_edges_are_as_sampled():
    rng = np.random.default_rng(8)
    images = rng.uniform(0, 255, (3, 50, 64)).astype(np.float32)
    at = np.concatenate((rng.uniform(-40, 110, (60, 2)), rng.integers(0, 50, (20, 2)), [[-1e6, 1e6]]))
    of = rng.integers(0, 3, len(at))
    places = [n.ravel() for n in np.meshgrid(np.arange(motion.WINDOW) - motion.WINDOW // 2, np.arange(motion.WINDOW) - motion.WINDOW // 2)]
    got = np.pad(motion._windows(motion._blocks(images), of, at), ((0, 0), (0, 1))).reshape(len(at), motion.WINDOW, motion.SIDE)[:, :, : motion.WINDOW]
    for k, (x, y), window in zip(of, at, got):
        assert np.allclose(window.ravel(), motion._sampled(images[k], places[0] + x, places[1] + y), atol=0.01)


def followed_one_by_one(before, after, point):
    """The plain tracker of one point on one level: every step samples its whole window."""
    reach = np.arange(motion.WINDOW) - motion.WINDOW // 2
    dx, dy = (n.ravel() for n in np.meshgrid(reach, reach))
    gx, gy = (motion._sampled(g[0], point[0] + dx, point[1] + dy) for g in motion._gradients(before[None]))
    window, moved = motion._sampled(before, point[0] + dx, point[1] + dy), np.zeros(2)
    xx, yy, xy = gx @ gx, gy @ gy, gx @ gy
    for steps in range(1, motion.STEPS + 1):
        differ = window - motion._sampled(after, point[0] + moved[0] + dx, point[1] + moved[1] + dy)
        step = np.array((yy * (differ @ gx) - xy * (differ @ gy), xx * (differ @ gy) - xy * (differ @ gx))) / (xx * yy - xy * xy)
        moved += step
        if np.hypot(*step) < motion.LEAST_STEP:
            break
    return point + moved, steps


def test_points_of_many_pairs_take_steps_together(monkeypatch):
    """places are those of the plain tracker, yet pixels aren't taken for each of its steps, and for all pairs at once."""
    monkeypatch.setattr(motion, "LEVELS", 0)
    shifts = [(0.6, -0.3), (-1.4, 0.8), (2.3, 1.1), (0.0, 0.0)]
    before = np.stack([texture(96, 72, seed=k) for k in range(4)]).astype(np.float32)
    after = np.stack([texture(96, 72, 0, *d, seed=k) for k, d in enumerate(shifts)]).astype(np.float32)
    points = [p[:30] for p in motion.corners(before)]
    calls, taken = [], motion._taken
    monkeypatch.setattr(motion, "_taken", lambda blocks, of, low: calls.append(len(low)) or taken(blocks, of, low))
    got = motion.tracked(before, after, points)
    n = sum(map(len, points))
    steps = most = 0
    for a, b, own, (to, _) in zip(before, after, points, got):
        for point, place in zip(own, to):
            want, k = followed_one_by_one(a, b, point)
            steps, most = steps + k, max(most, k)
            assert np.abs(place - want).max() < 0.01
    made = calls[3 * -(-n // motion.POINTS) :]  # the first are the earlier frames' windows
    assert sum(made) < 0.75 * steps and len(made) <= most * -(-n // motion.POINTS)


def test_pairs_of_several_sizes_and_of_none_are_as_alone():
    flat = np.full((30, 50), 7, np.uint8)
    pairs = [(texture(160, 120), texture(160, 120, t, t, 2), 0.5) for t in (0, 1, -1, 2)] + [(flat, flat, 0.5), (texture(96, 72), texture(96, 72, 0, 3, 1), 0.25), (texture(96, 72), texture(192, 144), 1.0)]
    pairs *= 3  # more than TOGETHER
    for pair, m in zip(pairs, motion.measured_together(pairs)):
        alone = motion.measured(*pair)
        for name in ("dx", "dy", "degrees", "translation", "rotation"):
            assert m[name] == pytest.approx(alone[name], abs=1e-4)
        assert m["width"] == alone["width"] and m["current"] == alone["current"] and len(m["points"]) == len(alone["points"])
    assert motion.measured_together([]) == []


@pytest.mark.parametrize("turn,shift", [(1 + 0j, 0j), (0.5 + 0j, 0j), (np.exp(-0.0175j), 3.2 - 1.9j)])
def test_a_picture_is_the_sum_of_its_waves(turn, shift):
    from tidemark.plans.motion import HEIGHT, WIDTH, _picture

    waves = np.random.default_rng(4).normal(size=64)
    y, x = np.mgrid[:HEIGHT, :WIDTH]
    z = complex(turn) * (x + 1j * y) + shift
    value = sum(a * np.sin((0.12 + 0.09 * (n % 8)) * z.real + (0.11 * (n // 8) - 0.38) * z.imag + n * n % 7) for n, a in enumerate(waves / np.sqrt((waves**2).sum())))
    want = np.clip(128 + 55 * value, 0, 255)
    assert np.abs(_picture(waves, complex(turn), complex(shift)) - want).max() < 0.51


def test_columns_without_frames_are_as_with_them(spark):
    """what leaves the task of a query on hands is a few numbers a pair, as of the two steps that pass all frames on."""
    rows = [(k, 96, bytearray(texture(96, 72).tobytes()), 96, bytearray(texture(96, 72, 0, k, 1).tobytes()), 0.5, [(20.0, 20.0, 60.0, 50.0)] if k % 2 else None) for k in range(4)]
    rows += [(4, 96, None, 96, rows[0][4], 0.5, None), (5, 96, rows[0][2], 95, rows[0][4], 0.5, None), (6, 96, rows[0][2], 96, rows[0][4], None, None)]
    schema = "k int, previous_width int, previous_gray binary, width int, gray binary, dt double, boxes array<struct<x1 double, y1 double, x2 double, y2 double>>"
    pairs = spark.createDataFrame(rows, schema)
    pair = [F.col(c) for c in ("previous_gray", "previous_width", "gray", "width", "dt")]
    numbers = motion.camera_motion(*pair)
    hands = motion.hand_activity(*pair, F.col("boxes"), F.lit(72), F.lit(96))
    both = pairs.withColumn("m", motion.stabilised_motion(*pair)).select("k", "m", motion.idle_observation(F.col("m"), F.col("boxes"), F.lit(72), F.lit(96), F.col("dt")).alias("o")).orderBy("k").collect()
    few = pairs.select("k", numbers.alias("m"), hands.alias("o")).orderBy("k").collect()
    assert len(few) == 7 and all(r.m is None and r.o is None for r in few[4:]) and few[1].o.speed is not None and few[0].o.inactive is None
    for a, b in zip(both, few):
        assert (a.m and tuple(a.m)[:5]) == (b.m and tuple(b.m)) and a.o == b.o


@pytest.mark.parametrize("name", ["v03_stabilised_motion", "v04_hand_speed"])
def test_queries_on_motion_pass_no_frames_on(spark, name):
    from tidemark.plans import motion as plans

    plan = getattr(plans, name)(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2 and "aligned" not in plan
