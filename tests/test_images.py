import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import boxes, images


def decode(data):
    """A plain baseline decoder: bit by bit, block by block."""
    assert data[:2] == b"\xff\xd8" and data[-2:] == b"\xff\xd9"
    zigzag = [0, 1, 8, 16, 9, 2, 3, 10, 17, 24, 32, 25, 18, 11, 4, 5, 12, 19, 26, 33, 40, 48, 41, 34, 27, 20, 13, 6, 7, 14, 21, 28, 35, 42, 49, 56, 57, 50, 43, 36, 29, 22, 15, 23, 30, 37, 44, 51, 58, 59, 52, 45, 38, 31, 39, 46, 53, 60, 61, 54, 47, 55, 62, 63]
    at, quant, codes, parts = 2, {}, {}, []
    while True:
        mark, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if mark == 0xDB:
            quant[body[0]] = list(body[1:])
        elif mark == 0xC0:
            height, width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            parts = [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(body[5])]
        elif mark == 0xC4:
            code, k, table = 0, 17, {}
            for length in range(1, 17):
                for _ in range(body[length]):
                    table[length, code] = body[k]
                    code, k = code + 1, k + 1
                code <<= 1
            codes[body[0]] = table
        elif mark == 0xDA:
            use = {body[1 + 2 * k]: body[2 + 2 * k] for k in range(body[0])}
            break
    bits = iter("".join(f"{b:08b}" for b in data[at:-2].replace(b"\xff\0", b"\xff")))

    def symbol(table):
        code = length = 0
        while (length, code) not in table:
            code, length = code << 1 | int(next(bits)), length + 1
            assert length <= 16
        return table[length, code]

    def value(n):
        raw = int("".join(next(bits) for _ in range(n)) or "0", 2)
        return raw if not n or raw >> (n - 1) else raw - (1 << n) + 1

    cos = np.array([[np.sqrt((1 if u == 0 else 2) / 8) * np.cos((2 * x + 1) * u * np.pi / 16) for x in range(8)] for u in range(8)])
    top = max(p[1] for p in parts), max(p[2] for p in parts)
    rows, columns = -(-height // (8 * top[1])), -(-width // (8 * top[0]))
    planes, before = {p[0]: np.zeros((rows * 8 * p[2], columns * 8 * p[1])) for p in parts}, dict.fromkeys((p[0] for p in parts), 0)
    for my in range(rows):
        for mx in range(columns):
            for name, across, down, q in parts:
                for y in range(down):
                    for x in range(across):
                        block = [0] * 64
                        before[name] += value(symbol(codes[use[name] >> 4]))
                        block[0], k = before[name] * quant[q][0], 1
                        while k < 64:
                            s = symbol(codes[0x10 | use[name] & 15])
                            if s == 0:
                                break
                            k += s >> 4
                            block[zigzag[k]] = value(s & 15) * quant[q][k]
                            k += 1
                        py, px = (my * down + y) * 8, (mx * across + x) * 8
                        planes[name][py : py + 8, px : px + 8] = cos.T @ np.array(block).reshape(8, 8) @ cos + 128
    assert set(bits) <= {"1"}
    y, cb, cr = (np.repeat(np.repeat(planes[p[0]], top[1] // p[2], 0), top[0] // p[1], 1)[:height, :width] for p in parts)
    return np.clip(np.stack((y + 1.772 * (cb - 128), y - 0.344 * (cb - 128) - 0.714 * (cr - 128), y + 1.402 * (cr - 128)), 2), 0, 255)


def picture(height, width, seed=0):
    y, x = np.mgrid[:height, :width]
    rng = np.random.default_rng(seed)
    waves = [127 + 90 * np.sin(x * rng.uniform(0.02, 0.2) + y * rng.uniform(-0.2, 0.2) + k) for k in range(3)]
    return np.clip(np.stack(waves, 2), 0, 255).astype(np.uint8)


@pytest.mark.parametrize("height,width", [(48, 64), (16, 16), (17, 33), (1, 1), (5, 90)])
def test_a_plain_decoder_reads_it(height, width):
    frame = picture(height, width)
    back = decode(images.jpeg(frame, 90))
    assert back.shape == frame.shape and np.abs(back - frame).mean() < 6  # colour is of half the size
    assert np.abs((back - frame) @ (0.114, 0.587, 0.299)).mean() < 2


def test_noise_flat_frames_and_quality():
    noise = np.random.default_rng(1).integers(0, 256, (64, 64, 3), dtype=np.uint8)
    flat = np.full((40, 40, 3), (200, 30, 90), np.uint8)
    assert np.abs(decode(images.jpeg(flat)) - flat).max() <= 3
    assert np.abs(decode(images.jpeg(noise, 100))[:, :, 1] - noise[:, :, 1]).mean() < 60
    sizes = [len(images.jpeg(noise, q)) for q in (5, 40, 82, 100)]
    assert sizes == sorted(sizes) and sizes[0] * 3 < sizes[-1]
    decode(images.jpeg(noise, 5))


def test_code_words_are_short_and_never_all_ones():
    fib = {k: n for k, n in enumerate([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610, 987, 1597, 2584, 4181, 6765, 10946, 17711, 28657, 46368])}
    for counts in (fib, {7: 1}, {1: 5, 2: 5}, dict.fromkeys(range(256), 1)):
        word, length, _ = images._words(images._code_lengths(counts))
        used = [(f"{word[s]:0{length[s]}b}") for s in counts]
        assert all(1 <= len(w) <= 16 and "0" in w for w in used)
        assert not any(b.startswith(a) for a in used for b in used if a is not b)


def test_boxes_and_text_are_drawn():
    frame = np.zeros((120, 200, 3), np.uint8)
    out = images.annotated(frame, [{"x1": 40.4, "y1": 50.0, "x2": 90.0, "y2": 100.6, "score": 0.5}], "idle t=1.000s")
    assert (out[49:51, 60] == images.BOX_COLOUR).all() and (out[75, 39:41] == images.BOX_COLOUR).all() and not out[75, 60].any()
    assert (out[9:24, 12:160] == images.TEXT_COLOUR).all(2).sum() > 200 and not frame.any()
    images.annotated(frame, [{"x1": -50.0, "y1": -9.0, "x2": 900.0, "y2": 900.0, "score": 1.0}], "漢字" * 99)  # off the frame, letters without a picture


def test_only_chosen_frames_are_rendered_and_hashes_follow(spark):
    frames = spark.createDataFrame([(1, k, 40, 60, bytearray(picture(40, 60, k).tobytes())) for k in range(6)] + [(2, 0, 40, 60, bytearray(b"short"))], "clip long, seq int, height int, width int, bgr binary")
    box = [(5.0, 5.0, 20.0, 20.0, 0.9)]
    rows = [(1, "idle", k, float(k), [0.1, 0.7, 0.7, 0.2, 0.0, 0.3][k], box) for k in range(6)] + [(1, "blur", 2, 2.0, 0.5, None), (2, "idle", 0, 0.0, 1.0, None)]
    candidates = spark.createDataFrame(rows, "clip long, reason string, seq int, t double, score double, boxes array<struct<x1 double, y1 double, x2 double, y2 double, score double>>")
    got = {(r.clip, r.reason, r.slot): r for r in images.rendered_evidence(candidates, frames, "clip", most_width=30).collect()}
    assert {k: (r.t, r.score) for k, r in got.items()} == {(1, "idle", 0): (0.0, 0.1), (1, "idle", 1): (1.0, 0.7), (1, "idle", 2): (5.0, 0.3), (1, "blur", 0): (2.0, 0.5)}
    for r in got.values():
        assert hashlib.sha256(r.image).hexdigest() == r.sha256 and r.size_bytes == len(r.image) and decode(bytes(r.image)).shape == (20, 30, 3)


@pytest.mark.parametrize("rows,columns", [(90, 160), (160, 90), (416, 416), (3, 700), (1000, 7)])
def test_letterbox_round_trip(spark, rows, columns):
    frame = picture(rows, columns)
    planes, ratio = images.letterboxed(frame, 128, 192)
    assert planes.shape == (3, 128, 192) and planes.dtype == np.float32 and ratio == min(128 / rows, 192 / columns)
    pixels = planes.transpose(1, 2, 0) * np.array(images.SPREAD) + np.array(images.MEAN)
    h, w = max(1, int(rows * ratio)), max(1, int(columns * ratio))
    assert np.allclose(pixels[h:], 114, atol=1e-3) and np.allclose(pixels[:, w:], 114, atol=1e-3)
    for y, x in ((0, 0), (h // 2, w // 3), (h - 1, w - 1)):  # plain bilinear values
        sy, sx = (min(max((p + 0.5) * n / m - 0.5, 0), n - 1) for p, n, m in ((y, rows, h), (x, columns, w)))
        y0, x0 = min(int(sy), max(rows - 2, 0)), min(int(sx), max(columns - 2, 0))
        y1, x1 = min(y0 + 1, rows - 1), min(x0 + 1, columns - 1)
        fy, fx = sy - y0, sx - x0
        f = frame.astype(float)
        want = (f[y0, x0] * (1 - fx) + f[y0, x1] * fx) * (1 - fy) + (f[y1, x0] * (1 - fx) + f[y1, x1] * fx) * fy
        assert np.abs(pixels[y, x] - want).max() <= 0.51
    df = spark.createDataFrame([(bytearray(frame.tobytes()), rows, columns), (None, 1, 1)], "bgr binary, h int, w int")
    got = df.select("h", "w", images.detector_input(F.col("bgr"), F.col("h"), F.col("w"), 128, 192).alias("i"))
    box = F.struct(*((F.lit(v) * F.col("i.ratio")).alias(n) for v, n in ((0.2 * columns, "x1"), (0.1 * rows, "y1"), (0.9 * columns, "x2"), (2.0 * rows, "y2"))))
    back = got.where("i is not null").select("i.planes", boxes.unscaled(box, F.col("i.ratio"), F.col("w"), F.col("h")).alias("b")).collect()
    assert len(back) == 1 and np.array_equal(np.frombuffer(back[0].planes, "<f4").reshape(planes.shape), planes)
    assert np.allclose([back[0].b[n] for n in ("x1", "y1", "x2", "y2")], [0.2 * columns, 0.1 * rows, 0.9 * columns, rows])


def test_measures_of_bytes_equal_those_of_arrays(spark):
    from tidemark.operators import pixels

    rng = np.random.default_rng(2)
    shapes = [(1, 1), (1, 7), (6, 1), (2, 2), (9, 13), (20, 31)]
    grids = [(rng.integers(0, 256, h * w) // (1 + 80 * (k % 2))).tolist() for k, (h, w) in enumerate(shapes)]
    rows = [(k, w, g, bytearray(g)) for k, (g, (_, w)) in enumerate(zip(grids, shapes))]
    df = spark.createDataFrame(rows, "k int, w int, g array<int>, b binary")
    box = lambda *v: F.struct(*(F.lit(x).alias(n) for x, n in zip(v, ("x1", "y1", "x2", "y2"))))
    held = F.array(box(1, 0, 5, 3), box(0, 2, 2, 900), box(3, 3, 2, 2))
    got = df.select(pixels.frame_quality(F.col("g"), F.col("w")).alias("a"), pixels.measured_quality(F.col("b"), F.col("w")).alias("b"), pixels.region_activity(F.col("g"), F.col("w"), held, 90).alias("c"), pixels.measured_activity(F.col("b"), F.col("w"), held, 90).alias("d"))
    for r in got.collect():
        assert np.allclose([float(v) for v in r.a], [float(v) for v in r.b]) and np.allclose(list(r.c), list(r.d))
    odd = spark.createDataFrame([(bytearray(b"12345"), 2), (None, 2), (bytearray(b""), 1)], "b binary, w int")
    assert all(r.a is None for r in odd.select(pixels.measured_quality(F.col("b"), F.col("w")).alias("a")).collect())
