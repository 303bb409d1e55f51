"""Images for people and for detectors: evidence frames with boxes and a line of text as JPEG, and a detector's input planes.

Frames are rows of blue, green, red bytes. The JPEG is baseline, with chroma of half the size and Huffman codes made for each image from the
counts of its symbols, by array operations over all blocks. Evidence is chosen before anything is drawn: at most three frames of a
reason are looked up and rendered.
"""

from __future__ import annotations

import heapq
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.frames import area_weights

#: Width and quality of evidence, colours (blue, green, red) of boxes and of the line of text, a detector's padding, mean and spread.
MOST_WIDTH, QUALITY = 640, 82
BOX_COLOUR, TEXT_COLOUR = (0, 200, 255), (0, 0, 255)
PADDING, MEAN, SPREAD = 114, (103.53, 116.28, 123.675), (57.375, 57.12, 58.395)
#: Quantisation of brightness and of colour at quality 50, as the JPEG standard gives them for example.
BRIGHTNESS = """
16 11 10 16 24 40 51 61  12 12 14 19 26 58 60 55  14 13 16 24 40 57 69 56  14 17 22 29 51 87 80 62
18 22 37 56 68 109 103 77  24 35 55 64 81 104 113 92  49 64 78 87 103 121 120 101  72 92 95 98 112 100 103 99"""
COLOUR = """
17 18 24 47 99 99 99 99  18 21 26 66 99 99 99 99  24 26 56 99 99 99 99 99  47 66 99 99 99 99 99 99
99 99 99 99 99 99 99 99  99 99 99 99 99 99 99 99  99 99 99 99 99 99 99 99  99 99 99 99 99 99 99 99"""
#: A letter is five rows of three dots, a row an octal digit.
FONT = {
    "0": 0o75557, "1": 0o26227, "2": 0o71747, "3": 0o71717, "4": 0o55711, "5": 0o74717, "6": 0o74757, "7": 0o71111, "8": 0o75757, "9": 0o75717,
    "a": 0o25755, "b": 0o65656, "c": 0o34443, "d": 0o65556, "e": 0o74647, "f": 0o74644, "g": 0o34553, "h": 0o55755, "i": 0o72227, "j": 0o11152,
    "k": 0o55655, "l": 0o44447, "m": 0o57755, "n": 0o65555, "o": 0o25552, "p": 0o65644, "q": 0o25573, "r": 0o65655, "s": 0o34216, "t": 0o72222,
    "u": 0o55557, "v": 0o55552, "w": 0o55775, "x": 0o55255, "y": 0o55222, "z": 0o71247, "-": 0o00700, ".": 0o00002, "=": 0o07070,
}
_DOTS = {letter: np.array([bits >> (14 - k) & 1 for k in range(15)], bool).reshape(5, 3) for letter, bits in FONT.items()}

#: Places of a block from low to high frequency, by diagonals that turn back.
ZIGZAG = np.array(sorted(range(64), key=lambda k: (s := k // 8 + k % 8, k // 8 if s % 2 else k % 8)))
_COSINES = np.sqrt(np.where(np.arange(8) == 0, 1, 2) / 8)[:, None] * np.cos(np.pi * np.arange(8)[:, None] * (2 * np.arange(8) + 1) / 16)


def steps(table: str, quality: int) -> np.ndarray:
    """A table of steps at a quality from 1 to 100."""
    percent = 200 - 2 * quality if quality >= 50 else 5000 // quality
    return np.clip((np.array(table.split(), int) * percent + 50) // 100, 1, 255)


def _code_lengths(counts: dict[int, int]) -> dict[int, int]:
    """Lengths of a prefix code of 16 bits at most in which no word is all ones."""
    weights = sorted(counts.items(), key=lambda x: x[1])
    tallies = [1, *(n for _, n in weights)]  # the first is the word of all ones, which nothing gets
    while True:
        number = count()
        heap = [(n, next(number), [i]) for i, n in enumerate(tallies)]
        heapq.heapify(heap)
        depth = [0] * len(tallies)
        while len(heap) > 1:
            (m, _, a), (n, _, b) = heapq.heappop(heap), heapq.heappop(heap)
            for i in a + b:
                depth[i] += 1
            heapq.heappush(heap, (m + n, next(number), a + b))
        if max(depth) <= 16:
            break
        tallies = [(n + 1) // 2 for n in tallies]
    depth = sorted((max(d, 1) for d in depth), reverse=True)
    return {symbol: d for (symbol, _), d in zip(weights, depth[1:])}


def _words(lengths: dict[int, int]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Code words and their lengths by symbol, and the table as a file has it."""
    code = np.zeros((2, 256), np.int64)
    order, word, before = sorted(lengths, key=lambda s: (lengths[s], s)), 0, 0
    for s in order:
        word <<= lengths[s] - before
        before = lengths[s]
        code[:, s] = word, before
        word += 1
    return code[0], code[1], bytes(np.bincount(list(lengths.values()), minlength=17)[1:].tolist()) + bytes(order)


def _size(values: np.ndarray) -> np.ndarray:
    """Bits of a value's magnitude."""
    return np.where(values == 0, 0, np.floor(np.log2(np.maximum(np.abs(values), 1))).astype(int) + 1)


def _symbols(blocks: np.ndarray, previous: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of blocks in zigzag order, each with the first value of the one before: (block, order, symbol, extra bits, how many)."""
    n = len(blocks)
    first = blocks[:, 0] - previous
    block, place = np.nonzero(blocks[:, 1:])
    place += 1
    value = blocks[block, place]
    same = np.concatenate(([False], block[1:] == block[:-1]))
    run = place - np.where(same, np.concatenate(([0], place[:-1])), 0) - 1
    long = np.repeat(np.arange(len(run)), run // 16)  # sixteen zeros are a symbol of their own
    last = np.zeros(n, int)
    np.maximum.at(last, block, place)
    short = np.flatnonzero(last < 63)
    parts = (
        (np.arange(n), np.zeros(n, int), _size(first), first), (block[long], place[long] * 2 - 1, np.full(len(long), 0xF0), np.zeros(len(long), int)),
        (block, place * 2, run % 16 * 16 + _size(value), value), (short, np.full(len(short), 200), np.zeros(len(short), int), np.zeros(len(short), int)),
    )
    where, order, symbol, value = (np.concatenate(x) for x in zip(*parts))
    bits = _size(value)
    return where, order, symbol, np.where(value < 0, value + (1 << bits) - 1, value), bits


def _blocks(plane: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Rows of blocks by columns of blocks by 64 quantised values in zigzag order."""
    h, w = plane.shape
    cut = plane.reshape(h // 8, 8, w // 8, 8).transpose(0, 2, 1, 3) - 128.0
    return np.rint((_COSINES @ cut @ _COSINES.T).reshape(h // 8, w // 8, 64) / table).astype(int)[:, :, ZIGZAG]


def jpeg(frame: np.ndarray, quality: int = QUALITY) -> bytes:
    """A frame of blue, green and red as a baseline JPEG."""
    height, width = frame.shape[:2]
    wide = np.pad(frame.astype(float), ((0, -height % 16), (0, -width % 16), (0, 0)), "edge")
    b, g, r = np.moveaxis(wide, 2, 0)
    y = 0.299 * r + 0.587 * g + 0.114 * b
    half = lambda p: p.reshape(p.shape[0] // 2, 2, -1, 2).mean((1, 3)) + 128
    tables = steps(BRIGHTNESS, quality), steps(COLOUR, quality)
    bright, blue, red = (_blocks(p, tables[k]) for p, k in ((y, 0), (half((b - y) * 0.564), 1), (half((r - y) * 0.713), 1)))
    rows, columns = blue.shape[:2]
    bright = bright.reshape(rows, 2, columns, 2, 64).transpose(0, 2, 1, 3, 4).reshape(-1, 64)  # four to each of colour
    parts = []
    for k, (blocks, place) in enumerate(((bright, np.arange(len(bright)) // 4 * 6 + np.arange(len(bright)) % 4), (blue.reshape(-1, 64), np.arange(rows * columns) * 6 + 4), (red.reshape(-1, 64), np.arange(rows * columns) * 6 + 5))):
        where, order, symbol, extra, bits = _symbols(blocks, np.concatenate(([0], blocks[:-1, 0])))
        parts.append((place[where], order, symbol, extra, bits, np.full(len(where), int(k > 0)) * 2 + (order > 0)))
    where, order, symbol, extra, bits, kind = (np.concatenate(x) for x in zip(*parts))
    word, length, written = np.zeros(len(where), int), np.zeros(len(where), int), []
    for k in range(4):
        mine = kind == k
        found, n = np.unique(symbol[mine], return_counts=True)
        code, size, table = _words(_code_lengths(dict(zip(found.tolist(), n.tolist()))))
        word[mine], length[mine] = code[symbol[mine]], size[symbol[mine]]
        written.append(bytes([(k & 1) << 4 | k >> 1]) + table)
    o = np.lexsort((order, where))
    word, length = ((word << bits) | extra)[o], (length + bits)[o]
    at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    stream = (np.repeat(word, length) >> (np.repeat(length, length) - 1 - at)) & 1
    stream = np.concatenate((stream, np.ones(-len(stream) % 8, int)))
    data = np.packbits(stream.astype(np.uint8)).tobytes().replace(b"\xff", b"\xff\0")
    part = lambda mark, body: bytes([0xFF, mark]) + (len(body) + 2).to_bytes(2, "big") + body
    head = part(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0") + b"".join(part(0xDB, bytes([k]) + bytes(t[ZIGZAG].tolist())) for k, t in enumerate(tables))
    shape = b"\x08" + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes((3, 1, 0x22, 0, 2, 0x11, 1, 3, 0x11, 1))
    return b"\xff\xd8" + head + part(0xC0, shape) + b"".join(part(0xC4, t) for t in written) + part(0xDA, bytes((3, 1, 0, 2, 0x11, 3, 0x11, 0, 63, 0))) + data + b"\xff\xd9"


def _fill(frame: np.ndarray, left: int, top: int, right: int, bottom: int, colour: tuple[int, int, int]) -> None:
    frame[max(top, 0) : max(bottom, 0), max(left, 0) : max(right, 0)] = colour


def write_text(frame: np.ndarray, text: str, x: int, y: int, dot: int, colour: tuple[int, int, int]) -> None:
    """A line whose lower left corner is at (x, y), in dots of some pixels; letters without a picture are blank."""
    text = text.lower()
    dots = np.zeros((5, 4 * len(text)), bool)
    for n, letter in enumerate(text):
        if letter in _DOTS:
            dots[:, 4 * n : 4 * n + 3] = _DOTS[letter]
    wide, top = dots.repeat(dot, 0).repeat(dot, 1), y - 5 * dot
    part = frame[max(top, 0) : max(top + wide.shape[0], 0), max(x, 0) : max(x + wide.shape[1], 0)]
    part[wide[max(-top, 0) :, max(-x, 0) :][: part.shape[0], : part.shape[1]]] = colour


def annotated(frame: np.ndarray, boxes: list[dict], line: str) -> np.ndarray:
    """The frame with outlined boxes (x1, y1, x2, y2, score) and a line of text."""
    out = frame.copy()
    for b in boxes:
        x1, y1, x2, y2 = (round(b[n]) for n in ("x1", "y1", "x2", "y2"))
        for edge in ((x1 - 1, y1 - 1, x2 + 1, y1 + 1), (x1 - 1, y2 - 1, x2 + 1, y2 + 1), (x1 - 1, y1 - 1, x1 + 1, y2 + 1), (x2 - 1, y1 - 1, x2 + 1, y2 + 1)):
            _fill(out, *edge, BOX_COLOUR)
        write_text(out, f"hand {b['score']:.2f}", x1, max(18, y1 - 5), 2, BOX_COLOUR)
    write_text(out, line, 12, 24, 3, TEXT_COLOUR)
    return out


def _shaped(raw: pa.Scalar, height: int | None, width: int | None) -> np.ndarray | None:
    if not raw.is_valid or not height or not width or len(data := raw.as_buffer()) != height * width * 3:
        return None
    return np.frombuffer(data, np.uint8).reshape(height, width, 3)


def rendered(frame: Column, height: Column, width: Column, boxes: Column, line: Column, most_width: int = MOST_WIDTH, quality: int = QUALITY) -> Column:
    """Frames with their boxes and a line of text as JPEG, at most ``most_width`` wide; null where a frame isn't whole."""

    @F.arrow_udf("binary")
    def run(frames: pa.Array, h: pa.Array, w: pa.Array, held: pa.Array, lines: pa.Array) -> pa.Array:
        out, weights = [], lru_cache(64)(area_weights)
        for raw, rows, columns, boxes_, line_ in zip(frames, h.to_pylist(), w.to_pylist(), held.to_pylist(), lines.to_pylist()):
            image = _shaped(raw, rows, columns)
            if image is not None:
                image = annotated(image, boxes_ or [], line_ or "")
                if columns > most_width:
                    to = max(1, round(rows * most_width / columns))
                    image = np.rint(np.einsum("ij,jkc,lk->ilc", weights(rows, to), image.astype(float), weights(columns, most_width), optimize=True)).astype(np.uint8)
                image = jpeg(image, quality)
            out.append(image)
        return pa.array(out, pa.binary())

    return run(frame, height, width, boxes, line)


def rendered_evidence(candidates: DataFrame, frames: DataFrame, clip: str, order: str = "seq", most_width: int = MOST_WIDTH, bgr: Column | None = None) -> DataFrame:
    """candidates(clip, reason, seq, t, score, boxes) and frames(clip, seq, height, width, bgr) to (clip, reason, slot, t, score, image, sha256,
    size_bytes): first, worst (the earliest of equals) and last of each reason, a moment and image once. Frames of other candidates aren't read on.
    ``bgr`` reads or draws a frame from its row's other columns, of those that are picked only; a frame that is picked twice is rendered once.
    Then there are as many partitions as the session shuffles into, as a frame's work is far more than such a row's bytes say."""
    own = F.struct(order, "t", "score", "boxes")
    picked = candidates.groupBy(clip, "reason").agg(F.min_by(own, order).alias("a"), F.max_by(own, F.struct("score", (-F.col(order)).alias("o"))).alias("b"), F.max_by(own, order).alias("c"))
    slots = picked.select(clip, "reason", F.posexplode(F.array("a", "b", "c")).alias("slot", "e"), (F.col("a") == F.col("b")).alias("_ab"), (F.col("c").isin(F.col("a"), F.col("b"))).alias("_c"))
    again = ((F.col("slot") == 1) & F.col("_ab")) | ((F.col("slot") == 2) & F.col("_c"))
    slots = slots.where(~F.coalesce(again, F.lit(False))).select(clip, "reason", "slot", "e.*")
    line = F.format_string("%s t=%.3fs", "reason", "t")
    found = slots.join(frames, [clip, order])
    if bgr is not None:
        partitions = int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        found = found.repartition(partitions, F.xxhash64(clip, order)).withColumn("bgr", bgr)
    # as an array that is exploded: a filter on an image would be pushed below its step, which would then run twice
    image = rendered(F.col("bgr"), F.col("height"), F.col("width"), F.col("boxes"), line, most_width)
    drawn = found.withColumn("image", F.explode(F.array_compact(F.array(image))))
    hashed = drawn.select(clip, "reason", "slot", "t", "score", "image", F.sha2("image", 256).alias("sha256"), F.octet_length("image").cast("long").alias("size_bytes"))
    once = hashed.groupBy(clip, "reason", "t", "sha256").agg(F.min(F.struct("slot", "score", "image", "size_bytes")).alias("e"))
    return once.select(clip, "reason", "e.slot", "t", "e.score", "e.image", "sha256", "e.size_bytes")


def _between(n: int, m: int) -> np.ndarray:
    """m by n: weights of neighbours for values between pixels, by the middles of m equal parts."""
    at = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
    low = np.minimum(at.astype(int), max(n - 2, 0))
    out = np.zeros((m, n))
    out[np.arange(m), low] = 1 - (at - low)
    if n > 1:
        out[np.arange(m), low + 1] = at - low
    return out


def letterboxed(frame: np.ndarray, height: int, width: int) -> tuple[np.ndarray, float]:
    """Planes of blue, green, red for a detector of that input: the frame scaled to fit into the upper left corner, padded and normalised, and the
    factor that boxes are divided by to be on the frame again."""
    rows, columns = frame.shape[:2]
    ratio = min(height / rows, width / columns)
    to_h, to_w = max(1, int(rows * ratio)), max(1, int(columns * ratio))
    out = np.full((height, width, 3), PADDING, np.uint8)
    out[:to_h, :to_w] = np.clip(np.rint(np.einsum("ij,jkc,lk->ilc", _between(rows, to_h), frame.astype(float), _between(columns, to_w), optimize=True)), 0, 255)
    return ((out.astype(np.float32) - np.array(MEAN, np.float32)) / np.array(SPREAD, np.float32)).transpose(2, 0, 1), ratio


def detector_input(frame: Column, height: Column, width: Column, to_height: int, to_width: int) -> Column:
    """Frames to struct(planes: binary of 32-bit floats, plane by plane, ratio); null where a frame isn't whole."""

    @F.arrow_udf("struct<planes binary, ratio double>")
    def run(frames: pa.Array, h: pa.Array, w: pa.Array) -> pa.Array:
        out = []
        for raw, rows, columns in zip(frames, h.to_pylist(), w.to_pylist()):
            image = _shaped(raw, rows, columns)
            if image is not None:
                planes, ratio = letterboxed(image, to_height, to_width)
                image = {"planes": np.ascontiguousarray(planes).tobytes(), "ratio": ratio}
            out.append(image)
        return pa.array(out, pa.struct([("planes", pa.binary()), ("ratio", pa.float64())]))

    return run(frame, height, width)
