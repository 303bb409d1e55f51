"""What a clip's file says about itself: ISO media files (MP4, MOV, fragmented ones too) from their index, raw video (``.y4m``) from its header.

A file is read by ranges: box headers by eight or sixteen bytes, of the index the few boxes that a probe needs, of raw video the first line. The
media data is skipped whatever its size and place. The walk also takes bytes, such as a column of heads.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Boxes that hold boxes, of those that the walk enters.
_HOLDERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"mvex", b"moof", b"traf"}
#: Bytes of one read of a table of durations, and the largest of the other boxes that are read.
_PIECE, _MOST = 1 << 16, 1 << 12
HEADER = re.compile(rb"YUV4MPEG2((?: [A-Z][^ \n]*)*)\n")
MARK = b"FRAME\n"
INFO = "struct<container string, codec string, width int, height int, fps double, frame_count long, duration_seconds double, header_bytes long, bytes_read long>"
_INFO_ARROW = pa.struct([("container", pa.string()), ("codec", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("fps", pa.float64()), ("frame_count", pa.int64()), ("duration_seconds", pa.float64()), ("header_bytes", pa.int64()), ("bytes_read", pa.int64())])


class Ranges:
    """A file of any store that Arrow reaches, or bytes, read by ranges; ``read`` counts what was asked for."""

    def __init__(self, source: str | bytes | memoryview):
        self.read = 0
        if isinstance(source, str):
            import pyarrow.fs as pafs

            fs, at = pafs.FileSystem.from_uri(source) if "://" in source or source.startswith("file:/") else (pafs.LocalFileSystem(), source)
            self.file = fs.open_input_file(at)
        else:
            self.file = pa.BufferReader(source)
        self.size = self.file.size()

    def at(self, offset: int, n: int) -> bytes:
        n = max(0, min(n, self.size - offset))
        self.read += n
        self.file.seek(min(offset, self.size))
        return self.file.read(n)

    def __enter__(self) -> Ranges:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()


def _number(raw: bytes) -> int:
    return int.from_bytes(raw, "big")


def boxes(file: Ranges, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(type, where its content begins, its end) of the boxes in a range; stops at one that isn't whole."""
    while end - start >= 8:
        head = file.at(start, 8)
        size, kind, skip = _number(head[:4]), head[4:8], 8
        if size == 1:
            size, skip = _number(file.at(start + 8, 8)), 16
        elif size == 0:
            size = end - start
        if size < skip or start + size > end:
            return
        yield kind, start + skip, start + size
        start += size


def _durations(file: Ranges, start: int, end: int) -> tuple[int, int]:
    """Samples and their summed duration from a table of runs."""
    left, at, samples, total = _number(file.at(start + 4, 4)), start + 8, 0, 0
    while left and at < end:
        raw = file.at(at, min(left * 8, _PIECE, end - at))
        for k in range(0, len(raw) - 7, 8):
            n = _number(raw[k : k + 4])
            samples, total = samples + n, total + n * _number(raw[k + 4 : k + 8])
        left, at = left - len(raw) // 8, at + len(raw)
        if len(raw) < 8:
            break
    return samples, total


def _scaled_time(raw: bytes) -> tuple[int, int]:
    """Time scale and duration of a movie's or track's header, in its short or long form."""
    return (_number(raw[20:24]), _number(raw[24:32])) if raw[:1] == b"\1" else (_number(raw[12:16]), _number(raw[16:20]))


def _run(file: Ranges, start: int, end: int, duration: int) -> tuple[int, int]:
    """Samples and their summed duration of a fragment's run; ``duration`` holds where samples have none of their own."""
    raw = file.at(start, 8)
    flags, n = _number(raw[1:4]), _number(raw[4:8])
    width = 4 * sum(bool(flags & f) for f in (0x100, 0x200, 0x400, 0x800))
    if not flags & 0x100:
        return n, n * duration
    at, total = start + 8 + 4 * bool(flags & 1) + 4 * bool(flags & 4), 0
    for first in range(0, n, step := max(1, _PIECE // width)):
        raw = file.at(at + first * width, min(step, n - first) * width)
        total += sum(_number(raw[k : k + 4]) for k in range(0, len(raw), width))
    return n, total


def _iso(file: Ranges) -> dict | None:
    """The first video track of an ISO media file; its duration, or else the movie's."""
    tracks, movie, defaults, fragments = [], (0, 0), {}, []

    def walk(start: int, end: int, track: dict | None) -> None:
        nonlocal movie
        for kind, at, to in boxes(file, start, end):
            if kind == b"trak":
                tracks.append(mine := {})
                walk(at, to, mine)
            elif kind == b"traf":
                fragments.append(mine := {"runs": []})
                walk(at, to, mine)
            elif kind in _HOLDERS:
                walk(at, to, track)
            elif kind == b"stts" and track is not None:
                track["samples"] = _durations(file, at, to)
            elif kind == b"trun" and track is not None:
                track["runs"].append(_run(file, at, to, track.get("default", defaults.get(track.get("id"), 0))))
            elif kind in (b"mvhd", b"tkhd", b"mdhd", b"hdlr", b"stsd", b"trex", b"tfhd"):
                raw = file.at(at, min(to - at, _MOST))
                if kind == b"mvhd":
                    movie = _scaled_time(raw)
                elif kind == b"trex":
                    defaults[_number(raw[4:8])] = _number(raw[12:16])
                elif track is None:
                    continue
                elif kind == b"tkhd":
                    track["id"] = _number(raw[20:24] if raw[:1] == b"\1" else raw[12:16])
                    track["width"], track["height"] = _number(raw[-8:-6]), _number(raw[-4:-2])
                elif kind == b"mdhd":
                    track["time"] = _scaled_time(raw)
                elif kind == b"hdlr":
                    track["kind"] = raw[8:12]
                elif kind == b"stsd":
                    track["codec"] = raw[12:16].decode("latin-1").strip("\0 ")
                elif kind == b"tfhd":
                    flags, track["id"] = _number(raw[1:4]), _number(raw[4:8])
                    skip = 8 + 8 * bool(flags & 1) + 4 * bool(flags & 2)
                    if flags & 8:
                        track["default"] = _number(raw[skip : skip + 4])

    walk(0, file.size, None)
    video = next((t for t in tracks if t.get("kind") == b"vide"), None)
    if video is None:
        return None
    scale, duration = video.get("time", (0, 0))
    frames, total = video.get("samples", (0, 0))
    for f in fragments:
        if f.get("id") == video.get("id"):
            for n, ticks in f["runs"]:
                frames, total = frames + n, total + ticks
    ticks = total or duration
    seconds = ticks / scale if scale and ticks else movie[1] / movie[0] if movie[0] else 0.0
    return {"container": "iso", "codec": video.get("codec") or "unknown", "width": video.get("width", 0), "height": video.get("height", 0), "fps": frames / seconds if seconds else 0.0, "frame_count": frames, "duration_seconds": seconds, "header_bytes": 0}


def frame_bytes(width: int, height: int) -> int:
    return width * height + 2 * ((width + 1) // 2) * ((height + 1) // 2)


def _raw(file: Ranges) -> dict | None:
    found = HEADER.match(file.at(0, 1024))
    if not found:
        return None
    tags = {x[:1]: x[1:] for x in found[1].decode("latin-1").split()}
    width, height = (int(v) if (v := tags.get(k, "")).isdigit() else 0 for k in "WH")
    top, _, bottom = tags.get("F", "").partition(":")
    fps = int(top) / int(bottom or 1) if top.isdigit() and (bottom or "1").isdigit() and int(bottom or 1) else 0.0
    body = file.size - found.end()
    frames = body // (len(MARK) + frame_bytes(width, height)) if width > 0 and height > 0 else 0
    return {"container": "y4m", "codec": "rawvideo", "width": width, "height": height, "fps": fps, "frame_count": frames, "duration_seconds": frames / fps if fps else 0.0, "header_bytes": found.end()}


def info(source: str | bytes | memoryview) -> dict | None:
    """``INFO`` of a file or of bytes; None where neither form is found."""
    with Ranges(source) as file:
        head = file.at(0, 12)
        got = _raw(file) if head.startswith(b"YUV4MPEG2") else _iso(file) if len(head) >= 8 else None
        return None if got is None else got | {"bytes_read": file.read}


def clip_info(source: Column) -> Column:
    """``INFO`` of paths or of bytes, as a column; null for null, what isn't a clip, and what can't be opened."""

    @F.arrow_udf(INFO)
    def run(column: pa.Array) -> pa.Array:
        out = []
        for x in column:
            try:
                out.append(info(x.as_py() if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else x.as_buffer()) if x.is_valid else None)
            except OSError:
                out.append(None)
        return pa.array(out, _INFO_ARROW)

    return run(source)


def probed_clips(files: DataFrame, source: str = "path") -> DataFrame:
    """files(..., source) with the columns of ``INFO`` and ``valid``: dimensions, a rate and a duration above zero."""
    out = files.withColumn("_info", clip_info(F.col(source))).select(*files.columns, "_info.*")
    empty = {"width": 0, "height": 0, "fps": 0.0, "frame_count": 0, "duration_seconds": 0.0}
    return out.fillna(empty).withColumn("valid", (F.col("width") > 0) & (F.col("height") > 0) & (F.col("fps") > 0) & (F.col("duration_seconds") > 0))
