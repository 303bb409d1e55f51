import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.sources import frames, media


def box(kind, *parts):
    body = b"".join(parts)
    return struct.pack(">I", 8 + len(body)) + kind + body


def full(kind, version, flags, *parts):
    return box(kind, bytes([version]) + flags.to_bytes(3, "big"), *parts)


def track(kind, width, height, scale, runs, track_id=1, codec=b"avc1", long=False, duration=None):
    total = sum(n * d for n, d in runs) if duration is None else duration
    times = struct.pack(">QQIQ", 0, 0, scale, total) if long else struct.pack(">IIII", 0, 0, scale, total)
    tkhd = full(b"tkhd", 0, 7, struct.pack(">IIIII", 0, 0, track_id, 0, total), bytes(52), struct.pack(">II", width << 16, height << 16))
    stts = full(b"stts", 0, 0, struct.pack(">I", len(runs)), *(struct.pack(">II", n, d) for n, d in runs))
    stsd = full(b"stsd", 0, 0, struct.pack(">I", 1), box(codec, bytes(70)))
    handler = full(b"hdlr", 0, 0, bytes(4), kind, bytes(12))
    return box(b"trak", tkhd, box(b"mdia", full(b"mdhd", int(long), 0, times, bytes(4)), handler, box(b"minf", box(b"stbl", stsd, stts, full(b"stsz", 0, 0, bytes(8))))))


def movie(*tracks, scale=1000, duration=0):
    return box(b"moov", full(b"mvhd", 0, 0, struct.pack(">IIII", 0, 0, scale, duration), bytes(80)), *tracks)


FTYP = box(b"ftyp", b"isom", bytes(4), b"isom")
VIDEO = track(b"vide", 640, 360, 30000, [(299, 1001), (1, 500)])
SOUND = track(b"soun", 0, 0, 48000, [(100, 1024)], 2, b"mp4a")


@pytest.mark.parametrize("data_first", (False, True))
@pytest.mark.parametrize("long", (False, True))
def test_an_index_is_read_without_the_media(tmp_path, data_first, long):
    data = (struct.pack(">I", 1) + b"mdat" + struct.pack(">Q", 16 + 30_000_000) if long else struct.pack(">I", 8 + 30_000_000) + b"mdat") + bytes(30_000_000)
    index = movie(SOUND, track(b"vide", 640, 360, 30000, [(299, 1001), (1, 500)], long=long))
    path = tmp_path / "a.mp4"
    path.write_bytes(FTYP + (data + index if data_first else index + data))
    got = media.info(str(path))
    seconds = (299 * 1001 + 500) / 30000
    assert (got["container"], got["codec"], got["width"], got["height"], got["frame_count"]) == ("iso", "avc1", 640, 360, 300)
    assert got["duration_seconds"] == pytest.approx(seconds) and got["fps"] == pytest.approx(300 / seconds)
    assert got["bytes_read"] < 2000  # of 30 MB


def test_long_tables_are_read_in_pieces():
    runs = [(1, 1000 + k % 3) for k in range(20_000)]
    got = media.info(FTYP + movie(track(b"vide", 8, 6, 90000, runs)))
    assert got["frame_count"] == 20_000 and got["duration_seconds"] == pytest.approx(sum(d for _, d in runs) / 90000)


def test_fragments():
    head = movie(track(b"vide", 320, 240, 1000, [], 7), box(b"mvex", full(b"trex", 0, 0, struct.pack(">IIIII", 7, 1, 40, 0, 0))))
    moof = lambda *runs: box(b"moof", box(b"traf", full(b"tfhd", 0, 0x020000, struct.pack(">I", 7)), *runs))
    plain = full(b"trun", 0, 1, struct.pack(">Ii", 25, 0))
    own = full(b"trun", 0, 0x301, struct.pack(">Ii", 3, 0), *(struct.pack(">II", d, 99) for d in (10, 20, 30)))
    set_ = box(b"moof", box(b"traf", full(b"tfhd", 0, 0x8, struct.pack(">II", 7, 50)), full(b"trun", 0, 0, struct.pack(">I", 2))))
    other = box(b"moof", box(b"traf", full(b"tfhd", 0, 0, struct.pack(">I", 8)), plain))
    got = media.info(FTYP + head + moof(plain) + box(b"mdat", bytes(999)) + moof(own, plain) + set_ + other)
    assert got["frame_count"] == 25 + 3 + 25 + 2 and got["duration_seconds"] == pytest.approx((50 * 40 + 60 + 100) / 1000)


def test_a_track_without_samples_lasts_as_the_movie():
    got = media.info(FTYP + movie(track(b"vide", 4, 2, 600, [], duration=0), scale=500, duration=1250))
    assert got["duration_seconds"] == 2.5 and got["frame_count"] == 0 and got["fps"] == 0


def test_damaged_and_other_files(spark, tmp_path):
    whole = FTYP + movie(VIDEO)
    files = {"cut.mp4": whole[:-40], "small.mp4": struct.pack(">I", 4) + b"moov", "empty.mp4": b"", "text.txt": b"no clip at all", "sound.mp4": FTYP + movie(SOUND), "good.mp4": whole, "flat.mp4": FTYP + movie(track(b"vide", 0, 360, 30, [(9, 1)]))}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    rows = {r.path.rsplit("/", 1)[1]: r for r in frames.probe(spark, str(tmp_path)).collect()}
    assert {n for n, r in rows.items() if r.valid} == {"good.mp4"} and set(rows) == set(files) - {"empty.mp4"}  # Spark lists no empty files
    assert rows["good.mp4"].length == len(whole) and rows["flat.mp4"].width == 0 and media.info(b"") is None
    gone = spark.createDataFrame([("/no/such/file.mp4",), (None,)], "path string")
    assert [r.valid for r in media.probed_clips(gone).collect()] == [False, False]
    held = spark.createDataFrame([(1, bytearray(whole)), (2, None)], "k int, head binary")
    assert [(r.k, r.frame_count) for r in media.probed_clips(held, "head").orderBy("k").collect()] == [(1, 300), (2, 0)]
    with pytest.raises(Exception, match="isn't a clip"):
        frames.read_frames(spark, [str(tmp_path / "good.mp4")], 5.0).collect()


def test_frames_are_dealt_out_scaled_and_coloured(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(frames, "RANGE", 4)
    rng = np.random.default_rng(3)
    raw = [rng.integers(16, 236, 12 * 8 + 2 * 24, dtype=np.uint8) for _ in range(30)]
    (tmp_path / "c.y4m").write_bytes(b"YUV4MPEG2 W12 H8 F10:1\n" + b"".join(b"FRAME\n" + f.tobytes() for f in raw))
    clips = frames.probe(spark, str(tmp_path))
    assert clips.first().bytes_read <= 1100 + 12
    out = frames.sampled_frames(clips, 4.0, 6, True)
    rows = out.orderBy("sample").collect()
    at = [round(k * 2.5) for k in range(12)]
    assert [(r.sample, r.width, r.height, r.t) for r in rows] == [(k, 6, 4, k / 4) for k in range(12)]
    for r, k in zip(rows, at):
        luma = raw[k][:96].reshape(8, 12).astype(float)
        assert np.abs(np.frombuffer(r.luma, np.uint8).reshape(4, 6) - luma.reshape(4, 2, 6, 2).mean((1, 3))).max() <= 0.5
        y, u, v = luma, *(raw[k][96 + 24 * c : 120 + 24 * c].reshape(4, 6).repeat(2, 0).repeat(2, 1) - 128.0 for c in (0, 1))
        blue = (1.164 * (y - 16) + 2.017 * u).reshape(4, 2, 6, 2).mean((1, 3))
        assert np.abs(np.frombuffer(r.bgr, np.uint8).reshape(4, 6, 3)[:, :, 0] - np.clip(blue, 0, 255)).max() <= 0.51
    assert out.where("sample >= 100").count() == 0 and out.select(F.countDistinct("sample")).first()[0] == 12
