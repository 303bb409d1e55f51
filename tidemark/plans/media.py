"""Queries on clips' files, evidence images, detector input, objects and result documents. Files and frames are drawn from the tables' values."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import evidence, images, report
from tidemark.plans.gate import query
from tidemark.plans.reporting import _CAMERA, _camera
from tidemark.plans.tables import read, spread
from tidemark.sources import objects
from tidemark.sources.media import probed_clips
from tidemark.sources.results import parsed_results


def _be(n, width: int = 8):
    """A number as hex digits, the highest first."""
    return F.lpad(F.hex(n.cast("long") if not isinstance(n, int) else F.lit(n)), width, "0")


def _box(kind: str, *parts):
    """A box as hex digits."""
    body = F.concat(*parts)
    return F.concat(_be((F.length(body) / 2 + 8).cast("long")), F.lit(kind.encode().hex().upper()), body)


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE p_size * 16 END::INT AS width, CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE p_size * 9 END::INT AS height, CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE p_partkey % 50 END::BIGINT AS frame_count,
CASE WHEN p_partkey % 5 = 0 THEN 0e0 WHEN p_partkey % 50 = 0 THEN 4e0 ELSE round(p_partkey % 50 * 1001 / 30000e0, 6) END AS duration_seconds, p_partkey % 5 <> 0 AND p_partkey % 50 <> 0 AS valid FROM part""")
def s04_iso_index(spark, sf_dir):
    """The index of an MP4 for each part, with a sound track before the video; every fifth is cut off within it."""
    k, n = F.col("p_partkey"), F.col("p_partkey") % 50
    zeros = lambda bytes_: F.lit("00" * bytes_)
    track = lambda handler, width, height, scale, samples, delta: _box(
        "trak", _box("tkhd", zeros(12), _be(1), zeros(60), _be(width, 4), zeros(2), _be(height, 4), zeros(2)),
        _box("mdia", _box("mdhd", zeros(12), _be(scale), _be(samples * delta), zeros(4)), _box("hdlr", zeros(8), F.lit(handler.encode().hex()), zeros(12)),
             _box("minf", _box("stbl", _box("stsd", zeros(4), _be(1), _box("avc1", zeros(70))), _box("stts", zeros(4), _be(1), _be(samples), _be(delta)))))
    )
    movie = _box("moov", _box("mvhd", zeros(12), _be(250), _be(1000), zeros(80)), track("soun", k * 0, k * 0, F.lit(48000), F.lit(9), F.lit(1024)), track("vide", F.col("p_size") * 16, F.col("p_size") * 9, F.lit(30000), n, F.lit(1001)))
    head = F.concat(_box("ftyp", F.lit(b"isom".hex()), zeros(4)), movie)
    cut = F.when(k % 5 == 0, F.substring(head, F.lit(1), F.length(head) - 40)).otherwise(head)
    parts = spread(read(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey")
    clips = probed_clips(parts.select("p_partkey", F.unhex(cut).alias("head")), "head")
    return clips.select("p_partkey", "width", "height", "frame_count", F.round("duration_seconds", 6).alias("duration_seconds"), "valid")


@query(_CAMERA + """, g AS (SELECT user_id, reason, min(event_id) AS i0, max(event_id) AS i2, max(score) AS m FROM (SELECT user_id, reason, event_id, score FROM c) GROUP BY 1, 2),
w AS (SELECT c.user_id, c.reason, min(c.event_id) AS i1 FROM c JOIN g ON g.user_id = c.user_id AND g.reason = c.reason AND c.score = g.m GROUP BY 1, 2),
u AS (SELECT user_id, reason, 0 AS slot, i0 AS event_id FROM g UNION ALL SELECT user_id, reason, 1, i1 FROM w UNION ALL SELECT user_id, reason, 2, i2 FROM g),
e AS (SELECT u.user_id, u.reason, min(slot) AS slot, event_id FROM u GROUP BY u.user_id, u.reason, event_id)
SELECT e.user_id, e.reason, e.slot, round(c.t, 6) AS t, round(c.score, 6) AS score, 40 AS width, 20 AS height, true AS whole FROM e JOIN c ON c.user_id = e.user_id AND c.reason = e.reason AND c.event_id = e.event_id""")
def v09_rendered_evidence(spark, sf_dir):
    """Frames of 80 by 40 pixels, rendered at half the size; the height and width are those in the JPEG."""
    camera = _camera(spark, sf_dir)
    found = evidence.camera_candidates(camera.withColumn("t", F.struct("t", "event_id")), "user_id")
    box = F.array(F.struct(*(F.lit(v).alias(n) for n, v in (("x1", 20.0), ("y1", 10.0), ("x2", 60.0), ("y2", 30.0), ("score", 0.5)))))
    candidates = found.select("user_id", "reason", F.col("t.event_id").alias("seq"), F.col("t.t").alias("t"), "score", box.alias("boxes"))
    pixel = F.lpad(F.hex(F.col("event_id") % 0xFFFFFF), 6, "0")
    frames = camera.select("user_id", F.col("event_id").alias("seq"), F.lit(40).alias("height"), F.lit(80).alias("width"), pixel.alias("pixel"))
    out = images.rendered_evidence(candidates, frames, "user_id", most_width=40, bgr=F.unhex(F.repeat("pixel", 40 * 80)))
    digits = F.hex("image")
    frame = F.instr(digits, "FFC0")  # the tables before it have no such bytes
    whole = digits.startswith("FFD8FFE0") & digits.endswith("FFD9") & (F.sha2("image", 256) == F.col("sha256")) & (F.octet_length("image") == F.col("size_bytes"))
    sides = out.withColumns({"height": F.conv(F.substring(digits, frame + 10, F.lit(4)), 16, 10).cast("int"), "width": F.conv(F.substring(digits, frame + 14, F.lit(4)), 16, 10).cast("int"), "whole": whole})
    return sides.select("user_id", "reason", "slot", F.round("t", 6).alias("t"), F.round("score", 6).alias("score"), "width", "height", "whole")


@query("""WITH f AS (SELECT p_partkey, p_size + 1 AS w, p_size % 7 + 2 AS h, p_partkey % 256 AS c FROM part), r AS (SELECT *, least(24e0 / h, 32e0 / w) AS ratio FROM f),
d AS (SELECT *, greatest(1, floor(w * ratio)::INT) * greatest(1, floor(h * ratio)::INT) AS n FROM r)
SELECT p_partkey, round(ratio, 6) AS ratio, round((n * ((c - 10353e-2) / 57375e-3) + (768 - n) * ((114 - 10353e-2) / 57375e-3)) / 768, 4) AS mean_blue FROM d""")
def v05_detector_input(spark, sf_dir):
    """A frame of one colour for each part: the mean of its first plane says how much of the input it fills."""
    w, h = F.col("p_size") + 1, F.col("p_size") % 7 + 2
    pixel = F.lpad(F.hex(F.col("p_partkey") % 256), 2, "0")
    parts = spread(read(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey")
    frames = parts.select("p_partkey", w.alias("w"), h.alias("h"), F.unhex(F.repeat(F.concat(pixel, F.lit("0000")), (w * h).cast("int"))).alias("bgr"))
    planes = frames.withColumn("i", images.detector_input(F.col("bgr"), F.col("h"), F.col("w"), 24, 32))

    @F.arrow_udf("double")
    def mean_of_first(planes_):
        import numpy as np
        import pyarrow as pa

        return pa.array([float(np.frombuffer(p.as_buffer(), "<f4", 768).mean(dtype=float)) for p in planes_])

    return planes.select("p_partkey", F.round("i.ratio", 6).alias("ratio"), F.round(mean_of_first("i.planes"), 4).alias("mean_blue"))


_TABLES = ("part", "nation", "orders")


@query("""SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'part' WHEN 1 THEN 'nation' WHEN 2 THEN 'orders' ELSE 'absent-' || n_nationkey END AS name, CASE WHEN n_nationkey % 4 = 3 THEN 'absent' WHEN n_nationkey % 3 = 0 THEN 'size' ELSE 'same' END AS state FROM nation""")
def s06_expected_objects(spark, sf_dir):
    """Tables that a nation names against the listing of the folder that they are in; a file of zero bytes is expected of every third."""
    k = F.col("n_nationkey")
    name = F.when(k % 4 == 3, F.concat(F.lit("absent-"), k)).otherwise(F.get(F.array(*map(F.lit, _TABLES)), (k % 4).cast("int")))
    expected = read(spark, sf_dir, "nation").select("n_nationkey", name.alias("name"), F.when(k % 3 == 0, 0).cast("long").alias("size_bytes"))
    folder = F.regexp_extract("key", r"^([a-z]+)\.parquet(?:/|$)", 1)
    held = objects.listing(spark, sf_dir).select(folder.alias("key"), "size_bytes").where("key <> ''").groupBy("key").agg(F.sum("size_bytes").alias("size_bytes"))
    return objects.checked(expected.withColumn("key", F.col("name")), held).select("n_nationkey", "name", "state")


@query("""SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'not a JSON object' WHEN 1 THEN 'missing: verdict' WHEN 2 THEN 'unknown: more' WHEN 3 THEN 'verdict' WHEN 4 THEN 'item_id' WHEN 5 THEN 'no result' END AS error,
CASE WHEN o_orderkey % 7 = 6 THEN 'good' END AS verdict, CASE WHEN o_orderkey % 7 = 6 THEN round(o_totalprice, 2) END AS duration_seconds FROM orders""")
def s09_results_read_back(spark, sf_dir):
    """A result document for each order, six of seven with something wrong."""
    k = F.col("o_orderkey")
    doc = F.struct(F.when(k % 7 == 4, "other").otherwise(k.cast("string")).alias("item_id"), F.lit("clips/x.mp4").alias("source_key"), F.col("o_totalprice").cast("double").alias("duration_seconds"), F.when(k % 7 == 3, "fine").when(k % 7 != 1, "good").alias("verdict"), F.when(k % 7 == 2, 1).alias("more"))
    text = F.to_json(doc)
    text = F.when(k % 7 == 0, F.substring(text, F.lit(1), F.length(text) - 5)).when(k % 7 != 5, text)
    out = parsed_results(read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("item_id"), F.lit("").alias("key"), text.alias("text")))
    return out.select(F.col("item_id").cast("long").alias("o_orderkey"), "error", F.col("result.verdict").alias("verdict"), F.round("result.duration_seconds", 2).alias("duration_seconds"))


@query("""SELECT o_orderkey, sha256('{"a":[' || o_custkey || ',{"x":null,"y":"' || o_orderstatus || '"}],"b":{"deep":{"k":' || o_orderkey || ',"z":true},"empty":{}}}') AS digest FROM orders""")
def a27_nested_document_hash(spark, sf_dir):
    """Of documents whose keys are in another order at every depth."""
    text = F.format_string('{ "b": {"empty": {}, "deep": {"z": true, "k": %d}},\n"a": [%d, {"y": "%s", "x": null}]}', "o_orderkey", "o_custkey", "o_orderstatus")
    return read(spark, sf_dir, "orders").select("o_orderkey", report.document_hash(text).alias("digest"))


@query("""SELECT c_custkey, CASE c_custkey % 10 WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN false WHEN 4 THEN true WHEN 5 THEN false WHEN 6 THEN false WHEN 7 THEN true WHEN 8 THEN true END AS public FROM customer""")
def f05_public_addresses(spark, sf_dir):
    """Addresses of both versions, of networks that are public or not; of ten the last isn't an address."""
    k = F.col("c_custkey")
    forms = ("2001:db8::%x", "2606:4700::%x", "fe80::%x:1", "::ffff:10.0.%d.1", "::ffff:8.8.%d.1", "fd00:1:2:3:4:5:6:%x", "2002:%x::", "2001:4:112::%x", "9.9.%d.9", "1:2:3:%x")
    address = F.get(F.array(*(F.format_string(f, k % 250) for f in forms)), (k % 10).cast("int"))
    return read(spark, sf_dir, "customer").select("c_custkey", C.public_address(address).alias("public"))
