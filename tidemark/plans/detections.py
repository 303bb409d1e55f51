"""Queries on boxes and on a run's telemetry. ``lineitem`` stands in for detections (an order is a frame), ``events`` for telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import boxes, telemetry
from tidemark.plans.gate import iou_sql, query, suppression_sql
from tidemark.plans.tables import read

SHARE, SCALE, RATIO, OVERLAP = 0.25, 0.5, 0.4, 0.15
_B = "WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity * 10 AS x1, l_discount * 1000 AS y1, l_quantity * 10 + (50 + l_linenumber * 7) AS x2, l_discount * 1000 + (30 + l_tax * 1000) AS y2 FROM lineitem)"


def _detections(spark, sf_dir):
    x1, y1 = F.col("l_quantity") * 10, F.col("l_discount") * 1000
    box = F.struct(x1.alias("x1"), y1.alias("y1"), (x1 + (F.col("l_linenumber") * 7 + 50)).alias("x2"), (y1 + (F.col("l_tax") * 1000 + 30)).alias("y2"), (1 - F.col("l_discount")).alias("score"))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", box.alias("box"))


@query(_B + """ SELECT l_orderkey, l_linenumber, CAST(trunc(greatest(0e0, (x1 - (x2 - x1) * 25e-2) * 5e-1)) AS INT) AS x1, CAST(trunc(greatest(0e0, (y1 - (y2 - y1) * 25e-2) * 5e-1)) AS INT) AS y1,
CAST(trunc(least(320e0, (x2 + (x2 - x1) * 25e-2) * 5e-1)) AS INT) AS x2, CAST(trunc(least(180e0, (y2 + (y2 - y1) * 25e-2) * 5e-1)) AS INT) AS y2 FROM b""")
def p11_expanded_boxes(spark, sf_dir):
    grown = boxes.expanded(F.col("box"), SHARE, SCALE, SCALE, 320, 180)
    return _detections(spark, sf_dir).select("l_orderkey", "l_linenumber", grown.alias("g")).select("l_orderkey", "l_linenumber", "g.*")


@query(_B + """ SELECT l_orderkey, l_linenumber, round(least(greatest(x1 / 4e-1, 0e0), 1280e0), 6) AS x1, round(least(greatest(y1 / 4e-1, 0e0), 720e0), 6) AS y1,
round(least(greatest(x2 / 4e-1, 0e0), 1280e0), 6) AS x2, round(least(greatest(y2 / 4e-1, 0e0), 720e0), 6) AS y2 FROM b""")
def p12_unscaled_boxes(spark, sf_dir):
    box = boxes.unscaled(F.col("box"), RATIO, F.lit(1280), F.lit(720))
    return _detections(spark, sf_dir).select("l_orderkey", "l_linenumber", box.alias("g")).select("l_orderkey", "l_linenumber", *(F.round(f"g.{c}", 6).alias(c) for c in ("x1", "y1", "x2", "y2")))


@query("""WITH f AS (SELECT p_partkey, 641 + p_size * 8 AS w, 361 + p_size * 4 AS h FROM part),
s AS (SELECT *, least(w, CAST(round_even(w * (5e-1 + 15e-2 / 2e0), 0) AS INT)) AS tw, least(h, CAST(round_even(h * (5e-1 + 15e-2 / 2e0), 0) AS INT)) AS th FROM f)
SELECT p_partkey, tile, tw AS w, th AS h, (CASE WHEN tile % 2 = 1 THEN w - tw ELSE 0 END) + 5 AS x1, (CASE WHEN tile >= 2 THEN h - th ELSE 0 END) + 6 AS y1 FROM s, (SELECT unnest([0, 1, 2, 3]) AS tile) t""")
def p13_p14_tiles(spark, sf_dir):
    frames = read(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 8 + 641).alias("w"), (F.col("p_size") * 4 + 361).alias("h"))
    cut = frames.select("p_partkey", F.posexplode(boxes.tiles(F.col("w"), F.col("h"), OVERLAP)).alias("tile", "t"))
    local = F.struct(F.lit(5).alias("x1"), F.lit(6).alias("y1"), F.lit(20).alias("x2"), F.lit(20).alias("y2"))
    return cut.withColumn("b", boxes.on_frame(local, F.col("t"))).select("p_partkey", "tile", "t.w", "t.h", "b.x1", "b.y1")


def _matched(spark, sf_dir):
    held = lambda odd: F.transform(F.array_sort(F.collect_list(F.when(F.col("l_linenumber") % 2 == odd, F.struct("l_linenumber", "box")))), lambda s: s["box"])
    frames = _detections(spark, sf_dir).groupBy("l_orderkey").agg(held(1).alias("old"), held(0).alias("new"))
    return frames.select("l_orderkey", (F.size("old") == F.size("new")).alias("count_match"), boxes.greedy_matches(F.col("old"), F.col("new")).alias("matches"))


_IOU = iou_sql("c", "o.b", "0")
_MATCH = f"""WITH RECURSIVE b AS (SELECT l_orderkey, l_linenumber, {{'x1': l_quantity * 10, 'y1': l_discount * 1000, 'x2': l_quantity * 10 + (l_linenumber * 7 + 50), 'y2': l_discount * 1000 + (l_tax * 1000 + 30), 'score': 1 - l_discount}} AS b FROM lineitem),
o AS (SELECT l_orderkey, b, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, b) AS n FROM b WHERE l_linenumber % 2 = 1), w AS (SELECT l_orderkey, list(b ORDER BY l_linenumber, b) AS new FROM b WHERE l_linenumber % 2 = 0 GROUP BY 1),
s AS (SELECT l_orderkey, count(*) FILTER (WHERE l_linenumber % 2 = 1) AS n_old, count(*) FILTER (WHERE l_linenumber % 2 = 0) AS n_new FROM b GROUP BY 1),
f AS (SELECT s.l_orderkey, 0 AS n, coalesce(new, []) AS "left", CAST([] AS STRUCT(iou DOUBLE, delta DOUBLE)[]) AS matches FROM s LEFT JOIN w USING (l_orderkey) UNION ALL
SELECT q.l_orderkey, q.n, CASE WHEN spot IS NULL THEN q."left" ELSE list_filter(q."left", lambda x, i: i <> spot) END, CASE WHEN spot IS NULL THEN q.matches ELSE list_append(q.matches, {{'iou': ious[spot], 'delta': abs(q.b.score - q."left"[spot].score)}}) END
FROM (SELECT *, list_position(ious, list_max(ious)) AS spot FROM (SELECT o.l_orderkey, o.n, o.b, f."left", f.matches, list_transform(f."left", lambda c: {_IOU}) AS ious FROM f JOIN o ON o.l_orderkey = f.l_orderkey AND o.n = f.n + 1)) q),
m AS (SELECT l_orderkey, arg_max(matches, n) AS matches FROM f GROUP BY 1)"""


@query(_MATCH + " SELECT s.l_orderkey, n_old = n_new AS count_match, len(matches)::INT AS matched, round(coalesce(list_sum(list_transform(matches, lambda x: sqrt(x.iou))), 0e0), 6) AS root_iou, round(coalesce(list_sum(list_transform(matches, lambda x: x.delta)), 0e0), 6) AS score_delta FROM s JOIN m USING (l_orderkey)")
def j07_greedy_matching(spark, sf_dir):
    total = lambda f: F.round(F.aggregate("matches", F.lit(0.0), lambda acc, m: acc + f(m)), 6)
    return _matched(spark, sf_dir).select("l_orderkey", "count_match", F.size("matches").alias("matched"), total(lambda m: F.sqrt(m["iou"])).alias("root_iou"), total(lambda m: m["score_delta"]).alias("score_delta"))


@query(_MATCH + """, x AS (SELECT l_orderkey, unnest(matches, recursive := true) FROM m), y AS (SELECT coalesce(min(iou), 1e0) AS lo, coalesce(avg(iou), 1e0) AS mean, coalesce(max(delta), 0e0) AS d, count(*) AS k FROM x), z AS (SELECT count(*) AS frames, avg(CASE WHEN n_old = n_new THEN 1e0 ELSE 0e0 END) AS same FROM s)
SELECT frames, round(same, 6) AS count_match_fraction, k AS matched_boxes, round(lo, 6) AS min_iou, round(mean, 6) AS mean_iou, round(d, 6) AS max_score_delta, same = 1 AND lo >= 9e-1 AND d <= 3e-2 AS passed FROM y, z""")
def a26_f15_detector_parity(spark, sf_dir):
    out = boxes.parity(_matched(spark, sf_dir), 0.90, 0.03)
    return out.withColumns({c: F.round(c, 6) for c in ("count_match_fraction", "min_iou", "mean_iou", "max_score_delta")})


def _classed(spark, sf_dir):
    box = F.struct("l_linenumber", (F.col("l_partkey") % 60).cast("double").alias("x1"), (F.col("l_suppkey") % 60).cast("double").alias("y1"), ((F.col("l_partkey") % 60) + F.col("l_quantity") + 30).alias("x2"), ((F.col("l_suppkey") % 60) + F.col("l_quantity") + 30).alias("y2"), (1 - F.col("l_discount") * 8).alias("score"), (F.col("l_linenumber") % 2).alias("class_id"))
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(box)).alias("d"))


_CLASSED = "WITH RECURSIVE d AS (SELECT l_orderkey AS frame, l_linenumber, {'n': l_linenumber, 'x1': (l_partkey % 60)::DOUBLE, 'y1': (l_suppkey % 60)::DOUBLE, 'x2': (l_partkey % 60) + l_quantity + 30, 'y2': (l_suppkey % 60) + l_quantity + 30, 'score': 1 - l_discount * 8, 'class_id': l_linenumber % 2} AS b FROM lineitem)"


@query(_CLASSED + " SELECT frame AS l_orderkey, count(*) FILTER (WHERE b.score >= 3e-1) AS kept FROM d GROUP BY 1")
def f09_confident_detections(spark, sf_dir):
    return _classed(spark, sf_dir).select("l_orderkey", F.size(boxes.confident(F.col("d"), 0.3)).cast("long").alias("kept"))


@query(_CLASSED + f", x AS (SELECT frame, b, row_number() OVER (PARTITION BY frame ORDER BY b.score DESC, b DESC) AS place FROM d), {suppression_sql('x', '45e-2', True)} SELECT frame AS l_orderkey, array_to_string(list_transform(kept, lambda k: k.n), ',') AS kept FROM kept")
def t04_suppression_by_class(spark, sf_dir):
    kept = boxes.suppressed_by_class(F.col("d"), 0.45)
    return _classed(spark, sf_dir).select("l_orderkey", F.array_join(F.transform(kept, lambda k: k["l_linenumber"]), ",").alias("kept"))


@query(_CLASSED + f""", u AS (SELECT frame, count(*) FILTER (WHERE l_linenumber = 1 AND b.score >= 5e-1) AS n FROM d GROUP BY 1), t AS (SELECT d.frame, d.l_linenumber, d.b FROM d JOIN u USING (frame) WHERE n = 0 AND l_linenumber > 1),
x AS (SELECT frame, b, row_number() OVER (PARTITION BY frame ORDER BY b.score DESC, b DESC) AS place FROM t), {suppression_sql('x', '45e-2', False)}
SELECT u.frame AS l_orderkey, CASE WHEN n > 0 THEN repeat('1,', (n - 1)::INT) || '1' ELSE coalesce(array_to_string(list_transform(kept, lambda k: k.n), ','), '') END AS kept FROM u LEFT JOIN kept USING (frame)""")
def u03_v08_tile_fallback(spark, sf_dir):
    """A frame's first box, if it is confident, stands in for its own detections; the others for those of its tiles."""
    full = F.filter("d", lambda b: (b["l_linenumber"] == 1) & (b["score"] >= 0.5))
    merged = boxes.merged_with_tiles(full, F.filter("d", lambda b: b["l_linenumber"] > 1), 0.45)
    return _classed(spark, sf_dir).select("l_orderkey", F.array_join(F.transform(merged, lambda k: k["l_linenumber"]), ",").alias("kept"))


_STRIDES = (4, 8)


@query("""WITH p AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), c AS (SELECT row_number() OVER (ORDER BY s, y, x) - 1 AS k, x, y, s FROM (SELECT 4 AS s, x, y FROM unnest(range(0, 4)) a(x), unnest(range(0, 2)) b(y) UNION ALL SELECT 8, x, y FROM unnest(range(0, 2)) a(x), unnest(range(0, 1)) b(y))),
d AS (SELECT vec_id, k, (e[k * 6 + 1] + x) * s AS cx, (e[k * 6 + 2] + y) * s AS cy, exp(e[k * 6 + 3]) * s AS w, exp(e[k * 6 + 4]) * s AS h, e[k * 6 + 5] * e[k * 6 + 6] AS a, e[k * 6 + 5] * (1 - e[k * 6 + 6]) AS b FROM p, c)
SELECT vec_id, k::INT AS k, round((cx - w / 2) / 5e-1, 5) AS x1, round((cy - h / 2) / 5e-1, 5) AS y1, round((cx + w / 2) / 5e-1, 5) AS x2, round((cy + h / 2) / 5e-1, 5) AS y2, round(greatest(a, b), 6) AS score, CASE WHEN a >= b THEN 0 ELSE 1 END AS class_id FROM d""")
def p15_j14_v06_decoded_boxes(spark, sf_dir):
    """A vector's first 60 numbers are ten output rows of a detector for 16 by 8 pixels: a box, an objectness, and a share of the first class."""
    e = F.transform("embedding", lambda v: v.cast("double"))
    row = lambda k: F.array(*(F.get("e", k * 6 + j) for j in range(5)), F.get("e", k * 6 + 5), 1 - F.get("e", k * 6 + 5))
    rows = read(spark, sf_dir, "embeddings").select("vec_id", e.alias("e")).select("vec_id", F.transform(F.sequence(F.lit(0), F.lit(9)), row).alias("rows"))
    out = rows.select("vec_id", F.posexplode(boxes.decoded(F.col("rows"), boxes.anchors(16, 8, _STRIDES), F.lit(0.5))).alias("k", "b")).select("vec_id", "k", "b.*")
    return out.withColumns({c: F.round(c, 6 if c == "score" else 5) for c in ("x1", "y1", "x2", "y2", "score")})


_END = "WITH RECURSIVE p AS (SELECT vec_id AS frame, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), r AS (SELECT frame, k, 60 + 100 * e[k * 5 + 1] AS x1, 60 + 100 * e[k * 5 + 2] AS y1, 40 + 20 * e[k * 5 + 3] AS w, 40 + 20 * e[k * 5 + 4] AS h, e[k * 5 + 5] + 55e-2 AS s FROM p, unnest(range(0, 12)) AS t(k)),"
_END += " d AS (SELECT frame, k, {'x1': x1 / 5e-1, 'y1': y1 / 5e-1, 'x2': (x1 + w) / 5e-1, 'y2': (y1 + h) / 5e-1, 'score': s, 'class_id': 0} AS b FROM r WHERE s >= 3e-1), x AS (SELECT frame, b, row_number() OVER (PARTITION BY frame ORDER BY b.score DESC, k DESC) AS place FROM d)"


@query(_END + f", {suppression_sql('x', '45e-2', True)}, u AS (SELECT frame, unnest(kept, recursive := true) FROM kept) SELECT frame AS vec_id, round(least(greatest(x1, 0e0), 200e0), 5) AS x1, round(least(greatest(y1, 0e0), 150e0), 5) AS y1, round(least(greatest(x2, 0e0), 200e0), 5) AS x2, round(least(greatest(y2, 0e0), 150e0), 5) AS y2, round(score, 6) AS score FROM u")
def v06_end_to_end_detections(spark, sf_dir):
    """A vector's first 60 numbers are twelve output rows of a detector that decodes by itself."""
    e = F.transform("embedding", lambda v: v.cast("double"))

    def row(k):
        x, y = F.get("e", k * 5) * 100 + 60, F.get("e", k * 5 + 1) * 100 + 60
        return F.array(x, y, x + (F.get("e", k * 5 + 2) * 20 + 40), y + (F.get("e", k * 5 + 3) * 20 + 40), F.get("e", k * 5 + 4) + 0.55)

    rows = read(spark, sf_dir, "embeddings").select("vec_id", e.alias("e")).select("vec_id", F.transform(F.sequence(F.lit(0), F.lit(11)), row).alias("rows"))
    found = rows.select("vec_id", boxes.suppressed_by_class(boxes.confident(boxes.end_to_end(F.col("rows"), F.lit(0.5)), 0.3), 0.45).alias("d"))
    out = found.select("vec_id", F.explode(boxes.clipped_detections(F.col("d"), F.lit(200), F.lit(150))).alias("b")).select("vec_id", "b.*").drop("class_id")
    return out.withColumns({c: F.round(c, 6 if c == "score" else 5) for c in ("x1", "y1", "x2", "y2", "score")})


@query("SELECT event_type, round(sum(greatest(value - 50e0, 0e0)), 4) AS seconds, count(*) AS calls FROM events GROUP BY event_type")
def a17_stage_times(spark, sf_dir):
    calls = read(spark, sf_dir, "events").withColumn("s", F.col("value") - 50.0)
    return telemetry.stage_times(calls, "event_type", "s").withColumn("seconds", F.round("seconds", 4))


@query("""WITH s AS (SELECT user_id, CASE WHEN event_type = 'purchase' THEN value END AS gpu, CASE WHEN event_type = 'error' THEN value END AS cpu FROM events)
SELECT user_id, greatest(count(gpu), count(cpu)) AS samples, round(avg(gpu), 5) AS mean_gpu, max(gpu) AS peak_gpu, round(avg(cpu), 5) AS mean_cpu FROM s GROUP BY user_id""")
def a18_system_load(spark, sf_dir):
    s = read(spark, sf_dir, "events").select("user_id", F.when(F.col("event_type") == "purchase", F.col("value")).alias("gpu"), F.when(F.col("event_type") == "error", F.col("value")).alias("cpu"))
    return telemetry.system_load(s, ["user_id"], "gpu", "cpu").withColumns({c: F.round(c, 5) for c in ("mean_gpu", "mean_cpu")})


@query("""SELECT event_type, CAST(sum(event_id % 1000) AS BIGINT) AS bytes, round(sum(value), 4) AS elapsed_seconds, round(sum(event_id % 1000) / nullif(sum(value), 0e0), 6) AS bytes_per_second
FROM events WHERE event_id % 5 <> 0 GROUP BY event_type""")
def a19_transfers(spark, sf_dir):
    d = read(spark, sf_dir, "events").select("event_type", (F.col("event_id") % 1000).alias("size"), "value", (F.col("event_id") % 5 == 0).alias("reused"))
    return telemetry.transfers(d, ["event_type"], "size", "value", "reused").withColumns({"elapsed_seconds": F.round("elapsed_seconds", 4), "bytes_per_second": F.round("bytes_per_second", 6)})


@query("""SELECT event_type, count(*) AS batches, CAST(sum(event_id % 9) AS BIGINT) AS frames, round(sum(event_id % 9) / count(*), 6) AS mean_batch_size,
round(sum(value) * 1e3 / nullif(sum(event_id % 9), 0), 4) AS mean_queue_wait_ms FROM events GROUP BY event_type""")
def a20_batching(spark, sf_dir):
    b = read(spark, sf_dir, "events").select("event_type", (F.col("event_id") % 9).alias("n"), "value")
    return telemetry.batching(b, ["event_type"], "n", "value").withColumns({"mean_batch_size": F.round("mean_batch_size", 6), "mean_queue_wait_ms": F.round("mean_queue_wait_ms", 4)})
