"""Queries on reports, evidence, run telemetry and retries, on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import evidence, journal, report, telemetry, timeline
from tidemark.plans.gate import RATE, _clips, query
from tidemark.plans.tables import read

_S = "WITH s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) / 5e0 AS t FROM events)"


@query("""WITH i AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CASE WHEN o_orderkey % 5 = 0 THEN 0e0 ELSE o_totalprice END END AS d FROM orders), r AS (SELECT o_orderkey, o_totalprice / 2 AS d FROM orders WHERE o_orderkey % 3 <> 0)
SELECT (SELECT count(*) FROM i) AS captured_clips, (SELECT round(sum(coalesce(nullif(i.d, 0), r.d, 0)) / 3600, 4) FROM i LEFT JOIN r USING (o_orderkey)) AS captured_hours, (SELECT count(*) FROM r) AS processed_clips, (SELECT round(sum(d) / 3600, 4) FROM r) AS processed_hours""")
def a10_j09_captured_and_processed(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    items = o.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.when(F.col("o_orderkey") % 5 == 0, 0.0).otherwise(F.col("o_totalprice"))).alias("duration_seconds"))
    results = o.where("o_orderkey % 3 <> 0").select("o_orderkey", (F.col("o_totalprice") / 2).alias("duration_seconds"))
    return report.totals(items, results, "o_orderkey").withColumns({c: F.round(c, 4) for c in ("captured_hours", "processed_hours")})


@query("""WITH t AS (SELECT l_linenumber, sum(CASE WHEN l_discount < 5e-2 THEN l_quantity / 60 ELSE 0e0 END) AS h FROM lineitem GROUP BY 1) SELECT round(quantile_cont(h, 0.025), 5) AS low, round(quantile_cont(h, 0.975), 5) AS high FROM t""")
def a08_good_hours_of_samples(spark, sf_dir):
    s = read(spark, sf_dir, "lineitem").select("l_linenumber", (F.col("l_quantity") / 60).alias("hours"), (F.col("l_discount") < 0.05).alias("good"))
    return report.good_hours_of_samples(s, "hours", "l_linenumber", "good").select(F.round("low", 5).alias("low"), F.round("high", 5).alias("high"))


@query("""SELECT n_nationkey, sha256('{"even":' || CASE WHEN n_nationkey % 2 = 0 THEN 'true' ELSE 'false' END || ',"key":' || n_nationkey || ',"name":"' || replace(n_name, 'A', '\\"') || '","none":null}') AS digest FROM nation""")
def a27_canonical_hash(spark, sf_dir):
    k = F.col("n_nationkey")
    fields = {"name": F.replace("n_name", F.lit("A"), F.lit('"')), "key": k, "even": k % 2 == 0, "none": F.lit(None).cast("string")}
    return read(spark, sf_dir, "nation").select("n_nationkey", report.canonical_hash(fields).alias("digest"))


@query("""WITH r AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'good' ELSE 'bad' END AS verdict, o_totalprice / 1000 AS source_xrt FROM orders), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'good' ELSE 'bad' END AS bv, (o_orderkey % 4)::DOUBLE AS bx FROM orders WHERE o_orderkey % 3 = 0)
SELECT o_orderkey, verdict, bv AS baseline_verdict, bx AS baseline_xrt, verdict <> bv AS changed, round(source_xrt / nullif(bx, 0), 7) AS speedup FROM r LEFT JOIN b USING (o_orderkey)""")
def j08_baseline_comparison(spark, sf_dir):
    o, k = read(spark, sf_dir, "orders"), F.col("o_orderkey")
    results = o.select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "good").otherwise("bad").alias("verdict"), (F.col("o_totalprice") / 1000).alias("source_xrt"))
    old = o.where(k % 3 == 0).select("o_orderkey", F.when(k % 2 == 0, "good").otherwise("bad").alias("verdict"), (k % 4).cast("double").alias("source_xrt"))
    return report.compared(results, old, "o_orderkey").drop("source_xrt").withColumn("speedup", F.round("speedup", 7))


@query("SELECT o_custkey, o_orderkey FROM orders ORDER BY o_custkey, o_orderkey")
def t01_t06_report_order(spark, sf_dir):
    return report.ordered_items(read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey")


@query("SELECT string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS counts FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)")
def t07_sorted_counts(spark, sf_dir):
    counts = telemetry.sorted_counts(read(spark, sf_dir, "events"), "event_type")
    return counts.select(F.array_join(F.transform(F.map_entries("counts"), lambda x: F.concat(x["key"], F.lit("="), x["value"])), ",").alias("counts"))


@query(_S + """, f AS (SELECT *, CASE WHEN count(*) OVER w = 10 AND avg(CASE WHEN event_type <> 'error' THEN 1e0 ELSE 0e0 END) OVER w >= 9e-1 THEN 1 ELSE 0 END AS fullw FROM s WINDOW w AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)),
m AS (SELECT *, max(fullw) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS mark FROM f), g AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, mark ORDER BY i) AS island FROM m),
o AS (SELECT *, CASE WHEN event_type <> 'error' THEN event_type <> 'purchase' END AS o, nth_value(t, 2) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS t1 FROM s),
q AS (SELECT *, sum(CASE WHEN coalesce(o, false) THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY i) AS island FROM o)
SELECT user_id, 'black-covered' AS reason, round(min(t), 6) AS start_seconds, round(max(t) + 2e-1, 6) AS end_seconds, 'reject' AS severity FROM g WHERE mark = 1 GROUP BY user_id, island
UNION ALL SELECT user_id, 'extended-idle', round(min(t), 6), round(max(t) + coalesce(max(t1), 1e0), 6), 'reject' FROM q WHERE o GROUP BY user_id, island HAVING max(t) + coalesce(max(t1), 1e0) - min(t) >= 1e0""")
def u01_failure_intervals(spark, sf_dir):
    s = _clips(spark, sf_dir).withColumns({"flag": F.col("event_type") != "error", "o": F.when(F.col("event_type") != "error", F.col("event_type") != "purchase")})
    out = evidence.failure_intervals(timeline.covered_spans(s, "user_id", "flag", 10, 0.9, 1 / RATE), timeline.qualified_runs(s, "user_id", "o", 1.0), "user_id")
    return out.withColumns({c: F.round(c, 6) for c in ("start_seconds", "end_seconds")})


def _camera(spark, sf_dir):
    v = F.col("value")
    quality = F.struct(
        (v / 10).alias("mean_luminance"), (F.col("event_id") % 9).cast("double").alias("entropy"), (v * 2).alias("laplacian_variance"), (F.col("event_id") % 10 / 10).alias("clipped_fraction"), ((v / 10 <= 8) | (F.col("event_id") % 9 <= 1)).alias("blackish"),
        (v * 2 < 80).alias("blurry"), (F.col("event_id") % 10 >= 6).alias("exposure_bad"),
    )
    return _clips(spark, sf_dir).select("user_id", "event_id", "t", quality.alias("quality"), (v / 1000).alias("translation"), (v / 20).alias("rotation"))


_CAMERA = _S + """, c AS (SELECT user_id, event_id, t, 'black-covered' AS reason, greatest((8 - value / 10) / 8, (1 - event_id % 9) / 1e0) AS score FROM s WHERE value / 10 <= 8 OR event_id % 9 <= 1
UNION ALL SELECT user_id, event_id, t, 'blur-warning', 80 - value * 2 FROM s WHERE value * 2 < 80 UNION ALL SELECT user_id, event_id, t, 'exposure-warning', event_id % 10 / 10e0 FROM s WHERE event_id % 10 >= 6
UNION ALL SELECT user_id, event_id, t, 'translation-shake', value / 1000 FROM s WHERE value / 1000 > 3e-2 UNION ALL SELECT user_id, event_id, t, 'rotation-shake', value / 20 FROM s WHERE value / 20 > 5)"""


@query(_CAMERA + " SELECT user_id, reason, round(t, 6) AS t, round(score, 6) AS score FROM c")
def f10_p05_p06_camera_evidence(spark, sf_dir):
    out = evidence.camera_candidates(_camera(spark, sf_dir), "user_id")
    return out.withColumns({c: F.round(c, 6) for c in ("t", "score")})


_HANDS = _S + """, h AS (SELECT *, event_type <> 'error' AS visible, CASE WHEN event_type <> 'error' THEN event_type = 'view' END AS inactive, value / 500 AS activity, CASE WHEN event_type <> 'error' THEN value / 100 END AS speed FROM s),
c AS (SELECT user_id, t, 'hands-visible' AS reason, 1e0 AS score FROM h WHERE NOT visible UNION ALL SELECT user_id, t, 'extended-idle', 1 - activity FROM h WHERE inactive UNION ALL SELECT user_id, t, 'hand-speed', speed FROM h WHERE speed > 75e-2
UNION ALL SELECT user_id, t, 'repetitive-motion', speed FROM h WHERE speed >= 5e-2 AND (i + 1) % 20 = 0)"""


def _hand_samples(spark, sf_dir):
    seen = F.col("event_type") != "error"
    return _clips(spark, sf_dir).select("user_id", "i", "t", seen.alias("visible"), F.when(seen, F.col("event_type") == "view").alias("inactive"), (F.col("value") / 500).alias("activity"), F.when(seen, F.col("value") / 100).alias("speed"))


@query(_HANDS + " SELECT user_id, reason, round(t, 6) AS t, round(score, 6) AS score FROM c")
def f10_f11_p04_hand_evidence(spark, sf_dir):
    out = evidence.hand_candidates(_hand_samples(spark, sf_dir), "user_id", 0.75, 2.0)
    return out.withColumns({c: F.round(c, 6) for c in ("t", "score")})


@query(_S + """, c AS (SELECT user_id, event_type AS reason, i, round_even(t / 10, 0) AS t, value AS score, CAST(i % 3 AS VARCHAR) AS image FROM s),
a AS (SELECT user_id, reason, min(i) AS i0, max(i) AS i2, max(score) AS m FROM c GROUP BY 1, 2), w AS (SELECT c.user_id, c.reason, min(i) AS i1 FROM c JOIN a ON a.user_id = c.user_id AND a.reason = c.reason AND score = m GROUP BY 1, 2),
u AS (SELECT user_id, reason, 0 AS slot, i0 AS i FROM a UNION ALL SELECT user_id, reason, 1, i1 FROM w UNION ALL SELECT user_id, reason, 2, i2 FROM a),
e AS (SELECT u.user_id, u.reason, slot, c.t, c.score, sha256(image) AS sha256, row_number() OVER (PARTITION BY u.user_id, u.reason, c.t, image ORDER BY slot) AS n FROM u JOIN c ON c.user_id = u.user_id AND c.reason = u.reason AND c.i = u.i),
f AS (SELECT * FROM e WHERE n = 1)
SELECT user_id, reason, slot, t, round(score, 6) AS score, sha256, printf('%02d-%s-%.3f.jpg', row_number() OVER (PARTITION BY user_id ORDER BY reason, slot) - 1, reason, t) AS name FROM f""")
def t05_k05_evidence_files(spark, sf_dir):
    c = _clips(spark, sf_dir).select("user_id", F.col("event_type").alias("reason"), F.col("i").alias("seq"), F.bround(F.col("t") / 10).alias("t"), F.col("value").alias("score"), (F.col("i") % 3).cast("string").cast("binary").alias("image"))
    out = evidence.named(report.evidence_by_image(c, ["user_id", "reason"]), "user_id")
    return out.drop("size_bytes").withColumn("score", F.round("score", 6))


@query(_HANDS + """, r AS (SELECT DISTINCT user_id, CASE WHEN user_id % 3 = 0 THEN 'hand-speed' ELSE 'extended-idle' END AS reason FROM events WHERE user_id % 4 <> 0) SELECT c.user_id, c.reason, count(*) AS n FROM c JOIN r USING (user_id, reason) GROUP BY 1, 2""")
def j06_kept_evidence(spark, sf_dir):
    k = F.col("user_id")
    results = read(spark, sf_dir, "events").select("user_id", F.when(k % 3 == 0, "hand-speed").otherwise("extended-idle").alias("rule_id"), F.when(k % 4 == 0, "pass").when(k % 4 == 1, "uncertain").otherwise("fail").alias("outcome")).distinct()
    kept = report.kept_evidence(evidence.hand_candidates(_hand_samples(spark, sf_dir), "user_id", 0.75, 2.0), results, "user_id")
    return kept.groupBy("user_id", "reason").agg(F.count("*").alias("n"))


@query("""WITH c AS (SELECT user_id, event_id, sum(1 + event_id % 3) OVER w AS total, sum(event_id % 2) OVER w AS idle FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)), k AS (SELECT *, total - total % 2 AS tot FROM c),
d AS (SELECT user_id, event_id, tot - lag(tot) OVER w AS dt, idle - lag(idle) OVER w AS di FROM k WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) SELECT user_id, event_id, round(100 * (1 - di / dt::DOUBLE), 6) AS percent FROM d WHERE dt > 0""")
def w09_s14_counter_load(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("event_id")
    k = read(spark, sf_dir, "events").select("user_id", "event_id", F.sum(F.col("event_id") % 3 + 1).over(w).alias("total"), F.sum(F.col("event_id") % 2).over(w).alias("idle"))
    k = k.withColumn("total", F.col("total") - F.col("total") % 2)
    return telemetry.counter_load(k, "user_id", "event_id", "total", "idle").withColumn("percent", F.round("percent", 6))


@query(_S + " SELECT user_id, floor(i / 64)::BIGINT AS chunk, count(*) AS frames FROM s GROUP BY 1, 2")
def w11_sample_chunks(spark, sf_dir):
    return telemetry.chunks(_clips(spark, sf_dir), "i", 64).groupBy("user_id", "chunk").agg(F.count("*").alias("frames"))


@query("SELECT p_partkey, slice, slice * 16 AS first, least(16, p_size - slice * 16)::INT AS size FROM part, unnest(range(0, ((p_size + 15) // 16)::BIGINT)) AS x(slice) WHERE p_size > 0")
def w12_request_slices(spark, sf_dir):
    out = telemetry.request_slices(read(spark, sf_dir, "part"), "p_size", 16)
    return out.select("p_partkey", F.col("slice").cast("long").alias("slice"), F.col("first").cast("long").alias("first"), F.col("size").cast("int").alias("size"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'TensorRTNative is required' WHEN s_suppkey % 4 = 0 THEN 'nvdec is required' WHEN s_suppkey % 5 = 0 THEN 'NVDEC runtime and FFmpeg h264_cuvid decoder are required' END AS error, s_suppkey % 3 <> 0 AND s_suppkey % 4 <> 0 AND s_suppkey % 5 <> 0 AS ready FROM supplier""")
def f13_readiness(spark, sf_dir):
    k = F.col("s_suppkey")
    workers = read(spark, sf_dir, "supplier").select("s_suppkey", F.when(k % 3 != 0, "TensorRTNative").alias("provider"), F.when(k % 4 == 0, "cpu").otherwise("nvdec").alias("video_backend"), (k % 5 != 0).alias("decoder"))
    return telemetry.readiness(workers).select("s_suppkey", "error", "ready")


@query("SELECT s_suppkey, concat_ws(',', CASE WHEN s_suppkey % 2 = 0 THEN 'ACCESS_KEY' END, CASE WHEN s_suppkey % 3 = 0 THEN 'SECRET' END, 'URL') AS missing FROM supplier")
def u04_missing_settings(spark, sf_dir):
    k, lit = F.col("s_suppkey"), F.lit
    held = F.create_map(lit("ACCESS_KEY"), F.when(k % 2 == 0, "").otherwise("a"), lit("SECRET"), F.when(k % 3 != 0, "s"), lit("OTHER"), lit("x"))
    return read(spark, sf_dir, "supplier").select("s_suppkey", F.array_join(telemetry.missing_settings(held, ["ACCESS_KEY", "SECRET", "URL"]), ",").alias("missing"))


_RETRY = """WITH e AS (SELECT user_id AS item_id, event_id AS seq, CASE WHEN event_type = 'view' THEN 'attempting' WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'purchase' AND event_id % 9 = 0 THEN 'freed' ELSE 'processing' END AS status, CASE WHEN event_id % 40 = 0 THEN 'SourceConflict' ELSE 'MediaError' END AS kind FROM events),
a AS (SELECT *, sum(CASE WHEN status = 'attempting' THEN 1 ELSE 0 END) OVER (PARTITION BY item_id ORDER BY seq) AS attempts FROM e),
b AS (SELECT item_id, seq, attempts, CASE WHEN status <> 'failed' THEN status WHEN kind = 'SourceConflict' THEN 'conflict' WHEN attempts >= 3 THEN 'quarantined' ELSE 'failed-retryable' END AS status FROM a),
c AS (SELECT *, coalesce(sum(CASE WHEN status IN ('freed', 'conflict', 'quarantined') THEN 1 ELSE 0 END) OVER (PARTITION BY item_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ended FROM b)"""


def _attempts(spark, sf_dir):
    kind, n = F.col("event_type"), F.col("event_id")
    status = F.when(kind == "view", "attempting").when(kind == "error", "failed").when((kind == "purchase") & (n % 9 == 0), "freed").otherwise("processing")
    return read(spark, sf_dir, "events").select(F.col("user_id").alias("item_id"), n.alias("seq"), status.alias("status"), F.when(n % 40 == 0, "SourceConflict").otherwise("MediaError").alias("error_type"))


@query(_RETRY + " SELECT item_id, seq, status, CAST(attempts AS BIGINT) AS attempts FROM c WHERE ended = 0")
def r02_retry_states(spark, sf_dir):
    return journal.retried(_attempts(spark, sf_dir), 3).drop("error_type")


@query(_RETRY + """, l AS (SELECT item_id, arg_max(status, seq) AS status, CAST(count(*) FILTER (WHERE status = 'attempting') AS BIGINT) AS attempts FROM c WHERE ended = 0 GROUP BY item_id) SELECT c_custkey AS item_id, status, coalesce(attempts, 0) AS attempts FROM customer LEFT JOIN l ON item_id = c_custkey""")
def j01_items_with_latest_state(spark, sf_dir):
    items = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("item_id"))
    return journal.with_latest(items, journal.retried(_attempts(spark, sf_dir), 3))
