"""Queries on grey frames. An embedding of 64 numbers is a frame of 8 by 8 pixels, and its change from a flipped one is the residual."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import pixels
from tidemark.plans.gate import query
from tidemark.plans.tables import read
from tidemark.sources.frames import probed

_G = "WITH g AS (SELECT vec_id, i, g[i + 1] AS g FROM (SELECT vec_id, list_transform(embedding, lambda x: least(255, greatest(0, floor((x::DOUBLE + 55e-2) * 231)))::INT) AS g FROM embeddings), unnest(range(0, 64)) AS x(i))"
_Q = _G + """, h AS (SELECT vec_id, g, count(*) AS c FROM g GROUP BY 1, 2), e AS (SELECT vec_id, -sum(c / 64e0 * log2(c / 64e0)) AS entropy FROM h GROUP BY 1),
n AS (SELECT vec_id, i // 8 AS y, i % 8 AS x, g FROM g), r(a, b) AS (SELECT a, CASE WHEN a < 0 THEN -a WHEN a > 7 THEN 14 - a ELSE a END FROM unnest(range(-1, 9)) AS t(a)),
l AS (SELECT n.vec_id, u.g + d.g + w.g + o.g - 4 * n.g AS l FROM n JOIN r ru ON ru.a = n.y - 1 JOIN r rd ON rd.a = n.y + 1 JOIN r rw ON rw.a = n.x - 1 JOIN r ro ON ro.a = n.x + 1
JOIN n u ON u.vec_id = n.vec_id AND u.y = ru.b AND u.x = n.x JOIN n d ON d.vec_id = n.vec_id AND d.y = rd.b AND d.x = n.x JOIN n w ON w.vec_id = n.vec_id AND w.x = rw.b AND w.y = n.y JOIN n o ON o.vec_id = n.vec_id AND o.x = ro.b AND o.y = n.y),
v AS (SELECT vec_id, var_pop(l) AS lap FROM l GROUP BY 1), m AS (SELECT vec_id, avg(g) AS mean, avg(CASE WHEN g <= 5 OR g >= 250 THEN 1e0 ELSE 0e0 END) AS clipped FROM g GROUP BY 1)"""


def _grey(spark, sf_dir):
    grid = F.transform("embedding", lambda v: F.least(F.lit(255), F.greatest(F.lit(0), F.floor((v.cast("double") + 0.55) * 231))).cast("int"))
    return read(spark, sf_dir, "embeddings").select("vec_id", grid.alias("g"))


@query(_Q + """ SELECT vec_id, round(mean, 6) AS mean_luminance, round(entropy, 6) AS entropy, round(sqrt(lap), 6) AS laplacian_deviation, round(clipped, 6) AS clipped_fraction, mean <= 130 OR entropy <= 1 AS blackish, lap < 40000 AS blurry, clipped >= 1e-2 AS exposure_bad
FROM m JOIN e USING (vec_id) JOIN v USING (vec_id)""")
def v02_a21_a22_a23_a24_f03_frame_quality(spark, sf_dir):
    q = pixels.frame_quality(F.col("g"), F.lit(8), black_mean=130.0, blur=40000.0, clipped=0.01)
    out = _grey(spark, sf_dir).select("vec_id", q.alias("q")).select("vec_id", "q.*").withColumn("laplacian_deviation", F.sqrt("laplacian_variance"))
    return out.drop("laplacian_variance").withColumns({c: F.round(c, 6) for c in ("mean_luminance", "entropy", "laplacian_deviation", "clipped_fraction")})


_ACTIVITY = _G + """, f AS (SELECT vec_id, i // 8 AS y, i % 8 AS x, abs(g - lead(g, 1, 0) OVER (PARTITION BY vec_id ORDER BY i)) AS r FROM g),
k AS (SELECT *, (x >= vec_id % 5 AND x < vec_id % 5 + 3 AND y >= 1 AND y < 4) OR (x >= 0 AND x < vec_id % 3 AND y >= 5 AND y < 8) AS hand, y >= 0 AND x >= 0 AND x < 7 AS inner_ FROM f),
a AS (SELECT vec_id, coalesce(avg(CASE WHEN r >= 80 THEN 1e0 ELSE 0e0 END) FILTER (WHERE hand), 0e0) AS hand, avg(CASE WHEN r >= 80 THEN 1e0 ELSE 0e0 END) FILTER (WHERE inner_) AS workspace FROM k GROUP BY vec_id)"""


def _activity(spark, sf_dir):
    residual = F.transform("g", lambda v, i: F.abs(v - F.coalesce(F.get("g", i + 1), F.lit(0))))
    box = lambda x1, y1, x2, y2: F.struct(*(F.lit(v).cast("int").alias(n) if isinstance(v, int) else v.cast("int").alias(n) for v, n in zip((x1, y1, x2, y2), ("x1", "y1", "x2", "y2"))))
    k = F.col("vec_id")
    held = F.array(box(k % 5, 1, k % 5 + 3, 4), box(0, 5, k % 3, 8))
    return _grey(spark, sf_dir).select("vec_id", pixels.region_activity(residual, F.lit(8), held, 80).alias("a"))


@query(_ACTIVITY + " SELECT vec_id, round(hand, 6) AS hand, round(workspace, 6) AS workspace FROM a")
def a25_j12_u06_region_activity(spark, sf_dir):
    return _activity(spark, sf_dir).select("vec_id", F.round("a.hand", 6).alias("hand"), F.round("a.workspace", 6).alias("workspace"))


@query(_ACTIVITY + " SELECT vec_id, CASE WHEN vec_id % 4 <> 0 THEN hand < 3e-1 AND workspace < 4e-1 END AS inactive FROM a")
def v04_idle_state(spark, sf_dir):
    """Of measured activities; the motion that gives the residual comes from outside."""
    return _activity(spark, sf_dir).select("vec_id", pixels.idle_state(F.col("vec_id") % 4 != 0, F.col("a"), 0.3, 0.4).alias("inactive"))


@query("""WITH f AS (SELECT p_partkey, p_size * 2 + 1 AS w, p_size + 1 AS h, (p_partkey % 9)::BIGINT AS n, p_partkey % 4 <> 0 AS ok FROM part), b AS (SELECT *, 6 + w * h + 2 * ((w + 1) // 2) * ((h + 1) // 2) AS size FROM f)
SELECT p_partkey, CASE WHEN ok THEN w ELSE 0 END::INT AS width, CASE WHEN ok THEN h ELSE 0 END::INT AS height, round(CASE WHEN ok THEN 30000 / 1001e0 ELSE 0e0 END, 6) AS fps, CASE WHEN ok THEN n ELSE 0 END AS frame_count,
round(CASE WHEN ok THEN n / (30000 / 1001e0) ELSE 0e0 END, 6) AS duration_seconds, ok AND n > 0 AS valid FROM b""")
def s04_probed_clips(spark, sf_dir):
    """Of file heads and lengths as a listing has them; a part is a clip."""
    w, h, k = F.col("p_size") * 2 + 1, F.col("p_size") + 1, F.col("p_partkey")
    head = F.when(k % 4 != 0, F.concat(F.format_string("YUV4MPEG2 W%d H%d F30000:1001 Ip C420\n", w, h), F.lit("FRAME\n"))).otherwise("RIFF....AVI LIST")
    size = w * h + 2 * F.floor((w + 1) / 2) * F.floor((h + 1) / 2) + 6
    length = F.length(F.format_string("YUV4MPEG2 W%d H%d F30000:1001 Ip C420\n", w, h)) + k % 9 * size + 3
    files = read(spark, sf_dir, "part").select(k.cast("string").alias("path"), length.alias("length"), head.alias("head"))
    return probed(files).select(F.col("path").cast("long").alias("p_partkey"), "width", "height", F.round("fps", 6).alias("fps"), "frame_count", F.round("duration_seconds", 6).alias("duration_seconds"), "valid")


#: Frames of 360 by 16 pixels: a number of an embedding is a field of 45 by 2.
_WIDE = "WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: least(255, greatest(0, floor((x::DOUBLE + 55e-2) * 231)))::INT) AS g FROM embeddings), p AS (SELECT vec_id, y, x, g, g[(y // 2) * 8 + x // 45 + 1] AS c FROM v, unnest(range(0, 16)) AS a(y), unnest(range(0, 360)) AS b(x))"


def _wide(spark, sf_dir):
    digits = F.transform("g", lambda v: F.lpad(F.hex(v), 2, "0"))
    row = lambda y: F.concat(*(F.repeat(F.get("d", 8 * y + x), 45) for x in range(8)))
    grid = _grey(spark, sf_dir).select("vec_id", digits.alias("d"))
    return grid.select("vec_id", F.unhex(F.concat(*(F.repeat(row(y), 2) for y in range(8)))).alias("frame"))


@query(_WIDE + """, l AS (SELECT vec_id, c, g[(CASE WHEN y = 0 THEN 1 ELSE y - 1 END // 2) * 8 + x // 45 + 1] + g[(CASE WHEN y = 15 THEN 14 ELSE y + 1 END // 2) * 8 + x // 45 + 1] + g[(y // 2) * 8 + CASE WHEN x = 0 THEN 1 ELSE x - 1 END // 45 + 1] + g[(y // 2) * 8 + CASE WHEN x = 359 THEN 358 ELSE x + 1 END // 45 + 1] - 4 * c AS l FROM p),
h AS (SELECT vec_id, c, count(*) AS n FROM p GROUP BY 1, 2), e AS (SELECT vec_id, -sum(n / 5760e0 * log2(n / 5760e0)) AS entropy FROM h GROUP BY 1),
m AS (SELECT vec_id, avg(c) AS mean, var_pop(l) AS lap, avg(CASE WHEN c <= 5 OR c >= 250 THEN 1e0 ELSE 0e0 END) AS clipped FROM l GROUP BY 1)
SELECT vec_id, round(mean, 6) AS mean_luminance, round(entropy, 6) AS entropy, round(sqrt(lap), 6) AS laplacian_deviation, round(clipped, 6) AS clipped_fraction, mean <= 130 OR entropy <= 1 AS blackish, lap < 3000 AS blurry, clipped >= 1e-2 AS exposure_bad FROM m JOIN e USING (vec_id)""")
def v02_a21_a22_a23_a24_frame_quality_360(spark, sf_dir):
    q = pixels.measured_quality(F.col("frame"), F.lit(360), black_mean=130.0, blur=3000.0, clipped=0.01)
    out = _wide(spark, sf_dir).select("vec_id", q.alias("q")).select("vec_id", "q.*").withColumn("laplacian_deviation", F.sqrt("laplacian_variance"))
    return out.drop("laplacian_variance").withColumns({c: F.round(c, 6) for c in ("mean_luminance", "entropy", "laplacian_deviation", "clipped_fraction")})


@query(_WIDE + """, k AS (SELECT vec_id, c >= 140 AS on_, (x >= vec_id % 100 AND x < vec_id % 100 + 77 AND y >= 3 AND y < 9) OR (x >= 0 AND x < vec_id % 3 AND y >= 11 AND y < 16) AS hand, y >= 1 AND x >= 36 AND x < 324 AS inner_ FROM p)
SELECT vec_id, round(coalesce(avg(CASE WHEN on_ THEN 1e0 ELSE 0e0 END) FILTER (WHERE hand), 0e0), 6) AS hand, round(avg(CASE WHEN on_ THEN 1e0 ELSE 0e0 END) FILTER (WHERE inner_), 6) AS workspace FROM k GROUP BY vec_id""")
def a25_region_activity_360(spark, sf_dir):
    k = F.col("vec_id")
    box = lambda *sides: F.struct(*((F.lit(v) if isinstance(v, int) else v).cast("int").alias(n) for v, n in zip(sides, ("x1", "y1", "x2", "y2"))))
    a = pixels.measured_activity(F.col("frame"), F.lit(360), F.array(box(k % 100, 3, k % 100 + 77, 9), box(0, 11, k % 3, 16)), 140)
    return _wide(spark, sf_dir).select("vec_id", a.alias("a")).select("vec_id", F.round("a.hand", 6).alias("hand"), F.round("a.workspace", 6).alias("workspace"))
