"""A run's report from samples to one row, and its parts. A user of ``events`` is a clip that was processed; a customer of an even key is one that wasn't."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import report, rules, signals, statistics
from tidemark.plans.gate import _S, RATE, _clips, query
from tidemark.plans.tables import read

HAND, IDLE, SPEED = "hand.visibility_fraction", "idle.fraction", "hand.motion_speed_p95"
#: Two rules on one signal, one on another, one on a signal without replicates, a warning.
RULES = (
    (0, "hands-visible", HAND, ">=", 0.613, False, "reject"), (1, "hands-always", HAND, "<", 0.987, False, "reject"), (2, "extended-idle", IDLE, "<=", 0.287, False, "reject"),
    (3, "hand-speed", SPEED, "<=", 1.413, False, "reject"), (4, "slow-warning", SPEED, ">", 0.3, False, "warn"),
)


def _boot(name: str, where: str, value: str, seed: int) -> str:
    """The replicates of one statistic as tables: m of them, q of their intervals."""
    return f"""
k_{name} AS (SELECT user_id, {value} AS v, row_number() OVER (PARTITION BY user_id ORDER BY i) - 1 AS k FROM s WHERE {where}),
n_{name} AS (SELECT user_id, count(*) AS n, avg(v) AS point, greatest(1, least(10, greatest(1, count(*) // 4))) AS l FROM k_{name} GROUP BY user_id),
b_{name} AS (SELECT *, ('0x' || substr(sha256(concat_ws('|', {seed}, user_id, r, b)), 1, 8))::BIGINT % (n - l + 1) AS st FROM n_{name}, unnest(range(0, 1000)) AS x(r), unnest(range(0, CAST(ceil(n / l) AS BIGINT))) AS y(b)),
m_{name} AS (SELECT b.user_id, b.r, avg(k.v) AS m FROM b_{name} b JOIN k_{name} k ON k.user_id = b.user_id AND k.k BETWEEN b.st AND least(b.st + l - 1, b.st + n - 1 - b.b * l) GROUP BY 1, 2),
q_{name} AS (SELECT user_id, quantile_cont(m, 0.025) AS low, quantile_cont(m, 0.975) AS high FROM m_{name} GROUP BY user_id),"""


_RESULTS = _S + "," + _boot("h", "true", "CASE WHEN event_type <> 'error' THEN 1e0 ELSE 0e0 END", 21) + _boot("i", "event_type <> 'error'", "CASE WHEN event_type = 'purchase' THEN 1e0 ELSE 0e0 END", 22) + """
c AS (SELECT user_id, count(*) / 5e0 AS duration, quantile_cont(value / 100, 0.95) AS speed FROM s GROUP BY user_id),
o AS (SELECT c.*, CASE WHEN h.low >= 613e-3 THEN 2 WHEN h.high < 613e-3 THEN 0 ELSE 1 END AS r0, CASE WHEN h.high < 987e-3 THEN 2 WHEN h.low >= 987e-3 THEN 0 ELSE 1 END AS r1,
CASE WHEN i.user_id IS NULL THEN 2 WHEN i.high <= 287e-3 THEN 2 WHEN i.low > 287e-3 THEN 0 ELSE 1 END AS r2, CASE WHEN speed <= 1413e-3 THEN 2 ELSE 0 END AS r3 FROM c JOIN q_h h USING (user_id) LEFT JOIN q_i i USING (user_id)),
p AS (SELECT h.user_id, avg(CASE WHEN h.m >= 613e-3 AND h.m < 987e-3 AND i.m <= 287e-3 THEN 1e0 ELSE 0e0 END) AS p FROM m_h h JOIN m_i i USING (user_id, r) GROUP BY h.user_id),
r AS (SELECT o.user_id, duration, duration / (2 + o.user_id % 3) AS elapsed, CASE WHEN least(r0, r1, r2, r3) = 0 THEN 'bad' WHEN least(r0, r1, r2, r3) = 1 THEN 'uncertain' ELSE 'good' END AS verdict, CASE WHEN r3 = 2 THEN coalesce(p, 0e0) ELSE 0e0 END AS probability FROM o LEFT JOIN p USING (user_id))"""


def _results(spark, sf_dir):
    """(user_id, verdict, reasons, duration_seconds, elapsed_seconds, probability): bootstraps, signals with intervals, rules, probability."""
    seen = F.col("event_type") != "error"
    idle = F.when(seen, (F.col("event_type") == "purchase").cast("double"))
    held = _clips(spark, sf_dir).groupBy("user_id").agg(
        (F.count("*") / RATE).alias("duration_seconds"), F.percentile(F.col("value") / 100, F.lit(0.95)).alias("speed"),
        statistics.in_order(seen.cast("double")).alias("hands"), statistics.in_order(idle).alias("idles"),
    )
    boot = lambda c, seed: statistics.hash_replicates(F.col("user_id").cast("string"), F.col(c), 2.0, RATE, 1000, seed)
    wide = statistics.dealt(held, "user_id").withColumns({"h": boot("hands", 21), "i": boot("idles", 22)})
    values = {HAND: F.coalesce("h.point", F.lit(0.0)), IDLE: F.coalesce("i.point", F.lit(0.0)), SPEED: F.col("speed")}
    intervals = {n: (F.col(f"{c}.low"), F.col(f"{c}.high")) for n, c in ((HAND, "h"), (IDLE, "i"))}
    found = rules.verdict(rules.outcomes(signals.signal_map(values, intervals), RULES))
    eligible = F.forall(rules.outcomes(signals.signal_map(values, {}), rules.other_rejects(RULES)), lambda r: r["outcome"] == "pass")
    probability = report.good_probability_of_samples(F.col("h.samples"), F.col("i.samples"), eligible, RULES)
    elapsed = F.col("duration_seconds") / (2 + F.col("user_id") % 3)
    return wide.select("user_id", found.alias("v"), "duration_seconds", elapsed.alias("elapsed_seconds"), probability.alias("probability")).select("user_id", "v.*", "duration_seconds", "elapsed_seconds", "probability")


@query(_RESULTS + " SELECT user_id, verdict, round(duration, 6) AS duration_seconds, round(probability, 6) AS probability FROM r")
def a06_a04_results_by_rules(spark, sf_dir):
    return _results(spark, sf_dir).select("user_id", "verdict", F.round("duration_seconds", 6).alias("duration_seconds"), F.round("probability", 6).alias("probability"))


@query(_RESULTS + """, items AS (SELECT DISTINCT user_id, CASE WHEN user_id % 2 = 0 THEN 90e0 END AS d FROM events UNION ALL SELECT 1000000 + c_custkey, 45e0 FROM customer WHERE c_custkey % 2 = 0),
g AS (SELECT x.r, sum(CASE WHEN ('0x' || substr(sha256(concat_ws('|', 11, user_id, x.r)), 1, 8))::BIGINT / 4294967296e0 < probability THEN duration / 3600 ELSE 0e0 END) AS h FROM r, unnest(range(0, 1000)) AS x(r) GROUP BY x.r)
SELECT (SELECT count(*) FROM items) AS captured_clips, (SELECT round(sum(coalesce(d, duration, 0)) / 3600, 5) FROM items LEFT JOIN r USING (user_id)) AS captured_hours, count(*) AS processed_clips, round(sum(duration) / 3600, 5) AS processed_hours,
count(*) FILTER (WHERE verdict = 'good') AS good_clips, round(coalesce(sum(duration) FILTER (WHERE verdict = 'good'), 0) / 3600, 5) AS good_hours, count(*) FILTER (WHERE verdict = 'bad') AS bad_clips, round(coalesce(sum(duration) FILTER (WHERE verdict = 'bad'), 0) / 3600, 5) AS bad_hours,
count(*) FILTER (WHERE verdict = 'uncertain') AS uncertain_clips, round(coalesce(sum(duration) FILTER (WHERE verdict = 'uncertain'), 0) / 3600, 5) AS uncertain_hours, 0::BIGINT AS error_clips, 0e0 AS error_hours,
(SELECT round(quantile_cont(h, 0.025), 5) FROM g) AS good_hours_low, (SELECT round(quantile_cont(h, 0.975), 5) FROM g) AS good_hours_high, round(sum(duration) / sum(elapsed), 5) AS source_xrt, round(7500 / (sum(duration) / sum(elapsed)), 4) AS projected_hours, 'partial' AS status FROM r""")
def a06_a07_a08_a09_a10_a11_run_report(spark, sf_dir):
    """The whole way: samples, replicates, signals, rules, verdicts, probabilities, hours; one row."""
    results = _results(spark, sf_dir)
    own = read(spark, sf_dir, "events").select("user_id").distinct().withColumn("duration_seconds", F.when(F.col("user_id") % 2 == 0, 90.0))
    other = read(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select((F.col("c_custkey") + 1_000_000).alias("user_id"), F.lit(45.0).alias("duration_seconds"))
    out = report.summary(own.union(other), results, "user_id", 7500.0, 1000, 11)
    hours = [c for c in out.columns if "hours" in c or c == "source_xrt"]
    return out.withColumns({c: F.round(c, 4 if c == "projected_hours" else 5) for c in hours})


@query(_S + """, d AS (SELECT user_id, i - 1 AS k, value - lag(value) OVER (PARTITION BY user_id ORDER BY i) AS d FROM s), e AS (SELECT * FROM d WHERE d IS NOT NULL),
p AS (SELECT user_id, avg(d) AS m, stddev_pop(d) AS sd, count(*) AS n FROM e GROUP BY user_id), z AS (SELECT user_id, k, (d - m) / sd AS z FROM e JOIN p USING (user_id) WHERE sd > 1e-9 AND n + 1 >= 40),
c AS (SELECT a.user_id, lag, avg(a.z * b.z) AS r, count(*) AS o FROM z a, unnest(range(3, 17)) AS x(lag), z b WHERE b.user_id = a.user_id AND b.k = a.k + lag GROUP BY 1, 2 HAVING count(*) >= greatest(12, lag)), r AS (SELECT user_id, max(r) AS r FROM c GROUP BY user_id)
SELECT u.user_id, round(coalesce(least(1e0, greatest(0e0, r)), 0e0), 6) AS score FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN r USING (user_id)""")
def a05_repetition_of_rounded_bounds(spark, sf_dir):
    """20.1 seconds at 2 Hz are 40 samples."""
    return statistics.repetition(_clips(spark, sf_dir), "user_id", "value", 2.0, 1.5, 8.0, 20.1).select("user_id", F.round("score", 6).alias("score"))
