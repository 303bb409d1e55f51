"""Queries over the driver's tables, one for each operator or a few that belong together, and the SQL they are compared with.

Keys name the operators of the survey that a query covers. ``events`` stands in for sampled clips: a user is a clip, rows are
samples at 5 Hz in time order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import journal, report, rules, statistics, timeline
from tidemark.plans.tables import read

QUERIES, ORACLE_SQL = {}, {}
RATE = 5.0


def query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.numbered(read(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], RATE)


#: The same numbering in SQL, as the table s.
_S = "WITH s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) / 5e0 AS t FROM events)"


@query(_S + ", d AS (SELECT user_id, i, t, floor((t + 1e-6) * 2) AS q, lag(floor((t + 1e-6) * 2)) OVER (PARTITION BY user_id ORDER BY i) AS q0 FROM s), h AS (SELECT user_id, i, t FROM d WHERE q0 IS NULL OR q > q0) SELECT user_id, CAST(i AS BIGINT) AS i, round(greatest(t - lag(t) OVER (PARTITION BY user_id ORDER BY i), 5e-1), 6) AS dt FROM h")
def w01_w02_hand_decimation(spark, sf_dir):
    hand = timeline.decimated(_clips(spark, sf_dir), "user_id", 2.0).where("selected").select("user_id", "i", "t")
    step = timeline.effective_step(hand, "user_id", 2.0)
    return step.select("user_id", F.col("i").cast("long").alias("i"), F.round(F.when(F.lag("t").over(_by_clip()).isNotNull(), F.col("dt")).otherwise(F.lit(0.5)), 6).alias("dt"))


def _by_clip():
    from pyspark.sql import Window

    return Window.partitionBy("user_id").orderBy("i")


@query(_S + """, f AS (SELECT *, CASE WHEN count(*) OVER w = 10 AND avg(CASE WHEN event_type <> 'error' THEN 1e0 ELSE 0e0 END) OVER w >= 9e-1 THEN 1 ELSE 0 END AS fullw FROM s WINDOW w AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)),
m AS (SELECT *, max(fullw) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS mark FROM f),
g AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, mark ORDER BY i) AS island FROM m)
SELECT user_id, round(min(t), 6) AS start_seconds, round(max(t) + 2e-1, 6) AS end_seconds, count(*) AS n_samples FROM g WHERE mark = 1 GROUP BY user_id, island""")
def w03_covered_windows(spark, sf_dir):
    s = _clips(spark, sf_dir).withColumn("flag", F.col("event_type") != "error")
    return _rounded(timeline.covered_spans(s, "user_id", "flag", 10, 0.9, 1 / RATE))


def _rounded(spans: DataFrame) -> DataFrame:
    return spans.select("user_id", F.round("start_seconds", 6).alias("start_seconds"), F.round("end_seconds", 6).alias("end_seconds"), "n_samples")


_STATE = "CASE WHEN event_type = 'error' THEN NULL ELSE event_type <> 'purchase' END"


@query(_S + f""", o AS (SELECT *, {_STATE} AS o, nth_value(t, 2) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS t1 FROM s),
g AS (SELECT *, sum(CASE WHEN coalesce(o, false) THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY i) AS island FROM o)
SELECT user_id, round(min(t), 6) AS start_seconds, round(max(t) + coalesce(max(t1), 1e0), 6) AS end_seconds, count(*) AS n_samples FROM g WHERE o GROUP BY user_id, island HAVING max(t) + coalesce(max(t1), 1e0) - min(t) >= 1e0""")
def w04_idle_runs(spark, sf_dir):
    s = _clips(spark, sf_dir).withColumn("o", F.when(F.col("event_type") != "error", F.col("event_type") != "purchase"))
    return _rounded(timeline.qualified_runs(s, "user_id", "o", 1.0))


@query(_S + """, g AS (SELECT *, sum(CASE WHEN event_type <> 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY i) AS island FROM s),
r AS (SELECT user_id, island, count(*) AS n, min(i) AS i0, max(i) AS i1 FROM g WHERE event_type <> 'error' GROUP BY user_id, island)
SELECT user_id, CAST(arg_max(i0, n * 100000 - i0) AS BIGINT) AS first_i, CAST(arg_max(i1, n * 100000 - i0) AS BIGINT) AS last_i FROM r GROUP BY user_id""")
def w05_longest_run(spark, sf_dir):
    s = _clips(spark, sf_dir).withColumn("v", F.when(F.col("event_type") != "error", F.col("value")))
    return timeline.longest_run(s, "user_id", "v").groupBy("user_id").agg(F.min("i").cast("long").alias("first_i"), F.max("i").cast("long").alias("last_i"))


@query(_S + ", d AS (SELECT user_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY i) AS d FROM s) SELECT user_id, count(d) AS n, round(avg(d), 6) AS mean_d, round(stddev_pop(d), 6) AS sd FROM d GROUP BY user_id")
def w06_first_differences(spark, sf_dir):
    d = timeline.differences(_clips(spark, sf_dir), "user_id", "value")
    return d.groupBy("user_id").agg(F.count("d").alias("n"), F.round(F.avg("d"), 6).alias("mean_d"), F.round(F.stddev_pop("d"), 6).alias("sd"))


@query(_S + f" SELECT user_id, round(coalesce(avg(CASE WHEN ({_STATE}) THEN 1e0 WHEN NOT ({_STATE}) THEN 0e0 END), 0e0), 6) AS fraction, round(quantile_cont(value, 0.95), 6) AS p95 FROM s GROUP BY user_id")
def a01_a02_a03_fractions_and_p95(spark, sf_dir):
    o = F.when(F.col("event_type") != "error", F.col("event_type") != "purchase")
    return _clips(spark, sf_dir).groupBy("user_id").agg(F.round(statistics.known_fraction(o), 6).alias("fraction"), F.round(F.percentile("value", F.lit(0.95)), 6).alias("p95"))


_BOOT = _S + """, k AS (SELECT user_id, CASE WHEN event_type <> 'error' THEN value END AS v, row_number() OVER (PARTITION BY user_id ORDER BY i) - 1 AS k FROM s WHERE event_type <> 'error'),
n AS (SELECT user_id, count(*) AS n, avg(v) AS point FROM k GROUP BY user_id),
l AS (SELECT *, greatest(1, least(10, greatest(1, n // 4))) AS l FROM n),
b AS (SELECT l.*, r, b FROM l, unnest(range(0, 1000)) AS x(r), unnest(range(0, CAST(ceil(n / l) AS BIGINT))) AS y(b)),
st AS (SELECT *, ('0x' || substr(sha256(concat_ws('|', 7, user_id, r, b)), 1, 8))::BIGINT % (n - l + 1) AS st FROM b),
m AS (SELECT st.user_id, st.r, avg(k.v) AS m FROM st JOIN k ON k.user_id = st.user_id AND k.k BETWEEN st.st AND least(st.st + l - 1, st.st + n - 1 - b * l) GROUP BY 1, 2)
SELECT m.user_id, round(any_value(n.point), 6) AS point, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high FROM m JOIN n USING (user_id) GROUP BY m.user_id"""


@query(_BOOT)
def a04_block_bootstrap_by_hash(spark, sf_dir):
    s = _clips(spark, sf_dir).withColumn("v", F.when(F.col("event_type") != "error", F.col("value")))
    out = statistics.bootstrap_by_hash(s, "user_id", "v", 2.0, RATE, 1000, 7)
    return out.select("user_id", *(F.round(c, 6).alias(c) for c in ("point", "low", "high")))


@query(_BOOT.replace("avg(v) AS point", "quantile_cont(v, 0.95) AS point").replace("avg(k.v) AS m", "quantile_cont(k.v, 0.95) AS m"))
def a04_block_bootstrap_p95(spark, sf_dir):
    s = _clips(spark, sf_dir).withColumn("v", F.when(F.col("event_type") != "error", F.col("value")))
    out = statistics.bootstrap_by_hash(s, "user_id", "v", 2.0, RATE, 1000, 7, "p95")
    return out.select("user_id", *(F.round(c, 6).alias(c) for c in ("point", "low", "high")))


@query(None)
def a04_block_bootstrap_seeded(spark, sf_dir):
    """NumPy's generator can't be written in SQL; tests/test_statistics.py compares with a plain loop."""
    s = _clips(spark, sf_dir).withColumn("v", F.when(F.col("event_type") != "error", F.col("value")))
    return statistics.bootstrap(s, "user_id", "v", "p95", 2.0, RATE, 1000, job="job").drop("samples")


@query(_S + """, d AS (SELECT user_id, i - 1 AS k, value - lag(value) OVER (PARTITION BY user_id ORDER BY i) AS d FROM s), e AS (SELECT * FROM d WHERE d IS NOT NULL),
p AS (SELECT user_id, avg(d) AS m, stddev_pop(d) AS sd, count(*) AS n FROM e GROUP BY user_id), z AS (SELECT user_id, k, (d - m) / sd AS z FROM e JOIN p USING (user_id) WHERE sd > 1e-9 AND n + 1 >= 40),
c AS (SELECT a.user_id, lag, avg(a.z * b.z) AS r, count(*) AS o FROM z a, unnest(range(8, 31)) AS x(lag), z b WHERE b.user_id = a.user_id AND b.k = a.k + lag GROUP BY 1, 2 HAVING count(*) >= greatest(12, lag)),
r AS (SELECT user_id, max(r) AS r FROM c GROUP BY user_id)
SELECT u.user_id, round(coalesce(least(1e0, greatest(0e0, r)), 0e0), 6) AS score FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN r USING (user_id)""")
def a05_w06_j11_repetition(spark, sf_dir):
    return statistics.repetition(_clips(spark, sf_dir), "user_id", "value", RATE, 1.6, 6.0, 8.0).select("user_id", F.round("score", 6).alias("score"))


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount AS v, l_discount - l_tax AS lo, l_discount + l_tax AS hi, l_partkey % 6 = 0 AS b, (l_linenumber + l_partkey) % 5 AS op, l_suppkey % 4 = 0 AS none FROM lineitem),
p AS (SELECT *, CASE op WHEN 0 THEN v >= 5e-2 WHEN 1 THEN v <= 5e-2 WHEN 2 THEN v > 5e-2 WHEN 3 THEN v < 5e-2 ELSE v = 5e-2 END AS point,
CASE op WHEN 0 THEN lo >= 5e-2 WHEN 1 THEN hi <= 5e-2 WHEN 2 THEN lo > 5e-2 ELSE hi < 5e-2 END AS sure, CASE op WHEN 0 THEN hi < 5e-2 WHEN 1 THEN lo > 5e-2 WHEN 2 THEN hi <= 5e-2 ELSE lo >= 5e-2 END AS never FROM x)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN b OR op = 4 OR none THEN CASE WHEN point THEN 'pass' ELSE 'fail' END WHEN sure THEN 'pass' WHEN never THEN 'fail' ELSE 'uncertain' END AS outcome FROM p""")
def f02_f07_all_operators(spark, sf_dir):
    op = F.get(F.array(*map(F.lit, (">=", "<=", ">", "<", "=="))), ((F.col("l_linenumber") + F.col("l_partkey")) % 5).cast("int"))
    v, none = F.col("l_discount"), F.col("l_suppkey") % 4 == 0
    low, high = F.when(~none, v - F.col("l_tax")), F.when(~none, v + F.col("l_tax"))
    outcome = C.rule_outcome(v, F.col("l_partkey") % 6 == 0, op, F.lit(0.05), low, high)
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", outcome.alias("outcome"))


@query(_S + """, d AS (SELECT user_id, i, t, value, floor((t + 1e-6) * 2) AS q, lag(floor((t + 1e-6) * 2)) OVER (PARTITION BY user_id ORDER BY i) AS q0 FROM s), h AS (SELECT *, q0 IS NULL OR q > q0 AS sel FROM d)
SELECT a.user_id, CAST(a.i AS BIGINT) AS i, round(max(b.t), 6) AS previous_t, arg_max(b.value, b.i) AS previous_value FROM h a LEFT JOIN h b ON b.user_id = a.user_id AND b.i < a.i AND b.sel GROUP BY 1, 2""")
def j10_previous_hand_frame(spark, sf_dir):
    out = timeline.with_previous_selected(timeline.decimated(_clips(spark, sf_dir), "user_id", 2.0), "user_id", "selected", ["t", "value"])
    return out.select("user_id", F.col("i").cast("long").alias("i"), F.round("previous.t", 6).alias("previous_t"), F.col("previous.value").alias("previous_value"))


_CTX = "SELECT user_id, count(*) FILTER (WHERE event_type = 'error') * 4 > count(*) AS cov, 100 * avg(CASE WHEN event_type <> 'error' THEN 1e0 ELSE 0e0 END) - 20 AS hands, 100 * avg(CASE WHEN event_type = 'view' THEN 1e0 ELSE 0e0 END) AS idle, avg(value) / 50 AS tr, max(value) / 90 AS rot, least(1e0, avg(value) / 60) AS rep FROM events GROUP BY user_id"


@query(f"""WITH x AS ({_CTX}), c AS (SELECT *, CASE WHEN cov THEN 'fail' ELSE 'pass' END AS covered_check, CASE WHEN cov THEN 'not_applicable' WHEN hands - 4 >= 60 THEN 'pass' WHEN hands + 4 < 60 THEN 'fail' ELSE 'uncertain' END AS hands_check FROM x),
d AS (SELECT *, CASE WHEN hands_check <> 'pass' THEN 'not_applicable' WHEN idle + 5 <= 50 THEN 'pass' WHEN idle - 5 > 50 THEN 'fail' ELSE 'uncertain' END AS idle_check, CASE WHEN tr <= 3 AND rot <= 5 THEN 'pass' ELSE 'fail' END AS steady_check,
CASE WHEN hands_check <> 'pass' THEN 'not_applicable' WHEN rep <= 85e-2 THEN 'pass' ELSE 'fail' END AS repetition_check FROM c)
SELECT user_id, covered_check, hands_check, idle_check, steady_check, repetition_check, CASE WHEN 'fail' IN (covered_check, hands_check, idle_check, steady_check, repetition_check) THEN 'bad' WHEN 'uncertain' IN (hands_check, idle_check) THEN 'uncertain' ELSE 'good' END AS verdict FROM d""")
def f08_a16_gate_policy(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    x = e.groupBy("user_id").agg(
        (F.sum((F.col("event_type") == "error").cast("int")) * 4 > F.count("*")).alias("camera_covered"),
        (100 * F.avg((F.col("event_type") != "error").cast("double")) - 20).alias("hands"), (100 * F.avg((F.col("event_type") == "view").cast("double"))).alias("idle"),
        (F.avg("value") / 50).alias("translation"), (F.max("value") / 90).alias("rotation"), F.least(F.lit(1.0), F.avg("value") / 60).alias("repetition"),
        F.lit(0.0).alias("blur"), F.lit(0.0).alias("exposure"),
    )
    for c, by in (("hands", 4), ("idle", 5)):
        x = x.withColumn(f"{c}_low", F.col(c) - by).withColumn(f"{c}_high", F.col(c) + by)
    return rules.gate(x).select("user_id", "covered_check", "hands_check", "idle_check", "steady_check", "repetition_check", "verdict")


def _journal(spark, sf_dir):
    status = F.when(F.col("event_type") == "purchase", "freed").when(F.col("event_type") == "error", "failed-retryable").when(F.col("event_type") == "view", "attempting").otherwise("processing")
    return read(spark, sf_dir, "events").select(F.col("user_id").alias("item_id"), F.col("event_id").alias("seq"), status.alias("status"))


_J = "WITH j AS (SELECT user_id AS item_id, event_id AS seq, CASE event_type WHEN 'purchase' THEN 'freed' WHEN 'error' THEN 'failed-retryable' WHEN 'view' THEN 'attempting' ELSE 'processing' END AS status FROM events), l AS (SELECT item_id, arg_max(status, seq) AS status, CAST(count(*) FILTER (WHERE status = 'attempting') AS BIGINT) AS attempts FROM j GROUP BY item_id)"


@query(_J + " SELECT item_id, status, attempts FROM l")
def w07_a12_r01_journal_state(spark, sf_dir):
    return journal.latest(_journal(spark, sf_dir))


@query(_J + " SELECT status, count(*) AS items FROM l GROUP BY status")
def a13_status_counts(spark, sf_dir):
    return journal.status_counts(_journal(spark, sf_dir))


@query(_J + " SELECT c_custkey AS item_id, false AS retry FROM customer WHERE c_custkey NOT IN (SELECT item_id FROM l WHERE status IN ('freed', 'conflict', 'quarantined')) UNION ALL SELECT c_custkey, true FROM customer WHERE c_custkey IN (SELECT item_id FROM l WHERE status = 'failed-retryable')")
def f06_u05_j01_remaining_work(spark, sf_dir):
    items, events = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("item_id")), _journal(spark, sf_dir)
    normal = journal.remaining(items, events).withColumn("retry", F.lit(False))
    return normal.union(journal.remaining(items, events, retry_only=True).withColumn("retry", F.lit(True)))


@query("""WITH i AS (SELECT o_orderkey AS k, CAST(o_totalprice AS BIGINT) AS size, o_orderpriority AS etag FROM orders), v AS (SELECT o_orderkey AS k, CAST(o_totalprice AS BIGINT) + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS size, o_orderpriority AS etag FROM orders WHERE o_orderkey % 5 <> 0)
SELECT CASE WHEN v.k IS NULL THEN 'missing' WHEN i.size = v.size AND i.etag = v.etag THEN 'same' ELSE 'conflict' END AS state, count(*) AS items FROM i LEFT JOIN v USING (k) GROUP BY 1""")
def f04_j02_inventory_drift(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").cast("long").alias("size_bytes"), F.col("o_orderpriority").alias("etag"))
    there = o.where("key % 5 <> 0").select("key", (F.col("size_bytes") + (F.col("key") % 7 == 0).cast("int")).alias("size_bytes"), F.concat(F.lit('"'), "etag", F.lit('"')).alias("etag"))
    return journal.drift(o, there, "key").groupBy("state").agg(F.count("*").alias("items"))


@query("""WITH RECURSIVE o AS (SELECT o_custkey AS job, o_orderkey AS k, CAST(round(o_totalprice * 100) AS BIGINT) AS size, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
f AS (SELECT job, k, n, size, 0 AS cohort, size AS held FROM o WHERE n = 1 UNION ALL SELECT o.job, o.k, o.n, o.size, CASE WHEN held + o.size > 100000000 THEN cohort + 1 ELSE cohort END, CASE WHEN held + o.size > 100000000 THEN o.size ELSE held + o.size END FROM f JOIN o ON o.job = f.job AND o.n = f.n + 1)
SELECT job, k, CAST(cohort AS BIGINT) AS cohort FROM f""")
def w10_cohorts(spark, sf_dir):
    items = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("job"), F.col("o_orderkey").alias("k"), F.round(F.col("o_totalprice") * 100).cast("long").alias("size"))
    return journal.cohorts(items, "job", "k", "size", 100_000_000).select("job", "k", "cohort")


@query(_S + """, c AS (SELECT user_id, event_type, t, value FROM s), f AS (SELECT user_id, event_type, min(t) AS ft, max(t) AS lt, max(value) AS wv FROM c GROUP BY 1, 2),
w AS (SELECT c.user_id, c.event_type, min(c.t) AS wt FROM c JOIN f ON f.user_id = c.user_id AND f.event_type = c.event_type AND c.value = f.wv GROUP BY 1, 2),
u AS (SELECT user_id, event_type, '0-first' AS slot, ft AS t FROM f UNION ALL SELECT user_id, event_type, '1-worst', wt FROM w UNION ALL SELECT user_id, event_type, '2-last', lt FROM f)
SELECT user_id, event_type, min(slot) AS slot, round(t, 6) AS t FROM u GROUP BY user_id, event_type, t""")
def w08_t05_evidence(spark, sf_dir):
    s = _clips(spark, sf_dir).select("user_id", "event_type", "t", F.col("value").alias("score"))
    return report.evidence(s, ["user_id", "event_type"]).select("user_id", "event_type", "slot", F.round("t", 6).alias("t"))


@query("""SELECT n_name AS site, CASE o_orderstatus WHEN 'O' THEN 'good' WHEN 'F' THEN 'bad' WHEN 'P' THEN 'uncertain' ELSE 'error' END AS verdict, count(*) AS clips, round(sum(o_totalprice) / 3600, 4) AS hours
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def a09_corpus_rollup(spark, sf_dir):
    o, c, n = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    verdict = F.when(F.col("o_orderstatus") == "O", "good").when(F.col("o_orderstatus") == "F", "bad").when(F.col("o_orderstatus") == "P", "uncertain").otherwise("corrupt")
    r = o.join(c, o["o_custkey"] == c["c_custkey"]).join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"]).select(F.col("n_name").alias("site"), verdict.alias("verdict"), F.col("o_totalprice").alias("duration_seconds"))
    return report.rollup(r, ["site"]).select("site", "verdict", "clips", F.round("hours", 4).alias("hours"))


@query("SELECT round(sum(l_extendedprice) / sum(l_quantity), 6) AS source_xrt, round(7500 / (sum(l_extendedprice) / sum(l_quantity)), 6) AS projected_hours FROM lineitem")
def a11_p16_throughput(spark, sf_dir):
    r = read(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("duration_seconds"), F.col("l_quantity").alias("elapsed_seconds"))
    return report.throughput(r, 7500.0).select(F.round("source_xrt", 6).alias("source_xrt"), F.round("projected_hours", 6).alias("projected_hours"))


@query("SELECT doc_id, source AS item, regexp_full_match(source, '[A-Za-z0-9][A-Za-z0-9._:-]{0,127}') AS id_ok FROM documents")
def f01_manifest_ids(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("item"), C.valid_id(F.col("source")).alias("id_ok"))


@query("SELECT page_id, url LIKE 'https://%' AS safe, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host FROM pages")
def f05_url_safety(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", C.https_host(F.col("url")).alias("safe"), F.parse_url("url", F.lit("HOST")).alias("host"))


@query("SELECT p_partkey, least(640, p_size * 37 + 3) - least(640, p_size * 37 + 3) % 2 AS w, greatest(CAST(round_even((p_size * 11 + 7)::DOUBLE * (least(640, p_size * 37 + 3) - least(640, p_size * 37 + 3) % 2) / (p_size * 37 + 3), 0) AS BIGINT) - CAST(round_even((p_size * 11 + 7)::DOUBLE * (least(640, p_size * 37 + 3) - least(640, p_size * 37 + 3) % 2) / (p_size * 37 + 3), 0) AS BIGINT) % 2, 2) AS h FROM part")
def p02_scaled_dimensions(spark, sf_dir):
    w, h = C.even_dimensions(F.col("p_size") * 37 + 3, F.col("p_size") * 11 + 7, 640)
    return read(spark, sf_dir, "part").select("p_partkey", w.cast("int").alias("w"), h.alias("h"))


def iou_sql(a: str, b: str, epsilon: str) -> str:
    """Intersection over union in SQL; ``epsilon`` is added to the union."""
    side = lambda v, i, j: f"greatest(0e0, {v}.{j} - {v}.{i})"
    area = lambda v: f"{side(v, 'x1', 'x2')} * {side(v, 'y1', 'y2')}"
    both = " * ".join(f"greatest(0e0, least({a}.{j}, {b}.{j}) - greatest({a}.{i}, {b}.{i}))" for i, j in (("x1", "x2"), ("y1", "y2")))
    return f"coalesce({both} / nullif({area(a)} + {area(b)} - {both} + {epsilon}, 0), 0e0)"


def suppression_sql(boxes: str, threshold: str, same_class: bool) -> str:
    """Tables that follow boxes (frame, b struct, place in order): kept(frame, kept list), one recursion a box."""
    rival = f"{'k.class_id = o.b.class_id AND ' if same_class else ''}{iou_sql('k', 'o.b', '1e-9')} > {threshold}"
    return f"""f AS (SELECT frame, 1 AS place, [b] AS kept FROM {boxes} WHERE place = 1 UNION ALL
SELECT o.frame, o.place, CASE WHEN len(list_filter(f.kept, lambda k: {rival})) > 0 THEN f.kept ELSE list_append(f.kept, o.b) END FROM f JOIN {boxes} o ON o.frame = f.frame AND o.place = f.place + 1),
kept AS (SELECT frame, arg_max(kept, place) AS kept FROM f GROUP BY frame)"""


_T03 = f"""WITH RECURSIVE d AS (SELECT l_orderkey AS frame, l_linenumber, {{'n': l_linenumber, 'x1': (l_partkey % 100)::DOUBLE, 'y1': (l_suppkey % 100)::DOUBLE, 'x2': (l_partkey % 100)::DOUBLE + (l_quantity + 20), 'y2': (l_suppkey % 100)::DOUBLE + (l_quantity + 20), 'score': l_discount + l_linenumber / 1000e0}} AS b FROM lineitem),
x AS (SELECT frame, b, row_number() OVER (PARTITION BY frame ORDER BY b.score DESC, b DESC) AS place FROM d), {suppression_sql("x", "45e-2", False)}
SELECT frame AS l_orderkey, array_to_string(list_transform(kept, lambda k: k.n), ',') AS kept FROM kept"""


@query(_T03)
def t03_j13_suppression(spark, sf_dir):
    b = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") % 100).cast("double").alias("x"), (F.col("l_suppkey") % 100).cast("double").alias("y"), (F.col("l_quantity") + 20).alias("s"), (F.col("l_discount") + F.col("l_linenumber") / 1000).alias("score"))
    boxes = b.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.col("x").alias("x1"), F.col("y").alias("y1"), (F.col("x") + F.col("s")).alias("x2"), (F.col("y") + F.col("s")).alias("y2"), "score"))).alias("boxes"))
    kept = F.transform(C.suppressed(F.col("boxes"), 0.45), lambda k: k["l_linenumber"])
    return boxes.select("l_orderkey", F.array_join(kept, ",").alias("kept"))
