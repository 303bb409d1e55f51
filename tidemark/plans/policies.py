"""Queries from signals to verdicts. A user of ``events`` is a clip; one in 17 can't be read."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import policy, rules, signals
from tidemark.plans.gate import query
from tidemark.plans.tables import read

#: Names of signals and the columns of their stand-ins, in both languages.
_NAMES = {
    "hand.visibility_fraction": "vis", "hand.motion_speed_p95": "speed", "idle.fraction": "idle", "motion.repetition_score": "rep", "camera.corrupt": "cor", "camera.black_covered": "black",
    "camera.blur_fraction": "blur", "camera.exposure_fraction": "expo", "camera.shake_p95_translation": "trans", "camera.shake_p95_rotation": "rot",
}
_UNPIVOT = ", ".join(
    f"{{'signal': '{n}', 'value': {'CASE WHEN ' + c + ' THEN 1e0 ELSE 0e0 END' if n in signals.BOOLEAN else c}, 'is_bool': {str(n in signals.BOOLEAN).lower()}, "
    f"'low': {c + ' - 5e-2' if c in ('vis', 'idle') else c + ' - 1e-2' if c == 'speed' else 'NULL::DOUBLE'}, 'high': {c + ' + 5e-2' if c in ('vis', 'idle') else c + ' + 1e-2' if c == 'speed' else 'NULL::DOUBLE'}}}"
    for n, c in _NAMES.items()
)
_FIXED = ", ".join(
    f"{{'signal': '{n}', 'value': {v}e0, 'is_bool': {str(n in signals.BOOLEAN).lower()}, 'low': {'NULL::DOUBLE' if lo is None else str(lo) + 'e0'}, 'high': {'NULL::DOUBLE' if hi is None else str(hi) + 'e0'}}}" for n, (v, lo, hi) in signals.CORRUPT.items()
)
_S = f"""WITH m AS (SELECT user_id, avg(CASE WHEN event_type <> 'error' THEN 1e0 ELSE 0e0 END) AS vis, quantile_cont(value, 0.95) / 250 AS speed,
avg(CASE WHEN event_type <> 'error' THEN CASE WHEN event_type IN ('view', 'click') THEN 1e0 ELSE 0e0 END END) AS idle, least(1e0, avg(value) / 65) AS rep, false AS cor, count(*) FILTER (WHERE event_type = 'error') * 100 > count(*) * 29 AS black,
avg(CASE WHEN value < 9 THEN 1e0 ELSE 0e0 END) AS blur, avg(CASE WHEN value > 75 THEN 1e0 ELSE 0e0 END) AS expo, avg(value) / 1900 AS trans, quantile_cont(value, 0.95) / 35 AS rot FROM events WHERE user_id % 17 <> 0 GROUP BY user_id),
s AS (SELECT user_id, unnest([{_UNPIVOT}], recursive := true) FROM m UNION ALL SELECT user_id, unnest([{_FIXED}], recursive := true) FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 17 = 0))"""
_RULES = ", ".join(f"({o}, '{i}', '{s}', '{op}', {t}::DOUBLE, '{sev}')" for o, i, s, op, t, _, sev in rules.DEFAULT_RULES)
_R = f""", r(ord, rule_id, signal, operator, thr, severity) AS (VALUES {_RULES}),
e AS (SELECT user_id, ord, rule_id, severity, s.signal, CASE WHEN is_bool OR operator = '==' OR low IS NULL THEN CASE WHEN (operator = '>=' AND value >= thr) OR (operator = '<=' AND value <= thr) OR (operator = '==' AND value = thr) THEN 'pass' ELSE 'fail' END
WHEN operator = '>=' THEN CASE WHEN low >= thr THEN 'pass' WHEN high < thr THEN 'fail' ELSE 'uncertain' END ELSE CASE WHEN high <= thr THEN 'pass' WHEN low > thr THEN 'fail' ELSE 'uncertain' END END AS outcome,
(operator = '>=' AND value >= thr) OR (operator = '<=' AND value <= thr) OR (operator = '==' AND value = thr) AS point FROM r JOIN s ON r.signal = s.signal),
v AS (SELECT user_id, bool_or(severity = 'reject' AND outcome = 'fail') AS f, bool_or(severity = 'reject' AND outcome = 'uncertain') AS u FROM e GROUP BY user_id)"""


def _signals(spark, sf_dir):
    e, value = read(spark, sf_dir, "events"), F.col("value")
    seen, share = F.col("event_type") != "error", lambda c: F.avg(c.cast("double"))
    m = e.where("user_id % 17 <> 0").groupBy("user_id").agg(
        share(seen).alias("vis"), (F.percentile("value", F.lit(0.95)) / 250).alias("speed"), share(F.when(seen, F.col("event_type").isin("view", "click"))).alias("idle"),
        F.least(F.lit(1.0), F.avg("value") / 65).alias("rep"), F.lit(False).alias("cor"), (F.sum(F.when(~seen, 1).otherwise(0)) * 100 > F.count("*") * 29).alias("black"), share(value < 9).alias("blur"),
        share(value > 75).alias("expo"), (F.avg("value") / 1900).alias("trans"), (F.percentile("value", F.lit(0.95)) / 35).alias("rot"),
    )
    rows = signals.signal_rows(m, "user_id", {n: F.col(c) for n, c in _NAMES.items()})
    around = [F.when(F.col(c).isNotNull(), F.struct(F.lit(n).alias("signal"), (F.col(c) - d).alias("low"), (F.col(c) + d).alias("high"))) for n, c, d in (("hand.visibility_fraction", "vis", 0.05), ("idle.fraction", "idle", 0.05), ("hand.motion_speed_p95", "speed", 0.01))]
    intervals = m.select("user_id", F.explode(F.array(*around)).alias("x")).select("user_id", "x.*")
    return signals.with_corrupt(signals.with_intervals(rows, intervals, "user_id"), e.select("user_id").distinct(), "user_id")


@query(_S + " SELECT user_id, signal, round(value, 6) AS value, is_bool, round(low, 6) AS low, round(high, 6) AS high FROM s")
def p07_j04_p18_signal_vector(spark, sf_dir):
    return _signals(spark, sf_dir).select("user_id", "signal", *(F.round(c, 6).alias(c) for c in ("value",)), "is_bool", *(F.round(c, 6).alias(c) for c in ("low", "high")))


@query(_S + _R + """ SELECT e.user_id, any_value(CASE WHEN f THEN 'bad' WHEN u THEN 'uncertain' ELSE 'good' END) AS verdict,
coalesce(string_agg(rule_id, ',' ORDER BY ord) FILTER (WHERE outcome = 'fail' OR (NOT f AND severity = 'reject' AND outcome = 'uncertain')), '') AS reasons FROM e JOIN v ON e.user_id = v.user_id GROUP BY e.user_id""")
def j03_f02_f07_a14_a15_ten_rules(spark, sf_dir):
    return rules.verdicts(rules.rule_results(_signals(spark, sf_dir), rules.DEFAULT_RULES, "user_id"), "user_id")


@query(_S + _R + " SELECT user_id, bool_and(point) AS eligible FROM e WHERE severity = 'reject' AND signal NOT IN ('hand.visibility_fraction', 'idle.fraction') GROUP BY user_id")
def f12_other_rejects_pass(spark, sf_dir):
    return rules.other_rejects_pass(_signals(spark, sf_dir), rules.DEFAULT_RULES, "user_id")


_X = """, x AS (SELECT user_id, bool_or(signal = 'camera.black_covered' AND value <> 0) AS camera_covered, max(100 * value) FILTER (WHERE signal = 'hand.visibility_fraction') AS hands, max(100 * low) FILTER (WHERE signal = 'hand.visibility_fraction') AS hands_low,
max(100 * high) FILTER (WHERE signal = 'hand.visibility_fraction') AS hands_high, max(100 * value) FILTER (WHERE signal = 'idle.fraction') AS idle, max(100 * low) FILTER (WHERE signal = 'idle.fraction') AS idle_low, max(100 * high) FILTER (WHERE signal = 'idle.fraction') AS idle_high,
max(100 * value) FILTER (WHERE signal = 'camera.shake_p95_translation') AS translation, max(value) FILTER (WHERE signal = 'camera.shake_p95_rotation') AS rotation, max(value) FILTER (WHERE signal = 'motion.repetition_score') AS repetition,
max(100 * value) FILTER (WHERE signal = 'camera.blur_fraction') AS blur, max(100 * value) FILTER (WHERE signal = 'camera.exposure_fraction') AS exposure FROM s GROUP BY user_id)"""
_G = _X + """, c AS (SELECT *, CASE WHEN camera_covered THEN 'fail' ELSE 'pass' END AS cov, CASE WHEN camera_covered THEN 'not_applicable' WHEN hands_low >= 60 THEN 'pass' WHEN hands_high < 60 THEN 'fail' ELSE 'uncertain' END AS han,
CASE WHEN translation <= 3 AND rotation <= 5 THEN 'pass' ELSE 'fail' END AS ste FROM x),
g AS (SELECT *, CASE WHEN han <> 'pass' THEN 'not_applicable' WHEN idle_high <= 50 THEN 'pass' WHEN idle_low > 50 THEN 'fail' ELSE 'uncertain' END AS idl, CASE WHEN han <> 'pass' THEN 'not_applicable' WHEN repetition <= 85e-2 THEN 'pass' ELSE 'fail' END AS rpt,
CASE WHEN cov = 'fail' THEN 'not_applicable' WHEN blur <= 20 THEN 'pass' ELSE 'fail' END AS blu, CASE WHEN cov = 'fail' THEN 'not_applicable' WHEN exposure <= 20 THEN 'pass' ELSE 'fail' END AS exq FROM c),
k AS (SELECT user_id, unnest([{'ord': 0, 'check': 'camera_covered', 'outcome': cov}, {'ord': 1, 'check': 'hands_visible', 'outcome': han}, {'ord': 2, 'check': 'worker_idle', 'outcome': idl}, {'ord': 3, 'check': 'camera_steadiness', 'outcome': ste},
{'ord': 4, 'check': 'repetitive_motion', 'outcome': rpt}, {'ord': 5, 'check': 'blurry', 'outcome': blu}, {'ord': 6, 'check': 'bad_exposure', 'outcome': exq}], recursive := true) FROM g)"""


@query(_S + _X + " SELECT user_id, camera_covered, " + ", ".join(f"round({c}, 5) AS {c}" for c in ("hands", "hands_low", "hands_high", "idle", "idle_low", "idle_high", "translation", "rotation", "repetition", "blur", "exposure")) + " FROM x")
def p08_policy_context(spark, sf_dir):
    out = policy.context(_signals(spark, sf_dir), "user_id")
    return out.select(*(F.round(c, 5).alias(c) if c not in ("user_id", "camera_covered") else c for c in out.columns))


def _gated(spark, sf_dir):
    return rules.gate(policy.context(_signals(spark, sf_dir), "user_id"))


@query(_S + _G + ' SELECT user_id, ord, "check", outcome FROM k')
def u02_checks_and_warnings(spark, sf_dir):
    return policy.check_rows(_gated(spark, sf_dir), "user_id")


@query(_S + _G + """, q AS (SELECT user_id, unnest([{'rule_id': 'black-covered', 'severity': 'reject', 'value': CASE WHEN camera_covered THEN 1e0 ELSE 0e0 END, 'outcome': cov, 'low': NULL::DOUBLE, 'high': NULL::DOUBLE},
{'rule_id': 'hands-visible', 'severity': 'reject', 'value': hands / 100, 'outcome': han, 'low': hands_low / 100, 'high': hands_high / 100}, {'rule_id': 'extended-idle', 'severity': 'reject', 'value': idle / 100, 'outcome': idl, 'low': idle_low / 100, 'high': idle_high / 100},
{'rule_id': 'translation-shake', 'severity': 'reject', 'value': translation / 100, 'outcome': CASE WHEN translation <= 3 THEN 'pass' ELSE 'fail' END, 'low': NULL, 'high': NULL}, {'rule_id': 'rotation-shake', 'severity': 'reject', 'value': rotation, 'outcome': CASE WHEN rotation <= 5 THEN 'pass' ELSE 'fail' END, 'low': NULL, 'high': NULL},
{'rule_id': 'repetitive-motion', 'severity': 'reject', 'value': repetition, 'outcome': rpt, 'low': NULL, 'high': NULL}, {'rule_id': 'blur-warning', 'severity': 'warn', 'value': blur / 100, 'outcome': blu, 'low': NULL, 'high': NULL}, {'rule_id': 'exposure-warning', 'severity': 'warn', 'value': exposure / 100, 'outcome': exq, 'low': NULL, 'high': NULL}], recursive := true) FROM g)
SELECT user_id, rule_id, severity, outcome, round(value, 6) AS value, round(low, 6) AS low, round(high, 6) AS high FROM q WHERE outcome <> 'not_applicable'""")
def p10_gate_rule_results(spark, sf_dir):
    out = policy.rule_results(_gated(spark, sf_dir), "user_id", rules.STANDARD)
    return out.select("user_id", "rule_id", "severity", "outcome", *(F.round(c, 6).alias(c) for c in ("value", "low", "high")))


_REASONS = ", ".join(f"('{r}', '{c}')" for r, c in policy.REASON_CHECKS.items())


@query(_S + _G + f""", y(reason, name) AS (VALUES {_REASONS}) SELECT user_id, reason FROM k JOIN y ON name = "check" WHERE outcome = 'fail'""")
def j05_failed_reasons(spark, sf_dir):
    return policy.failed_reasons(policy.check_rows(_gated(spark, sf_dir), "user_id"), "user_id")


_COMPILED = ", ".join(f"{{'ord': {o}, 'rule_id': '{i}', 'signal': '{s}', 'operator': '{op}', 'threshold': {f'{f} / {by}e0' if f else '0e0'}, 'is_bool': {str(b).lower()}, 'severity': '{sev}'}}" for o, i, s, op, f, by, b, sev in policy.COMPILED)


@query(f"""WITH p AS (SELECT n_name AS name, n_nationkey * 4e0 AS hands, n_nationkey * 2e0 AS idle, n_nationkey / 10e0 AS translation, n_nationkey / 5e0 AS rotation, n_nationkey / 25e0 AS repetition, n_nationkey * 3e0 AS blur, n_nationkey * 1e0 AS exposure FROM nation),
u AS (SELECT name, unnest([{_COMPILED}], recursive := true) FROM p) SELECT name, ord, rule_id, signal, operator, round(threshold, 8) AS threshold, is_bool, severity FROM u""")
def p09_policy_rules(spark, sf_dir):
    k = F.col("n_nationkey")
    fields = {"hands": k * 4.0, "idle": k * 2.0, "translation": k / 10.0, "rotation": k / 5.0, "repetition": k / 25.0, "blur": k * 3.0, "exposure": k * 1.0}
    policies = read(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), *(c.alias(n) for n, c in fields.items()))
    return policy.compiled(policies).withColumn("threshold", F.round("threshold", 8))
