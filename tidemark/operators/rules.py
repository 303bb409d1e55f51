"""Rules and policies: outcomes by clip, verdicts, reasons, and the gate's dependent checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import rule_outcome

#: The ten default rules (order, id, signal, operator, threshold, boolean, severity).
DEFAULT_RULES = (
    (0, "hands-visible", "hand.visibility_fraction", ">=", 0.60, False, "reject"),
    (1, "extended-idle", "idle.fraction", "<=", 0.50, False, "reject"),
    (2, "hand-speed", "hand.motion_speed_p95", "<=", 0.75, False, "reject"),
    (3, "repetitive-motion", "motion.repetition_score", "<=", 0.85, False, "reject"),
    (4, "corrupt-video", "camera.corrupt", "==", 0.0, True, "reject"),
    (5, "black-covered", "camera.black_covered", "==", 0.0, True, "reject"),
    (6, "blur-warning", "camera.blur_fraction", "<=", 0.20, False, "warn"),
    (7, "exposure-warning", "camera.exposure_fraction", "<=", 0.20, False, "warn"),
    (8, "translation-shake", "camera.shake_p95_translation", "<=", 0.03, False, "reject"),
    (9, "rotation-shake", "camera.shake_p95_rotation", "<=", 5.0, False, "reject"),
)
RULE_SCHEMA = "ord int, rule_id string, signal string, operator string, threshold double, is_bool boolean, severity string"


def rule_array(rules=DEFAULT_RULES) -> Column:
    """Rules (order, id, signal, operator, threshold, boolean, severity), a list of a configuration, as one constant."""
    names = ("ord", "rule_id", "signal", "operator", "threshold", "is_bool", "severity")
    return F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, r))) for r in rules))


def rule_results(signals: DataFrame, rules, clip: str) -> DataFrame:
    """signals(clip, signal, value, is_bool, low, high) by rules (a list, see ``rule_array``): one row for each clip and rule, with its outcome.

    A clip's signals, a closed vocabulary, become one map, so one shuffle serves all rules. A rule whose signal a clip lacks fails the
    query. Whether a value is a boolean, to which no interval applies, is the signal's affair (``is_bool``), not the rule's.
    """
    flag = F.col("is_bool") if "is_bool" in signals.columns else F.lit(False)
    entry = F.struct("signal", F.struct(F.col("value").cast("double").alias("value"), flag.alias("is_bool"), F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high")).alias("s"))
    held = signals.groupBy(clip).agg(F.map_from_entries(F.collect_list(entry)).alias("held"))

    return held.select(clip, F.explode(outcomes(F.col("held"), rules)).alias("r")).select(clip, "r.*")


def outcomes(held: Column, rules) -> Column:
    """A clip's signals (a map to value, is_bool, low, high) by rules: an array of one result a rule. A signal that isn't there fails the query."""

    def result(r: Column) -> Column:
        s = F.try_element_at(held, r["signal"])
        value = F.coalesce(s["value"], F.raise_error(F.concat(F.lit("no signal "), r["signal"])).cast("double"))
        outcome = rule_outcome(value, s["is_bool"], r["operator"], r["threshold"], s["low"], s["high"])
        return F.struct(r["ord"].alias("ord"), r["rule_id"].alias("rule_id"), r["signal"].alias("signal"), r["severity"].alias("severity"), value.alias("value"), outcome.alias("outcome"))

    return F.transform(rule_array(rules), result)


#: Signals that the probability of a good clip draws from replicates, not from their points.
SAMPLED = ("hand.visibility_fraction", "idle.fraction")


def other_rejects(rules) -> list:
    """Reject rules but those on sampled signals."""
    return [r for r in rules if r[6] == "reject" and r[2] not in SAMPLED]


def other_rejects_pass(signals: DataFrame, rules, clip: str) -> DataFrame:
    """(clip, eligible): whether all reject rules but those on sampled signals pass by their point values, intervals or not."""
    points = signals.withColumns({c: F.lit(None).cast("double") for c in ("low", "high")})
    return rule_results(points, other_rejects(rules), clip).groupBy(clip).agg(F.bool_and(F.col("outcome") == "pass").alias("eligible"))


def verdict(results: Column) -> Column:
    """Results of a clip's rules, an array in rule order, to struct(verdict, reasons): bad if a reject rule fails, uncertain if one is uncertain, else good.
    Reasons are in rule order: all fails, and uncertain reject rules only where no reject rule fails."""
    reject = lambda x, outcome: (x["severity"] == "reject") & (x["outcome"] == outcome)
    failed, unsure = F.exists(results, lambda x: reject(x, "fail")), F.exists(results, lambda x: reject(x, "uncertain"))
    named = F.filter(results, lambda x: (x["outcome"] == "fail") | (~failed & reject(x, "uncertain")))
    return F.struct(F.when(failed, "bad").when(unsure, "uncertain").otherwise("good").alias("verdict"), F.array_join(F.transform(named, lambda x: x["rule_id"]), ",").alias("reasons"))


def verdicts(results: DataFrame, clip: str) -> DataFrame:
    """(clip, verdict, reasons): ``verdict`` of rows, one for each clip and rule."""
    held = results.groupBy(clip).agg(F.array_sort(F.collect_list(F.struct("ord", "rule_id", "severity", "outcome"))).alias("all"))
    return held.select(clip, verdict(F.col("all")).alias("v")).select(clip, "v.*")


def _at_least(value: Column, low: Column, high: Column, threshold: float) -> Column:
    point = F.when(value >= threshold, "pass").otherwise("fail")
    return F.when(low.isNull(), point).otherwise(F.when(low >= threshold, "pass").when(high < threshold, "fail").otherwise("uncertain"))


def _at_most(value: Column, low: Column, high: Column, threshold: float) -> Column:
    point = F.when(value <= threshold, "pass").otherwise("fail")
    return F.when(low.isNull(), point).otherwise(F.when(high <= threshold, "pass").when(low > threshold, "fail").otherwise("uncertain"))


#: The standard policy's thresholds, in percent, degrees a second and score.
STANDARD = {"hands": 60.0, "idle": 50.0, "translation": 3.0, "rotation": 5.0, "repetition": 0.85, "blur": 20.0, "exposure": 20.0}


def gate(context: DataFrame, policy: dict[str, float] = STANDARD) -> DataFrame:
    """context(camera_covered, hands, hands_low, hands_high, idle, idle_low, idle_high, translation, rotation, repetition, blur,
    exposure) to the five checks, two warnings and the verdict. Checks that depend on a covered camera or missing hands are
    not_applicable; a clip is good only if its hands pass."""
    na, none = F.lit("not_applicable"), F.lit(None).cast("double")
    hands = _at_least(F.col("hands"), F.col("hands_low"), F.col("hands_high"), policy["hands"])
    covered = F.when(F.col("camera_covered"), "fail").otherwise("pass")
    steady = F.when((F.col("translation") <= policy["translation"]) & (F.col("rotation") <= policy["rotation"]), "pass").otherwise("fail")
    out = context.withColumn("covered_check", covered).withColumn("hands_check", F.when(F.col("covered_check") == "fail", na).otherwise(hands))
    open_, dependent = F.col("covered_check") == "pass", F.col("hands_check") == "pass"
    out = out.withColumn("idle_check", F.when(dependent, _at_most(F.col("idle"), F.col("idle_low"), F.col("idle_high"), policy["idle"])).otherwise(na))
    out = out.withColumn("steady_check", steady)
    out = out.withColumn("repetition_check", F.when(dependent, _at_most(F.col("repetition"), none, none, policy["repetition"])).otherwise(na))
    for name in ("blur", "exposure"):
        out = out.withColumn(f"{name}_warning", F.when(open_, _at_most(F.col(name), none, none, policy[name])).otherwise(na))
    checks = [F.col(f"{c}_check") for c in ("covered", "hands", "idle", "steady", "repetition")]
    failed, unsure = (sum((F.when(c == state, 1).otherwise(0) for c in checks), F.lit(0)) > 0 for state in ("fail", "uncertain"))
    return out.withColumn("verdict", F.when(failed, "bad").when(unsure, "uncertain").otherwise("good"))
