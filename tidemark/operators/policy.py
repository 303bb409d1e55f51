"""Policies in percent: what they make of a clip's signals, the rules that they stand for, and their checks as rule results again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.signals import wide

#: Context field, its signal, the factor to percent, the fields of its interval.
CONTEXT = (
    ("hands", "hand.visibility_fraction", 100.0, True), ("idle", "idle.fraction", 100.0, True), ("translation", "camera.shake_p95_translation", 100.0, False),
    ("rotation", "camera.shake_p95_rotation", 1.0, False), ("repetition", "motion.repetition_score", 1.0, False), ("blur", "camera.blur_fraction", 100.0, False),
    ("exposure", "camera.exposure_fraction", 100.0, False),
)
#: Rules of a policy (order, id, signal, operator, policy field or fixed threshold, divisor, boolean, severity).
COMPILED = (
    (0, "hands-visible", "hand.visibility_fraction", ">=", "hands", 100.0, False, "reject"), (1, "extended-idle", "idle.fraction", "<=", "idle", 100.0, False, "reject"),
    (2, "repetitive-motion", "motion.repetition_score", "<=", "repetition", 1.0, False, "reject"), (3, "corrupt-video", "camera.corrupt", "==", None, 1.0, True, "reject"),
    (4, "black-covered", "camera.black_covered", "==", None, 1.0, True, "reject"), (5, "blur-warning", "camera.blur_fraction", "<=", "blur", 100.0, False, "warn"),
    (6, "exposure-warning", "camera.exposure_fraction", "<=", "exposure", 100.0, False, "warn"),
    (7, "translation-shake", "camera.shake_p95_translation", "<=", "translation", 100.0, False, "reject"),
    (8, "rotation-shake", "camera.shake_p95_rotation", "<=", "rotation", 1.0, False, "reject"),
)
#: Evidence reason to the check that it belongs to.
REASON_CHECKS = {
    "black-covered": "camera_covered", "hands-visible": "hands_visible", "extended-idle": "worker_idle", "translation-shake": "camera_steadiness",
    "rotation-shake": "camera_steadiness", "repetitive-motion": "repetitive_motion", "blur-warning": "blurry", "exposure-warning": "bad_exposure",
}
#: Check, the column of its outcome, the context field that it measures, its rule, signal, divisor and severity.
CHECKS = (
    ("camera_covered", "covered_check", "camera_covered", "black-covered", "camera.black_covered", 1.0, "reject"),
    ("hands_visible", "hands_check", "hands", "hands-visible", "hand.visibility_fraction", 100.0, "reject"),
    ("worker_idle", "idle_check", "idle", "extended-idle", "idle.fraction", 100.0, "reject"),
    ("camera_steadiness", "steady_check", None, None, None, 1.0, "reject"),
    ("repetitive_motion", "repetition_check", "repetition", "repetitive-motion", "motion.repetition_score", 1.0, "reject"),
    ("blurry", "blur_warning", "blur", "blur-warning", "camera.blur_fraction", 100.0, "warn"),
    ("bad_exposure", "exposure_warning", "exposure", "exposure-warning", "camera.exposure_fraction", 100.0, "warn"),
)


def context(signals: DataFrame, clip: str) -> DataFrame:
    """Signals to one row per clip in the policy's units: camera_covered, hands, hands_low, hands_high, idle, ..., exposure. A number that is
    missing or a boolean fails the query."""
    held = wide(signals, clip)

    def number(signal: str) -> Column:
        s = F.try_element_at("held", F.lit(signal))
        return F.coalesce(F.when(~s["is_bool"], s["value"]), F.raise_error(F.lit(f"missing numeric metric {signal}")).cast("double"))

    out = [(F.try_element_at("held", F.lit("camera.black_covered"))["value"] != 0).alias("camera_covered")]
    for name, signal, factor, interval in CONTEXT:
        out.append((number(signal) * factor).alias(name))
        if interval:
            out += [(F.try_element_at("held", F.lit(signal))[end] * factor).alias(f"{name}_{end}") for end in ("low", "high")]
    return held.select(clip, *out)


def compiled(policies: DataFrame) -> DataFrame:
    """policies(name, hands, idle, translation, rotation, repetition, blur, exposure) to the nine rules of each. There is none for the speed of hands."""
    threshold = lambda field, by: F.col(field).cast("double") / by if field else F.lit(0.0)
    names = ("ord", "rule_id", "signal", "operator", "threshold", "is_bool", "severity")
    rows = [(F.lit(o), F.lit(i), F.lit(s), F.lit(op), threshold(field, by), F.lit(b), F.lit(sev)) for o, i, s, op, field, by, b, sev in COMPILED]
    return policies.select("name", F.explode(F.array(*(F.struct(*(c.alias(n) for c, n in zip(r, names))) for r in rows))).alias("r")).select("name", "r.*")


def check_rows(gated: DataFrame, clip: str) -> DataFrame:
    """The gate's checks, then its warnings, one row each: (clip, ord, check, outcome)."""
    rows = F.array(*(F.struct(F.lit(i).alias("ord"), F.lit(c[0]).alias("check"), F.col(c[1]).alias("outcome")) for i, c in enumerate(CHECKS)))
    return gated.select(clip, F.explode(rows).alias("x")).select(clip, "x.*")


def rule_results(gated: DataFrame, clip: str, policy: dict[str, float]) -> DataFrame:
    """The gate's checks as results of core rules: (clip, ord, rule_id, signal, severity, value, outcome, low, high), in fractions. Checks that
    don't apply give none; the one of steadiness gives two, by their own limits."""
    none = F.lit(None).cast("double")

    def row(place: int, rule: str, signal: str, severity: str, value: Column, outcome: Column, low: Column = none, high: Column = none) -> Column:
        named = ((F.lit(place), "ord"), (F.lit(rule), "rule_id"), (F.lit(signal), "signal"), (F.lit(severity), "severity"), (value, "value"), (outcome, "outcome"), (low, "low"), (high, "high"))
        return F.struct(*(c.alias(n) for c, n in named))

    rows = []
    for i, (name, outcome, field, rule, signal, by, severity) in enumerate(CHECKS):
        if name == "camera_steadiness":
            for k, (f, rule_, signal_, by_) in enumerate((("translation", "translation-shake", "camera.shake_p95_translation", 100.0), ("rotation", "rotation-shake", "camera.shake_p95_rotation", 1.0))):
                rows.append(row(10 * i + k, rule_, signal_, severity, F.col(f) / by_, F.when(F.col(f) <= policy[f], "pass").otherwise("fail")))
            continue
        ends = [F.col(f"{field}_{e}") / by for e in ("low", "high")] if field in ("hands", "idle") else []
        rows.append(F.when(F.col(outcome) != "not_applicable", row(10 * i, rule, signal, severity, F.col(field).cast("double") / by, F.col(outcome), *ends)))
    return gated.select(clip, F.explode(F.array_compact(F.array(*rows))).alias("x")).select(clip, "x.*")


def failed_reasons(checks: DataFrame, clip: str) -> DataFrame:
    """(clip, reason): evidence reasons whose check failed; the rest of a clip's evidence isn't kept."""
    reasons = lambda check: [r for r, c in REASON_CHECKS.items() if c == check]
    held = F.array().cast("array<string>")
    for name, *_ in CHECKS:
        held = F.when(F.col("check") == name, F.array(*map(F.lit, reasons(name)))).otherwise(held)
    return checks.where("outcome = 'fail'").select(clip, F.explode(held).alias("reason"))
