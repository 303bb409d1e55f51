"""Evidence selection and the corpus report."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rules import SAMPLED


def evidence(candidates: DataFrame, keys: list[str], t: str = "t", score: str = "score") -> DataFrame:
    """First, worst (the earliest of equals) and last candidate of each key, each moment once: (keys, slot, t, score)."""
    at = F.struct(t, score)
    agg = candidates.groupBy(*keys).agg(F.min(at).alias("first"), F.max(F.struct(F.col(score).alias("s"), (-F.col(t)).alias("n"))).alias("worst"), F.max(at).alias("last"))
    slots = agg.select(*keys, F.explode(F.array(
        F.struct(F.lit("0-first").alias("slot"), F.col(f"first.{t}").alias(t), F.col(f"first.{score}").alias(score)),
        F.struct(F.lit("1-worst").alias("slot"), (-F.col("worst.n")).alias(t), F.col("worst.s").alias(score)),
        F.struct(F.lit("2-last").alias("slot"), F.col(f"last.{t}").alias(t), F.col(f"last.{score}").alias(score)),
    )).alias("e")).select(*keys, "e.*")
    return slots.groupBy(*keys, t).agg(F.min(F.struct("slot", score)).alias("e")).select(*keys, "e.slot", t, f"e.{score}")


def evidence_by_image(candidates: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """First, worst (the earliest of equals) and last candidate of each key in the order of ``order``, a piece (time, hash of the image) once:
    candidates(keys, order, t, score, image, ...) to (keys, slot, t, score, sha256, size_bytes). Images are hashed after the selection."""
    own = F.struct("t", "score", "image")
    agg = candidates.groupBy(*keys).agg(
        F.min_by(own, order).alias("first"), F.max_by(own, F.struct("score", (-F.col(order)).alias("o"))).alias("worst"), F.max_by(own, order).alias("last")
    )
    slots = agg.select(*keys, F.posexplode(F.array("first", "worst", "last")).alias("slot", "e"))
    hashed = slots.select(*keys, "slot", "e.t", "e.score", F.sha2("e.image", 256).alias("sha256"), F.octet_length("e.image").cast("long").alias("size_bytes"))
    return hashed.groupBy(*keys, "t", "sha256").agg(F.min(F.struct("slot", "score", "size_bytes")).alias("e")).select(*keys, "e.slot", "t", "e.score", "sha256", "e.size_bytes")


def kept_evidence(evidence: DataFrame, results: DataFrame, clip: str, reason: str = "reason") -> DataFrame:
    """Evidence whose reason is a rule that didn't pass for its clip."""
    return evidence.join(results.where("outcome <> 'pass'").select(clip, F.col("rule_id").alias(reason)).distinct(), [clip, reason], "left_semi")


def totals(items: DataFrame, results: DataFrame, item: str) -> DataFrame:
    """One row: clips and hours of the manifest and of what was processed. A clip's duration is the manifest's, else (null or 0) its result's."""
    of_result = results.select(item, F.col("duration_seconds").alias("_result"))
    planned = items.select(item, "duration_seconds").join(of_result, item, "left")
    duration = F.coalesce(F.nullif("duration_seconds", F.lit(0.0)), "_result", F.lit(0.0))
    none, zero = F.lit(0).cast("long"), F.lit(0.0)
    rows = planned.select(F.lit(1).cast("long").alias("c"), duration.alias("ch"), none.alias("p"), zero.alias("ph"))
    rows = rows.union(results.select(none, zero, F.lit(1).cast("long"), F.coalesce("duration_seconds", zero)))
    total = lambda c, by, zero: F.coalesce(F.sum(c) / by if by else F.sum(c), zero)
    return rows.agg(total("c", 0, none).alias("captured_clips"), total("ch", 3600, zero).alias("captured_hours"), total("p", 0, none).alias("processed_clips"), total("ph", 3600, zero).alias("processed_hours"))


def good_hours_of_samples(samples: DataFrame, hours: str, replicate: str, good: str, confidence: float = 0.95) -> DataFrame:
    """Interval of the good hours from verdict samples (one row a clip and replicate): (low, high)."""
    by_replicate = samples.groupBy(replicate).agg(F.sum(F.when(F.col(good), F.col(hours)).otherwise(0.0)).alias("h"))
    tail = (1.0 - confidence) / 2.0
    return by_replicate.agg(F.percentile("h", F.lit(tail)).alias("low"), F.percentile("h", F.lit(1.0 - tail)).alias("high"))


def ordered_items(results: DataFrame, item: str = "item_id", *then: str) -> DataFrame:
    return results.orderBy(item, *then)


def status(processed: Column, complete: Column) -> Column:
    return F.when(complete, "complete").when(processed > 0, "partial").otherwise("error")


def compared(results: DataFrame, baseline: DataFrame, item: str) -> DataFrame:
    """Results beside an older run's of the same item: baseline_verdict, baseline_xrt (null where there is none), ``changed`` and ``speedup``."""
    old = baseline.select(item, F.col("verdict").alias("baseline_verdict"), F.col("source_xrt").alias("baseline_xrt"))
    joined = results.join(old, item, "left")
    return joined.withColumns({"changed": F.col("verdict") != F.col("baseline_verdict"), "speedup": F.try_divide("source_xrt", "baseline_xrt")})


def canonical_hash(fields: dict[str, Column]) -> Column:
    """SHA-256 of a flat document as compact JSON with sorted keys. Values are texts, whole numbers or booleans; null is kept."""
    spelled = lambda c: F.coalesce(F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'^\{"v":([\s\S]*)\}\z', 1), F.lit("null"))
    value = lambda c: F.when(c.isNull(), "null").otherwise(spelled(c))
    pairs = [F.concat(F.lit(f'"{k}":'), value(fields[k])) for k in sorted(fields)]
    return F.sha2(F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}")), 256)


def canonical_json(text: Column) -> Column:
    """A JSON document at any depth as compact JSON with the keys of every object sorted by code point and beyond ASCII escaped; of repeated keys the last
    counts. Null for null and for what isn't JSON."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            try:
                out.append(None if t is None else json.dumps(json.loads(t), sort_keys=True, separators=(",", ":")))
            except (ValueError, RecursionError):
                out.append(None)
        return pa.array(out, pa.string())

    return run(text)


def document_hash(text: Column) -> Column:
    """SHA-256 of a document's canonical form: equal for documents that differ in the order of keys and in white space only."""
    return F.sha2(canonical_json(text), 256)


def write_report(report: DataFrame, path: str) -> None:
    """One JSON document at ``path``, which must not exist; the commit of the write makes it visible as a whole."""
    report.coalesce(1).write.mode("errorifexists").json(path)


def rollup(results: DataFrame, by: list[str]) -> DataFrame:
    """Clips, hours and shares by verdict; a verdict outside good, bad and uncertain counts as error."""
    verdict = F.when(F.col("verdict").isin("good", "bad", "uncertain"), F.col("verdict")).otherwise("error")
    return results.withColumn("verdict", verdict).groupBy(*by, "verdict").agg(F.count("*").alias("clips"), (F.sum("duration_seconds") / 3600).alias("hours"))


def throughput(results: DataFrame, corpus_hours: float) -> DataFrame:
    """One row: source seconds for each second of processing, and the hours that the corpus would take (null where unknown)."""
    sums = results.agg(F.sum("duration_seconds").alias("d"), F.sum("elapsed_seconds").alias("e"))
    xrt = F.coalesce(F.try_divide(F.col("d"), F.when(F.col("e") > 0, F.col("e"))), F.lit(0.0))
    return sums.select(xrt.alias("source_xrt"), F.try_divide(F.lit(float(corpus_hours)), F.nullif(xrt, F.lit(0.0))).alias("projected_hours"))


def good_probability(samples: DataFrame, clip: str, hand: str, idle: str, eligible: str, least_hand: float, most_idle: float) -> DataFrame:
    """Share of a clip's replicates that meet both bounds; 0 where the other rules fail or a replicate lacks a value. NaN meets none."""
    both = (F.col(hand) >= least_hand) & ~F.isnan(hand) & (F.col(idle) <= most_idle) & ~F.isnan(idle)
    share = F.avg(F.coalesce(both, F.lit(False)).cast("double"))
    return samples.groupBy(clip).agg(F.when(F.bool_and(eligible), share).otherwise(0.0).alias("probability"))


#: Operators whose rules a replicate must meet.
_MEETS = {">=": lambda v, t: v >= t, ">": lambda v, t: v > t, "<=": lambda v, t: v <= t, "<": lambda v, t: v < t}


def good_probability_of_samples(hand: Column, idle: Column, eligible: Column, rules) -> Column:
    """Share of a clip's replicates, two arrays of bootstrap samples as far as both go, that meet all reject rules on the two sampled signals;
    0 without samples or where the other rules fail. ``rules`` as in ``rules.DEFAULT_RULES``: several rules of one signal all hold, one with another
    operator than these four asks nothing of a replicate. NaN meets none."""
    own = [(SAMPLED.index(r[2]), _MEETS[r[3]], float(r[4])) for r in rules if r[6] == "reject" and r[2] in SAMPLED and r[3] in _MEETS]
    n = F.least(F.size(hand), F.size(idle))

    def meets(h: Column, i: Column) -> Column:
        met = F.lit(True)
        for which, compare, threshold in own:
            met = met & compare((h, i)[which], F.lit(threshold)) & ~F.isnan((h, i)[which])
        return F.when(met, 1.0).otherwise(0.0)

    pairs = F.zip_with(F.slice(hand, F.lit(1), n), F.slice(idle, F.lit(1), n), meets)
    share = F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x) / n
    return F.coalesce(F.when(F.coalesce(eligible, F.lit(False)) & (n > 0), share), F.lit(0.0))


def summary(items: DataFrame, results: DataFrame, item: str, corpus_hours: float, replicates: int, seed: int, confidence: float = 0.95) -> DataFrame:
    """The report's one row: items(item, duration_seconds) of the manifest and results(item, verdict, duration_seconds, elapsed_seconds, probability) of
    what was processed to captured and processed clips and hours, clips and hours by verdict, the interval of good hours, ``source_xrt``,
    ``projected_hours`` and ``status``. Without results the interval is null."""
    own = results.select(F.col(item), F.lit(1).cast("long").alias("p"), F.when(F.col("verdict").isin("good", "bad", "uncertain"), F.col("verdict")).otherwise("error").alias("verdict"), "duration_seconds", "elapsed_seconds", "probability")
    given = F.nullif("duration_seconds", F.lit(0.0))
    planned = items.groupBy(F.col(item).alias("_item")).agg(F.count("*").alias("c"), F.sum(given).alias("given"), F.count_if(given.isNull()).alias("open"))
    both = planned.join(own, F.col("_item") == F.col(item), "full_outer")
    # results are worked out once: a row's counts go with number -1, its draws with the replicates' numbers
    numbers = F.when(F.col("p").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(-1), F.lit(replicates - 1)))
    rows = both.select("*", F.explode(numbers).alias("r"))
    counts, zero, none = F.col("r") < 0, F.lit(0.0), F.lit(0).cast("long")
    total = lambda value, name: F.sum(F.when(counts, value)).alias(name)
    captured = F.coalesce("given", zero) + F.col("open") * F.coalesce("duration_seconds", zero)
    parts = [total(F.col("c"), "captured_clips"), total(F.when(F.col("c") > 0, captured), "captured_hours"), total(F.col("p"), "processed_clips"), total(F.when(F.col("p") > 0, F.coalesce("duration_seconds", zero)), "processed_hours")]
    for v in ("good", "bad", "uncertain", "error"):
        parts += [total((F.col("verdict") == v).cast("long"), f"{v}_clips"), total(F.when(F.col("verdict") == v, F.col("duration_seconds")), f"{v}_hours")]
    parts += [total(F.col("duration_seconds"), "d"), total(F.col("elapsed_seconds"), "e")]
    drawn = F.when(_draw(item, seed) < F.coalesce("probability", zero), F.col("duration_seconds") / 3600).otherwise(0.0)
    by = rows.groupBy("r").agg(*parts, F.sum(F.when(~counts, drawn)).alias("h"))
    tail = (1.0 - confidence) / 2.0
    sums = [c for c in by.columns if c not in ("r", "h")]
    interval = (F.percentile("h", F.lit(q)).alias(n) for q, n in ((tail, "good_hours_low"), (1.0 - tail, "good_hours_high")))
    one = by.agg(*(F.max(c).alias(c) for c in sums), *interval)
    xrt = F.coalesce(F.try_divide("d", F.when(F.col("e") > 0, F.col("e"))), zero)
    one = one.select(
        *(F.coalesce(F.col(c) / 3600, zero).alias(c) if c.endswith("hours") else F.coalesce(c, none).alias(c) for c in sums if c not in ("d", "e")),
        "good_hours_low", "good_hours_high", xrt.alias("source_xrt"), F.try_divide(F.lit(float(corpus_hours)), F.nullif(xrt, zero)).alias("projected_hours"),
    )
    return one.withColumn("status", status(F.col("processed_clips"), F.col("processed_clips") == F.col("captured_clips")))


def _draw(item: str, seed: int) -> Column:
    """A number from 0 to 1 by the hash of an item and of the replicate ``r``."""
    digits = F.substring(F.sha2(F.concat_ws("|", F.lit(seed), F.col(item), F.col("r")), 256), 1, 8)
    return F.conv(digits, 16, 10).cast("long") / float(1 << 32)


def good_hours(items: DataFrame, item: str, probability: str, hours: str, replicates: int, seed: int, confidence: float = 0.95) -> DataFrame:
    """Interval of the hours that are good: in each replicate an item counts with its probability, by a draw from its hash.

    Draws are summed by replicate before the shuffle, so only ``replicates`` rows leave a task.
    """
    drawn = items.select("*", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("r"))
    counted = F.when(_draw(item, seed) < F.coalesce(F.col(probability), F.lit(0.0)), F.col(hours)).otherwise(0.0)
    totals = drawn.groupBy("r").agg(F.sum(counted).alias("h"))
    tail = (1.0 - confidence) / 2.0
    return totals.agg(F.percentile("h", F.lit(tail)).alias("low"), F.percentile("h", F.lit(1.0 - tail)).alias("high"))
