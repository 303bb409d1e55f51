"""Batch manifests: JSON documents with an explicit nested schema, their settings with defaults, their items, and what is wrong with them.

A manifest is one document; many of them are a table of texts. Nothing is inferred: fields that the schema doesn't know are reported by
``unknown_keys``, as the parser would skip them in silence. Every constraint is one boolean column, so a caller sees all that fail.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import OPERATORS, normalised_etag, normalised_key, safe_prefix, valid_id, valid_key
from tidemark.operators.rules import rule_array

#: Every setting by section, its type, its default (paths have none) and what must hold of it.
SETTINGS = {
    "sampling": (
        ("hand_fps", "double", "2", "{x} > 0 AND {x} <= 30"), ("camera_fps", "double", "5", "{x} > 0 AND {x} <= 30"),
        ("frame_width", "int", "640", "{x} BETWEEN 160 AND 1920"), ("chunk_frames", "int", "64", "{x} BETWEEN 1 AND 512"),
        ("decode_backend", "string", "cpu", "{x} IN ('cpu', 'nvdec')"),
    ),
    "detector": (
        ("backend", "string", "tensorrt", "{x} IN ('tensorrt-native', 'tensorrt', 'cuda', 'cpu')"), ("device_id", "int", "0", "{x} >= 0"),
        ("input_height", "int", "320", "{x} BETWEEN 128 AND 1280"), ("input_width", "int", "320", "{x} BETWEEN 128 AND 1280"),
        ("score_threshold", "double", "0.3", "{x} BETWEEN 0 AND 1"), ("nms_threshold", "double", "0.45", "{x} BETWEEN 0 AND 1"),
        ("tile_fallback", "boolean", "true", "true"), ("tile_overlap", "double", "0.15", "{x} >= 0 AND {x} < 0.5"),
        ("max_batch_size", "int", "32", "{x} BETWEEN 1 AND 128"), ("optimal_batch_size", "int", "16", "{x} BETWEEN 1 AND 128"),
        ("batch_wait_ms", "double", "4", "{x} BETWEEN 0 AND 100"), ("model_path", "string", None, "true"),
        ("cache_dir", "string", None, "true"), ("input_name", "string", "input", "true"),
    ),
    "camera": (
        ("black_mean_threshold", "double", "8", "{x} BETWEEN 0 AND 255"), ("entropy_threshold", "double", "1", "{x} BETWEEN 0 AND 8"),
        ("black_window_seconds", "double", "5", "{x} > 0"), ("black_window_fraction", "double", "0.9", "{x} BETWEEN 0 AND 1"),
        ("blur_laplacian_threshold", "double", "80", "{x} >= 0"), ("clipped_pixel_threshold", "double", "0.6", "{x} BETWEEN 0 AND 1"),
        ("exposure_low", "int", "5", "{x} BETWEEN 0 AND 255"), ("exposure_high", "int", "250", "{x} BETWEEN 0 AND 255"),
        ("shake_translation_threshold", "double", "0.03", "{x} >= 0"), ("shake_rotation_threshold", "double", "5", "{x} >= 0"),
    ),
    "idle": (
        ("min_run_seconds", "double", "10", "{x} > 0"), ("residual_pixel_delta", "int", "12", "{x} BETWEEN 1 AND 255"),
        ("hand_activity_fraction", "double", "0.01", "{x} BETWEEN 0 AND 1"), ("workspace_activity_fraction", "double", "0.005", "{x} BETWEEN 0 AND 1"),
        ("hand_box_expansion", "double", "0.25", "{x} BETWEEN 0 AND 2"),
    ),
    "motion": (
        ("repetition_min_period_seconds", "double", "1.5", "{x} > 0"), ("repetition_max_period_seconds", "double", "12", "{x} > 0"),
        ("repetition_min_duration_seconds", "double", "20", "{x} > 0"), ("repetition_evidence_min_speed", "double", "0.05", "{x} >= 0"),
    ),
    "uncertainty": (
        ("replicates", "int", "1000", "{x} BETWEEN 100 AND 10000"), ("block_seconds", "double", "30", "{x} > 0"),
        ("confidence", "double", "0.95", "{x} > 0.5 AND {x} < 1"),
    ),
    "runtime": (
        ("max_staging_bytes", "bigint", "64424509440", "{x} >= 1073741824"), ("download_workers", "int", "8", "{x} BETWEEN 1 AND 64"),
        ("processing_workers", "int", "1", "{x} BETWEEN 1 AND 16"), ("upload_workers", "int", "8", "{x} BETWEEN 1 AND 64"),
        ("max_attempts", "int", "3", "{x} BETWEEN 1 AND 5"), ("target_corpus_hours", "double", "7500", "{x} > 0"),
    ),
}
#: Settings that must be in an order (section, the one that is at most or below, the other, whether equal is allowed).
ORDERED = (("detector", "optimal_batch_size", "max_batch_size", True), ("motion", "repetition_min_period_seconds", "repetition_max_period_seconds", False))
SIGNALS = (
    "hand.visibility_fraction", "hand.motion_speed_p95", "idle.fraction", "motion.repetition_score", "camera.corrupt", "camera.black_covered",
    "camera.blur_fraction", "camera.exposure_fraction", "camera.shake_p95_translation", "camera.shake_p95_rotation",
)
VERSION = "qc-job-v1"
ITEM_KEYS = ("item_id", "key", "size_bytes", "etag", "duration_seconds", "metadata")
RULE_KEYS = ("id", "signal", "operator", "threshold", "severity")
JOB_KEYS = ("schema_version", "job_id", "source", "target", "rules", *SETTINGS)

_ITEM = "struct<item_id:string,key:string,size_bytes:bigint,etag:string,duration_seconds:double,metadata:map<string,string>>"
_RULE = "struct<id:string,signal:string,operator:string,threshold:string,severity:string>"
_SECTIONS = ", ".join(f"{s} struct<{','.join(f'{n}:{t}' for n, t, _, _ in fields)}>" for s, fields in SETTINGS.items())
JOB = f"schema_version string, job_id string, source struct<bucket:string,items:array<{_ITEM}>>, target struct<bucket:string,prefix:string>, rules array<{_RULE}>, {_SECTIONS}"


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of manifest files, each one JSON document."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def parsed(manifests: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``job``, the document by the schema, and ``unknown_keys``, what the schema doesn't know. A text that is no JSON fails the query."""
    job = F.from_json(text, JOB, {"mode": "FAILFAST"})
    return manifests.withColumn("job", job).withColumn("unknown_keys", unknown_keys(F.col(text)))


def unknown_keys(text: Column) -> Column:
    """Keys of the document, its sections and its items that the schema doesn't have, sorted."""
    none = F.array().cast("array<string>")
    keys = lambda path: F.coalesce(F.json_object_keys(F.get_json_object(text, path)), none)
    known = lambda names: F.array(*map(F.lit, names))
    below = lambda section, names: F.transform(names, lambda k: F.concat(F.lit(section), F.lit("."), k))
    found = [F.array_except(F.coalesce(F.json_object_keys(text), none), known(JOB_KEYS))]
    for section, fields in SETTINGS.items():
        found.append(below(section, F.array_except(keys(f"$.{section}"), known([f[0] for f in fields]))))
    for section, names in (("source", ("bucket", "items")), ("target", ("bucket", "prefix"))):
        found.append(below(section, F.array_except(keys(f"$.{section}"), known(names))))
    for one, path, names in (("item", "$.source.items", ITEM_KEYS), ("rule", "$.rules", RULE_KEYS)):
        rows = F.coalesce(F.from_json(F.get_json_object(text, path), "array<string>"), none)
        odd = F.flatten(F.transform(rows, lambda x: F.array_except(F.coalesce(F.json_object_keys(x), none), known(names))))  # noqa: B023
        found.append(below(one, F.array_distinct(odd)))
    return F.array_sort(F.concat(*found))


def settings(jobs: DataFrame) -> DataFrame:
    """jobs(job, ...) with ``settings``, one struct a section with the defaults filled in, and ``invalid_settings``, what breaks its rule."""
    filled = F.struct(*(F.struct(*(F.coalesce(F.col(f"job.{s}.{n}"), F.lit(d).cast(t)).alias(n) for n, t, d, _ in fields)).alias(s) for s, fields in SETTINGS.items()))
    rules = [(f"{s}.{n}", rule.format(x=f"settings.{s}.{n}")) for s, fields in SETTINGS.items() for n, _, _, rule in fields]
    rules += [(f"{s}.{a}", f"settings.{s}.{a} {'<=' if equal else '<'} settings.{s}.{b}") for s, a, b, equal in ORDERED]
    broken = F.array_compact(F.array(*(F.when(~F.expr(rule), F.lit(name)) for name, rule in rules)))
    return jobs.withColumn("settings", filled).withColumn("invalid_settings", F.array_sort(F.array_distinct(broken)))


def analysis_rate() -> Column:
    """Frames a second that a clip is read at, of rows with ``settings``: the faster of its two samplings."""
    return F.greatest("settings.sampling.hand_fps", "settings.sampling.camera_fps")


def items(jobs: DataFrame, *keep: str) -> DataFrame:
    """One row an item, in the manifest's order: ``keep``, ``position`` and the item's fields, key and etag normalised."""
    cut = jobs.select(*keep, F.posexplode("job.source.items").alias("position", "item")).select(*keep, "position", "item.*")
    return cut.withColumns({"key": normalised_key(F.col("key")), "etag": normalised_etag(F.col("etag"))})


def item_checks(rows: DataFrame, *job: str) -> DataFrame:
    """items(...) with one boolean for each constraint, and ``valid`` where all hold. Uniqueness is within ``job``."""
    of = lambda c: F.coalesce(c, F.lit(False))
    checked = rows.withColumns({
        "id_ok": of(valid_id(F.col("item_id"))), "key_ok": of(valid_key(F.col("key"))), "size_ok": of(F.col("size_bytes") >= 1),
        "etag_ok": of(F.length("etag") >= 1), "duration_ok": F.coalesce(F.col("duration_seconds") > 0, F.lit(True)),
    })
    for name, c in (("id_unique", "item_id"), ("key_unique", "key")):
        checked = checked.withColumn(name, F.count("*").over(Window.partitionBy(*job, c)) == 1)
    names = ("id_ok", "key_ok", "size_ok", "etag_ok", "duration_ok", "id_unique", "key_unique")
    return checked.withColumn("valid", F.forall(F.array(*names), lambda x: x))


def effective_rules(jobs: DataFrame, *keep: str) -> DataFrame:
    """jobs(job, ...) to the rules that hold, one row each: ``keep``, ord, rule_id, signal, operator, threshold, is_bool, severity. A job without rules
    has the default ones, one with an empty list has none. A threshold that is true or false, also as text, is a boolean."""
    flag = lambda r: F.lower(r["threshold"]).isin("true", "false")
    number = lambda r: F.when(flag(r), (F.lower(r["threshold"]) == "true").cast("double")).otherwise(r["threshold"].try_cast("double"))
    own = F.transform("job.rules", lambda r, i: F.struct(i.alias("ord"), r["id"].alias("rule_id"), r["signal"].alias("signal"), r["operator"].alias("operator"), number(r).alias("threshold"), flag(r).alias("is_bool"), r["severity"].alias("severity")))
    return jobs.select(*keep, F.explode(F.when(F.col("job.rules").isNull(), rule_array()).otherwise(own)).alias("r")).select(*keep, "r.*")


def job_checks(jobs: DataFrame) -> DataFrame:
    """jobs(job, unknown_keys, ...) of ``settings`` with one boolean for each constraint on the document, and ``prefix`` normalised."""
    rules = F.coalesce(F.col("job.rules"), F.array().cast(f"array<{_RULE}>"))
    is_bool = lambda r: r["threshold"].isin("true", "false")
    rule_ok = lambda r: valid_id(r["id"]) & r["signal"].isin(*SIGNALS) & r["operator"].isin(*OPERATORS) & r["severity"].isin("reject", "warn") & (~is_bool(r) | (r["operator"] == "=="))
    filled = lambda c: F.coalesce(F.length(c) >= 1, F.lit(False))
    prefix, ok = safe_prefix(F.coalesce(F.col("job.target.prefix"), F.lit("qc/")))
    return jobs.withColumns({
        "version_ok": F.coalesce(F.col("job.schema_version"), F.lit(VERSION)) == VERSION, "job_id_ok": F.coalesce(valid_id(F.col("job.job_id")), F.lit(False)),
        "items_ok": F.coalesce(F.size("job.source.items") > 0, F.lit(False)), "buckets_ok": filled("job.source.bucket") & filled("job.target.bucket"), "prefix": prefix, "prefix_ok": ok,
        "rules_ok": F.coalesce(F.forall(rules, rule_ok), F.lit(False)) & (F.size(F.array_distinct(F.transform(rules, lambda r: r["id"]))) == F.size(rules)),
        "settings_ok": F.size("invalid_settings") == 0, "keys_ok": F.size("unknown_keys") == 0,
    })
