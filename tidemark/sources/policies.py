"""Policy files: small documents of a configuration, read on the driver into one row each."""

from __future__ import annotations

import json
import posixpath

from pyspark.sql import DataFrame, SparkSession

#: Where a policy has each field, its bounds and whether the lower one is allowed.
FIELDS = {
    "covered_seconds": ("checks.camera_covered.reject_after_seconds", 0, None, False), "hands": ("checks.hands_visible.minimum_percent", 0, 100, True),
    "idle": ("checks.worker_idle.maximum_percent", 0, 100, True), "idle_seconds": ("checks.worker_idle.minimum_segment_seconds", 0, None, False),
    "translation": ("checks.camera_steadiness.maximum_translation_percent", 0, 100, True), "rotation": ("checks.camera_steadiness.maximum_rotation_degrees_per_second", 0, None, True),
    "repetition": ("checks.repetitive_motion.maximum_score", 0, 1, True), "blur": ("warnings.blurry.maximum_percent", 0, 100, True),
    "exposure": ("warnings.bad_exposure.maximum_percent", 0, 100, True),
}
SCHEMA = "name string, file string, " + ", ".join(f"{f} double" for f in FIELDS)


def _leaves(node: dict, at: str = "") -> dict:
    out = {}
    for key, value in node.items():
        out |= _leaves(value, f"{at}{key}.") if isinstance(value, dict) else {f"{at}{key}": value}
    return out


def policy_row(document: dict, file: str = "") -> tuple:
    """A policy document as a row of SCHEMA; unknown or missing fields, values out of bounds and other versions raise."""
    leaves = _leaves(document)
    if leaves.pop("version", None) != 1:
        raise ValueError(f"{file}: a policy must have version 1")
    name = leaves.pop("name", None)
    if set(leaves) != {path for path, *_ in FIELDS.values()}:
        raise ValueError(f"{file}: unknown or missing fields {sorted(set(leaves) ^ {path for path, *_ in FIELDS.values()})}")
    row = []
    for field, (path, low, high, from_low) in FIELDS.items():
        value = float(leaves[path])
        if value < low or value == low and not from_low or high is not None and value > high:
            raise ValueError(f"{file}: {field} is out of bounds")
        row.append(value)
    return name, file, *row


def read_policies(spark: SparkSession, folder: str) -> DataFrame:
    """All policies of a folder (``*.yaml``, where a YAML library is installed, else ``*.json``), in the order of their files; of policies of one name
    the last counts. A folder without any raises."""
    try:
        import yaml
    except ImportError:
        parse, kind = json.loads, "json"
    else:
        parse, kind = yaml.safe_load, "yaml"
    texts = spark.read.option("pathGlobFilter", f"*.{kind}").text(folder, wholetext=True).select("_metadata.file_path", "value")
    files = sorted((posixpath.basename(path), text) for path, text in texts.collect())  # a few small files
    if not files:
        raise ValueError(f"no policies in {folder}")
    rows = {}
    for file, text in files:
        row = policy_row(parse(text), file)
        rows[row[0]] = row
    return spark.createDataFrame(list(rows.values()), SCHEMA)
