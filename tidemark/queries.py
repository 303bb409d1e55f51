"""The registry: name to query, and name to the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import detections, frames, gate, good_hours, manifests, media, motion, policies, reporting, run_report, slice0, storage  # noqa: F401  (all but gate and slice0 add to the queries of gate)

FLAGSHIP = "slice0_verdict_rollup"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {FLAGSHIP: slice0.verdict_rollup, **gate.QUERIES}
ORACLE_SQL: dict[str, str] = {FLAGSHIP: slice0.SQL, **gate.ORACLE_SQL}
