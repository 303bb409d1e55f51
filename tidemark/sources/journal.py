"""The journal as files of JSON lines: a scan that keeps the order of lines, and a sink of numbered batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What every event has besides its details.
FIELDS = ("timestamp", "item_id", "status")


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    """(timestamp, item_id, status, details map<string,string>, seq), where ``seq`` orders events as their lines are: by file name,
    block and line. Blank lines are skipped; a line that isn't a JSON object fails the query. An empty file has no events."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
    )
    bad = F.raise_error(F.format_string("not an event in %s: %s", "file", F.substring("value", 1, 200)))
    event = F.coalesce(F.from_json("value", "map<string,string>"), bad)
    parsed = lines.where(F.trim("value") != "").select(event.alias("event"), F.struct("file", "block", "line").alias("seq"))
    details = F.map_filter("event", lambda k, v: ~k.isin(*FIELDS))
    return parsed.select(*(F.col("event")[f].alias(f) for f in FIELDS), details.alias("details"), "seq")


def append_batch(events: DataFrame, batch_id: int, path: str) -> None:
    """Writes (timestamp, item_id, status, details) as one batch, its keys sorted. A batch that is written again replaces itself, so a
    retried ``foreachBatch`` leaves no event twice; batches are read in the order of their numbers."""
    own = F.create_map(*(x for f in FIELDS for x in (F.lit(f), F.col(f).cast("string"))))
    other = F.map_filter(F.coalesce("details", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))), lambda k, v: ~k.isin(*FIELDS))
    entries = F.array_sort(F.map_entries(F.map_concat(own, other)))
    lines = events.select(F.to_json(F.map_from_entries(entries)).alias("value"))
    lines.write.mode("overwrite").text(f"{path.rstrip('/')}/batch-{batch_id:012d}")
