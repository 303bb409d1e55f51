"""Object inventories, create-only uploads, guarded reads, and which frames of a clip are looked at."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def upload_actions(objects: DataFrame, inventory: DataFrame, key: str) -> DataFrame:
    """Objects (key, size_bytes, sha256, ...) with ``action``: write where the target has no such key, noop where size and hash are
    equal, otherwise conflict. A target whose hash is unknown is a conflict. ``inventory`` has a key once."""
    there = inventory.select(key, F.col("size_bytes").alias("_size"), F.col("sha256").alias("_hash"), F.lit(True).alias("_there"))
    same = F.coalesce((F.col("size_bytes") == F.col("_size")) & (F.col("sha256") == F.col("_hash")), F.lit(False))
    action = F.when(F.col("_there").isNull(), "write").when(same, "noop").otherwise("conflict")
    return objects.join(there, key, "left").withColumn("action", action).drop("_size", "_hash", "_there")


def verified(content: Column, size: Column, sha256: Column) -> Column:
    """Whether bytes have the size and the hash (lowercase hex) that were promised; false where anything is null."""
    return F.coalesce((F.octet_length(content) == size) & (F.sha2(content, 256) == sha256), F.lit(False))


def sampled_indices(clips: DataFrame, count: str, n: int) -> DataFrame:
    """Clips with ``k`` and ``frame``: n frame numbers at even steps from the first to the last, cut to whole numbers. Clips without
    frames have none; clips of fewer than n frames have some more than once."""
    last = F.col(count).cast("long") - 1
    k = F.col("k")
    frame = F.when((k == n - 1) & (k > 0), last).otherwise(F.floor(k * (last / F.lit(float(max(n - 1, 1))))))
    return clips.where(F.col(count) > 0).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("frame", frame.cast("long"))


def _below(folder: str) -> Column:
    """The part of ``path`` below a folder."""
    root = folder.rstrip("/").split("://")[-1]
    return F.regexp_replace(F.col("path"), rf"^.*?\Q{root}\E/+", "")


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """(key, size_bytes, modified) of the files below a folder, from their listing; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(_below(folder).alias("key"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))


def guarded_read(spark: SparkSession, folder: str, expected: DataFrame) -> DataFrame:
    """(key, content) of expected(key, size_bytes, sha256) below a folder. A file that is absent or whose size or hash differs fails the query."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    joined = expected.join(files.select(_below(folder).alias("key"), "content"), "key", "left")
    return joined.select("key", F.coalesce(F.when(verified(F.col("content"), F.col("size_bytes"), F.col("sha256")), F.col("content")), F.raise_error(F.concat(F.lit("not as expected: "), "key")).cast("binary")).alias("content"))


def upload(objects: DataFrame, target: str) -> DataFrame:
    """Adds objects(key, content, ...) to the table at ``target`` where it has no such key. An object that is there with the same size and hash is
    left alone; one that differs fails before anything is written. Returns (action, objects), after what was written was read back and verified."""
    spark = objects.sparkSession
    rows = objects.select("key", "content", F.octet_length("content").cast("long").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))
    schema = "key string, content binary, size_bytes long, sha256 string"
    there = lambda: spark.read.schema(schema).parquet(target)
    try:
        held = there().select("key", "size_bytes", "sha256")
        held.isEmpty()
    except AnalysisException:
        held = spark.createDataFrame([], schema).select("key", "size_bytes", "sha256")
    actions = upload_actions(rows.drop("content"), held, "key").select("key", "action")
    conflict = actions.where("action = 'conflict'").first()
    if conflict:
        raise ValueError(f"{conflict['key']} is there with another size or hash")
    fresh = actions.where("action = 'write'").select("key")
    planned = actions.groupBy("action").count().collect()  # three rows at most
    rows.join(fresh, "key", "left_semi").write.mode("append").parquet(target)
    checked = upload_actions(rows.drop("content"), there().select("key", "size_bytes", "sha256"), "key")
    if not checked.where("action <> 'noop'").isEmpty():
        raise ValueError(f"{target} doesn't hold what was written")
    return spark.createDataFrame(planned, "action string, objects long")
