"""Queries on object stores and seekable frames. A part is an object; a user of ``events`` is a clip, its events are frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import storage
from tidemark.plans.gate import query
from tidemark.plans.tables import read

_OBJECTS = "WITH o AS (SELECT p_partkey, p_size AS size_bytes, sha256(p_name) AS sha256 FROM part), t AS (SELECT p_partkey, p_size + CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS size_bytes, sha256(CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_name END) AS sha256 FROM part WHERE p_partkey % 3 <> 0)"


@query(_OBJECTS + " SELECT o.p_partkey, CASE WHEN t.p_partkey IS NULL THEN 'write' WHEN o.size_bytes = t.size_bytes AND o.sha256 = t.sha256 THEN 'noop' ELSE 'conflict' END AS action FROM o LEFT JOIN t ON o.p_partkey = t.p_partkey")
def k03_upload_actions(spark, sf_dir):
    part, key = read(spark, sf_dir, "part"), F.col("p_partkey")
    objects = part.select("p_partkey", F.col("p_size").alias("size_bytes"), F.sha2("p_name", 256).alias("sha256"))
    name = F.when(key % 7 == 0, "").otherwise(F.col("p_name"))
    target = part.where(key % 3 != 0).select("p_partkey", (F.col("p_size") + (key % 5 == 0).cast("int")).alias("size_bytes"), F.sha2(name, 256).alias("sha256"))
    return storage.upload_actions(objects, target, "p_partkey").select("p_partkey", "action")


@query("SELECT p_partkey, p_size = length(p_name) AND p_partkey % 4 <> 0 AS intact FROM part")
def k06_verified_artifacts(spark, sf_dir):
    promised = F.sha2(F.when(F.col("p_partkey") % 4 == 0, F.concat("p_name", F.lit("!"))).otherwise(F.col("p_name")), 256)
    return read(spark, sf_dir, "part").select("p_partkey", storage.verified(F.encode("p_name", "UTF-8"), F.col("p_size"), promised).alias("intact"))


@query("WITH c AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) SELECT user_id, k::INT AS k, CASE WHEN k = 15 THEN n - 1 ELSE floor(k * ((n - 1) / 15e0))::BIGINT END AS frame FROM c, unnest(range(0, 16)) AS x(k)")
def s15_sampled_frames(spark, sf_dir):
    clips = read(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return storage.sampled_indices(clips, "n", 16).select("user_id", "k", "frame")


@query(None)
def s06_object_inventory(spark, sf_dir):
    """Of the folder of tables itself; what it lists differs by machine, so there is no SQL. tests/test_gate_fixtures.py has a folder of known files."""
    return storage.inventory(spark, sf_dir).select("key", "size_bytes")
