"""Queries on manifests. A customer's orders are the items of a job's manifest, which is put together as JSON and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.plans.gate import query
from tidemark.plans.tables import read
from tidemark.sources import manifest

_I = """WITH i AS (SELECT o_custkey, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS position,
CASE WHEN o_orderkey % 13 = 0 THEN 'same' WHEN o_orderkey % 11 = 0 THEN 'clip 1' ELSE 'clip.' || o_orderkey END AS item_id,
CASE o_orderkey % 6 WHEN 0 THEN ' /clips/' || o_orderkey || '.mp4 ' WHEN 1 THEN 'a/../b' WHEN 2 THEN '' WHEN 3 THEN 'a' || chr(9) || o_orderkey WHEN 4 THEN 'same/key.mp4' ELSE 'c/' || o_orderkey END AS raw,
o_orderkey % 3 AS size_bytes, CASE WHEN o_orderkey % 7 = 0 THEN '""' ELSE ' "' || o_orderpriority || '"' END AS tag, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice - 1000 END AS duration_seconds FROM orders),
n AS (SELECT *, ltrim(regexp_replace(raw, '^\\s+|\\s+$', '', 'g'), '/') AS key, trim(regexp_replace(tag, '^\\s+|\\s+$', '', 'g'), '"') AS etag FROM i),
c AS (SELECT *, regexp_full_match(item_id, '[A-Za-z0-9][A-Za-z0-9._:-]{0,127}') AS id_ok, key <> '' AND NOT list_has_any(string_split(key, '/'), ['', '.', '..']) AND NOT regexp_matches(key, '[\\r\\n\\t]') AS key_ok,
size_bytes >= 1 AS size_ok, length(etag) >= 1 AS etag_ok, coalesce(duration_seconds > 0, true) AS duration_ok, count(*) OVER (PARTITION BY o_custkey, item_id) = 1 AS id_unique, count(*) OVER (PARTITION BY o_custkey, key) = 1 AS key_unique FROM n)"""


def _manifests(spark, sf_dir):
    k, lit = F.col("o_orderkey"), F.lit
    key = (
        F.when(k % 6 == 0, F.concat(lit(" /clips/"), k, lit(".mp4 "))).when(k % 6 == 1, "a/../b").when(k % 6 == 2, "").when(k % 6 == 3, F.concat(lit("a\t"), k))
        .when(k % 6 == 4, "same/key.mp4").otherwise(F.concat(lit("c/"), k))
    )
    item = F.struct(
        k.alias("_k"), F.when(k % 13 == 0, "same").when(k % 11 == 0, "clip 1").otherwise(F.concat(lit("clip."), k)).alias("item_id"), key.alias("key"), (k % 3).alias("size_bytes"),
        F.when(k % 7 == 0, '""').otherwise(F.concat(lit(' "'), "o_orderpriority", lit('"'))).alias("etag"), F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") - 1000).alias("duration_seconds"),
    )
    jobs = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(item)).alias("items"))
    bare = F.transform("items", lambda x: x.dropFields("_k"))
    source = F.struct(lit("videos").alias("bucket"), bare.alias("items"))
    document = F.struct(lit(manifest.VERSION).alias("schema_version"), F.concat(lit("job-"), "o_custkey").alias("job_id"), source.alias("source"), F.struct(lit("out").alias("bucket")).alias("target"))
    return jobs.select("o_custkey", F.to_json(document).alias("text"))


@query(_I + " SELECT o_custkey, CAST(position AS INT) AS position, item_id, key, size_bytes, etag, round(duration_seconds, 4) AS duration_seconds FROM c")
def s01_manifest_items(spark, sf_dir):
    rows = manifest.items(manifest.parsed(_manifests(spark, sf_dir)), "o_custkey")
    return rows.drop("metadata").withColumn("duration_seconds", F.round("duration_seconds", 4))


@query(_I + " SELECT o_custkey, CAST(position AS INT) AS position, id_ok, key_ok, size_ok, etag_ok, duration_ok, id_unique, key_unique, id_ok AND key_ok AND size_ok AND etag_ok AND duration_ok AND id_unique AND key_unique AS valid FROM c")
def f01_manifest_item_checks(spark, sf_dir):
    rows = manifest.item_checks(manifest.items(manifest.parsed(_manifests(spark, sf_dir)), "o_custkey"), "o_custkey")
    return rows.select("o_custkey", "position", "id_ok", "key_ok", "size_ok", "etag_ok", "duration_ok", "id_unique", "key_unique", "valid")


@query("""WITH j AS (SELECT c_custkey, c_nationkey::DOUBLE AS hand_fps, c_custkey % 50 AS optimal, CASE c_custkey % 4 WHEN 0 THEN ' /a/b ' WHEN 1 THEN 'a/../b' WHEN 2 THEN '/' ELSE 'reports//' END AS raw FROM customer),
p AS (SELECT *, ltrim(trim(raw), '/') AS bare FROM j)
SELECT c_custkey, 'job-' || c_custkey AS job_id, hand_fps, 5e0 AS camera_fps, greatest(hand_fps, 5e0) AS analysis_rate, 32 AS max_batch_size, concat_ws(',', CASE WHEN optimal > 32 OR optimal < 1 THEN 'detector.optimal_batch_size' END, CASE WHEN hand_fps <= 0 THEN 'sampling.hand_fps' END) AS invalid,
concat_ws(',', CASE WHEN c_custkey % 10 = 0 THEN 'notes' END, CASE WHEN c_custkey % 9 = 0 THEN 'sampling.extra' END) AS unknown, rtrim(bare, '/') || '/' AS prefix, bare <> '' AND NOT list_contains(string_split(bare, '/'), '..') AS prefix_ok, false AS items_ok FROM p""")
def s01_f01_p01_manifest_settings(spark, sf_dir):
    k = F.col("c_custkey")
    raw = F.when(k % 4 == 0, " /a/b ").when(k % 4 == 1, "a/../b").when(k % 4 == 2, "/").otherwise("reports//")
    form = '{"schema_version":"qc-job-v1","job_id":"job-%d",%s"source":{"bucket":"b","items":[]},"target":{"bucket":"t","prefix":"%s"},"sampling":{"hand_fps":%d%s},"detector":{"optimal_batch_size":%d}}'
    text = F.format_string(form, k, F.when(k % 10 == 0, '"notes":1,').otherwise(""), raw, F.col("c_nationkey"), F.when(k % 9 == 0, ',"extra":{}').otherwise(""), k % 50)
    jobs = manifest.job_checks(manifest.settings(manifest.parsed(read(spark, sf_dir, "customer").select("c_custkey", text.alias("text")))))
    invalid, unknown = (F.array_join(c, ",") for c in ("invalid_settings", "unknown_keys"))
    return jobs.select("c_custkey", "job.job_id", "settings.sampling.hand_fps", "settings.sampling.camera_fps", manifest.analysis_rate().alias("analysis_rate"), "settings.detector.max_batch_size", invalid.alias("invalid"), unknown.alias("unknown"), "prefix", "prefix_ok", "items_ok")


@query("SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_size * 1000 / (p_partkey % 3 + 1)::DOUBLE WHEN 1 THEN p_size::DOUBLE ELSE 0e0 END AS rate FROM part")
def p03_rational_rates(spark, sf_dir):
    k = F.col("p_partkey")
    text = F.when(k % 5 == 0, F.concat(F.col("p_size") * 1000, F.lit("/"), k % 3 + 1)).when(k % 5 == 1, F.col("p_size").cast("string")).when(k % 5 == 2, "0/0").when(k % 5 == 3, "N/A").otherwise("")
    return read(spark, sf_dir, "part").select("p_partkey", C.ratio(text).alias("rate"))


@query("""SELECT s_suppkey, 'qc/job-' || s_nationkey || '/items/' || s_suppkey || '/result.json' AS key, s_suppkey % 5 NOT IN (1, 2, 3) AS artifact_ok FROM supplier""")
def p17_k07_object_keys(spark, sf_dir):
    k = F.col("s_suppkey")
    name = F.when(k % 5 == 1, "../../other").when(k % 5 == 2, "..").when(k % 5 == 3, "").otherwise(F.concat(F.lit("00-idle-"), k))
    key = C.object_key(F.lit("qc/"), F.concat(F.lit("job-"), "s_nationkey"), k.cast("string"), F.lit("result.json"))
    return read(spark, sf_dir, "supplier").select("s_suppkey", key.alias("key"), C.safe_artifact_id(name).alias("artifact_ok"))


@query("""WITH a AS (SELECT s_suppkey, s_suppkey % 256 AS b, (s_suppkey * 7) % 256 AS c, (ARRAY['10', '172', '192', '100', '8', '127', '169', '198', '240', '203'])[(s_suppkey % 10 + 1)::INT] AS a FROM supplier)
SELECT s_suppkey, CASE WHEN b > 250 THEN NULL ELSE NOT (a IN ('10', '127', '240') OR a = '172' AND b BETWEEN 16 AND 31 OR a = '192' AND (b = 168 OR b = 0 AND c IN (0, 2)) OR a = '100' AND b BETWEEN 64 AND 127 OR a = '169' AND b = 254
OR a = '198' AND (b IN (18, 19) OR b = 51 AND c = 100) OR a = '203' AND b = 0 AND c = 113) END AS public FROM a""")
def f05_public_addresses(spark, sf_dir):
    k = F.col("s_suppkey")
    first = F.get(F.array(*map(F.lit, ("10", "172", "192", "100", "8", "127", "169", "198", "240", "203"))), (k % 10).cast("int"))
    address = F.when(k % 256 > 250, "host.example").otherwise(F.concat_ws(".", first, k % 256, (k * 7) % 256, F.lit("9")))
    return read(spark, sf_dir, "supplier").select("s_suppkey", C.public_ipv4(address).alias("public"))
