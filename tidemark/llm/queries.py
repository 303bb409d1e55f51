"""The registered queries of this subpackage: thin digests of what the operators return, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import align, chat_quotes, decontaminate, html_text, jaccard_join, license_scan, minhash_join, packing, quality, quality_rules, secret_scan, spelling, toxicity
from tidemark.llm.shared import fold_of, table

#: The tokenizer file that packing uses unless told otherwise.
VOCABULARY = "word_bpe_49k.json"
#: The two sides that are aligned unless told otherwise.
SIDE_A, SIDE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def _vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
    return out.select("doc_id", (fold_of("doc_id", quality.FOLDS) == quality.HELD_OUT).alias("held_out"), "score", "predicted")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    hit = F.aggregate("hits.words", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])
    ids = F.array_join(F.array_sort("hits.items"), ",")
    return found.select("doc_id", F.col("hits.n_words").alias("n_words"), hit.alias("n_hit"), F.size("hits.items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select("doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"), F.sha2(secret_scan.spelled(base), 256).alias("base_sha256"), secret_scan.spelled(F.col("spans")).alias("spans"))


def op4_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_quotes.link_quotes(table(spark, sf_dir, "conversations"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), _vocabulary())


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), ["doc_id"])


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
    return out.select("doc_id", (fold_of("doc_id", toxicity.FOLDS) == toxicity.HELD_OUT).alias("held_out"), "score", "predicted")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ratio")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_duplicate_groups(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align_tokens(table(spark, sf_dir, "documents"), _vocabulary(SIDE_A), _vocabulary(SIDE_B))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_decontamination, op3_secret_scan, op4_chat_quotes, op5_packing, op6_license_scan, op7_html_text,
        op8_toxicity, op9_quality_rules, op10_jaccard_join, op11_spelling_variants,
        op12_minhash_dedup, op13_token_alignment,
    )
}

#: Where SQL can express the whole result on whole tables; the other queries are tested against brute force (tests/llm).
ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS g FROM b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS x(k) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM p),
g AS (SELECT doc_id, k, n, array_to_string(w[k : k + n - 1], ' ') AS g FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS x(k)),
hit AS (SELECT doc_id, k, n, item_id FROM g JOIN p USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT DISTINCT doc_id, k, n FROM hit), unnest(range(k, k + n)) AS x(i) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_spelling_variants": r"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
each_run AS (SELECT doc_id, run, count(*) AS k, hex(encode(doc_id || ':' || run)) AS h FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, k, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM each_run, crc),
damaged AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed),
v AS (SELECT word, sum(k)::BIGINT AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
less AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM v, unnest(range(length(word))) AS x(i)),
one AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT a.word, a.n, v.word, v.n FROM less a JOIN v ON a.rest = v.word),
pairs AS (FROM one UNION SELECT near, near_n, word, n FROM one),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS form, max(near_n) AS form_n, any_value(n) AS n FROM pairs GROUP BY word),
forms AS (SELECT word, form, form_n FROM best WHERE form_n >= 5 * n),
path AS (SELECT word, form AS root FROM forms UNION ALL SELECT p.word, f.form FROM path p JOIN forms f ON p.root = f.word),
ends AS (SELECT word, root FROM path WHERE root NOT IN (SELECT word FROM forms))
SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, forms.form, forms.form_n, coalesce(root, v.word) AS root
FROM v LEFT JOIN best USING (word) LEFT JOIN forms USING (word) LEFT JOIN ends USING (word)""",
    "op12_minhash_dedup": r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[k : k + least(len(w), 3) - 1], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 3, 0) + 2)) AS x(k) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM both_ JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= 85 * (x.n + y.n - i)),
edges AS (FROM links UNION SELECT b, a FROM links),
reach AS (SELECT DISTINCT a, a AS b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
root AS (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept FROM d LEFT JOIN n USING (doc_id) LEFT JOIN root USING (doc_id)""",
}
