"""Hashes of nested documents, addresses, and what manifests leave open."""

import hashlib
import ipaddress
import json
import random

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import report
from tidemark.operators.rules import DEFAULT_RULES
from tidemark.sources import manifest


def nested(rnd, depth=0):
    kind = rnd.randint(0, 9 if depth < 5 else 6)
    if kind >= 7:
        return {rnd.choice(("a", "Z", "é", "漢", "b c", '"', "\n", "🙂", "aa")) + str(rnd.randint(0, 3)) * rnd.randint(0, 1): nested(rnd, depth + 1) for _ in range(rnd.randint(0, 5))} if kind > 7 else [nested(rnd, depth + 1) for _ in range(rnd.randint(0, 4))]
    return [None, True, False, rnd.randint(-(10**18), 10**18), rnd.random() * 10 ** rnd.randint(-20, 20), 1.0, rnd.choice(("", "x", "é ", "\\", "🙂\t"))][kind]


def test_nested_documents_hash_as_their_sorted_dump(spark):
    rnd = random.Random(5)
    docs = [{"k": nested(rnd), "a": nested(rnd)} for _ in range(300)]
    rows = [(i, json.dumps(d, indent=rnd.choice((None, 2)), ensure_ascii=rnd.random() < 0.5)) for i, d in enumerate(docs)]
    rows += [(1000, "{not json"), (1001, None), (1002, '{"a":1,"a":2}'), (1003, '{"b":{"d":1,"c":[{"z":1,"y":2}]},"a":1}'), (1004, '{"a":1,\n "b":{"c":[{"y":2, "z":1}],"d":1}}')]
    got = {r.i: r.h for r in spark.createDataFrame(rows, "i int, t string").repartition(3).select("i", report.document_hash(F.col("t")).alias("h")).collect()}
    for i, d in enumerate(docs):
        assert got[i] == hashlib.sha256(json.dumps(d, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert got[1000] is None and got[1001] is None and got[1002] == hashlib.sha256(b'{"a":2}').hexdigest() and got[1003] == got[1004]


def test_public_addresses_equal_the_standard_library(spark):
    rnd = random.Random(6)
    first = ["2001:db8::", "2001:", "2001:1::", "2001:3::", "2001:4:112::", "2001:20::", "2001:2f:", "2001:30::", "2001:40::", "2001:1ff:", "2001:200:", "2002:", "3fff:", "3fff:fff:", "4000:", "fc00:", "fdff:", "fe00:", "fe80:", "febf:", "fec0:", "ff02:", "64:ff9b:1:", "64:ff9b::", "100::", "100:0:0:1:", "2606:4700:", "::", "::ffff:", "0:0:0:0:0:ffff:"]
    texts = ["::", "::1", "::2", "2001:1::1", "2001:1::2", "2001:1::3", "::ffff:8.8.8.8", "::FFFF:10.0.0.1", "::ffff:192.0.0.9", "::ffff:c000:209", "64:ff9b::8.8.8.8", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:1.2.3.4", "1::8", "::8", "1::", "ABCD:EF01:2345:6789:abcd:ef01:2345:6789"]
    for f in first:
        for _ in range(6):
            groups = [f"{rnd.choice((0, 1, 2, 0xFFFF, rnd.getrandbits(16))):x}" for _ in range(rnd.randint(1, 7))]
            texts += [f + ":".join(groups), f.rstrip(":") + "::" + ":".join(groups[:2])]
    texts += ["", ":", ":::", "1:::2", "1:2", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7::8:9", "12345::", "g::", "::1.2.3", "::1.2.3.4:5", "1.2.3.4", "192.0.0.9", "192.0.0.8", "10.1.1.1", "300.1.1.1", "fe80::1%eth0", " ::1", "::1 ", "1::2::3", "host.example", "::01234"]

    def want(text):
        try:
            ip = ipaddress.ip_address(text)
        except ValueError:
            return None
        if "%" in text:
            return None
        return ip.is_global if ip.version == 4 or ip.ipv4_mapped is None else ip.ipv4_mapped.is_global

    df = spark.createDataFrame([(t,) for t in [*texts, None]], "a string")
    for r in df.select("a", C.public_address(F.col("a")).alias("p")).collect():
        assert r.p == (None if r.a is None else want(r.a)), r.a


def test_manifests_with_odd_rules_and_empty_buckets(spark):
    item = {"item_id": "clip-1", "key": "a.mp4", "size_bytes": 5, "etag": "e"}
    base = {"schema_version": "qc-job-v1", "job_id": "j", "source": {"bucket": "in", "items": [item]}, "target": {"bucket": "out"}}
    rule = {"id": "r1", "signal": "camera.corrupt", "operator": "==", "threshold": False, "severity": "reject"}
    docs = [base, {**base, "rules": []}, {**base, "rules": [rule, {**rule, "id": "r2", "threshold": 0.5, "note": 1}]}, {**base, "source": {"bucket": "", "items": [item]}}, {**base, "target": {}}, {**base, "detector": {"model_path": "m", "colour": 1}}]
    jobs = manifest.job_checks(manifest.settings(manifest.parsed(spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "k int, text string"))))
    rows = {r.k: r for r in jobs.collect()}
    assert [rows[k].buckets_ok for k in range(6)] == [True, True, True, False, False, True]
    assert rows[2].unknown_keys == ["rule.note"] and not rows[2].keys_ok and rows[5].unknown_keys == ["detector.colour"]
    assert rows[5].settings.detector.model_path == "m" and rows[0].settings.detector.input_name == "input" and rows[0].settings_ok
    held = {}
    for r in manifest.effective_rules(jobs, "k").collect():
        held.setdefault(r.k, []).append((r.ord, r.rule_id, r.signal, r.operator, r.threshold, r.is_bool, r.severity))
    assert sorted(held[0]) == sorted(DEFAULT_RULES) and 1 not in held
    assert sorted(held[2]) == [(0, "r1", "camera.corrupt", "==", 0.0, True, "reject"), (1, "r2", "camera.corrupt", "==", 0.5, False, "reject")]
