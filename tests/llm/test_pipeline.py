import random
import zlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_decontaminate import brute as contamination
from test_decontaminate import words_of
from test_jaccard_join import brute
from test_packing import plain
from test_secret_scan import base

import corpus_pipeline
from tidemark.llm import quality
from tidemark.llm.shared import table

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(DATA).is_dir(), reason="no driver tables")
def test_stages(spark, tmp_path):
    docs = first = table(spark, DATA, "documents")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DATA)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == first.columns, name
        out.write.parquet(str(tmp_path / name))
        docs, before = spark.read.parquet(str(tmp_path / name)), docs
        assert 0 < docs.select("doc_id").distinct().count() <= before.count()
    assert docs.where("size(ids) <> length").count() == 0


def test_run_equals_plain_stages(spark, tmp_path):
    rnd = random.Random(4)
    vocab = ["alpha", "Beta", "gamma,", "delta", "epsilon.", "zeta", "eta", "theta", "iota", "kappa"]
    prose = lambda n: " ".join(rnd.choice(vocab) + str(rnd.randint(0, 99)) for _ in range(n))
    item = "which of these ten words stands at the very end of it"
    rows = []
    for i in range(60):
        text = prose(rnd.randint(20, 60))
        if i % 6 == 1:
            text = text + " " + item.upper() + " " + prose(5)
        if i % 7 == 2:
            text += f"\npassword: hunter{i}hunter AKIA{'A1B2' * 4} end"
        rows.append((i, text, len(text)))
    rows += [(100 + i, rows[i][1] + " tail", rows[i][2] + 5) for i in range(0, 40, 5)] + [(5, rows[5][1], rows[5][2]), (200, None, None), (201, "", 0), (None, prose(30), 9)]
    rows += [(300 + i, "$$$ ### " * 20, 160) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumns({c: F.lit(c) for c in ("lang", "source", "score", "hits", "spans", "base", "runs")})
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in [*range(60), *range(300, 330)]], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, item), (2, "short one")], "item_id long, text string")
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    read = lambda name: table(spark, str(tmp_path), name)

    passed = Counter((r.doc_id, r.text) for r in quality.score_quality(read("documents"), read("labels"), ["doc_id", "text"]).where("predicted = 1").collect())
    assert sum(passed.values()) < len(rows) and not any(d and d >= 300 for d, _ in passed)
    links = brute([x for x, n in passed.items() if x[0] is not None])
    stays = {x: n for x, n in passed.items() if x[0] is None or links[x[0]][1] == x[0]}
    assert sum(stays.values()) < sum(passed.values())
    want = Counter()
    found = contamination([(i, t) for i, (_, t) in enumerate(stays)], [(1, item), (2, "short one")])
    for i, ((d, t), n) in enumerate(stays.items()):
        text = t or ""
        w, hit = words_of(text), sorted(found[i][3])
        for k in hit[::-1]:
            if k + 1 not in found[i][3]:
                last = k
            if k - 1 not in found[i][3]:
                text = text[: w[k][1]] + "\n" + text[w[last][2] :]
        for start, _, end in sorted(base(text), reverse=True):
            text = text[:start] + "[SECRET]" + text[end:]
        want[d, tuple([*plain(text), 1])] += n

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    by_sequence, ids = {}, {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        ids.setdefault(r.doc_id, []).append((r.start, r.doc_tokens, tuple(r.ids)))
        assert len(r.ids) == r.length and zlib.crc32(b"".join(x.to_bytes(4, "little") for x in r.ids)) == r.ids_crc32
    for pieces in by_sequence.values():
        assert [o for o, _ in sorted(pieces)] == [sum(n for _, n in sorted(pieces)[:k]) for k in range(len(pieces))] and sum(n for _, n in pieces) <= 2048
    got = Counter()
    for d, pieces in ids.items():
        copies = sum(1 for s, _, _ in pieces if s == 0)
        places = Counter((start + k, x) for start, _, part in pieces for k, x in enumerate(part))
        assert set(places.values()) == {copies}  # rows of one id have one text here
        tokens = tuple(x for _, x in sorted(places))
        got[d, tokens] += copies
    assert got == want
