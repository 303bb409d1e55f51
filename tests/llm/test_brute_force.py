"""Results against plain versions, and tables whose columns have the operators' own names."""

import random
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, license_scan, linear, quality, quality_rules, toxicity
from tidemark.llm.chat_quotes import LEAST_CHARS, link_quotes
from tidemark.llm.html_text import extract_main_text


def test_ftrl_equals_a_dense_version():
    rng = np.random.default_rng(1)
    model, z, n = linear.Ftrl(20, 0.3, 1.0, 0.02, 0.02), np.zeros(20), np.zeros(20)
    for _ in range(200):
        at = np.sort(rng.choice(np.arange(1, 20), 5, replace=False))
        at = np.concatenate(([0], at))
        x = np.zeros(20)
        x[at] = rng.random(6)
        y = float(rng.random() < 0.5)
        w = np.zeros(20)
        for i in range(20):
            l1 = 0.0 if i == 0 else 0.02
            if abs(z[i]) > l1:
                w[i] = -(z[i] - np.sign(z[i]) * l1) / ((1.0 + np.sqrt(n[i])) / 0.3 + 0.02)
        g = (1 / (1 + np.exp(-w @ x)) - y) * 2.0 * x
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / 0.3
        z, n = z + np.where(x != 0, g - sigma * w, 0), n + g * g
        model.update(at, x[at], y, 2.0)
        assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_quality_features_equal_a_plain_count():
    text = "Aa bb, aa BB, aa bb. cc!! .. dd"
    (lo, hi, slots, values, first), = quality.features(pa.array([text]))
    words = text.lower().split()
    marks = re.findall(r"[!-/:-@\[-`{-~]+", text)
    triples = list(zip(words, words[1:], words[2:]))
    total = len(words) + len(words) - 1 + len(marks) + len(marks) - 1 + len(triples) - len(set(triples))
    assert (lo, hi, list(first)) == (0, 1, [0, len(slots)]) and list(values[:2]) == [1.0, np.sqrt((len(triples) - len(set(triples))) / total)]
    counts = [c for group in (words, list(zip(words, words[1:])), marks, list(zip(marks, marks[1:]))) for c in np.unique(np.array([str(g) for g in group]), return_counts=True)[1]]
    assert np.allclose(sorted(values[2:]), np.sqrt(np.sort(counts) / total))


def test_training_reads_the_kept_sample_only(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i % 7} text {'bad' if i % 3 else 'idiot'}") for i in range(60)], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2, i % 3 // 2) for i in range(60)], "doc_id long, quality int, toxic int")
    seen = []
    plain = linear.train
    for module in (quality, toxicity):
        monkeypatch.setattr(module, "train", lambda rows, *a, **b: seen.append(rows._jdf.queryExecution().executedPlan().toString()) or plain(rows, *a, **b))
        module.fit(docs, labels)
    assert len(seen) == 2 and all("Scan parquet" in p and not re.search("MapInArrow|Join|ExistingRDD", p) for p in seen)


def test_votes_and_label_model():
    voters = np.unique(toxicity._lexicon())
    names = {h: w for w, h in zip(toxicity.LEXICON, toxicity._lexicon())}
    texts = ["you idiot", "a fine day", "", None, "stupid " + "word " * 500, "IDIOT stupid"]
    fired = toxicity.votes(pa.array(texts), voters)
    for text, row in zip(texts, fired):
        words = re.findall(r"[a-zäöüßéíú]+", (text or "").lower())
        want = [bool(words) and words.count(names[v]) * toxicity.RARELY >= len(words) and names[v] in words for v in voters]
        assert row[:-1].astype(bool).tolist() == want and row[-1] == (not any(want))
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.3
    single = [rng.random(4000) < np.where(truth, p, 0.02) for p in (0.8, 0.6, 0.7)]
    copied = single[0]  # a voter that always fires with the first one, in both classes
    x = np.stack((*single, copied), 1)
    fired = np.concatenate((x, ~x.any(1, keepdims=True)), 1).astype(np.uint8)
    model = toxicity.LabelModel(fired)
    assert abs(model.share - 0.3) < 0.05 and np.allclose(model.rate[1][:3], (0.8, 0.6, 0.7), atol=0.08)
    assert model.weight[0] < 0.7 and model.weight[3] < 0.7 and model.weight[1] > 0.8
    assert ((model.posterior(fired) > 0.5) == truth).mean() > 0.9


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def sets_of(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_licenses_equal_exact_containment(spark):
    rnd = random.Random(6)
    rows = [(0, None), (1, ""), (2, "one two"), (3, " ".join(license_scan.TEMPLATES.values())), (4, "x " * 200_000 + license_scan.TEMPLATES["MIT-text"])]
    for i in range(5, 700):
        w = rnd.choice(list(license_scan.TEMPLATES.values())).split()
        for _ in range(rnd.choice([0, 0, 1, 2, 4])):
            k = rnd.randrange(len(w))
            w[k : k + rnd.randint(0, 1)] = [f"edit{rnd.random()}"]
        around = [f"f{rnd.randint(0, 10**9)}" for _ in range(rnd.randint(0, 40))]
        k = rnd.randint(0, len(around))
        rows.append((i, " ".join(around[:k] + w + around[k:])))
    known = {n: sets_of(t) for n, t in license_scan.TEMPLATES.items()}
    want = {i: sorted(n for n, s in known.items() if s and 4 * len(s & sets_of(t)) >= 3 * len(s)) for i, t in rows}
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"shingles": F.lit(1), "licenses": F.lit("x")}).repartition(4)
    out = license_scan.scan(docs, docs.columns)
    assert out.columns == ["doc_id", "text", "shingles", "licenses", "n_licenses"]
    got = {r.doc_id: r.licenses for r in out.collect()}
    assert all(set(got[i]) <= set(want[i]) for i in want)
    assert sum(map(len, got.values())) >= 0.99 * sum(map(len, want.values())) and got[3] == want[3] and got[4] == want[4] == ["MIT-text"]


def test_quote_links_equal_a_loop(spark):
    rnd = random.Random(8)
    vocab = ["alpha", "beta", "gamma", "delta", "yes", "no", "omega"]
    rows = []
    for c in range(40):
        said = []
        for t in range(rnd.randint(1, 12)):
            lines = []
            for _ in range(rnd.randint(0, 2)):
                source = rnd.choice(said) if said and rnd.random() < 0.9 else " ".join(rnd.choices(vocab, k=4))
                lines += [rnd.choice(["> ", ">> ", "> > ", ">"]) + x.upper() for x in source.split("\n")]
                if rnd.random() < 0.5:
                    lines.append(" ".join(rnd.choices(vocab, k=3)))
            own = "\n".join(" ".join(rnd.choices(vocab, k=rnd.randint(1, 5))) for _ in range(rnd.randint(1, 2)))
            said.append(own)
            rows.append((c, t, "\n".join([*lines, own])))

    def norm(x):
        return " ".join(re.findall(r"[^\W_]+", x.lower()))

    def pieces(parts, wholes):
        return {n for p in parts if len(n := norm(p)) >= LEAST_CHARS} | {norm(p) or p.strip(" ") for p in wholes} - {""}

    want = {}
    for c in range(40):
        own, quotes = {}, {}
        for _, t, text in (r for r in rows if r[0] == c):
            levels = [(m[0].count(">") if (m := re.match(r"^(?:[ \t]*>)+[ \t]?", x)) else 0, re.sub(r"^(?:[ \t]*>)+[ \t]?", "", x)) for x in text.split("\n")]
            mine = "\n".join(x for level, x in levels if not level).strip(" ")
            own[t] = pieces(mine.split("\n") + re.split("\n\\s*\n", mine), [mine])
            runs = []
            for level, x in levels:
                if runs and runs[-1][0] == level:
                    runs[-1][1].append(x)
                else:
                    runs.append((level, [x]))
            quotes[t] = {(level, p) for level, x in runs if level for p in pieces(x, ["\n".join(x)])}
        for t in own:
            links = {(level, min(u for u in own if p in own[u])) for level, p in quotes[t] if any(p in own[u] for u in own)}
            links = sorted(x for x in links if x[1] < t)
            least = min((x[0] for x in links), default=None)
            want[c, t] = (max((u for level, u in links if level == least), default=None), links)
    got = {(r.conv_id, r.turn): (r.reply_to, [tuple(x) for x in r.quoted_turns]) for r in link_quotes(spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")).collect()}
    assert got == want and sum(x[0] is not None for x in want.values()) > 50


def test_a_long_message_of_many_quotes(spark):
    text = "\n".join(f"> line number {i} of it\nanswer {i}" for i in range(20_000))
    rows = [(1, 0, "a", "line number 7 of it"), (1, 1, "b", text)]
    got = {r.turn: r for r in link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[1].n_quotes == 20_000 and got[1].reply_to == 0 and got[1].text.count("\n") == 19_999


def test_ratios_equal_a_plain_count(spark):
    rnd = random.Random(9)
    vocab = [f"{a}{b}" for a in ("wo", "thé", "漢字", "x") for b in ("rd", "n", "ing$", "")]
    rows = [(i, " ".join(rnd.choices(vocab, k=rnd.choice([0, 1, 60, 120])))) for i in range(120)] + [(5, None)]
    labels = [(i, i % 2) for i in range(0, 120, 3)]

    def slots(text):
        h = [xxhash.xxh64_intdigest(w[-3:].encode(), 42) for w in re.findall("[^\x20\x09-\x0D]+", text or "")]
        pair = lambda a, b: xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42))
        return [x % quality_rules.SLOTS for x in h + [pair(a, b) for a, b in zip(h, h[1:])]]  # SLOTS is a power of two

    good = {d for d, q in labels if q}
    raw, target = np.zeros(quality_rules.SLOTS), np.zeros(quality_rules.SLOTS)
    for d, t in rows:
        np.add.at(raw, slots(t), 1)
        if d in good:
            np.add.at(target, slots(t), 1)
    share = lambda x: np.log((x + 0.5) / (x.sum() + 0.5 * len(x)))
    ratio = share(target) - share(raw)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("t", "words", "n_words", "kept", "lines")})
    out = quality_rules.rate(docs, spark.createDataFrame(labels, "doc_id long, quality int"), ["doc_id", "text", "t", "words", "n_words", "lines"])
    assert out.columns[:5] == ["doc_id", "text", "t", "words", "lines"] and out.columns.count("n_words") == 1
    for r in out.collect():
        own = slots(r.text)
        assert (r.log_ratio is None) == (not own) and (not own or abs(r.log_ratio - ratio[own].mean()) < 1e-9)
        assert r.kept == (not r.base_failed and bool(own) and ratio[own].mean() >= quality_rules.THRESHOLD)


def test_own_names_as_columns(spark):
    docs = spark.createDataFrame([(1, "good words here", 5, "a", "b", "c"), (2, "one two three four five six seven eight nine ten", 6, "a", "b", "c")], "doc_id long, text string, n_chars int, score string, hits string, predicted string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([("item", "one two three four five six seven eight nine ten")], "item_id string, text string")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and all(r.score == "a" for r in kept.collect())
    assert quality.score_quality(docs, labels, docs.columns).columns == ["doc_id", "text", "n_chars", "hits", "score", "predicted"]
    assert toxicity.score_toxicity(docs, labels, ["doc_id", "score"]).columns == ["doc_id", "score", "predicted"]
    clean = decontaminate.decontaminate(docs, bench)
    assert clean.schema == docs.schema and {r.doc_id: (r.text, r.n_chars, r.hits) for r in clean.collect()} == {1: ("good words here", 5, "b"), 2: ("\n", 1, "b")}
    assert [r.hits["items"] for r in decontaminate.find_contamination(docs, bench, ["doc_id", "hits"]).orderBy("doc_id").collect()] == [[], ["item"]]
    pages = spark.createDataFrame([(1, "<p>x</p>", "old", 9)], "page_id long, html string, text string, n_chars long")
    assert extract_main_text(pages, pages.columns).collect() == [(1, "x", 1)]


def test_contamination_within_a_text_of_many_shards(spark, monkeypatch):
    phrase = " ".join(f"p{i}" for i in range(12))
    text = " ".join(f"w{i % 997}" for i in range(400_000)) + f" {phrase} end"
    bench = [(i, f"{phrase} {i}" if i % 2 else f"other words {i} " + phrase) for i in range(20)]
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 150)  # many passes
    out = decontaminate.find_contamination(spark.createDataFrame([(1, text), (2, "w1 w2")], "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"), ["doc_id"])
    got = {r.doc_id: r.hits for r in out.collect()}
    assert got[1].n_words == 400_013 and [tuple(x) for x in got[1].words] == [(400_000, 400_012)] and got[1]["items"] == sorted(map(str, range(20)))
    assert got[2].n_words == 2 and got[2]["items"] == []
