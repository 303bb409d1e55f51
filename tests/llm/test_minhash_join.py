import random
import re

import numpy as np
import pytest

from tidemark.llm import minhash_join
from tidemark.llm.minhash_join import COORDINATES, MATCHES, near_duplicate_groups, signatures


def sets_of(text):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) >= 3:
        return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
    return {tuple(words)} if words else set()


def brute(rows):
    sets = {}
    for d, t in rows:
        if d is not None:
            sets.setdefault(d, []).append(sets_of(t))
    ids, root = sorted(sets), {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if any(100 * len(x & y) >= 85 * len(x | y) and x and y for x in sets[a] for y in sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: (max(map(len, sets[d])), find(d), find(d) == d) for d in ids}


def corpus(seed, groups=6, copies=25):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(500)]
    passage, rows = [rnd.choice(vocab) for _ in range(60)], []
    for i in range(100):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(0, 90))]
        rows.append((3 * i, " ".join(passage + words[: rnd.randint(0, 30)] if i % 5 == 0 else words)))
    for g in range(groups):  # edits of one text and of each other: chains of links, texts that several coordinates share
        words = [rnd.choice(vocab) for _ in range(rnd.choice((8, 40, 120)))]
        for k in range(copies):
            mine = list(words)
            for _ in range(rnd.randint(0, max(1, len(words) // 25))):
                mine[rnd.randrange(len(mine))] = rnd.choice(vocab)
            if rnd.random() < 0.3:
                words = mine
            rows.append((5000 + 1000 * g - 7 * k, " \t".join(w.upper() if rnd.random() < 0.1 else w for w in mine)))
    return rows + [(20_000, None), (20_001, ""), (20_002, " \n"), (20_003, "Éa b"), (20_004, "Éa B"), (20_005, "éa b"), (20_006, "a a a a a"), (20_007, "A a a"), (None, "x y z"), (None, None)]


def result(df):
    rows = near_duplicate_groups(df).collect()
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is not None}, [r for r in rows if r.doc_id is None]


def test_equals_brute_force(spark):
    rows = corpus(1)
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "doc_id long, text string, n int, c0 string").repartition(5)
    got, unnamed = result(df)
    assert got == brute(rows)
    assert [tuple(r) for r in unnamed] == [(None, None, None, True)] * 2
    assert sum(not kept for *_, kept in got.values()) > 60


def test_salted_lists_and_shuffled_verification(spark, monkeypatch):
    for name, value in {"LIST_PART": 3, "PIVOT_PART": 2, "COPY_PARTS": 3, "BROADCAST_IDS": 0}.items():
        monkeypatch.setattr(minhash_join, name, value)
    rows = corpus(2, groups=3, copies=40)
    rows += [(d + 1, t) for d, t in rows[100:140]] + [(9, rows[150][1]), (9, rows[30][1])] + [rows[120]] * 3  # copies, an id of several texts, repeated rows
    got, _ = result(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert got == brute(rows)


@pytest.mark.parametrize("share", (0.86, 0.5))
def test_signatures_agree_as_often_as_sets_do(share):
    rng, agreed = np.random.default_rng(4), []
    for _ in range(400):
        n = int(rng.integers(20, 400))
        common = round(n * 2 * share / (1 + share))
        x = rng.integers(0, 1 << 63, 2 * n - common).astype(np.uint64)
        a, b = signatures([x[:n], x[n - common :]])
        agreed.append(int((a == b).sum()))
    expected = COORDINATES * share
    assert abs(np.mean(agreed) - expected) < 0.6 and abs(np.std(agreed) - np.sqrt(expected * (1 - share))) < 0.6
    assert share < 0.85 or min(agreed) >= MATCHES


def around(rnd, words, n, edits):
    """n texts of random edits of one."""
    for _ in range(n):
        mine = list(words)
        for at in rnd.sample(range(len(mine)), rnd.randint(*edits)):
            mine[at] = f"x{rnd.random()}"
        yield mine


def test_texts_around_a_hub_do_not_meet_each_other(spark, monkeypatch):
    """Half the texts are linked with the first one, half are not; pairs to be verified grow with the texts, not with their square."""
    made = []
    verify = minhash_join.MinHashJoin._links
    monkeypatch.setattr(minhash_join.MinHashJoin, "_links", lambda self, pairs: made.append(pairs.count()) or verify(self, pairs))
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(1000)]
    near, far = around(rnd, words, 100, (0, 10)), around(rnd, words, 100, (29, 34))
    rows = [(i, " ".join(w)) for i, w in enumerate([words, *near, *far])]
    chain = rows[-1][1].split()
    for k in range(5):  # edits of a far text, each linked with the one before
        chain[70 * k] = f"y{k}"
        rows.append((1000 - k, " ".join(chain)))
    got, _ = result(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert got == brute(rows)
    assert len({c for _, c, _ in got.values()}) > 90 and sum(made) < 4 * len(rows)


@pytest.mark.parametrize("part", (4_000, 2))
def test_links_by_differences_from_a_hub(spark, monkeypatch, part):
    monkeypatch.setattr(minhash_join, "LIST_PART", part)
    rnd, hub = random.Random(part), set(range(200))
    other = [set(rnd.sample(range(200), 22)) | set(range(1000 + 30 * k, 1022 + 30 * k)) for k in range(4)]  # differences that several share
    sets = []
    for i in range(160):
        mine = set(hub)
        for x in rnd.sample(sorted(rnd.choice(other)), rnd.randint(20, 44)) if rnd.random() < 0.7 else ():
            mine ^= {x}
        mine ^= set(rnd.sample(range(200), rnd.choice((2, 4, 14)))) | {5000 + 50 * i + k for k in range(rnd.choice((0, 3, 14)))}
        sets.append(mine)
    link = lambda x, y: 100 * len(x & y) >= 85 * len(x | y)
    far = [not link(x, hub) for x in sets]
    rows = [(0, len(hub), i, len(x), far[i], sorted(x ^ hub)) for i, x in enumerate(sets)]
    first = far.index(False)
    expected = {(i, k) for k in range(160) for i in range(k) if (far[i] or far[k]) and link(sets[i], sets[k])}
    assert any(far[i] != far[k] for i, k in expected) and any(far[i] and far[k] for i, k in expected) and sum(far) > 40
    circles = spark.createDataFrame(rows, "hub long, hub_n int, doc long, n int, far boolean, apart array<long>")
    component = spark.createDataFrame([(i, first) for i in range(first + 1, 160) if not far[i]], "node long, component long")
    join = minhash_join.MinHashJoin(spark.createDataFrame([], "doc_id long, text string"))
    got = join._within(circles, component).collect()
    assert {tuple(sorted((r.a, r.b))) for r in got} == expected and len(got) == len(expected)


def test_very_long_text_and_empty_table(spark):
    long = " ".join(f"t{i % 9973}" for i in range(200_000))
    got, _ = result(spark.createDataFrame([(4, long), (3, long + " end"), (5, None)], "doc_id long, text string"))
    assert got == {3: (9974, 3, True), 4: (9973, 3, False), 5: (0, 5, True)}
    assert near_duplicate_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []
