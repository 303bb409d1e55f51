import random
import re

from tidemark.llm import jaccard_join
from tidemark.llm.jaccard_join import jaccard_components, keep_one_of_each


def sets_of(text):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) >= 5:
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def brute(rows):
    ids = sorted({d for d, _ in rows if d is not None})
    sets = {d: sets_of(t) for d, t in rows if d is not None}
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                ra, rb = sorted((find(a), find(b)))
                root[rb] = ra
    return {d: (len(sets[d]), find(d)) for d in ids}


def corpus(seed=1):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, passage = [], [rnd.choice(vocab) for _ in range(40)]
    for i in range(120):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(1, 120))]
        if i % 7 == 0:
            words = passage + words[: rnd.randint(0, 25)]
        rows.append((i * 3 + 1, " ".join(words)))
    for i in range(160):
        words = rnd.choice(rows[:120])[1].split()
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(len(words))] = rnd.choice(vocab)
        rows.append((1000 - i, " \t".join(w.upper() if rnd.random() < 0.2 else w for w in words)))
    return rows + [(5000, None), (5001, ""), (5002, " \n"), (5003, "Éa b"), (5004, "Éa B"), (5005, "éa b"), (None, "x y z")]


def test_components_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", __import__("pyspark").sql.functions.lit("clash")).repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df).collect()}
    assert got.pop(None) == (None, None)
    assert got == brute(rows)
    kept = {r.doc_id for r in keep_one_of_each(df).collect()}
    assert kept == {c for _, c in got.values()} | {None}


def test_large_group_of_near_copies(spark):
    rnd = random.Random(5)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(2):
            words[rnd.randrange(100)] = f"x{i}_{rnd.random()}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_components(df).collect() == []
    assert keep_one_of_each(df).collect() == []


def test_long_texts_on_both_sides_of_the_limit(spark):
    """Sets of some 600 shingles, whose wide signatures have different sizes, with similarities around 0.75."""
    rnd = random.Random(9)
    rows = []
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(500 + 15 * g)]
        for k in range(4):
            words = list(base[: len(base) - rnd.randint(0, 60)])
            for _ in range(rnd.randint(0, 24)):
                words[rnd.randrange(len(words))] = f"y{rnd.random()}"
            rows.append((10 * g + k, " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_an_id_of_two_rows_links_through_both_texts(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(30)) for c in "pq")
    rows = [(7, one), (7, two), (3, one), (9, two), (5, "alone")]
    got = {r.doc_id: r.component_id for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {3: 3, 7: 3, 9: 3, 5: 5}


def test_hot_shingles_and_forgotten_sets_change_nothing(spark, monkeypatch):
    """Postings of hot shingles go to many buckets, and tasks that forget sets emit some again."""
    monkeypatch.setattr(jaccard_join, "HOT", 3)
    monkeypatch.setattr(jaccard_join, "SEEN", 4)
    rows = corpus(7)
    rows += [(20_000 + i, rows[i % 9][1]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df).collect() if r.doc_id is not None}
    assert got == brute(rows)


def test_passages_that_fill_most_of_many_texts(spark):
    """Texts that share one passage and differ in up to a third: some link through others only, some not at all."""
    rnd = random.Random(11)
    passages = [[f"p{g}w{i}" for i in range(60)] for g in range(3)]
    rows = [(i, " ".join((passages[i % 3] if rnd.random() < 0.8 else passages[i % 3][: rnd.randint(30, 60)]) + [f"u{i}x{k}" for k in range(rnd.randint(0, 30))])) for i in range(250)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows) and len({c for _, c in got.values()}) > 3
