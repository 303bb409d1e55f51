import random
import re
from collections import Counter
from zlib import crc32

from tidemark.llm.shared import Scratch
from tidemark.llm.spelling import _roots, near_pairs, spelling_groups

LOWER = {c: c + 32 for c in range(65, 91)}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    mates = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, others in mates.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= 5 * words[w]:
            form[w] = best
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (n, len(mates[w]), form.get(w), words.get(form.get(w)), root)
    return out


def result(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def test_equals_brute_force(spark):
    rnd = random.Random(3)
    base = ["".join(rnd.choice("abcdeéÀ×ÿ") for _ in range(rnd.randint(6, 9))) for _ in range(40)]
    weights = [rnd.choice((1, 1, 6, 40, 300)) for _ in base]
    rows = []
    for i in range(300):
        words = []
        for w in rnd.choices(base, weights, k=60):
            if rnd.random() < 0.3:
                at, c = rnd.randrange(len(w)), rnd.choice("aé")
                w = rnd.choice((w[:at] + w[at + 1 :], w[:at] + c + w[at + 1 :], w[:at] + c + w[at:]))
            words.append(w.upper() if rnd.random() < 0.1 and w.isascii() else w)
        rows.append((i, rnd.choice((" ", "-", "œ", "\n")).join(words)))
    rows += [(None, "Ærostat " * 7), (7, None), (8, ""), (9, "abcdef" * 40_000), (9, rows[9][1]), (10, " 1 漢字 "), *[(11, "abcdef" * 40_000)] * 4, (12, "wirfena " * 6 + "wirfen " * 31 + "wirden " * 200)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, word string").repartition(5)
    got = result(spelling_groups(df))
    want = brute(rows)
    assert got == want
    assert any(v[2] and v[4] != v[2] for v in want.values()) and any(v[1] > 1 for v in want.values())


def test_ties_go_to_the_first_in_code_point_order(spark):
    rows = [(1, "worfen " * 5 + "worden " * 50 + "worten " * 50)]
    got = result(spelling_groups(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute(rows) and got["worfen"][2] == "worden"


def test_empty_table(spark):
    assert spelling_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_tables_that_grow_with_the_vocabulary_are_not_broadcast(spark, tmp_path):
    """by its files, exploded keys looked small enough to broadcast, and the driver ran out of memory."""
    spark.createDataFrame([("wirfen", 31), ("wirfena", 6), ("wirden", 200)], "word string, n long").write.parquet(f"{tmp_path}/vocabulary")
    joined = [
        near_pairs(spark.read.parquet(f"{tmp_path}/vocabulary")),
        spelling_groups(spark.createDataFrame([(1, "wirfena " * 6 + "wirfen " * 31 + "wirden " * 200)], "doc_id long, text string")),
    ]
    forms = spark.createDataFrame([("wirfena", "wirfen"), ("wirfen", "wirden")], "word string, form string")
    steps = []

    class Kept(Scratch):
        def keep(self, df, name, partition_by=None):
            steps.append(df)
            return super().keep(df, name, partition_by)

    roots = _roots(forms, Kept(spark, "spelling"))
    assert {tuple(r) for r in roots.collect()} == {("wirfena", "wirden"), ("wirfen", "wirden")}
    for df in [*joined, steps[1]]:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
