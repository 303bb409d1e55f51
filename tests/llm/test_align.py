import hashlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tidemark.llm import align
from tidemark.llm.align import align_tokens

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ZERO = (0, 0, 0, 0, 0, 0, "")


@pytest.fixture(scope="module")
def sides():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    return a, b


def letters():
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return {chr(x if x in own else next(rest)): x for x in range(256)}


def groups(sides, text):
    """Groups of (A ids, B ids) of a whole text, by sets of end offsets."""
    a, b = sides
    if not text:
        return []
    alphabet, ids_a, ids_b = letters(), a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    raw_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
    pieces = [b.id_to_piece(i) for i in ids_b]
    raw_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in pieces]
    if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
        return []
    ends = lambda raw: [sum(map(len, raw[: i + 1])) for i in range(len(raw))] if len(raw) < 3000 else running(raw)
    ends_a, ends_b = ends(raw_a), ends(raw_b)
    cuts = sorted(set(ends_a) & set(ends_b))
    out, i, j = [], 0, 0
    for cut in cuts:
        ga, gb = [], []
        while i < len(ids_a) and ends_a[i] <= cut:
            ga.append(ids_a[i])
            i += 1
        while j < len(ids_b) and ends_b[j] <= cut:
            gb.append(ids_b[j])
            j += 1
        out.append((ga, gb))
    return out


def running(raw):
    out, at = [], 0
    for r in raw:
        at += len(r)
        out.append(at)
    return out


def brute(sides, rows):
    cut = [groups(sides, t) for _, t in rows]
    links = [Counter((x, y) for ga, gb in g for x in ga for y in gb) for g in cut]
    count = Counter(p for c in links for p in c)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (doc_id, _), g, c in zip(rows, cut, links):
        spelled = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g)
        n_best = sum(k for p, k in c.items() if count[p] == best[p[0]])
        sums = (sum(len(ga) for ga, _ in g), sum(len(gb) for _, gb in g), len(g), sum(c.values()), n_best, sum(k * count[p] for p, k in c.items()))
        out.append((doc_id, *sums, hashlib.sha256(spelled.encode()).hexdigest() if g else ""))
    return sorted(out, key=repr)


def texts(seed):
    rnd = random.Random(seed)
    odd = ["a\r\nb", ";\r\n  x", "\t\tif (x)\t{\r\n}", "don't I'LL", "▁", "<0x41>", "<s> </s> <|endoftext|>", "漢字かな", "🙂🙂", "é́", " x y", "  ", "\n\n \n", " z", "z ", "12345 67.8", "\x00\x1c\x85", "ﬁ", "naïveté", "ÀÉÿ", "_____", "-----=====", "the the the"]
    for _ in range(250):
        yield "".join(rnd.choice(odd + [" ", "\n", " of", "ing ", "Word"]) for _ in range(rnd.randint(1, 12)))


def test_equals_brute_force(spark, sides):
    rows = list(enumerate(texts(5))) + [(3, "the same id"), (None, "no id"), (None, None), (900, None), (901, ""), (902, "▁ alone"), (903, "x" * 70), (904, "ab " * 3000 + "q" * 500), (905, "é🙂" * 400)]
    df = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], "doc_id long, text string, n_a int, row string").repartition(4)
    got = sorted((tuple(r) for r in align_tokens(df, A, B).collect()), key=repr)
    want = brute(sides, rows)
    assert got == want
    assert (902, *ZERO) in got and any(r[1] and r[5] < r[4] for r in got)


def test_many_blocks_of_documents(spark, sides, monkeypatch):
    monkeypatch.setattr(align, "BLOCK_BYTES", 500)
    rows = list(enumerate(texts(6)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in align_tokens(df, A, B).collect()), key=repr) == brute(sides, rows)


def in_one_process(rows):
    batch = pa.record_batch({"doc_id": pa.array([r[0] for r in rows]), "text": pa.array([r[1] for r in rows]), "row": pa.array(range(len(rows)))})
    done = pa.Table.from_batches(list(align._pass(A, B)(iter([batch.slice(0, 100), batch.slice(100)]))))
    of = lambda kind: done.filter(pc.equal(done["kind"], kind))
    partial, links, sums = of(align._COUNTS).sort_by("stripe"), of(align._LINKS), defaultdict(lambda: [0, 0])
    counts = pa.Table.from_batches(list(align._stripes(32_000)(iter(partial.to_batches()))))
    for g in range(align.GROUPS):
        mine = counts.filter(pc.equal(pc.bit_wise_and(counts["stripe"], align.GROUPS - 1), g))
        for r in align._score(links.filter(pc.equal(links["stripe"], g)), mine).to_pylist():
            sums[r["row"]][0] += r["n_best"]
            sums[r["row"]][1] += r["count_sum"]
    out = [(r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], *sums[r["row"]], r["groups_sha256"]) for r in of(align._FACTS).to_pylist()]
    return sorted(out, key=repr), partial.num_rows, links.num_rows


def test_small_parts_forgetting_and_large_groups_change_nothing(sides, monkeypatch):
    rows = list(enumerate(texts(7))) + [(900, "é🙂" * 50)]
    plain = in_one_process(rows)
    align.aligner.cache_clear()
    for name, value in {"PART_LINKS": 50, "HELD_PAIRS": 40, "CACHE_STRETCHES": 30, "CACHE_CHARS": 900, "LARGE_GROUP": 1, "RUN": 3, "PART_CHARS": 100}.items():
        monkeypatch.setattr(align, name, value)
    small = in_one_process(rows)
    assert plain[0] == small[0] == brute(sides, rows)
    assert small[1] > plain[1] and small[2] > plain[2]


def test_empty_table(spark):
    assert align_tokens(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []
