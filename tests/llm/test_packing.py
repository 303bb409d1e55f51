import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.packing import hilbert_key, pack
from tidemark.llm.tokens import PieceTokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain(text):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t.encode(text, add_special_tokens=False).ids


def test_pieces_encode_as_whole_texts():
    rnd = random.Random(3)
    chars = "aAbé É́   \x0b\x0c\x1c\t\n.,!'’s7٣<|endoftext|>İßſΣς漢한\U0001f600 "
    encode = PieceTokenizer(PATH)
    for _ in range(300):
        text = "".join(rnd.choice(chars) for _ in range(rnd.randint(0, 150)))
        assert encode.ids(text.encode()).tolist() == plain(text)
    plain_chars = "aAbCéÉßöÿ .,!-1290(\n\t\"&"
    assert encode.plain
    for _ in range(300):
        text = "".join(rnd.choice(plain_chars) for _ in range(rnd.randint(0, 150)))
        assert encode.ids(text.encode()).tolist() == plain(text)
    assert encode.ids(("x" * 300 + " don't <|startoftext|> stop").encode()).tolist() == plain("x" * 300 + " don't <|startoftext|> stop")


def test_hilbert_neighbours_touch():
    bits = 3
    points = np.array([[a, b, c] for a in range(8) for b in range(8) for c in range(8)])
    order = np.argsort(hilbert_key(points, bits))
    assert sorted(hilbert_key(points, bits)) == list(range(512))
    assert (np.abs(np.diff(points[order], axis=0)).sum(1) == 1).all()


def test_pack_round_trip(spark):
    rnd = random.Random(4)
    texts = {i: " ".join(rnd.choice(["alpha", "Beta.", "gamma!", "δέλτα", "x"]) for _ in range(rnd.choice([0, 1, 5, 300, 5000]))) for i in range(60)}
    texts |= {100: None, 101: "", 102: "copy me", 103: "copy me"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("length", F.lit("clash")).repartition(3)
    rows = pack(df, PATH, with_ids=True).collect()
    want = {d: [*plain(t or ""), 1] for d, t in texts.items()}
    back = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == len(back.setdefault(r.doc_id, [])) and r.length == len(r.ids) > 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.doc_tokens == len(want[r.doc_id])
        back[r.doc_id] += r.ids
    assert back == want
    sequences = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences.get(r.sequence_id, 0)
        sequences[r.sequence_id] = r.offset + r.length
    assert all(n <= 2048 and n & (n - 1) == 0 for n in sequences.values())


def test_pack_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
