"""Operator 10: n-gram Jaccard join by rare-first prefix filtering.

Method. Words are hashed into 5-word shingles. A frequency sketch, counted over every document, orders the shingles from rare to
frequent; two sets of Jaccard similarity 3/4 or more must share a shingle among the rarest ``n // 4 + 1`` of each, whatever
total order is used, so the sketch only decides how many candidates arise, never which links are found. Prefix shingles go to
buckets by hash, where equal ones meet. Links need the length, positional and suffix filters to hold and are then verified once
per pair on the whole sets. The positional filter is strict: at the first shingle that a linked pair shares, nothing before it is
shared, so what follows must suffice in both; a pair that fails it at one shingle may hold it at another.

Groups of copies. All pairs of a group are never made. A task emits the prefix of equal sets once, and of the sets' documents one goes
on for all. Among the documents of a shingle whose sizes are within one factor of 4/3 (a size class) the one that has most of its set
left behind the shingle is the pivot, as it reaches the largest partners. A first round pairs each document with the
pivot that it shares most shingles with, a second one with all other pivots of its shingles and neighbouring size classes that are not in its component yet:
some pairs a posting at most. A last round pairs what the filters still let through between different components, and within it
only pairs whose smaller set has the shingle in its first seventh, as one of the two must. Pairs within a component add
nothing to the components, so no link between components is lost.

Cases. Null or wordless texts have no shingles and are alone. One to four words are one shingle, the whole sequence. A
null id takes no part in links and keeps a row with a null component. Rows that repeat an id are one document, with the
union of their shingle sets taken as separate sets linked by the id. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.shared import Scratch, in_few_files, shuffle_partitions, small_batches
from tidemark.llm.textops import SPACED_LOWER, Words, mix, ngrams, sequence_hash, signed, utf8_parts

SHINGLE = 5
#: 100 * intersection >= 75 * union, as a fraction of small whole numbers.
NUMERATOR, DENOMINATOR = 3, 4
#: Bits of the frequency sketch's slots: one counter (4 bytes) for each BYTES_A_COUNTER bytes of text, between these bounds, and the
#: blocks that it travels in. Tasks that count are joined to COUNT_TASKS a core, so that what they send doesn't grow with their number.
LEAST_BITS, MOST_BITS, BYTES_A_COUNTER, BLOCKS, COUNT_TASKS = 16, 24, 768, 256, 4
#: Bits of the set signature of the suffix filter, in 64-bit words; sets of more than WIDE_FROM shingles have a second signature of
#: a power of two bits, WIDE_BITS or more for each shingle, which is looked at once a pair.
SIGNATURE_WORDS = 8
WIDE_FROM, WIDE_BITS = 256, 2
PART_BYTES = 1 << 18
#: Prefix shingles that one bucket is planned to hold.
BUCKET_SHINGLES = 1_500_000
#: Estimated frequency from which a shingle's postings are dealt over many buckets, and the equal sets that a task remembers.
HOT, SEEN = 100_000, 100_000
#: Ids (8 bytes each) up to which the documents to verify are picked by a broadcast; beyond it by a shuffle join.
BROADCAST_IDS = 250_000

_META = np.dtype([("doc", "<i8"), ("n", "<i4"), ("h1", "<i8"), ("h2", "<i8"), ("again", "<i4"), ("sig", "<i8", SIGNATURE_WORDS), ("wide", "<i4")])
_HOT_FLAG = np.uint32(1 << 31)


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each row) for parts of the column."""
    for lo, hi, data, offsets in utf8_parts(texts, PART_BYTES):
        words = Words(data, offsets, SPACED_LOWER)
        grams, at = ngrams(words.hash, words.first, SHINGLE)
        sets = []
        for i in range(hi - lo):
            a, b = words.first[i], words.first[i + 1]
            if b - a >= SHINGLE:
                x = np.sort(grams[at[i] : at[i + 1]])
                sets.append(x[np.concatenate(([True], x[1:] != x[:-1]))])
            elif b > a:
                sets.append(sequence_hash(words.hash[a:b]))
            else:
                sets.append(grams[:0])
        yield lo, sets


def _slot(shingles: np.ndarray, bits: int) -> np.ndarray:
    return (shingles >> np.uint64(64 - bits)).astype(np.int64)


def _count(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for _, sets in shingle_sets(batch.column("text")):
                np.add.at(sketch, _slot(np.concatenate(sets), bits), np.uint32(1))
        for i, block in enumerate(sketch.reshape(BLOCKS, -1)):
            if block.any():  # in as few bytes as its counts need
                narrow = block.astype(np.min_scalar_type(block.max()))
                yield pa.record_batch({"block": pa.array([i], pa.int32()), "counts": pa.array([narrow.tobytes()], pa.binary())})

    return run


def _add_blocks(bits: int):
    size = (1 << bits) // BLOCKS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts")):
                raw = counts.as_buffer()
                narrow = np.frombuffer(raw, f"u{len(raw) // size}")
                sums[block] = np.minimum(sums.get(block, np.uint64(0)) + narrow.astype(np.uint64), 0xFFFFFFFF)
        for block, counts in sums.items():
            yield pa.record_batch({"block": pa.array([block], pa.int32()), "counts": pa.array([counts.astype(np.uint32).tobytes()], pa.binary())})

    return run


def sketch_bits(text_bytes: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, (text_bytes // BYTES_A_COUNTER).bit_length()))


def frequency_sketch(docs: DataFrame, bits: int) -> np.ndarray:
    """Occurrences by shingle slot over all documents; 2**bits counters, 64 MB at most whatever the input."""
    schema = "block int, counts binary"
    tasks = COUNT_TASKS * docs.sparkSession.sparkContext.defaultParallelism
    partial = docs.select("text").coalesce(tasks).mapInArrow(_count(bits), schema)
    sketch = np.zeros((BLOCKS, (1 << bits) // BLOCKS), np.uint32)
    with small_batches(docs.sparkSession):
        for row in partial.repartition(16, "block").mapInArrow(_add_blocks(bits), schema).toLocalIterator():
            sketch[row["block"]] = np.frombuffer(row["counts"], np.uint32)
    return sketch.ravel()


def _signature(shingles: np.ndarray, words: int = SIGNATURE_WORDS) -> np.ndarray:
    """Whether an odd number of shingles falls into each of some parts of the hash space. Where two signatures differ, at least one
    shingle is in one set only, however many both share. Halves of a signature, combined by XOR, are the one of half the size."""
    counts = np.bincount((shingles % np.uint64(words * 64)).astype(np.int64), minlength=words * 64)
    return np.packbits((counts & 1).astype(np.uint8)).view("<i8")


def _wide_signature(shingles: np.ndarray) -> np.ndarray:
    if len(shingles) <= WIDE_FROM:
        return np.empty(0, "<i8")
    return _signature(shingles, 1 << ((WIDE_BITS * len(shingles) - 1) >> 6).bit_length())


def _prefixes(ranks, bits: int, buckets: int):
    """Blobs of prefix shingles and of document facts, by bucket. A hot shingle's postings go to many buckets, by document."""

    def flush(rank, tokens, docs, sizes, places, facts, wides) -> Iterator[tuple[int, int, bytes]]:
        if tokens:
            tok = np.concatenate(tokens)
            index = np.repeat(np.arange(len(docs), dtype=np.uint32), [len(t) for t in tokens])
            pos, ids, n = np.concatenate(places), np.array(docs, "<i8"), np.array(sizes, "<u4")
            hot = rank[_slot(tok, bits)] >= HOT
            pos = np.where(hot, pos | _HOT_FLAG, pos)
            to = (mix(np.where(hot, tok ^ mix(ids[index].view(np.uint64)), tok)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            cuts = np.searchsorted(to[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)):
                o = order[cuts[b] : cuts[b + 1]]
                mine, local = np.unique(index[o], return_inverse=True)
                head = np.array([len(o), len(mine)], "<i8")
                yield int(b), 1, b"".join(x.tobytes() for x in (head, tok[o], local.astype("<u4"), pos[o], ids[mine], n[mine]))
        facts = np.array(facts, _META)
        to = (mix(facts["doc"].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        for b in np.unique(to):
            mine = np.flatnonzero(to == b)
            yield int(b), 0, b"".join((np.array([len(mine)], "<i8").tobytes(), facts[mine].tobytes(), *(wides[i].tobytes() for i in mine)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, seen = ranks.value, set()
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            tokens, docs, sizes, places, facts, wides = [], [], [], [], [], []
            for lo, sets in shingle_sets(batch.column("text")):
                for doc, x in zip(ids[lo : lo + len(sets)], sets):
                    n = len(x)
                    if doc is None:
                        continue
                    h1, h2 = (int(x.sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(mix(x ^ np.uint64(0x5BD1E995))).view(np.int64))) if n else (0, 0)
                    again = (n, h1, h2) in seen
                    wides.append(_wide_signature(x))
                    facts.append((doc, n, h1, h2, again, _signature(x), len(wides[-1])))
                    if n and not again:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add((n, h1, h2))
                        take = n - (NUMERATOR * n + DENOMINATOR - 1) // DENOMINATOR + 1
                        order = np.argsort(rank[_slot(x, bits)], kind="stable")[:take]  # ties keep the order of the hashes
                        tokens.append(x[order])
                        docs.append(doc)
                        sizes.append(n)
                        places.append(np.arange(take, dtype="<u4"))
                if sum(map(len, tokens)) > 400_000 or len(facts) > 20_000:
                    yield _blobs(flush(rank, tokens, docs, sizes, places, facts, wides))
                    tokens, docs, sizes, places, facts, wides = [], [], [], [], [], []
            if facts:
                yield _blobs(flush(rank, tokens, docs, sizes, places, facts, wides))

    return run


def _blobs(rows: Iterator[tuple[int, int, bytes]]) -> pa.RecordBatch:
    rows = list(rows)
    return pa.record_batch({"bucket": pa.array([r[0] for r in rows], pa.int32()), "kind": pa.array([r[1] for r in rows], pa.int32()), "blob": pa.array([r[2] for r in rows], pa.large_binary()).cast(pa.binary())})


_MET = "kind int, token long, doc long, n int, pos int, h1 long, h2 long, again int, sig array<long>, wide array<long>"
_MET_ARROW = pa.schema([("kind", pa.int32()), ("token", pa.int64()), ("doc", pa.int64()), ("n", pa.int32()), ("pos", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("again", pa.int32()), ("sig", pa.list_(pa.int64())), ("wide", pa.list_(pa.int64()))])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one bucket: its documents' facts (kind 0) and the postings of shingles that two or more documents hold, and of hot ones (kind 1)."""

    def out(rows: int, **columns) -> Iterator[pa.RecordBatch]:
        arrays = [columns.get(f.name, None) for f in _MET_ARROW]
        arrays = [pa.nulls(rows, f.type) if a is None else pa.array(a, f.type) if not isinstance(a, pa.Array) else a for a, f in zip(arrays, _MET_ARROW)]
        whole = pa.RecordBatch.from_arrays(arrays, schema=_MET_ARROW)
        for at in range(0, rows, 50_000):
            yield whole.slice(at, 50_000)

    tok, doc, size, pos = [], [], [], []
    for batch in batches:
        for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("blob")):
            blob = blob.as_buffer()
            if kind == 0:
                facts = np.frombuffer(blob, _META, int(np.frombuffer(blob, "<i8", 1)[0]), 8)
                sig = np.ascontiguousarray(facts["sig"]).ravel()
                wide, cuts = np.frombuffer(blob, "<i8", offset=8 + facts.nbytes), np.concatenate(([0], np.cumsum(facts["wide"])))
                lists = {"sig": (sig, np.arange(0, len(sig) + 1, SIGNATURE_WORDS)), "wide": (wide, cuts)}
                lists = {k: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x)) for k, (x, at) in lists.items()}
                yield from out(len(facts), kind=np.zeros(len(facts), np.int32), **{c: facts[c].copy() for c in ("doc", "n", "h1", "h2", "again")}, **lists)
                continue
            m, k = np.frombuffer(blob, "<i8", 2)
            tok.append(np.frombuffer(blob, "<u8", m, 16))
            local = np.frombuffer(blob, "<u4", m, 16 + 8 * m)
            pos.append(np.frombuffer(blob, "<u4", m, 16 + 12 * m))
            doc.append(np.frombuffer(blob, "<i8", k, 16 + 16 * m)[local])
            size.append(np.frombuffer(blob, "<u4", k, 16 + 16 * m + 8 * k)[local])
    if not tok:
        return
    tok, doc, size, pos = (np.concatenate(x) for x in (tok, doc, size, pos))
    order = np.argsort(tok)
    sorted_tok = tok[order]
    same = sorted_tok[1:] == sorted_tok[:-1]
    shared = np.concatenate(([False], same)) | np.concatenate((same, [False])) | (pos[order] >= _HOT_FLAG)
    o = order[shared]
    pos &= ~_HOT_FLAG
    yield from out(len(o), kind=np.ones(len(o), np.int32), token=signed(tok[o]), doc=doc[o], n=size[o].astype(np.int32), pos=pos[o].astype(np.int32))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, sets in shingle_sets(batch.column("text")):
            a, b = (batch.column(c).slice(lo, len(sets)).cast(pa.int64()) for c in "ab")
            yield pa.record_batch({"a": a, "b": b, "shingles": pa.array([x.tobytes() for x in sets], pa.binary())})


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = []
        for x, y in zip(batch.column("x"), batch.column("y")):
            x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
            if len(x) > len(y):
                x, y = y, x
            at = np.minimum(np.searchsorted(y, x), max(0, len(y) - 1))
            common = int((y[at] == x).sum()) if len(y) else 0
            good.append(common * DENOMINATOR >= NUMERATOR * (len(x) + len(y) - common) and common > 0)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(good, pa.bool_())), batch.column("b").filter(pa.array(good, pa.bool_()))], names=["a", "b"])


def _reach(n, pos):
    """The size of the largest set that one of ``n`` shingles can link with where the first shared one is at ``pos``."""
    return F.floor((n - pos) * (NUMERATOR + DENOMINATOR) / F.lit(NUMERATOR)).cast("int") - n


def _can_link(n1: str, n2: str, reach1: str, reach2: str):
    """The length and the positional filter, at a shingle that both share."""
    a, b = F.col(n1).cast("long"), F.col(n2).cast("long")
    return (F.least(a, b) * DENOMINATOR >= F.greatest(a, b) * NUMERATOR) & (a <= F.col(reach2)) & (b <= F.col(reach1))


def _size_class(n):
    """Sets that can link are in the same class or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / float(np.log(DENOMINATOR / NUMERATOR) * 1.0000001)).cast("int")


def _fits_apart(apart, n1: str, n2: str):
    need = F.ceil((F.col(n1) + F.col(n2)) * NUMERATOR / (NUMERATOR + DENOMINATOR))  # least overlap
    return apart <= F.col(n1) + F.col(n2) - 2 * need


def _may_overlap(n1: str, n2: str, sig1: str, sig2: str):
    """The suffix filter: shingle sets whose signatures differ in more places than their sizes allow can't link."""
    apart = sum((F.bit_count(F.col(sig1)[i].bitwiseXOR(F.col(sig2)[i])) for i in range(SIGNATURE_WORDS)), F.lit(0))
    return F.coalesce(_fits_apart(apart, n1, n2), F.lit(True))


def _may_overlap_wide(n1: str, n2: str, wide1: str, wide2: str):
    """The suffix filter on wide signatures. Sizes that can link differ by less than a factor of two, so signatures do by two at most."""
    x, y = F.col(wide1), F.col(wide2)
    k1, k2 = F.size(x), F.size(y)
    xor = lambda u, v: F.zip_with(u, v, lambda i, j: i.bitwiseXOR(j))
    half = lambda u, k: xor(F.slice(u, 1, k), F.slice(u, k + 1, k))
    between = F.when(k1 == k2, xor(x, y)).when(k1 == 2 * k2, xor(half(x, k2), y)).when(k2 == 2 * k1, xor(x, half(y, k1)))
    apart = F.aggregate(between, F.lit(0), lambda acc, i: acc + F.bit_count(i))
    return F.coalesce((k1 == 0) | (k2 == 0), F.lit(True)) | F.coalesce(_fits_apart(apart, n1, n2), F.lit(True))


class JaccardJoin:
    """Finds the links of one table of documents; see the module's text."""

    def __init__(self, spark: SparkSession, docs: DataFrame):
        self.spark, self.scratch = spark, Scratch(spark, "jaccard")
        self.docs = docs.select("doc_id", "text")
        self.with_id = self.docs.where("doc_id is not null")

    def _met(self) -> DataFrame:
        size = self.with_id.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        bits = sketch_bits(size)
        sketch = frequency_sketch(self.with_id, bits)
        shingles = int(sketch.sum(dtype=np.uint64))
        buckets = max(shuffle_partitions(self.spark), -(-shingles // (DENOMINATOR * BUCKET_SHINGLES)))
        ranks = self.spark.sparkContext.broadcast(sketch)
        blobs = self.with_id.mapInArrow(_prefixes(ranks, bits, buckets), "bucket int, kind int, blob binary")
        met = self.scratch.keep(blobs.repartitionById(buckets, F.col("bucket")).mapInArrow(_meet, _MET), "met", ["kind"])
        ranks.unpersist()
        return met

    def _checked(self, pairs: DataFrame) -> DataFrame:
        """pairs(a, b), distinct and of different sets, to those that are links."""
        pairs = self._facts_to(pairs, ["n", "sig"]).where(_may_overlap("n_a", "n_b", "sig_a", "sig_b")).select("a", "b")
        near = self.scratch.keep(pairs, "near")
        pairs = self._facts_to(near, ["n", "wide"]).where(_may_overlap_wide("n_a", "n_b", "wide_a", "wide_b")).select("a", "b")
        rest = self.scratch.keep(pairs, "filtered")
        hint = self._hint(rest)
        firsts = rest.select(F.col("a").alias("doc_id")).distinct()
        x = self.with_id.join(hint(firsts), "doc_id", "left_semi").select(F.lit(None).cast("long").alias("a"), F.col("doc_id").alias("b"), "text")
        y = self.with_id.withColumnRenamed("doc_id", "b").join(hint(rest), "b").select("a", "b", "text")
        shape = "a long, b long, shingles binary"
        ready = x.mapInArrow(_sets, shape).select(F.col("b").alias("a"), F.col("shingles").alias("x")).join(y.mapInArrow(_sets, shape).withColumnRenamed("shingles", "y"), "a")
        links = ready.select("a", "b", "x", "y").mapInArrow(_verify, "a long, b long").distinct()
        links = self.scratch.keep(in_few_files(links, rest.count()), "links")
        self.scratch.drop(near, rest)
        return links

    @staticmethod
    def _hint(ids: DataFrame):
        """Broadcasts a table of ids where it is small, by a count of its rows."""
        return F.broadcast if ids.count() <= BROADCAST_IDS else lambda df: df

    def _facts_to(self, pairs: DataFrame, columns: list[str]) -> DataFrame:
        """pairs(a, b), a kept table, with the columns of both documents."""
        hint = self._hint(pairs)
        of = lambda side: self.facts.select(F.col("doc").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns))
        seconds = of("b").join(hint(pairs.select("b").distinct()), "b", "left_semi")
        return of("a").join(hint(pairs), "a").join(seconds, "b")

    def _postings(self) -> tuple[DataFrame, DataFrame]:
        """Keeps ``facts``; returns copies (a, b), of equal sets, and the postings of one document of each set."""
        met = self.met = self._met()
        rows = met.where("kind = 0").select("doc", "n", "h1", "h2", "again", "sig", "wide")
        # An id of several rows has several sets: it has no signatures, so that no filter dismisses it, and keeps its postings.
        once = F.col("times") == 1
        facts = rows.groupBy("doc").agg(F.max(F.struct("n", "h1", "h2", "sig", "wide")).alias("f"), F.count("*").alias("times"))
        self.facts = self.scratch.keep(facts.select("doc", "f.n", *(F.when(once, F.col(f"f.{c}")).alias(c) for c in ("sig", "wide")), once.alias("once")), "facts")
        # The smallest id among those whose prefix was emitted goes on for its set.
        sets = rows.where("n > 0").groupBy("n", "h1", "h2").agg(F.min(F.struct("again", "doc")).alias("m"), F.count("*").alias("copies")).where("copies > 1").select("n", "h1", "h2", F.col("m.doc").alias("a"))
        self.rows = rows.count()
        sets = self.scratch.keep(in_few_files(sets, self.rows), "sets")
        copies = rows.select("doc", "n", "h1", "h2").join(self._hint(sets)(sets), ["n", "h1", "h2"]).where("doc <> a").select("a", F.col("doc").alias("b"))
        copies = self.scratch.keep(copies, "copies")
        several = self.facts.where("not once").select(F.col("doc").alias("b"))
        posts = met.where("kind = 1").select("token", "doc", "n", _reach(F.col("n"), F.col("pos")).alias("reach"), _size_class(F.col("n")).alias("size"))
        hidden = copies.select("b").join(several, "b", "left_anti").select(F.col("b").alias("doc"))
        return copies, posts.join(self._hint(copies)(hidden), "doc", "left_anti")

    @staticmethod
    def _able(posts: DataFrame) -> DataFrame:
        """Postings that may meet another at their shingle: by the smallest set and the largest reach there."""
        ends = posts.groupBy("token").agg(F.count("*").alias("k"), F.min("n").alias("least"), F.max("reach").alias("most")).where("k > 1")
        return posts.join(ends, "token").where("reach >= least and n <= most").select(*posts.columns)

    @staticmethod
    def _star(posts: DataFrame) -> DataFrame:
        """(a, b, lists): documents with the pivots of their shingles, by size class, where the filters hold."""
        best = F.max(F.struct("reach", (-F.col("doc")).alias("minus"), "n"))
        reached = F.sequence(F.col("size") - 1, F.least(F.col("size") + 1, _size_class(F.col("p.reach"))))  # classes of sets that the pivot reaches
        pivots = posts.groupBy("token", "size").agg(best.alias("p")).select("token", F.explode(F.filter(reached, lambda c: c <= _size_class(F.col("p.reach")))).alias("size"), (-F.col("p.minus")).alias("pivot"), F.col("p.n").alias("n2"), F.col("p.reach").alias("reach2"))
        met = posts.join(pivots, ["token", "size"]).where((F.col("doc") != F.col("pivot")) & _can_link("n", "n2", "reach", "reach2"))
        return met.groupBy(F.col("pivot").alias("a"), F.col("doc").alias("b")).agg(F.count("*").alias("lists"))

    @staticmethod
    def _partners(open_: DataFrame) -> DataFrame:
        """Pairs (a, b) of different components that the filters let through. At the first shingle that a linked pair shares, the smaller
        set's reach is its own size or more."""
        near = F.explode(F.array(F.col("size"), F.col("size") + 1)).alias("size")
        one = open_.where("reach >= n").select("token", near, *(F.col(x).alias(f"{x}1") for x in ("doc", "n", "reach", "c", "sig")))
        apart = (F.col("c") != F.col("c1")) & ((F.col("n1") < F.col("n")) | ((F.col("n1") == F.col("n")) & (F.col("doc1") < F.col("doc"))))
        pairs = open_.join(one, ["token", "size"]).where(apart & _can_link("n1", "n", "reach1", "reach") & _may_overlap("n1", "n", "sig1", "sig"))
        return pairs.select(F.least("doc", "doc1").alias("a"), F.greatest("doc", "doc1").alias("b")).distinct()

    def _open(self, posts: DataFrame, component: DataFrame) -> DataFrame:
        """Postings that may still link with one of another component at their shingle."""
        placed = posts.join(self._hint(component)(component), posts["doc"] == component["node"], "left").select("token", "doc", "n", "reach", "size", F.coalesce("component", "doc").alias("c"))
        placed = self.scratch.keep(placed, "placed")
        ends = placed.groupBy("token").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.min("n").alias("least"), F.max("reach").alias("most")).where("c0 < c1").select("token", "least", "most")
        return placed.join(ends, "token").where("reach >= least and n <= most").drop("least", "most").join(self.facts.select("doc", "sig"), "doc")

    def _merged(self, links: DataFrame, component: DataFrame) -> DataFrame:
        """component(node, component) with links(a, b) added."""
        up = lambda c: links.join(component.toDF(c, f"c_{c}"), c, "left").select(F.col("a"), F.col("b"), F.coalesce(f"c_{c}", c).alias(f"to_{c}"))
        joined = up("a").join(up("b").select("a", "b", "to_b"), ["a", "b"]).select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        merged = self.scratch.keep(in_few_files(connected_components(joined, self.scratch), self.rows), "merged")
        self.scratch.drop(links)
        if merged.isEmpty():
            return component
        through = component.join(merged.toDF("component", "to"), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        roots = merged.join(component.select("node"), "node", "left_anti")
        out = self.scratch.keep(through.union(roots), "component")
        self.scratch.drop(component, merged)
        return out

    @staticmethod
    def _across(pairs: DataFrame, component: DataFrame) -> DataFrame:
        """Pairs (a, b) of different components."""
        for side in "ab":
            pairs = pairs.join(component.toDF(side, f"c_{side}"), side, "left")
        return pairs.where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")

    def components(self) -> tuple[DataFrame, DataFrame]:
        """facts(doc, n) and component(doc, component) of the documents that are linked with a smaller id."""
        copies, posts = self._postings()
        every = self.scratch.keep(posts, "postings")
        self.scratch.drop(self.met)
        posts = self.scratch.keep(self._able(every), "able")
        self.scratch.drop(every)
        star = self.scratch.keep(in_few_files(self._star(posts), posts.count()), "star")
        most = star.groupBy("b").agg(F.max(F.struct("lists", (-F.col("a")).alias("a"))).alias("m"))
        first = self.scratch.keep(in_few_files(most.select((-F.col("m.a")).alias("a"), "b"), self.rows), "first")  # one pair a document
        links = self._checked(first)
        component = self.scratch.keep(in_few_files(connected_components(links.union(copies), self.scratch), self.rows), "component")
        self.scratch.drop(links, copies)
        second = self._across(star.select("a", "b").join(first, ["a", "b"], "left_anti"), component)
        second = second.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        second = self.scratch.keep(in_few_files(second, star.count()), "second")
        if not second.isEmpty():
            component = self._merged(self._checked(second), component)
        open_ = self.scratch.keep(self._open(posts, component), "open")
        tried = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).union(second)
        last = self.scratch.keep(self._partners(open_).join(tried, ["a", "b"], "left_anti"), "last")
        self.scratch.drop(posts, star, open_)
        if not last.isEmpty():
            component = self._merged(self._checked(last), component)
        self.scratch.drop(first, second, last)
        return self.facts.select("doc", "n"), component


def jaccard_components(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) to (doc_id, n_shingles, component_id), one row per id; a null id has a null component and no count."""
    spark = docs.sparkSession
    facts, component = JaccardJoin(spark, docs).components()
    out = facts.join(component, facts["doc"] == component["node"], "left").select(F.col("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))
    unnamed = docs.where("doc_id is null").select(F.col("doc_id").cast("long"), F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return out.union(unnamed)


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component stays, the one of the smallest id; null ids stay. Columns are unchanged."""
    spark = docs.sparkSession
    _, component = JaccardJoin(spark, docs).components()
    return docs.join(component.select(F.col("node").alias("doc_id")), "doc_id", "left_anti").select(*docs.columns)
