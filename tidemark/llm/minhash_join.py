"""Operator 12: near duplicates by an inverted join of MinHash signature coordinates.

Method. A document's signature has COORDINATES minima of its shingles' hashes; two documents agree at each with a probability of their
Jaccard similarity. Documents are posted under coordinate-value pairs, and pairs of documents that agree at MATCHES or more are
candidates. They are counted with prefix and skip merging. COORDINATES - POSTED coordinates are skipped for all: what agrees at MATCHES agrees at
LEAST_SHARED or more of the others. Of these a document's lists are ordered by their exact lengths; the LEAST_SHARED - 1 longest are skipped
too, and only the rest, the prefix, is merged, as candidates must meet in one of those. Skipped lists are never read: each posting carries some
bits of every coordinate, and the number of equal ones, which is never below the number of agreements, is counted there. A
document with fewer than LEAST_SHARED lists of two or more has no candidates and leaves before anything is merged.
Candidates are verified on their whole shingle sets.

A pair of similarity 0.85 agrees at 54 of 64 coordinates on average and at fewer than MATCHES = 38 with a probability of 1.5e-7; a more similar pair
still less often. Only that can lose a link.

Groups. All pairs of a group are never made. Equal sets are linked through one of them, which alone is posted. Of each list and size class
the document whose lists are longest in sum is the pivot: edits give a text rare lists, so it is the one that most others are edits of. Documents are
first paired with pivots, then, across the components which that gives, with what else they meet, as far as an exact bound lets them:
where the parities of two sets' hash counts differ, one shingle at least is in one set only. Pairs within a component add nothing to
it. The lists of frequent pairs are dealt over salted parts, as are a pivot's pairs.

Texts that are near a pivot of very many, but not near enough, would meet each other and all that is linked with it. Such a hub's candidates
meet by what sets them apart from it instead. For d shingles that one of two sets x, y and the hub h don't share,
|x ^ y| = |d(x)| + |d(y)| - 2 |d(x) & d(y)|, so a link between two that aren't both linked with the hub needs a common part of both
differences, of a size that follows from theirs. Rare-first prefixes of the differences find it: independent edits have rare shingles first and don't
meet. Both this and the bound are exact. In a list, and at a shingle of differences, only what is outside the largest component (or hub) meets the rest.

Cases. Null or wordless texts have no shingles and are alone. One or two words are one shingle, the whole sequence; sets of five shingles or
fewer link with equal ones only. A null id takes no part in links; its rows have a null component and count, and are kept. Rows that repeat an id are one
document with several sets that the id links; the largest is counted. Columns but doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.shared import Scratch
from tidemark.llm.textops import SPACED_LOWER, Words, mix, ngrams, sequence_hash, utf8_parts

SHINGLE = 3
#: 100 * intersection >= 85 * union, as a fraction of small whole numbers.
NUMERATOR, DENOMINATOR = 17, 20
#: Coordinates of a signature (bits of a long), those in which candidates agree, and those that are posted.
COORDINATES, MATCHES, POSTED = 64, 38, 40
LEAST_SHARED = MATCHES - (COORDINATES - POSTED)
#: What a posting carries: bits of each coordinate, and 64-bit words of the parities of the set's hashes.
CARRIED, PARITIES = 2, 4
#: Sets x, y link where _SUM * |x ^ y| <= _GAP * (|x| + |y|).
_SUM, _GAP = DENOMINATOR + NUMERATOR, DENOMINATOR - NUMERATOR
#: The least set that can link with a different one.
LEAST_SET = -(-NUMERATOR // (DENOMINATOR - NUMERATOR))
PART_BYTES = 1 << 18
#: Postings of a list, and pairs of a pivot, that one salted part is to hold; parts of groups of equal sets.
LIST_PART, PIVOT_PART, COPY_PARTS = 4_000, 1_000, 16
#: Candidates from which a pivot is a hub, and how many times the shingles that a link may have in one set only its candidates' differences may hold.
HUB, WIDE = 32, 3
#: Ids (8 bytes each) up to which the documents to verify are picked by a broadcast; beyond it by a shuffle join.
BROADCAST_IDS = 250_000

_SEEDS = mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_XORS, _FACTORS = _SEEDS[:COORDINATES], _SEEDS[COORDINATES:] | np.uint64(1)


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
            else:
                sets.append(sequence_hash(words.hash[a:b]) if b > a else grams[:0])
        yield lo, sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minima by coordinate, 32 bits each, of sets that aren't empty."""
    flat, at = np.concatenate(sets), np.concatenate(([0], np.cumsum([len(x) for x in sets])))[:-1]
    out, held = np.empty((len(sets), COORDINATES), np.uint32), np.empty_like(flat)
    for k in range(COORDINATES):
        np.bitwise_xor(flat, _XORS[k], out=held)
        np.multiply(held, _FACTORS[k], out=held)
        out[:, k] = np.minimum.reduceat(held, at) >> np.uint64(32)
    return out


_AGREE, _PARITY = [f"c{j}" for j in range(CARRIED)], [f"p{j}" for j in range(PARITIES)]
_CARRIED = _AGREE + _PARITY
_SETS = f"doc long, n int, h1 long, h2 long, signature array<int>, {', '.join(f'{c} long' for c in _CARRIED)}"
_KEY = ["doc", "n", "h1", "h2"]


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").cast(pa.int64())
        for lo, sets in shingle_sets(batch.column("text")):
            n = np.array([len(x) for x in sets], np.int32)
            h1 = np.array([x.sum(dtype=np.uint64) for x in sets], np.uint64)
            h2 = np.array([np.bitwise_xor.reduce(mix(x ^ np.uint64(0x5BD1E995))) if len(x) else 0 for x in sets], np.uint64)
            large, signed = n >= LEAST_SET, np.zeros((len(sets), COORDINATES), np.uint32)
            if large.any():
                signed[large] = signatures([x for x in sets if len(x) >= LEAST_SET])
            carried = {c: np.packbits((signed >> np.uint32(j)).astype(np.uint8) & 1, axis=1, bitorder="little").view("<i8").ravel() for j, c in enumerate(_AGREE)}
            parity = np.stack([np.bincount((x % np.uint64(64 * PARITIES)).astype(np.int64), minlength=64 * PARITIES) & 1 for x in sets]).astype(np.uint8)
            carried |= {c: np.packbits(parity[:, 64 * j : 64 * j + 64], axis=1).view("<i8").ravel() for j, c in enumerate(_PARITY)}
            at = np.concatenate(([0], np.cumsum(large * POSTED))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(signed[large, :POSTED].ravel().view(np.int32)))
            yield pa.record_batch({"doc": ids.slice(lo, len(sets)), "n": n, "h1": h1.view(np.int64), "h2": h2.view(np.int64), "signature": lists, **carried})


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, sets in shingle_sets(batch.column("text")):
            own = [batch.column(c).slice(lo, len(sets)) for c in ("a", "b", "hub", "part")]
            yield pa.RecordBatch.from_arrays([*own, pa.array([x.tobytes() for x in sets], pa.binary())], names=["a", "b", "hub", "part", "shingles"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, linked, apart = [], [], []
        for x, y, hub in zip(batch.column("x"), batch.column("y"), batch.column("hub").to_pylist()):
            x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
            both, single = len(x) + len(y), np.setxor1d(x, y, assume_unique=True)
            sizes.append((len(x), len(y)))
            linked.append(both > 0 and len(single) * _SUM <= both * _GAP)
            apart.append(single.view(np.int64) if hub and len(single) * _SUM <= both * _GAP * WIDE else None)
        na, nb = (pa.array([n[k] for n in sizes], pa.int32()) for k in (0, 1))
        out = pa.record_batch({"a": batch.column("a"), "b": batch.column("b"), "na": na, "nb": nb, "linked": pa.array(linked, pa.bool_()), "apart": pa.array(apart, pa.list_(pa.int64()))})
        yield out.filter(pa.array([one or other is not None for one, other in zip(linked, apart)], pa.bool_()))


def _size_class(n: Column) -> Column:
    """Sets that can link are in the same class or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / float(np.log(DENOMINATOR / NUMERATOR) * 1.0000001)).cast("int")


def _candidates(one: str, other: str, wide: int = 1) -> Column:
    """The length filter, MATCHES or more equal coordinates as far as the carried bits tell, and parities that differ in no more places
    than the sizes allow shingles to be in one set only (``wide`` times as many)."""
    a, b = F.col(f"{one}.n").cast("long"), F.col(f"{other}.n").cast("long")
    apart = lambda c: F.col(f"{one}.{c}").bitwiseXOR(F.col(f"{other}.{c}"))
    differ = functools.reduce(Column.bitwiseOR, map(apart, _AGREE))
    single = sum((F.bit_count(apart(c)) for c in _PARITY), F.lit(0))
    return (F.least(a, b) * DENOMINATOR >= F.greatest(a, b) * NUMERATOR) & (F.bit_count(differ) <= COORDINATES - MATCHES) & (single * _SUM <= (a + b) * (_GAP * wide))


def _parts(rows: Column, each: int) -> Column:
    return F.ceil(rows / F.lit(each)).cast("int")


class MinHashJoin:
    """Finds the links of one table of documents; see the module's text."""

    def __init__(self, docs: DataFrame):
        self.scratch = Scratch(docs.sparkSession, "minhash")
        self.docs = docs.select("doc_id", "text").where("doc_id is not null")

    @staticmethod
    def _hint(ids: DataFrame):
        """Broadcasts a table of ids where it is small, by a count of its rows."""
        return F.broadcast if ids.count() <= BROADCAST_IDS else lambda df: df

    def _copies(self) -> tuple[DataFrame, DataFrame]:
        """Links (a, b) of equal sets, and the sets, each once."""
        groups = self.signed.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc").alias("a"), F.count("*").alias("rows"))
        groups = self.scratch.keep(groups, "groups")
        part = F.explode(F.sequence(F.lit(0), F.lit(COPY_PARTS - 1))).alias("part")
        repeated = groups.where("rows > 1").select("n", "h1", "h2", "a", part)
        copies = self.signed.select(*_KEY, F.pmod(F.xxhash64("doc"), F.lit(COPY_PARTS)).cast("int").alias("part"))
        copies = copies.join(repeated, ["n", "h1", "h2", "part"]).where("doc <> a").select("a", F.col("doc").alias("b"))
        first = groups.where(F.col("n") >= LEAST_SET).select(F.col("a").alias("doc"), "n", "h1", "h2")
        sets = self.signed.join(first, _KEY, "left_semi")
        sets = sets.dropDuplicates(_KEY) if self.repeated else sets
        return self.scratch.keep(copies, "copies"), sets.withColumn("id", F.xxhash64(*_KEY) if self.repeated else F.col("doc"))

    def _prefixes(self, sets: DataFrame) -> DataFrame:
        """(token, document, its weight, size, class and carried bits) for lists that are merged: all but the LEAST_SHARED - 1 longest."""
        posted = sets.select("id", F.posexplode("signature").alias("k", "value"))
        posted = posted.select("id", F.col("k").cast("long").bitwiseOR(F.call_function("shiftleft", F.col("value").cast("long"), F.lit(8))).alias("token"))
        lengths = posted.groupBy("token").agg(F.count("*").alias("length")).where("length > 1")
        lists = posted.join(lengths, "token").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("length", "token"))).alias("lists"), F.sum("length").alias("weight"))  # POSTED at most
        prefix = lists.where(F.size("lists") >= LEAST_SHARED).select("id", "weight", F.explode(F.slice("lists", F.lit(1), F.size("lists") - (LEAST_SHARED - 1))["token"]).alias("token"))
        facts = sets.select("id", "doc", "n", _size_class(F.col("n")).alias("size"), *_CARRIED)
        return prefix.join(facts, "id").drop("id")

    def _with_pivots(self, posts: DataFrame) -> DataFrame:
        """(a, b, hub) of a pivot and a candidate of its lists; hub if a is the one with most candidates, near and WIDE, of b's pivots, HUB at least."""
        near = F.explode(F.array(*(F.col("size") + k for k in (-1, 0, 1)))).alias("size")
        most = F.max(F.struct("weight", (-F.col("doc")).alias("minus"), "n", *_CARRIED))
        pivots = posts.groupBy("token", "size").agg(most.alias("p")).select("token", near, (-F.col("p.minus")).alias("doc"), "p.n", *(f"p.{c}" for c in _CARRIED))
        met = posts.alias("x").join(pivots.alias("p"), ["token", "size"]).where((F.col("x.doc") != F.col("p.doc")) & _candidates("x", "p", WIDE))
        met = met.select(F.col("p.doc").alias("a"), F.col("x.doc").alias("b"), _candidates("x", "p").alias("near"))
        met = self.scratch.keep(met.groupBy("a", "b").agg(F.max("near").alias("near")), "met")
        held = met.join(met.groupBy("a").agg(F.count("*").alias("rows")).where(F.col("rows") >= HUB), "a")
        if self.repeated:  # an id of several sets has no one difference
            several = self.signed.groupBy("doc").count().where("count > 1")
            held = held.join(several, F.col("a") == several["doc"], "left_anti").join(several, F.col("b") == several["doc"], "left_anti")
        held = held.groupBy("b").agg(F.max(F.struct("rows", (-F.col("a")).alias("minus"))).alias("h")).select((-F.col("h.minus")).alias("a"), "b", F.lit(True).alias("hub"))
        return met.join(held, ["a", "b"], "left").where("near or hub").select("a", "b", F.coalesce("hub", F.lit(False)).alias("hub"))

    def _open(self, rows: DataFrame, key: list[str], group: str, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Of lists (``key``) with several groups: the rows outside the largest, each in one part, and all rows in each part; both with the
        largest as ``most``. And the kept table that both read."""
        lists = rows.groupBy(*key, group).agg(F.count("*").alias("k")).groupBy(*key).agg(F.max_by(group, "k").alias("most"), (F.sum("k") - F.max("k")).alias("others"))
        lists = lists.where("others > 0").select(*key, "most", _parts(F.col("others"), LIST_PART).alias("parts"))
        open_ = self.scratch.keep(rows.join(lists, key), name)
        one = open_.where(F.col(group) != F.col("most")).withColumn("part", F.pmod(F.xxhash64("doc"), "parts").cast("int"))
        return one, open_.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))), open_

    def _across(self, posts: DataFrame, component: DataFrame, circles: DataFrame) -> DataFrame:
        """Candidates (a, b) of different components, but for those of one hub."""
        of = component.toDF("node", "component").join(circles.select(F.col("doc").alias("node"), "hub"), "node", "full")
        of = self.scratch.keep(of, "of")
        group = F.struct(F.col("hub").isNull().alias("alone"), F.coalesce("hub", "c").alias("id")).alias("g")
        placed = posts.join(self._hint(of)(of), posts["doc"] == of["node"], "left").select("token", "doc", "n", "size", *_CARRIED, F.coalesce("component", "doc").alias("c"), "hub")
        placed = self.scratch.keep(placed.select("*", group).drop("hub"), "placed")
        one, each, open_ = self._open(placed, ["token"], "g", "open")
        self.scratch.drop(placed, of)
        one = one.withColumn("size", F.explode(F.array(*(F.col("size") + k for k in (-1, 0, 1)))))
        once = (F.col("x.c") != F.col("y.c")) & (F.col("x.g") != F.col("y.g")) & ((F.col("y.g") == F.col("y.most")) | (F.col("x.doc") < F.col("y.doc")))
        met = one.alias("x").join(each.alias("y"), ["token", "size", "part"]).where(once & _candidates("x", "y"))
        out = self.scratch.keep(met.select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b")).distinct(), "across")
        self.scratch.drop(open_)
        return out

    def _within(self, circles: DataFrame, component: DataFrame) -> DataFrame:
        """Links (a, b) of different components among the candidates of one hub, by their differences from it. At least one of the two is far, not
        linked with the hub. With a far one, a set shares ``least`` shingles of its difference or more, and a far one shares with any all but
        as many as a link may have in one set only. Where two meet, what is left of both must suffice."""
        placed = circles.join(self._hint(component)(component), circles["doc"] == component["node"], "left")
        placed = placed.select("hub", "hub_n", "doc", "n", "far", "apart", F.size("apart").alias("d"), F.coalesce("component", "doc").alias("c"))
        both = placed.groupBy("hub").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1").select("hub")
        both = self.scratch.keep(both, "hubs")
        placed = self.scratch.keep(placed.join(self._hint(both)(both), "hub"), "circles")
        items = placed.select("hub", "doc", F.explode("apart").alias("item"))
        often = items.groupBy("hub", "item").agg(F.count("*").alias("rows")).where("rows > 1")
        shared = items.join(often, ["hub", "item"]).groupBy("hub", "doc").agg(F.sort_array(F.collect_list(F.struct("rows", "item"))).alias("shared"))
        least = F.floor((F.col("d") * _SUM + (F.col("hub_n") - F.col("n")) * _GAP) / F.lit(2 * _SUM)) + 1
        alone = F.col("d") - F.size("shared")  # come first, and meet nothing
        short = (F.col("d") - least + 1 - alone).cast("int")
        long = F.least(F.col("d"), F.floor(F.col("n") * _GAP / F.lit(NUMERATOR)) + 1).cast("int") - alone
        posts = placed.drop("apart").join(shared, ["hub", "doc"]).withColumn("short", short).withColumn("long", F.greatest(F.lit(0), "short", F.when(F.col("far"), long)))
        posts = posts.select("hub", "doc", "c", "n", "d", "far", "short", F.size("shared").alias("k"), F.posexplode(F.slice("shared", F.lit(1), F.col("long"))).alias("at", "item"))
        posts = self.scratch.keep(posts.select("hub", "doc", "c", "n", "d", "far", (F.col("at") < F.col("short")).alias("short"), (F.col("k") - F.col("at")).alias("left"), "item.item"), "differences")
        one, each, open_ = self._open(posts, ["hub", "item"], "c", "open")
        x, y = one.alias("x"), each.alias("y")
        once = (F.col("x.c") != F.col("y.c")) & ((F.col("y.c") == F.col("y.most")) | (F.col("x.doc") < F.col("y.doc")))
        prefixes = ~F.col("x.far") | ~F.col("y.far") | (F.col("x.short") & F.col("y.short"))
        sum_ = F.col("x.n") + F.col("y.n")
        common = 2 * F.least("x.left", "y.left")  # twice what is common at most if nothing before the item is, as at the first one that is
        met = x.join(y, ["hub", "item", "part"]).where(once & prefixes & ((F.col("x.d") + F.col("y.d") - common) * _SUM <= sum_ * _GAP))
        met = self.scratch.keep(met.select("hub", F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b")).distinct(), "met")
        x, y = (placed.select("hub", F.col("doc").alias(c), *(F.col(k).alias(k + c) for k in ("n", "d", "apart"))) for c in "ab")
        single = F.col("da") + F.col("db") - 2 * F.size(F.array_intersect("aparta", "apartb"))
        links = self.scratch.keep(met.join(x, ["hub", "a"]).join(y, ["hub", "b"]).where(single * _SUM <= (F.col("na") + F.col("nb")) * _GAP).select("a", "b"), "within")
        self.scratch.drop(both, placed, posts, open_, met)
        return links

    def _links(self, pairs: DataFrame) -> DataFrame:
        """pairs(a, b, hub), a kept table, to (a, b, na, nb, linked, apart) of those that are links, and of those with a hub that aren't far too different, whose
        difference ``apart`` holds. A document's set goes once to each part of its pairs."""
        parts = pairs.groupBy("a").agg(_parts(F.count("*"), PIVOT_PART).alias("parts"))
        dealt = pairs.join(parts, "a").select("a", "b", "hub", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"))
        firsts = parts.select("a", F.lit(None).cast("long").alias("b"), F.lit(False).alias("hub"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        hint, shape = self._hint(pairs), "a long, b long, hub boolean, part int, shingles binary"
        sets = lambda rows, on: self.docs.join(hint(rows), self.docs["doc_id"] == rows[on]).select("a", "b", "hub", "part", "text").mapInArrow(_sets, shape)
        once = (lambda df: df.distinct()) if self.repeated else (lambda df: df)
        x = once(sets(firsts, "a").select("a", "part", F.col("shingles").alias("x")))
        y = once(sets(dealt, "b").select("a", "b", "hub", "part", F.col("shingles").alias("y")))
        shape = "a long, b long, na int, nb int, linked boolean, apart array<long>"
        return self.scratch.keep(x.join(y, ["a", "part"]).select("a", "b", "hub", "x", "y").mapInArrow(_verify, shape), "links")

    def components(self) -> DataFrame:
        """component(node, component) of the documents that are linked with a smaller id; keeps ``signed``."""
        self.signed = self.scratch.keep(self.docs.mapInArrow(_sign, _SETS), "signed")
        self.repeated = not self.signed.groupBy("doc").count().where("count > 1").isEmpty()  # then a set is sent once for all rows of an id
        copies, sets = self._copies()
        posts = self.scratch.keep(self._prefixes(sets), "prefixes")
        pairs = self.scratch.keep(self._with_pivots(posts), "pivots")
        links = self._links(pairs)
        component = self.scratch.keep(connected_components(links.where("linked").select("a", "b").union(copies), self.scratch), "component")
        circles = links.where("apart is not null").select(F.col("a").alias("hub"), F.col("na").alias("hub_n"), F.col("b").alias("doc"), F.col("nb").alias("n"), (~F.col("linked")).alias("far"), "apart")
        done = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        rest = self.scratch.keep(self._across(posts, component, circles).join(done, ["a", "b"], "left_anti").withColumn("hub", F.lit(False)), "rest")
        self.scratch.drop(posts, pairs)
        more = [] if circles.where("far").isEmpty() else [self._within(circles, component)]
        more += [] if rest.isEmpty() else [self._links(rest).select("a", "b")]
        if more:
            edges = functools.reduce(DataFrame.union, more, component.toDF("a", "b"))
            component = self.scratch.keep(connected_components(edges, self.scratch), "component")
        self.scratch.drop(links, copies, rest)
        return component


def near_duplicate_groups(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) to (doc_id, n_shingles, component_id, kept), one row per id and one for each row without."""
    join = MinHashJoin(docs)
    component = join.components()
    sizes = join.signed.groupBy("doc").agg(F.max("n").alias("n"))
    root = F.coalesce("component", "doc")
    out = sizes.join(component, sizes["doc"] == component["node"], "left").select(F.col("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), root.alias("component_id"), (F.col("doc") == root).alias("kept"))
    none = F.lit(None).cast("long")
    return out.union(docs.where("doc_id is null").select(none.alias("doc_id"), none.alias("n_shingles"), none.alias("component_id"), F.lit(True).alias("kept")))
