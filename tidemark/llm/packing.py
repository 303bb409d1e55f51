"""Operator 5: packs token sequences from documents that lie next to each other on a space-filling curve.

Method. A document's hashed bag of words is projected onto four dimensions by a fixed random table; the Hilbert key of the
quantised point, with a few bits of the id's hash below it, orders the corpus. Split points of that order come from
approximate percentiles of all keys (a sketch of bounded size), each range is one task, and a task packs its documents in curve
order, cutting where a sequence is full. What remains at a range's end is cut at powers of two, so nothing is padded.

Scale. Texts are shuffled once and tokenised once, after the shuffle. The number of ranges follows the bytes of text; copies share a
key but for the id's bits, so that a group of copies of any size is dealt over many ranges. A task holds the pieces of one open
sequence, the ids of some PART_BYTES of text or of one document, and a cache of bounded size.

Cases. A null or empty text is its end token alone. Null ids are packed as well. Repeated rows are packed as often as they
occur. Extra columns are ignored. An empty table has no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import shuffle_partitions, small_batches
from tidemark.llm.textops import SPACED_LOWER, Words, mix, utf8_parts
from tidemark.llm.tokens import tokenizer

DIMENSIONS, DIMENSION_BITS, TIE_BITS = 4, 12, 15
#: Slots of the hashed bag of words, and the seed of their random directions.
SLOTS, SEED = 4096, 20240
END_ID, LENGTH = 1, 2048
#: Bytes of text that a range has at most on average, pieces and tokens that leave a task at once.
RANGE_BYTES, BATCH_PIECES, BATCH_TOKENS = 128 << 20, 10_000, 200_000
PART_BYTES = 1 << 18


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of whole-number points (rows), by Skilling's transpose method on all points at once."""
    x = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            t = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ t)
            x[i] = x[i] ^ t if i else x[0]
        q >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (((x[i] ^ t) >> b) & 1)
    return key


def document_points(texts: pa.Array) -> np.ndarray:
    """Each text's projected mean word vector, squashed to whole numbers of DIMENSION_BITS bits."""
    table = np.random.default_rng(SEED).standard_normal((SLOTS, DIMENSIONS)).astype(np.float32)
    parts = [np.zeros((0, DIMENSIONS), np.int64)]
    for _, _, data, offsets in utf8_parts(texts, PART_BYTES):
        words = Words(data, offsets, SPACED_LOWER)
        slots = (words.hash % np.uint64(SLOTS)).astype(np.int64)
        sums = np.zeros((len(words.first), DIMENSIONS))
        for d in range(DIMENSIONS):
            running = np.concatenate(([0.0], np.cumsum(table[slots, d], dtype=np.float64)))
            sums[:, d] = running[words.first]
        mean = np.diff(sums, axis=0) / np.maximum(words.counts(), 1)[:, None]
        parts.append(np.clip((0.5 + 0.5 * np.tanh(4 * mean)) * (1 << DIMENSION_BITS), 0, (1 << DIMENSION_BITS) - 1).astype(np.int64))
    return np.concatenate(parts)


def _keys(texts: pa.Array, ids: pa.Array) -> np.ndarray:
    tie = mix(ids.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) >> np.uint64(64 - TIE_BITS)
    return (hilbert_key(document_points(texts), DIMENSION_BITS) << TIE_BITS) | tie.astype(np.int64)


def curve_key(text: str, doc_id: str):
    """A column: the document's place on the curve."""

    @F.arrow_udf("long")
    def key(texts: pa.Array, ids: pa.Array) -> pa.Array:
        return pa.array(_keys(texts, ids))

    return key(F.col(text), F.col(doc_id))


_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _packer(vocabulary: str, length: int, with_ids: bool):
    fields = [pa.field(x, pa.int64()) for x in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    schema = pa.schema(fields + [pa.field("ids", pa.list_(pa.int32()))] * with_ids)

    def cut(held: list[tuple], first: int) -> Iterator[tuple]:
        """The pieces of an open sequence, again cut where the powers of two of its length end."""
        total, at = sum(len(x[2]) for x in held), 0
        bounds = [0]
        for bit in range(total.bit_length() - 1, -1, -1):
            if total >> bit & 1:
                bounds.append(bounds[-1] + (1 << bit))
        k = 0
        for doc, start, ids, tokens in held:
            done = 0
            while done < len(ids):
                while at >= bounds[k + 1]:
                    k += 1
                take = min(len(ids) - done, bounds[k + 1] - at)
                yield doc, start + done, ids[done : done + take], tokens, first + k, at - bounds[k]
                done, at = done + take, at + take

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [
            pa.array([r[0] for r in rows], pa.int64()),
            *(pa.array(np.array(x, np.int64)) for x in ([r[1] for r in rows], [len(r[2]) for r in rows], [zlib.crc32(r[2].astype("<u4", copy=False)) for r in rows], [r[3] for r in rows], [r[4] for r in rows], [r[5] for r in rows])),
        ]
        if with_ids:
            ends = np.concatenate(([0], np.cumsum([len(r[2]) for r in rows])))
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([r[2] for r in rows]).astype(np.int32))))
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(vocabulary)
        end = np.array([END_ID], np.uint32)
        rows: list[tuple] = []
        held: list[tuple] = []  # the pieces of the sequence that is open
        filled, sequence, owner, tokens_out = 0, 0, None, 0
        for batch in batches:
            ranges, docs = batch.column("range").to_pylist(), batch.column("doc_id").to_pylist()
            for lo, hi, data, offsets in utf8_parts(batch.column("text"), PART_BYTES):
                flat, at_text = encode.many([data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])])
                for k in range(lo, hi):
                    if ranges[k] != owner:
                        rows += cut(held, sequence)
                        owner, held, filled, sequence = ranges[k], [], 0, ranges[k] << 32
                    ids = np.concatenate((flat[at_text[k - lo] : at_text[k - lo + 1]], end))
                    done = 0
                    while done < len(ids):
                        take = min(len(ids) - done, length - filled)
                        held.append((docs[k], done, ids[done : done + take], len(ids)))
                        done, filled = done + take, filled + take
                        if filled == length:
                            at = 0
                            for d, start, x, n in held:
                                rows.append((d, start, x, n, sequence, at))
                                at += len(x)
                            held, filled, sequence = [], 0, sequence + 1
                    tokens_out += len(ids)
                    if rows and (len(rows) >= BATCH_PIECES or tokens_out >= BATCH_TOKENS):
                        yield batch_of(rows)
                        rows, tokens_out = [], 0
        rows += cut(held, sequence)
        if rows:
            yield batch_of(rows)

    return run


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """docs(doc_id, text, ...) to one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and
    the piece's ids if asked for. ``vocabulary`` is a tokenizer file that every executor has; ``length`` a power of two."""
    spark = docs.sparkSession
    text_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ranges = max(shuffle_partitions(spark), -(-text_bytes // RANGE_BYTES))
    shares = [i / ranges for i in range(1, ranges)]
    keys = docs.select(curve_key("text", "doc_id").alias("key")).agg(F.percentile_approx("key", shares or [0.5], max(20_000, 4 * ranges)))
    with small_batches(spark):
        bounds = keys.first()[0] if shares else None
    splits = np.array(sorted(bounds or []), np.int64)

    @F.arrow_udf("struct<range int, key long>")
    def place(texts: pa.Array, ids: pa.Array) -> pa.Array:
        key = _keys(texts, ids)
        return pa.StructArray.from_arrays([pa.array(np.searchsorted(splits, key, "right").astype(np.int32)), pa.array(key)], ["range", "key"])

    placed = docs.select("doc_id", "text", place("text", "doc_id").alias("p")).select("doc_id", "text", "p.range", "p.key")
    dealt = placed.repartitionById(ranges, F.col("range")).sortWithinPartitions("range", "key", "doc_id")
    return dealt.mapInArrow(_packer(vocabulary, length, with_ids), _SCHEMA + ", ids array<int>" * with_ids)
