"""Language-model scoring by deleted interpolation.

The probability of a token mixes the maximum-likelihood estimates of its n-grams of each
length with a uniform share for tokens never seen. The weights depend on how often the
longest context was seen (its frequency bucket); expectation-maximisation learns them on
documents that are set aside, with those documents' own counts deleted.

How it runs. Documents are coded into *blocks* of about a million tokens: numbers, and the
hashes of the block's distinct words. A block sends each distinct n-gram once, with its
counts, to one of many hash ranges; the range adds up the counts of all blocks and answers
every block in the order in which it asked. So a frequent word costs each range one entry
per block, never one per occurrence, and nothing that grows with the corpus is on the driver
or in one task. N-grams are told apart by 48 hash bits inside their range.

Rows: a null or empty text has only its end token; repeated documents count as often as
they occur; ids may be null or repeat, and rows that share an id are scored one by one; extra
columns are left out. Without training documents all counts are 0 and the weights equal.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom import cluster
from rankloom.llm.common import column_bytes, ship, slices

ORDER = 2
# Tokens after which a block is closed, at least and at most; a longer document is a block by itself.
BLOCK_TOKENS, MOST_BLOCK_TOKENS = 1_000_000, 32_000_000
# Tokens of the corpus per hash range, at least.
RANGE_TOKENS = 500_000
# What a block sends to a range is about so many tokens of the block: blocks and ranges grow with
# the square root of the corpus, so that what a block sends does not fall apart into single n-grams.
FRAME_TOKENS = 50
# Bytes of a compressed file per token, for a first guess.
FILE_BYTES_PER_TOKEN = 3
# Context-frequency buckets: powers of two, the last one open.
BUCKETS = 16
# Expectation-maximisation: rounds at most, the change that ends it, the least weight.
ROUNDS, ENOUGH, LEAST = 20, 1e-4, 1e-6

# Hashes kept for the end of a text and for what stands before its first token.
END, START = 1, 2
_MULTIPLY, _FINISH = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One hash of two arrays of hashes; the order of the two matters."""
    x = left * _MULTIPLY + right
    x = (x ^ (x >> np.uint64(29))) * _FINISH
    return x ^ (x >> np.uint64(32))


def pack(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).reshape(-1).view(dtype)


def words_of(data: bytes | None) -> list[bytes]:
    return data.lower().split() if data else []


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def _block_rows(text: str, id_type: pa.DataType, block_tokens: int):
    """Kinds of documents: 0 not trained on, 1 trained on, 2 trained on and set aside."""
    def run(batches):
        part, serial = TaskContext.get().partitionId(), 0
        ids, kinds, sizes, codes, numbers = [], [], [], [], {}
        held = 0

        def out():
            hashes = np.fromiter(map(word_hash, numbers), np.uint64, len(numbers))
            hashes = np.concatenate([np.array([END], np.uint64), hashes])
            flat = np.concatenate(codes) if codes else np.empty(0, np.uint32)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + serial]), pa.array([ids], pa.list_(id_type)),
                 pa.array([pack(np.array(kinds, np.uint8))]), pa.array([pack(np.array(sizes, np.uint32))]),
                 pa.array([pack(flat)]), pa.array([pack(hashes)]), pa.array([len(flat)]),
                 pa.array([int(sum(s for s, k in zip(sizes, kinds) if k))]),
                 pa.array([sum(k > 0 for k in kinds)]),
                 pa.array([int(sum(s for s, k in zip(sizes, kinds) if k == 2))]),
                 pa.array([sum(k == 2 for k in kinds)])],
                names=[f.name for f in BLOCK.fields])

        for batch in batches:
            for piece in slices(batch, text):
                for data, doc_id, kind in zip(column_bytes(piece, text), piece.column(0).to_pylist(),
                                              piece.column(1).to_pylist()):
                    words = words_of(data)
                    number = numbers.setdefault
                    own = [number(w, len(numbers) + 1) for w in words]
                    own.append(0)
                    codes.append(np.array(own, np.uint32))
                    ids.append(doc_id), kinds.append(kind), sizes.append(len(own))
                    held += len(own)
                    if held >= block_tokens:
                        yield out()
                        serial, held = serial + 1, 0
                        ids, kinds, sizes, codes, numbers = [], [], [], [], {}
        if ids:
            yield out()

    return run


BLOCK = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType())),
    T.StructField("kinds", T.BinaryType()), T.StructField("sizes", T.BinaryType()),
    T.StructField("codes", T.BinaryType()), T.StructField("hashes", T.BinaryType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("n_train", T.LongType()),
    T.StructField("n_docs", T.LongType()), T.StructField("n_aside", T.LongType()),
    T.StructField("n_docs_aside", T.LongType())])


def _grams(codes: np.ndarray, hashes: np.ndarray, firsts: np.ndarray, order: int) -> list[np.ndarray]:
    """For each length the hash of the n-gram that ends at each token."""
    words = hashes[codes]
    grams, before = [words], np.array([START], np.uint64)
    for _ in range(order - 1):
        left = np.empty_like(words)
        left[1:] = grams[-1][:-1]
        left[firsts] = before
        grams.append(mix(left, words))
        before = mix(before, np.array([START], np.uint64))
    return grams


def _opened(row: dict, order: int):
    codes, hashes = unpack(row["codes"], np.uint32), unpack(row["hashes"], np.uint64)
    sizes = unpack(row["sizes"], np.uint32).astype(np.int64)
    kinds = np.repeat(unpack(row["kinds"], np.uint8), sizes)
    firsts = np.cumsum(sizes) - sizes
    return codes, sizes, kinds, firsts, _grams(codes, hashes, firsts, order)


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _ask(order: int, bits: int):
    """Each distinct n-gram of a block with its counts, cut into hash ranges."""
    def run(batches):
        shift, drop = np.uint64(64 - bits), np.uint64(bits)
        for row in _rows(batches):
            _, _, kinds, _, grams = _opened(row, order)
            for length, values in enumerate(grams, 1):
                keys, place = np.unique(values, return_inverse=True)
                seen = np.bincount(place, kinds > 0, len(keys)).astype(np.uint32)
                aside = np.bincount(place, kinds == 2, len(keys)).astype(np.uint32)
                ranges = (keys >> shift).astype(np.int64)
                edges = np.searchsorted(ranges, np.arange((1 << bits) + 1))
                small = (keys << drop) >> np.uint64(16)  # 48 bits, still sorted
                used = np.nonzero(np.diff(edges))[0]
                cut = [slice(edges[r], edges[r + 1]) for r in used]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), length, np.int32)), pa.array(used.astype(np.int32)),
                     pa.array(np.full(len(used), row["block"], np.int64)),
                     pa.array([_pack_sorted(small[c]) for c in cut], pa.binary()),
                     pa.array([pack(seen[c]) for c in cut], pa.binary()),
                     pa.array([pack(aside[c]) for c in cut], pa.binary())],
                    names=["length", "range", "block", "keys", "seen", "aside"])

    return run


def _pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def _answer(table: pa.Table) -> pa.Table:
    """Adds up one hash range over all blocks and answers each block in its own order."""
    keys = [np.cumsum(unpack(k, np.uint64)) for k in table.column("keys").to_pylist()]
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    totals = []
    for name in ("seen", "aside"):
        counts = np.concatenate([unpack(c, np.uint32) for c in table.column(name).to_pylist()])
        totals.append(np.bincount(place, counts).astype(np.uint32))
    edges = np.cumsum([0, *map(len, keys)])
    cut = [place[a:b] for a, b in zip(edges[:-1], edges[1:])]
    distinct = np.zeros(len(cut), np.int64)
    distinct[0] = np.count_nonzero(totals[0])
    return pa.table({
        "length": table.column("length"), "range": table.column("range"), "block": table.column("block"),
        "seen": pa.array([pack(totals[0][c]) for c in cut], pa.binary()),
        "aside": pa.array([pack(totals[1][c]) for c in cut], pa.binary()), "distinct": pa.array(distinct)})


ANSWER = "length int, range int, block bigint, seen binary, aside binary, distinct bigint"


@dataclass(frozen=True)
class Totals:
    tokens: int
    docs: int
    aside_tokens: int
    aside_docs: int
    words: int


def _estimates(counts: list[np.ndarray], firsts: np.ndarray, tokens: int, docs: int,
               words: int) -> tuple[np.ndarray, np.ndarray]:
    """Per token the bucket of its longest context, and the estimates from longest to uniform."""
    columns = [np.full(len(counts[0]), 1.0 / (words + 1)), counts[0] / max(tokens, 1)]
    context = np.full(len(counts[0]), tokens, np.int64)
    for shorter, longer in zip(counts[:-1], counts[1:]):
        context = np.empty(len(shorter), np.int64)
        context[1:] = shorter[:-1]
        context[firsts] = docs
        columns.append(longer / np.maximum(context, 1))
    bucket = np.minimum(BUCKETS - 1, np.floor(np.log2(context + 1.0)).astype(np.int64))
    return bucket, np.stack(columns[::-1])


def _resolve(order: int, totals: Totals):
    """Puts the answers in a block's token order; lists the estimates of what was set aside."""
    def run(batches):
        for row in _rows(batches):
            codes, sizes, kinds, firsts, grams = _opened(row, order)
            counts, left = [], []
            for length, values in enumerate(grams, 1):
                answers = sorted((a for a in row["answers"] if a["length"] == length), key=lambda a: a["range"])
                _, place = np.unique(values, return_inverse=True)
                seen, aside = (np.concatenate([unpack(a[n], np.uint32) for a in answers])[place].astype(np.int64)
                               for n in ("seen", "aside"))
                counts.append(seen)
                left.append(seen - aside)
            chosen = kinds == 2
            bucket, shares = _estimates(left, firsts, totals.tokens - totals.aside_tokens,
                                        totals.docs - totals.aside_docs, totals.words)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["ids"]], pa.list_(pa.int64())), pa.array([row["kinds"]], pa.binary()),
                 pa.array([row["sizes"]], pa.binary()),
                 pa.array([[pack(c.astype(np.uint32)) for c in counts]], pa.list_(pa.binary())),
                 pa.array([pack(bucket[chosen].astype(np.uint8))], pa.binary()),
                 pa.array([[pack(s[chosen].astype(np.float32)) for s in shares[:-1]]], pa.list_(pa.binary()))],
                names=["ids", "kinds", "sizes", "counts", "buckets", "shares"])

    return run


RESOLVED = ("ids array<bigint>, kinds binary, sizes binary, counts array<binary>, "
            "buckets binary, shares array<binary>")


def _expect(weights: np.ndarray, uniform: float):
    def run(batches):
        n = weights.shape[0]
        sums = np.zeros((n, BUCKETS))
        for row in _rows(batches):
            bucket = unpack(row["buckets"], np.uint8)
            shares = np.stack([*(unpack(s, np.float32).astype(np.float64) for s in row["shares"]),
                               np.full(len(bucket), uniform)])
            parts = weights[:, bucket] * shares
            parts /= parts.sum(axis=0)
            for k in range(n):
                sums[k] += np.bincount(bucket, parts[k], BUCKETS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(n), BUCKETS).astype(np.int32)),
             pa.array(np.tile(np.arange(BUCKETS), n).astype(np.int32)), pa.array(sums.reshape(-1))],
            names=["part", "bucket", "expected"])

    return run


def learn_weights(resolved: DataFrame, order: int, words: int) -> np.ndarray:
    """Mixture weights per part (longest n-gram first, uniform last) and bucket."""
    weights = np.full((order + 1, BUCKETS), 1.0 / (order + 1))
    for _ in range(ROUNDS):
        rows = (resolved.select("buckets", "shares")
                .mapInArrow(_expect(weights, 1.0 / (words + 1)), "part int, bucket int, expected double")
                .groupBy("part", "bucket").agg(F.sum("expected").alias("expected")).collect())
        expected = np.zeros_like(weights)
        for r in rows:
            expected[r.part, r.bucket] = r.expected
        total = expected.sum(axis=0)
        new = np.where(total > 0, expected / np.where(total > 0, total, 1), weights)
        new = np.maximum(new, LEAST)
        new /= new.sum(axis=0)
        change, weights = float(np.abs(new - weights).max()), new
        if change < ENOUGH:
            break
    return weights


def _score(weights: np.ndarray, totals: Totals):
    def run(batches):
        for row in _rows(batches):
            sizes = unpack(row["sizes"], np.uint32).astype(np.int64)
            kinds = unpack(row["kinds"], np.uint8)
            firsts = np.cumsum(sizes) - sizes
            counts = [unpack(c, np.uint32).astype(np.int64) for c in row["counts"]]
            bucket, shares = _estimates(counts, firsts, totals.tokens, totals.docs, totals.words)
            chance = (weights[:, bucket] * shares).sum(axis=0)
            base = np.log10((counts[0] + 1) / (totals.tokens + totals.words + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(kinds == 0), pa.array(sizes),
                 pa.array(np.add.reduceat((counts[0] > 0).astype(np.int64), firsts)),
                 pa.array(np.full(len(sizes), totals.tokens, np.int64)),
                 pa.array(np.add.reduceat(base, firsts)), pa.array(np.add.reduceat(np.log10(chance), firsts))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


SCORED = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double")


def block_tokens(tokens: int) -> int:
    """Tokens per block for a corpus of about so many."""
    return min(MOST_BLOCK_TOKENS, max(BLOCK_TOKENS, math.isqrt(FRAME_TOKENS * tokens)))


def range_bits(tokens: int, block: int) -> int:
    """Bits of a hash that name its range."""
    return max(4, int(tokens // max(RANGE_TOKENS, FRAME_TOKENS * tokens // block)).bit_length())


def score_documents(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text",
                    order: int = ORDER) -> DataFrame:
    """One row per document: known tokens, the add-one unigram score and the model's, in log10.

    ``held_out`` is a boolean column: such documents are scored and teach nothing. One in
    sixteen of the others, by hash of the id, is set aside to learn the weights from.
    """
    ship(docs)
    spark = docs.sparkSession
    aside = F.pmod(F.xxhash64(F.col(doc_id), F.lit("aside")), F.lit(16)) == 0
    kind = F.when(held_out, 0).when(aside, 2).otherwise(1)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(kind, F.lit(1)).alias("kind"),
                       F.col(text).alias("text"))
    size = block_tokens(cluster.input_bytes(docs) // FILE_BYTES_PER_TOKEN)
    blocks = cluster.materialise(rows.mapInArrow(_block_rows("text", pa.int64(), size), BLOCK), "zstd")
    sums = blocks.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (
        "n_tokens", "n_train", "n_docs", "n_aside", "n_docs_aside"))).first()
    bits = range_bits(sums.n_tokens, size)
    asked = blocks.select("block", "kinds", "sizes", "codes", "hashes").mapInArrow(
        _ask(order, bits), "length int, range int, block bigint, keys binary, seen binary, aside binary")
    answers = cluster.materialise(asked.groupBy("length", "range").applyInArrow(_answer, ANSWER), "zstd")
    words = answers.filter("length = 1").agg(F.sum("distinct")).first()[0] or 0
    totals = Totals(sums.n_train, sums.n_docs, sums.n_aside, sums.n_docs_aside, words)

    # a block gets one answer per range and length: as many bytes as it asked for
    own = answers.groupBy("block").agg(F.collect_list(F.struct("length", "range", "seen", "aside")).alias("answers"))
    joined = blocks.select("block", "ids", "kinds", "sizes", "codes", "hashes").join(own, "block")
    resolved = cluster.materialise(joined.mapInArrow(_resolve(order, totals), RESOLVED), "zstd")
    weights = learn_weights(resolved, order, words)
    return resolved.select("ids", "kinds", "sizes", "counts").mapInArrow(_score(weights, totals), SCORED)
