"""Phrase collocation mining by Rabin-Karp fingerprints.

Texts are lower-cased (A-Z), split at punctuation and line ends into pieces, and those at
blanks and tabs into words. A phrase is a candidate with 2 to ``LONGEST`` words and ``least``
contiguous occurrences in its language. It scores by its weakest cut: twice its count over the
counts of the two parts, in millionths. A candidate inside a longer one that has four fifths of
its count is dropped.

How it runs. One pass codes the texts into *blocks* of about a million words: numbers, and
the block's different words. For every length, numpy prefix polynomials give the fingerprints
of all n-grams of a block (128 bits, mixed with the language); a block sends each different
one once, with its count and a pointer (block and place) to an occurrence, and a shuffle adds
them up. A longer n-gram is sent only if both shorter ones in it may be frequent: a bit
table of at most ``MOST_BITS`` bits, set for the frequent ones, goes to the tasks, and its
false answers only cost rows. So a frequent word costs a row per block, and nothing that grows with the
corpus is on the driver. Only frequent phrases are read back through their pointers. Counts
of parts are joined by fingerprint: those of the most frequent parts, which are few by
definition, are broadcast, and the others cannot be parts of many candidates.

Fingerprints that collide would add up counts of different texts. So the phrases of the result
and their parts are counted once more by their words, exactly, over all blocks; where a count
differs, all is done again with other fingerprints.

Rows: a null or empty text has no words; a null language is ``und``; ids are not used, and a
repeated row counts again; equal scores go by count, then by the bytes of the phrase; an empty
table gives an empty result. Other columns are left out.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom import cluster
from rankloom.llm.common import column_bytes, ship, slices
from rankloom.llm.lm import pack, unpack

LONGEST = 4
LEAST, TOP = 30, 2_000
# A candidate goes if a longer one around it has so many hundredths of its count.
COVERED = 80
BLOCK_WORDS = 1_000_000
# Bits for every frequent n-gram, and in a table at most.
BITS_EACH, MOST_BITS = 8, 28
# A part with this share of all words is broadcast with its count.
HEAVY = 10_000
# Parts in which a language's best phrases are looked for first.
TOP_PARTS = 64
# Phrases that are counted again in one pass.
RECOUNTED = 50_000

# What ends a piece.
ENDS = b".,;:!?\n\x0b\x0c\r"
_TO_SIGNS = bytes.maketrans(ENDS + b"\t", b"\n" * len(ENDS) + b" ")
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_FINISH = np.uint64(0xBF58476D1CE4E5B9)

BLOCK = ("block bigint, langs array<string>, lang_words array<bigint>, doc_langs binary, sizes binary, "
         "words binary, codes binary")


def _blocks(text: str, lang: str):
    """Numbers of words from 1 on, 0 after every piece and text."""
    def run(batches):
        part, serial = TaskContext.get().partitionId() << 32, 0
        numbers, langs, doc_langs, sizes, codes = {b"": 0, b"\n": 1}, {}, [], [], []
        held = 0

        def out():
            flat = np.concatenate(codes)
            sized, of = np.array(sizes, np.uint32), np.array(doc_langs, np.uint32)
            words = np.bincount(np.repeat(of, sized), flat > 0, len(langs)).astype(np.int64)
            joined = zstandard.ZstdCompressor(level=1).compress(b"\n".join(list(numbers)[2:]))
            return pa.RecordBatch.from_arrays(
                [pa.array([part + serial]), pa.array([list(langs)], pa.list_(pa.string())),
                 pa.array([words.tolist()], pa.list_(pa.int64())), pa.array([pack(of)], pa.binary()),
                 pa.array([pack(sized)], pa.binary()), pa.array([joined], pa.binary()), pa.array([pack(flat)], pa.binary())],
                names=["block", "langs", "lang_words", "doc_langs", "sizes", "words", "codes"])

        for batch in batches:
            for piece in slices(batch, text):
                for data, name in zip(column_bytes(piece, text), piece.column(1).to_pylist()):
                    if not data:
                        continue
                    signs = data.lower().translate(_TO_SIGNS).replace(b"\n", b" \n ").split(b" ")
                    own = np.array([numbers.setdefault(w, len(numbers)) for w in signs] + [1], np.uint32)
                    own = own[own > 0] - np.uint32(1)  # without the nothing between two blanks
                    codes.append(own), sizes.append(len(own))
                    doc_langs.append(langs.setdefault(name, len(langs)))
                    held += len(own)
                    if held >= BLOCK_WORDS:
                        yield out()
                        serial, held = serial + 1, 0
                        numbers, langs, doc_langs, sizes, codes = {b"": 0, b"\n": 1}, {}, [], [], []
        if codes:
            yield out()

    return run


def _inverse(base: np.uint64) -> np.uint64:
    """The number that gives 1 with an odd ``base``, modulo 2^64."""
    return np.uint64(pow(int(base), -1, 1 << 64))


class Block:
    """A block's words and the fingerprints of its n-grams."""

    def __init__(self, row: dict, seed: int):
        self.number, self.langs = row["block"], row["langs"]
        self.codes = unpack(row["codes"], np.uint32).astype(np.int32)
        joined = zstandard.ZstdDecompressor().decompress(row["words"])
        self.words = joined.split(b"\n") if joined else []
        self.lang_of = np.repeat(unpack(row["doc_langs"], np.uint32).astype(np.int32),
                                 unpack(row["sizes"], np.uint32).astype(np.int64))
        self.breaks = np.concatenate([[0], np.cumsum(self.codes == 0, dtype=np.int32)])
        digests = b"".join(xxhash.xxh3_128_digest(w, seed) for w in [b"", *self.words])
        self.hashes = np.frombuffer(digests, np.uint64).reshape(-1, 2)
        self.names = np.array([xxhash.xxh3_64_intdigest(name, seed) for name in self.langs], np.uint64)
        self.side = None

    def _prefixes(self, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Prefix polynomials of the words, and what takes their powers back; of one side at a time."""
        if self.side is None or self.side[0] != side:
            n, base = len(self.codes), _BASES[side]
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(self.hashes[self.codes, side] * np.cumprod(np.full(n, base)), out=sums[1:])
            self.side = side, sums, np.cumprod(np.full(n, _inverse(base)))
        return self.side[1:]

    def whole(self, n: int) -> np.ndarray:
        """Where ``n`` words in a row stand, in one piece."""
        if len(self.codes) < n:
            return np.empty(0, bool)
        return self.breaks[n:] == self.breaks[:-n]

    def keys(self, n: int, side: int, at: np.ndarray) -> np.ndarray:
        """One half of the fingerprints of the n-grams at some places."""
        sums, back = self._prefixes(side)
        x = sums[at + n]
        x -= sums[at]
        x *= back[at]
        if len(at):
            x += self.names[self.lang_of[at]]
        x += np.uint64(n)
        x *= _FINISH
        out = x >> np.uint64(31)
        out ^= x
        out *= _BASES[0]
        x >>= np.uint64(29)
        out ^= x
        return out.view(np.int64)


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1)


def _grams(n: int, seed: int, frequent):
    """Each different n-gram of a block whose shorter ones may be frequent."""
    def run(batches):
        for row in _rows(batches):
            block = Block(row.to_pylist()[0], seed)
            kept = block.whole(n)
            if frequent is not None:
                maybe = frequent.value.has(block.keys(n - 1, 0, np.arange(max(0, len(block.codes) - n + 2), dtype=np.int32)))
                kept = kept & maybe[:-1] & maybe[1:]
            at = np.nonzero(kept)[0].astype(np.int32)
            key, check = block.keys(n, 0, at), block.keys(n, 1, at)
            order = np.argsort(key)
            key, check, at = key[order], check[order], at[order]
            # a key between two checks gives two rows more, which are added up like others
            first = np.nonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (check[1:] != check[:-1])]))[0] if len(at) else at
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[first]), pa.array(check[first]), pa.array(np.diff(np.append(first, len(at))).astype(np.int64)),
                 pa.array(np.full(len(first), block.number, np.int64)), pa.array(at[first])],
                names=["key", "check", "n", "block", "at"])

    return run


class Bits:
    """A set of keys that may also hold others."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.shift = words, np.uint64(64 - bits)

    @staticmethod
    def of(keys: DataFrame, count: int) -> Bits:
        bits = min(MOST_BITS, max(12, (BITS_EACH * count - 1).bit_length()))
        bit = F.shiftrightunsigned("key", 64 - bits)
        rows = keys.select(F.shiftright(bit, 6).cast("int").alias("word"), (bit % 64).cast("int").alias("bit")).groupBy("word").agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))).alias("bits")).toArrow()
        words = np.zeros(1 << (bits - 6), np.uint64)
        words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
        return Bits(words, bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        bit = keys.view(np.uint64) >> self.shift
        return (self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)) > 0


PHRASE = "lang string, length int, key bigint, `check` bigint, a bigint, phrase string, keys array<bigint>, checks array<bigint>"


def _part_places(n: int) -> list[tuple[int, int]]:
    """``(offset, words)`` of the parts of ``n`` words: left and right of each cut, then what is left."""
    cuts = [part for k in range(1, n) for part in ((0, k), (k, n - k))]
    return cuts + [(i, m) for m in range(2, n) for i in range(1, n - m)]


def _read_back(seed: int):
    """Texts of the wanted phrases of a block, and the fingerprints of their parts."""
    def run(batches):
        for row in _rows(batches):
            wanted = row.column(row.schema.get_field_index("wanted")).flatten()
            block = Block(row.drop_columns(["wanted"]).to_pylist()[0], seed)
            length, place = (pc.struct_field(wanted, c).to_numpy() for c in ("length", "at"))
            for n in np.unique(length):
                pick = np.nonzero(length == n)[0]
                at = place[pick]
                codes = np.stack([block.codes[at + j] for j in range(n)], axis=1).tolist()
                parts = [[block.keys(m, side, at + i) for i, m in _part_places(n)] for side in (0, 1)]
                lists = [pa.ListArray.from_arrays(np.arange(0, len(p) * len(at) + 1, len(p), dtype=np.int32),
                                                  np.stack(p, axis=1).reshape(-1)) for p in parts]
                own = wanted.take(pa.array(pick))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.langs[i] for i in block.lang_of[at].tolist()], pa.string()), pa.array(np.full(len(at), n, np.int32)),
                     *(pc.struct_field(own, c) for c in ("key", "check", "f")),
                     pa.array([b" ".join([block.words[c - 1] for c in cs]) for cs in codes], pa.binary()).cast(pa.string()), *lists],
                    names=["lang", "length", "key", "check", "a", "phrase", "keys", "checks"])

    return run


def _recount(phrases):
    """Occurrences of given phrases in a block, word by word."""
    def run(batches):
        given = phrases.value  # (lang, words) -> number
        for row in _rows(batches):
            block = Block(row.to_pylist()[0], 0)
            code = {w: i + 1 for i, w in enumerate(block.words)}
            lang = {name: i for i, name in enumerate(block.langs)}
            wide, states = len(code) + 1, len(lang)
            edges, ends = {}, {}
            for (name, words), number in given.items():
                state = lang.get(name)
                path = [code.get(w) for w in words]
                if state is None or None in path:
                    continue
                for c in path:
                    after = edges.get(state * wide + c)
                    if after is None:
                        after = edges[state * wide + c] = states
                        states += 1
                    state = after
                ends[state] = number
            steps = np.array(sorted(edges), np.int64)
            targets = np.array([edges[s] for s in steps.tolist()], np.int64)
            at, state = np.arange(len(block.codes)), block.lang_of
            seen = np.zeros(states, np.int64)
            while len(at) and len(steps):
                step = state * wide + block.codes[at]
                place = np.minimum(np.searchsorted(steps, step), len(steps) - 1)
                known = steps[place] == step
                at, state = at[known] + 1, targets[place[known]]
                seen += np.bincount(state, minlength=states)
                inside = at < len(block.codes)
                at, state = at[inside], state[inside]
            found = [(number, int(seen[s])) for s, number in ends.items() if seen[s]]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int32()), pa.array([x for _, x in found], pa.int64())],
                                             names=["number", "n"])

    return run


def frequent_grams(blocks: DataFrame, least: int, longest: int, seed: int) -> list[DataFrame]:
    """For each length the fingerprints with ``least`` occurrences, their counts and a pointer each."""
    spark = blocks.sparkSession
    out, bits = [], None
    for n in range(1, longest + 1):
        counted = blocks.mapInArrow(_grams(n, seed, bits), "key bigint, `check` bigint, n bigint, block bigint, at int")
        # both firsts are of the same row
        table = cluster.materialise(counted.groupBy("key", "check").agg(
            F.sum("n").alias("f"), F.first("block").alias("block"), F.first("at").alias("at")).filter(F.col("f") >= least))
        out.append(table.withColumn("length", F.lit(n)))
        if n < longest:
            bits = spark.sparkContext.broadcast(Bits.of(table, table.count()))
    return out


def _score(k: int, n: Column) -> Column:
    """The score of the cut after ``k`` words; the product may pass 64 bits."""
    total = F.col(f"l{k}") + F.col(f"r{k}")
    return F.when(n > k, F.call_function("div", F.col("a").cast("decimal(20,0)") * F.lit(2_000_000).cast("decimal(7,0)"), total.cast("decimal(20,0)")))


def _mine(blocks: DataFrame, least: int, top: int, longest: int, seed: int) -> DataFrame:
    levels = frequent_grams(blocks, least, longest, seed)
    together = levels[0]
    for level in levels[1:]:
        together = together.unionByName(level)
    candidates = together.filter("length > 1")
    wanted = candidates.groupBy("block").agg(F.collect_list(F.struct("length", "at", "key", "check", "f")).alias("wanted"))
    small = candidates.count() * cluster.ROW_BYTES <= cluster.BROADCAST_BYTES
    texts = cluster.materialise(blocks.join(F.broadcast(wanted) if small else wanted, "block").mapInArrow(_read_back(seed), PHRASE))

    # inside a longer one
    part = F.explode(F.arrays_zip("keys", "checks"))
    inner = {n: [j for j, (_, m) in enumerate(_part_places(n)) if m > 1] for n in range(3, longest + 1)}
    long = None
    for n, places in inner.items():
        pairs = F.explode(F.array(*(F.struct(F.col("keys")[j].alias("key"), F.col("checks")[j].alias("check")) for j in places)))
        rows = texts.filter(F.col("length") == n).select("a", pairs.alias("part")).select("part.key", "part.check", "a")
        long = rows if long is None else long.unionByName(rows)
    kept = texts
    if long is not None:
        around = long.groupBy("key", "check").agg(F.max("a").alias("around"))
        kept = texts.join(around, ["key", "check"], "left").filter(
            F.col("around").isNull() | (100 * F.col("around") < COVERED * F.col("a"))).drop("around")

    # counts of the parts; a heavy part may be in many phrases, any other in few
    cut = F.posexplode(F.slice(F.arrays_zip("keys", "checks"), F.lit(1), 2 * (F.col("length") - 1)))
    cuts = kept.select("lang", "length", "key", "check", "a", cut.alias("j", "part")).select(
        "lang", "length", "key", "check", "a", "j", F.col("part.keys").alias("part_key"), F.col("part.checks").alias("part_check"))
    counts = together.filter(F.col("length") < longest).select(
        F.col("key").alias("part_key"), F.col("check").alias("part_check"), "f")
    words = blocks.agg(F.sum(F.aggregate("lang_words", F.lit(0).cast("bigint"), lambda s, x: s + x))).first()[0] or 0
    heavy = F.col("f") * HEAVY >= words
    on = ["part_key", "part_check"]
    tried = cuts.join(F.broadcast(counts.filter(heavy)), on, "left")
    known = tried.filter("f IS NOT NULL").unionByName(tried.filter("f IS NULL").drop("f").join(counts.filter(~heavy), on))
    sides = [F.max(F.when(F.col("j") == 2 * (k - 1) + s, F.col("f"))).alias(f"{'lr'[s]}{k}") for k in range(1, longest) for s in (0, 1)]
    cut_counts = known.groupBy("lang", "length", "key", "check", "a").agg(*sides)
    scored = cut_counts.withColumn("score", F.array_min(F.array(*(_score(k, F.col("length")) for k in range(1, longest)))))

    def weakest(of) -> Column:
        """``of(k)`` of the first cut with the score."""
        return F.coalesce(*(F.when(_score(k, F.col("length")) == F.col("score"), of(k)) for k in range(1, longest)))

    # the best of a language's parts first, so that no task gets a share of all its phrases
    parts = scored.withColumn("part", F.pmod("key", F.lit(TOP_PARTS)))
    for by in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"))
        parts = parts.withColumn("place", F.rank().over(order)).filter(F.col("place") <= top)
    best = parts.select(
        "lang", "key", "check", "a", weakest(lambda k: F.col(f"l{k}")).alias("l"), weakest(lambda k: F.col(f"r{k}")).alias("r"),
        weakest(F.lit).alias("cut"), "score")
    named = best.join(texts.select("key", "check", "phrase"), ["key", "check"])
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    sizes = blocks.select(F.explode(F.arrays_zip("langs", "lang_words")).alias("x")).groupBy(F.col("x.langs").alias("lang")).agg(
        F.sum("x.lang_words").alias("n"))
    return named.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top).join(sizes, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")


def _differs(blocks: DataFrame, result: DataFrame) -> bool:
    """Whether a count of ``result`` is not what the words of the texts give."""
    spark = blocks.sparkSession
    turns = -(-result.count() // RECOUNTED)
    for turn in range(turns):
        claimed = {}
        for r in result.filter(F.pmod(F.xxhash64("lang", "rank"), F.lit(turns)) == turn).collect():
            words = tuple(r.phrase.encode().split(b" "))
            claimed |= {(r.lang, words): r.a, (r.lang, words[:r.cut]): r.l, (r.lang, words[r.cut:]): r.r}
        given = spark.sparkContext.broadcast({key: i for i, key in enumerate(claimed)})
        seen = {r.number: r.n for r in blocks.mapInArrow(_recount(given), "number int, n bigint").groupBy("number").agg(
            F.sum("n").alias("n")).collect()}
        if any(seen.get(i) != n for i, n in enumerate(claimed.values())):
            return True
    return False


def mine_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP,
                 longest: int = LONGEST) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score, cut)`` of the best phrases of every language.

    ``a`` counts the phrase, ``l`` and ``r`` its parts at the weakest ``cut`` (words before it),
    ``n`` the words of the language.
    """
    ship(docs)
    rows = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    blocks = cluster.materialise(rows.mapInArrow(_blocks("text", "lang"), BLOCK), "zstd")
    for seed in itertools.count():
        result = cluster.materialise(_mine(blocks, least, top, longest, seed))
        if not _differs(blocks, result):
            return result
