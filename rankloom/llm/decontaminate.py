"""Benchmark decontamination with suffix arrays over the training texts.

Every task cuts its documents into shards of about a million words and builds a suffix
array of each. Every window of the benchmark items, which are their suffixes cut to the
window's length, is looked up by binary search; the range it finds names all places where
the window occurs, and places that follow one another on the same item make up the longest
verbatim matches. Documents are never moved, and a shard's memory does not grow with the
corpus.

Items are sent to the executors in portions of a checked size; a larger benchmark is
searched portion by portion over all documents, and the results are put together.

Rows: a null or wordless text has no words and is never hit; an item without words, text
or id is no item; an item of fewer words than the window is one window; repeated items
count once per id; repeated documents are each judged. Other columns stay; a column that
has the name of a result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom import cluster
from rankloom.llm.common import column_bytes, with_columns

WINDOW = 10
# Bytes of item texts per portion; their words take several times as much in a worker.
PORTION_BYTES = 16 << 20
# Text per shard: about a million words.
SHARD_BYTES = 6 << 20

# ASCII letters and digits and everything beyond ASCII make words.
_WORD_BYTES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A
                    else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))

FIELDS = T.StructType([
    T.StructField("n_words", T.LongType(), False), T.StructField("n_hit", T.LongType(), False),
    T.StructField("items", T.ArrayType(T.StringType(), False), False),
    T.StructField("matches", T.ArrayType(T.StructType([
        T.StructField("item", T.StringType(), False),
        T.StructField("start", T.LongType(), False),
        T.StructField("length", T.LongType(), False)]), False), False)])


def words_of(data: bytes | None) -> list[bytes]:
    return data.translate(_WORD_BYTES).split() if data else []


class Windows:
    """The distinct windows of a portion of items, as numbers of words."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.window = window
        self.numbers: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[tuple[int, int]]] = {}
        self.names = sorted({name for name, _ in items})
        place = {name: i for i, name in enumerate(self.names)}
        for name, data in items:
            codes = [self.numbers.setdefault(w, len(self.numbers)) for w in words_of(data)]
            size = min(window, len(codes))
            for at in range(len(codes) - size + 1 if codes else 0):
                found.setdefault(tuple(codes[at:at + size]), set()).add((place[name], at))
        keys = list(found)
        self.codes = np.full((len(keys), window), -1, np.int64)
        for i, key in enumerate(keys):
            self.codes[i, :len(key)] = key
        self.length = np.array([len(k) for k in keys], np.int64)
        uses = [sorted(found[k]) for k in keys]
        self.first_use = np.concatenate([[0], np.cumsum([len(u) for u in uses])]).astype(np.int64)
        flat = [x for u in uses for x in u]
        self.item = np.array([x[0] for x in flat], np.int64)
        self.offset = np.array([x[1] for x in flat], np.int64)


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of the next ``depth`` codes, which are positive; 0 ends a text."""
    n = len(codes)
    rank, reach = codes.astype(np.int64), 1
    order = np.arange(n)
    while n:
        bits = max(1, int(rank.max()).bit_length())
        take = max(2, min(63 // bits, -(-depth // reach)))
        key = np.zeros(n, np.int64)
        for i in range(take):
            key <<= bits
            if i * reach < n:
                key[:n - i * reach] |= rank[i * reach:]
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[1], 1 + np.cumsum(ordered[1:] != ordered[:-1])])
        reach *= take
        if reach >= depth or rank[order[-1]] == n:
            break
    return order


def occurrences(codes: np.ndarray, order: np.ndarray, asked: np.ndarray,
                length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The range of ``order`` whose suffixes begin with each row of ``asked``."""
    padded = np.concatenate([codes, np.zeros(asked.shape[1], codes.dtype)])
    span = np.arange(asked.shape[1])
    counts = span[None, :] < length[:, None]

    def bound(upper: bool) -> np.ndarray:
        low, high = np.zeros(len(asked), np.int64), np.full(len(asked), len(order), np.int64)
        while True:
            open_ = np.nonzero(low < high)[0]
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) >> 1
            here = padded[order[middle][:, None] + span]
            differs = (here != asked[open_]) & counts[open_]
            first = differs.argmax(axis=1)
            rows = np.arange(len(open_))
            less = here[rows, first] < asked[open_, first]
            same = ~differs[rows, first]
            right = np.where(same, upper, less)
            low[open_] = np.where(right, middle + 1, low[open_])
            high[open_] = np.where(right, high[open_], middle)

    return bound(False), bound(True)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges that begin at ``starts``."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


class Shard:
    """A run of documents and its suffix array."""

    def __init__(self, texts: list[bytes | None], depth: int):
        self.numbers: dict[bytes, int] = {}
        number, flat, sizes = self.numbers.setdefault, [], []
        for data in texts:
            words = words_of(data)
            sizes.append(len(words))
            flat += [number(w, len(self.numbers) + 1) for w in words]
            flat.append(0)
        self.sizes = np.array(sizes, np.int64)
        self.codes = np.array(flat, np.int64)
        self.starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.order = suffix_array(self.codes, depth)

    def search(self, w: Windows) -> Iterator[tuple[int, int, list]]:
        """Per document: words hit, and the longest matches ``(item, start, length)``."""
        n = len(self.sizes)
        own = np.array([self.numbers.get(word, -1) for word in w.numbers], np.int64)
        asked = np.where(w.codes >= 0, own[w.codes] if len(own) else w.codes, 0)
        known = np.nonzero((asked >= 0).all(axis=1))[0]
        low, high = occurrences(self.codes, self.order, asked[known], w.length[known])
        size = high - low
        places = self.order[_spread(low, size)]
        window = np.repeat(known, size)
        length = w.length[window]

        change = np.zeros(len(self.codes) + 1, np.int64)
        np.add.at(change, places, 1)
        np.add.at(change, places + length, -1)
        hit = (np.cumsum(change[:-1]) > 0).astype(np.int64)
        hits = np.add.reduceat(hit, self.starts) if n else np.zeros(0, np.int64)

        # one row per use of a window by an item; a match goes on where both sides go on
        uses = np.diff(w.first_use)[window]
        use = _spread(w.first_use[window], uses)
        place, item, long = np.repeat(places, uses), w.item[use], np.repeat(length, uses)
        shift = place - w.offset[use]
        by = np.lexsort((place, shift, item))
        place, item, shift, long = place[by], item[by], shift[by], long[by]
        first = np.ones(len(place), bool)
        first[1:] = (item[1:] != item[:-1]) | (shift[1:] != shift[:-1]) | (place[1:] != place[:-1] + 1)
        begins = np.nonzero(first)[0]
        ends = np.append(begins[1:], len(place)) - 1
        start, item = place[begins], item[begins]
        long = place[ends] + long[ends] - start if len(begins) else start
        doc = np.searchsorted(self.starts, start, side="right") - 1
        by = np.lexsort((item, start, doc))
        doc, start, item, long = doc[by], start[by], item[by], long[by]
        edges = np.searchsorted(doc, np.arange(n + 1))
        for i in range(n):
            part = slice(edges[i], edges[i + 1])
            yield int(self.sizes[i]), int(hits[i]), [
                (w.names[a], int(b - self.starts[i]), int(c))
                for a, b, c in zip(item[part], start[part], long[part])]


def _portions(benchmark: DataFrame, item_id: str, text: str) -> list[DataFrame]:
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).filter(
        F.col("item").isNotNull() & F.col("text").isNotNull()).distinct()
    size = items.agg(F.sum(F.octet_length("text") + cluster.ROW_BYTES)).first()[0] or 0
    n = 1 + size // PORTION_BYTES
    # texts of one id may part: what is found is put together by id
    return [items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i) if n > 1 else items
            for i in range(n)]


def _searched(docs: DataFrame, items: DataFrame, text: str, window: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(
        [(r.item, r.text.encode("utf-8")) for r in items.collect()])

    def start():
        asked = Windows(shared.value, window)

        def step(piece):
            found = list(Shard(column_bytes(piece, text), window).search(asked))
            return [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                    pa.array([sorted({m[0] for m in f[2]}) for f in found], pa.list_(pa.string())),
                    pa.array([[dict(zip(("item", "start", "length"), m)) for m in f[2]] for f in found],
                             MATCHES)]
        return step

    return with_columns(docs, text, FIELDS, start, SHARD_BYTES)


MATCHES = pa.list_(pa.struct([("item", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                       item_id: str = "item_id", item_text: str = "text",
                       window: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` and ``matches`` (start and length in words).

    A word is hit when it lies inside an occurrence of any item's window. ``items`` are
    the ids, as text and sorted, of the items that have an occurring window; ``matches``
    their longest verbatim matches, by start.
    """
    portions = _portions(benchmark, item_id, item_text)
    if len(portions) == 1:
        return _searched(docs, portions[0], text, window)
    # the portions' findings are put together by a row key that is written down once
    keyed = cluster.materialise(docs.withColumn("row_key", F.monotonically_increasing_id()))
    found = None
    for items in portions:
        part = _searched(keyed.select("row_key", text), items, text, window).drop(text)
        found = part if found is None else found.unionByName(part)
    matches = F.array_sort(F.flatten(F.collect_list("matches")))
    together = found.groupBy("row_key").agg(F.max("n_words").alias("n_words"), matches.alias("matches"))
    spans = F.transform(F.col("matches"), lambda m: F.struct(m["start"].alias("start"),
                                                             (m["start"] + m["length"]).alias("end")))
    covered = F.aggregate(
        F.array_sort(spans), F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("upto")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("bigint"), s["end"] - F.greatest(s["start"], acc["upto"]))).alias("n"),
            F.greatest(s["end"], acc["upto"]).alias("upto")))["n"]
    result = together.select("row_key", "n_words", covered.alias("n_hit"),
                             F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item"]))).alias("items"),
                             "matches")
    names = {f.name for f in FIELDS}
    return keyed.select(*[c for c in keyed.columns if c not in names]).join(result, "row_key").drop("row_key")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a window of an item."""
    found = find_contamination(docs, benchmark, **options)
    return found.filter(F.col("n_hit") == 0).drop(*(f.name for f in FIELDS))


def items_digest(items: Column) -> Column:
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)
