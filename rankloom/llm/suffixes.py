"""Repeated passages by sparse suffix arrays.

Of every text only the suffixes at minimiser positions are kept: a word position is one
when the hash of the ``GRAM`` words from it is the least in some window of ``WINDOW``
positions. The content alone selects them, so two texts that share ``min_words`` words keep
a common position inside. A suffix carries the words around its position, as far as a
match of ``min_words`` through it can reach to either side.

Suffixes are sorted twice over the whole corpus, by range partitioning: by the words from
the position on, and by the words before it read backwards. Neighbours that share the
gram are compared: the match is extended to the right and to the left, and one of
``min_words`` or more marks those words in both texts. No match goes further to either side
than the best neighbour on that side does. Where that leaves open whether a match reaches
beyond what is marked, all windows of ``min_words`` within those reaches are compared by their
hashes, so that every word of a repeated window is marked. Equal surroundings are one suffix
from the start, with a count, so copies cost one row; a common line is split over tasks by
what surrounds it, and the places of a common passage are dealt over tasks by their number.

Rows: a null text counts as empty; texts with fewer than ``min_words`` words have no repeated
passage; a passage repeated inside one text counts only if another text has it too, or if
``within`` is set; rows that share an id count as different texts; a row without an id is
reported without one. Extra columns are left out.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom import cluster
from rankloom.llm.common import column_bytes, ship, slices
from rankloom.llm.lm import mix

MIN_WORDS = 51
GRAM = 8
SORTED_ROWS = 50_000
# Tasks of a sort at most.
MOST_PARTS = 100_000
# Rows of one key from which on they are dealt over several tasks; no more keys than this are.
SPLIT_ROWS, MOST_SPLIT = 20_000, 100_000


def word_codes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash per word of all texts (lower case, without blanks), and the words per text."""
    numbers: dict[bytes, int] = {}
    flat, sizes = [], []
    for data in texts:
        words = data.lower().split() if data else []
        sizes.append(len(words))
        flat += [numbers.setdefault(w, len(numbers)) for w in words]
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in numbers), np.uint64, len(numbers))
    return (hashes[np.array(flat, np.int64)] if flat else hashes), np.array(sizes, np.int64)


def rolled(words: np.ndarray, size: int) -> np.ndarray:
    out = words
    for k in range(1, size):
        out = mix(out[:-1], words[k:]) if len(out) > 1 else out[:0]
    return out


def minimisers(grams: np.ndarray, window: int) -> np.ndarray:
    """Places that are the least, rightmost of equals, of some window; all windows if there are fewer."""
    n = len(grams)
    if not n:
        return np.empty(0, np.int64)
    if n <= window:
        return np.array([n - 1 - int(np.argmin(grams[::-1]))])
    least, place = grams.copy(), np.arange(n)
    reach = 1
    while reach < window:  # the least of twice as many, or of what is missing
        step = min(reach, window - reach)
        m = len(least) - step
        take = least[step:] <= least[:m]
        least, place = np.where(take, least[step:], least[:m]), np.where(take, place[step:], place[:m])
        reach += step
    return np.unique(place)


def _codes32(words: np.ndarray) -> np.ndarray:
    """The half of a word's hash that is compared; 0 is kept for what lies outside a text."""
    return np.maximum((words >> np.uint64(32)).astype(np.uint32), 1)


def _around(words: np.ndarray, places: np.ndarray, gram: int, reach: int) -> tuple[np.ndarray, ...]:
    """Words after the gram, words before it backwards, and how many of each there are."""
    n = len(words)
    codes = np.concatenate([np.zeros(reach, np.uint32), _codes32(words), np.zeros(reach + gram, np.uint32)])
    span = np.arange(reach)
    after = codes[reach + places[:, None] + gram + span]
    before = codes[reach + places[:, None] - 1 - span]
    return after, before, np.minimum(n - gram - places, reach), np.minimum(places, reach)


def _digests(after: np.ndarray, before: np.ndarray) -> np.ndarray:
    joined = np.ascontiguousarray(np.concatenate([after, before], axis=1))
    return np.fromiter((xxhash.xxh3_64_intdigest(row.tobytes()) for row in joined), np.uint64,
                       len(joined)).view(np.int64)


class Sparse:
    """The suffixes of one text at its minimisers."""

    def __init__(self, words: np.ndarray, min_words: int, gram: int):
        grams = rolled(words, gram)
        self.places = minimisers(grams, min_words - gram + 1) if len(words) >= min_words else np.empty(0, np.int64)
        self.grams = grams[self.places].view(np.int64)
        self.after, self.before, self.n_after, self.n_before = _around(words, self.places, gram, min_words - gram)
        self.digests = _digests(self.after, self.before)


def _texts(piece: pa.RecordBatch, column: str):
    words, sizes = word_codes(column_bytes(piece, column))
    ends = np.cumsum(sizes)
    return [words[b - n:b] for n, b in zip(sizes, ends)]


def _suffixes(min_words: int, gram: int):
    """One row per retained suffix; a text gets a number of its own."""
    def run(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for piece in slices(batch, "text"):
                ids = piece.column(0).to_pylist()
                for doc_id, words in zip(ids, _texts(piece, "text")):
                    row += 1
                    s = Sparse(words, min_words, gram)
                    if n := len(s.places):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([doc_id] * n, pa.int64()), pa.array(np.full(n, row)), pa.array(s.places.astype(np.int32)),
                             pa.array(s.grams), pa.array(s.digests), pa.array(s.n_after.astype(np.int32)),
                             pa.array(s.n_before.astype(np.int32))],
                            names=["doc_id", "row", "place", "gram", "digest", "n_after", "n_before"])

    return run


SUFFIX = "doc_id bigint, row bigint, place int, gram bigint, digest bigint, n_after int, n_before int"


def _surroundings(min_words: int, gram: int):
    """The words around the asked suffixes of a text."""
    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                for words, asked in zip(_texts(piece, "text"), piece.column(1).to_pylist()):
                    s = Sparse(words, min_words, gram)
                    place = {int(p): i for i, p in enumerate(s.places)}
                    # rows that share an id may have other texts
                    at = {(a["gram"], a["digest"]): place[a["place"]] for a in asked if a["place"] in place
                          and s.digests[place[a["place"]]] == a["digest"]}
                    pick = np.array(list(at.values()), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k[0] for k in at], pa.int64()), pa.array([k[1] for k in at], pa.int64()),
                         pa.array([r.astype(">u4").tobytes() for r in s.after[pick]], pa.binary()),
                         pa.array([r.astype(">u4").tobytes() for r in s.before[pick]], pa.binary())],
                        names=["gram", "digest", "after", "before"])

    return run


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal words from the front, row by row; what lies outside a text is equal to nothing."""
    differs = (a != b) | (a == 0)
    return np.where(differs.any(axis=1), differs.argmax(axis=1), a.shape[1])


def _differing(group: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of each row with the nearest rows before and after it in its group that have
    another owner."""
    n = len(owner)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begins = np.nonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (group[1:] != group[:-1])]))[0]
    run = np.searchsorted(begins, np.arange(n), side="right") - 1
    before, after = begins[run] - 1, np.append(begins, n)[run + 1]
    own = np.concatenate([np.arange(n), np.arange(n)])
    other = np.concatenate([before, after])
    inside = (other >= 0) & (other < n)
    own, other = own[inside], other[inside]
    same = group[own] == group[other]
    return own[same], other[same]


def _neighbours(min_words: int, gram: int, ends: bool):
    """Compares each suffix of a sorted task with its neighbours from other texts."""
    names = ["side", "gram", "digest", "first", "second", "doc", "owner", "other", "reach", "left", "right", "other_doc"]

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        side, key, digest, doc, owner = (t.column(i).to_numpy() for i in (0, 1, 2, 5, 6))
        first, second = (np.frombuffer(b"".join(t.column(i).to_pylist()), ">u4").reshape(t.num_rows, -1) for i in (3, 4))
        group = np.cumsum(np.concatenate([[0], (side[1:] != side[:-1]) | (key[1:] != key[:-1])]))
        own, other = _differing(group, owner)
        for at in range(0, len(own), 20_000):
            i, j = own[at:at + 20_000], other[at:at + 20_000]
            a, b = _common(first[i], first[j]), _common(second[i], second[j])
            forward = side[i] == 0
            right, left = np.where(forward, a, b) + gram, np.where(forward, b, a)
            found = left + right >= min_words
            none = pa.nulls(len(i), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(side[i]), pa.array(key[i]), pa.array(digest[i]), none, none, pa.array(doc[i]), pa.array(owner[i]),
                 pa.array(digest[j]), pa.array(a.astype(np.int32)), pa.array(np.where(found, left, -1).astype(np.int32)),
                 pa.array(np.where(found, right, -1).astype(np.int32)), pa.array(doc[j])], names=names)
        if ends:  # what neighbours in other tasks' ranges are compared with
            last = t.num_rows - 1
            new = np.concatenate([[0], np.cumsum((owner[1:] != owner[:-1]) | (group[1:] != group[:-1]))])
            # the rows that no other text separates from the end, and the next ones beyond
            near = np.nonzero((new == 0) | (new == new[last]))[0]
            near = np.unique(np.concatenate([near, other[own == 0], other[own == last]]))
            rows = t.take(pa.array(near))
            empty = [pa.nulls(len(near), k) for k in (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*rows.columns, *empty], names=names)

    return run


NEIGHBOUR = ("side int, gram bigint, digest bigint, first binary, second binary, doc bigint, owner bigint, other bigint, "
             "reach int, left int, right int, other_doc bigint")


def _windows(min_words: int, gram: int):
    """Hashes of the windows through a suffix that a longer match could fill."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                before, after = (np.frombuffer(row[c], ">u4").astype(np.uint64) for c in ("before", "after"))
                lefts = range(max(0, min_words - row["max_right"]), min(row["max_left"], min_words - gram) + 1)
                keys = [xxhash.xxh3_64_intdigest(before[:a].tobytes() + b"|" + after[:min_words - gram - a].tobytes())
                        for a in lefts]
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["gram"]] * n, pa.int64()), pa.array([row["digest"]] * n, pa.int64()),
                     pa.array([row["doc"]] * n, pa.int64()), pa.array([row["owner"]] * n, pa.int64()),
                     pa.array(list(lefts), pa.int32()), pa.array(np.array(keys, np.uint64).view(np.int64))],
                    names=["gram", "digest", "doc", "owner", "left", "key"])

    return run


def _sorted_neighbours(rows: DataFrame, count: int, min_words: int, gram: int) -> DataFrame:
    """The compared neighbours of all rows: ranges first, then what their ends cut apart, which
    are few rows per range and sorted again in ranges as long as they are many."""
    order = ["side", "gram", "first", "digest"]
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts, met = min(MOST_PARTS, max(least, -(-count // SORTED_ROWS))), []
    while True:
        ranges = rows.coalesce(1) if parts == 1 else rows.repartitionByRange(parts, *order)
        found = cluster.materialise(ranges.sortWithinPartitions(*order).mapInArrow(
            _neighbours(min_words, gram, parts > 1), NEIGHBOUR))
        met.append(found.filter("other IS NOT NULL"))
        if parts == 1:
            return reduce(DataFrame.unionByName, met)
        rows = found.filter("other IS NULL").select("side", "gram", "digest", "first", "second", "doc", "owner")
        parts = max(1, min(parts // 2, -(-rows.count() // SORTED_ROWS)))


def _dealt(rows: DataFrame, many: DataFrame, by: list[str], side: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` joined with ``side``, which has each key once; ``many(key, pieces)`` names the keys
    whose rows are dealt over several tasks."""
    piece = F.coalesce(F.pmod(F.xxhash64(*by), F.col("pieces")), F.lit(0)).cast("int")
    dealt = rows.join(F.broadcast(many), key, "left").withColumn("piece", piece).drop("pieces")
    last = F.coalesce(F.col("pieces"), F.lit(1)).cast("int") - 1
    copies = side.join(F.broadcast(many), key, "left").withColumn("piece", F.explode(F.sequence(F.lit(0), last))).drop("pieces")
    return dealt.join(copies, [*key, "piece"]).drop("piece")


def _many(counted: DataFrame, key: list[str]) -> DataFrame:
    """``(key, pieces)`` of the keys of ``counted(key, n)`` with very many rows; a bounded number."""
    total = counted.agg(F.sum("n")).first()[0] or 0
    step = max(SPLIT_ROWS, -(-total // MOST_SPLIT))
    return counted.filter(F.col("n") >= step).select(*key, F.expr(f"1 + n div {step}").alias("pieces"))


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
                      gram: int = GRAM, within: bool = False) -> DataFrame:
    """``(doc_id, start, end, n_words, first_doc_id)``: the stretches of words that occur elsewhere.

    ``start`` and ``end`` count words from 0, the end exclusive. Stretches that touch or
    overlap are one. ``first_doc_id`` is the least id met among texts with part of it.
    """
    ship(docs)
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    suffixes = cluster.materialise(source.mapInArrow(_suffixes(min_words, gram), SUFFIX))
    key = ["gram", "digest"]
    # suffixes of one text only are owned by it, others by nobody but themselves
    alone = F.lit(False) if within else F.min("row") == F.max("row")
    classes = cluster.materialise(suffixes.groupBy(*key).agg(
        F.min("doc_id").alias("doc"), F.min_by("place", "doc_id").alias("place"), F.count("*").alias("n"),
        F.when(alone, F.min("row")).otherwise(-1 - F.pmod(F.xxhash64(*key), F.lit(1 << 62))).alias("owner"),
        F.first("n_after").alias("n_after"), F.first("n_before").alias("n_before")))
    shared = (F.col("owner") < 0) & (F.col("n") > 1)
    whole = F.col("n_before") + F.col("n_after") + gram
    equal = classes.filter(shared & (whole >= min_words)).select(
        *key, F.col("n_before").alias("left"), (F.col("n_after") + gram).alias("right"), "doc")

    # suffixes with the same gram in other surroundings: their words are fetched and sorted
    varied = classes.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram")
    asked = (classes.filter("doc IS NOT NULL").join(varied, "gram").groupBy("doc")
             .agg(F.collect_list(F.struct("gram", "digest", "place")).alias("asked")))
    asked = cluster.materialise(asked)
    size = asked.agg(F.count("*"), F.sum(F.size("asked"))).first()
    small = size[0] * cluster.ROW_BYTES + (size[1] or 0) * 32 <= cluster.BROADCAST_BYTES
    wanted = source.join(F.broadcast(asked) if small else asked, F.col("doc_id") == F.col("doc"))
    words = wanted.select("text", "asked").mapInArrow(
        _surroundings(min_words, gram), "gram bigint, digest bigint, after binary, before binary")
    words = cluster.materialise(words.dropDuplicates(key).join(classes.select(*key, "doc", "owner"), key), "zstd")

    sides = words.select(*key, "doc", "owner", F.inline(F.array(
        F.struct(F.lit(0).alias("side"), F.col("after").alias("first"), F.col("before").alias("second")),
        F.struct(F.lit(1).alias("side"), F.col("before").alias("first"), F.col("after").alias("second")))))
    met = _sorted_neighbours(sides.select("side", "gram", "digest", "first", "second", "doc", "owner"),
                             2 * words.count(), min_words, gram)
    best = cluster.materialise(met.groupBy(*key).agg(
        F.max("left").alias("left"), F.max("right").alias("right"), F.min("doc").alias("doc"),
        F.min(F.when(F.col("left") >= 0, F.col("other_doc"))).alias("other_doc"),
        F.coalesce(F.max(F.when(F.col("side") == 0, F.col("reach"))), F.lit(0)).alias("max_right"),
        F.coalesce(F.max(F.when(F.col("side") == 1, F.col("reach"))), F.lit(0)).alias("max_left")))
    near = best.filter("left >= 0").select(*key, "left", "right", F.least("doc", "other_doc").alias("doc"))

    # left open: both sides reach far enough together, and further than what was found
    open_ = best.filter(F.col("max_left") + F.col("max_right") + gram >= min_words).withColumn(
        "beyond", (F.col("max_left") > F.col("left")) | (F.col("max_right") + gram > F.col("right")))
    unsure = open_.filter("beyond").select("gram").distinct()
    tried = (open_.join(unsure, "gram").select(*key, "max_left", (F.col("max_right") + gram).alias("max_right"))
             .join(words, key).mapInArrow(_windows(min_words, gram), "gram bigint, digest bigint, doc bigint, owner bigint, left int, key bigint"))
    tried = cluster.materialise(tried)
    window = ["gram", "left", "key"]
    twice = cluster.materialise(tried.groupBy(*window).agg(
        (F.min("owner") < F.max("owner")).alias("met"), F.min("doc").alias("low"), F.count("*").alias("n")).filter("met"))
    windows = _dealt(tried, _many(twice, window), ["digest"], twice.select(*window, "low"), window).select(
        *key, "left", (F.lit(min_words) - F.col("left")).alias("right"), F.col("low").alias("doc"))

    spans = equal.unionByName(near).unionByName(windows).groupBy(*key).agg(
        F.max("left").alias("left"), F.max("right").alias("right"), F.min("doc").alias("first_doc_id"))
    placed = _dealt(suffixes, _many(classes, key), ["row", "place"], spans, key).select(
        "doc_id", "row", (F.col("place") - F.col("left")).alias("start"),
        (F.col("place") + F.col("right")).alias("end"), "first_doc_id")
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("row").orderBy("start", "end")
    begun = placed.withColumn("new", F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True)).cast("int"))
    return (begun.withColumn("stretch", F.sum("new").over(upto)).groupBy("doc_id", "row", "stretch").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("first_doc_id").alias("first_doc_id"))
        .select("doc_id", "start", "end", (F.col("end") - F.col("start")).alias("n_words"), "first_doc_id"))
