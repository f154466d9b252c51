"""MinHash near-duplicates by an LSH forest.

A document's set holds its distinct shingles of five words. Its MinHash signature is laid
out in several orders of the hash functions. In each order the signatures are sorted, and
documents that stand near each other and share a long enough prefix become candidates: where
a region is crowded only deeper prefixes bring two documents near each other, where it is
empty a short one does. Candidates are then confirmed on their full sets, each shingle by 48
bits of its hash. In a crowd the partners of a document need not be among its ``REACH`` neighbours. So
a document that met members of a component in vain is held against all of them on full sets, in
blocks that give nothing but links.

Equal sets are one class from the start. Sorting is a range partitioning of all orders
together, so that a common prefix is split over tasks; the few rows at the ends of the
tasks' ranges are compared once more. Every class first confirms its most likely partners;
of what is left, only candidates that would join different components are.

Rows: a text that is null or has no word has an empty set and is linked with nothing; a
text of fewer than five words is one shingle; ids that repeat are judged text by text; a row
without an id joins the component of its set where a named row has that set, and else is
kept without a component. Extra columns are left out.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom import cluster
from rankloom.llm.common import column_bytes, released, ship, slices
from rankloom.llm.graph import components
from rankloom.llm.lm import mix, pack, unpack

SHINGLE = 5
# A link needs THRESHOLD percent of the union in the intersection.
THRESHOLD = 75
HASHES, ORDERS, STEP, DEPTH = 128, 20, 6, 16
# Least common prefix of candidates, and how many places on a neighbour may stand.
LEAST_PREFIX, REACH = 3, 6
# Partners that a class confirms before components are made.
LIKELY = 2
# Members of a component, and others that may belong to it, that meet in one block.
BLOCK_NODES = 500
# Sorted rows per task, and members of one class that are confirmed in one group.
SORTED_ROWS, GROUP_MEMBERS = 200_000, 256
# Tasks of a sort at most.
MOST_PARTS = 100_000

_KEYS = np.random.default_rng(20_24)
_A = _KEYS.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _KEYS.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingle_sets(texts: list[bytes | None], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    numbers: dict[bytes, int] = {}
    flat, sizes = [], []
    for data in texts:
        words = data.lower().split() if data else []
        sizes.append(len(words))
        flat += [numbers.setdefault(w, len(numbers)) for w in words]
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in numbers), np.uint64, len(numbers))
    words = hashes[np.array(flat, np.int64)] if flat else hashes
    rolled = words
    for k in range(1, size):
        rolled = mix(rolled[:-1], words[k:]) if len(rolled) > 1 else rolled[:0]
    out, at = [], 0
    for n in sizes:
        if n >= size:
            out.append(np.unique(rolled[at:at + n - size + 1]))
        elif n:
            short = np.array([n], np.uint64)
            for w in words[at:at + n]:
                short = mix(short, np.array([w], np.uint64))
            out.append(short)
        else:
            out.append(words[:0])
        at += n
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of HASHES minima per set that is not empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((HASHES, len(sets)), np.uint32)
    for k in range(HASHES):
        values = ((flat * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32)
        out[k] = np.minimum.reduceat(values, starts)
    return out.T


def _profile(text: str, size: int):
    """Set size, a 128-bit key of the set, and the signature, of each document."""
    def run(batches):
        for batch in batches:
            for piece in slices(batch, text):
                sets = shingle_sets(column_bytes(piece, text), size)
                some = [s for s in sets if len(s)]
                rows = iter(signatures(some)) if some else iter(())
                salt = np.array([0x5851F42D4C957F2D], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([int(s.sum().view(np.int64)) for s in sets], pa.int64()),
                     pa.array([int(mix(s, salt).sum().view(np.int64)) if len(s) else 0 for s in sets], pa.int64()),
                     pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary())],
                    names=["doc_id", "n_shingles", "key1", "key2", "signature"])

    return run


def _orders(batches):
    """Each signature in every order, as the low halves of its hashes."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            piece = batch.slice(at, 2000)
            data = b"".join(piece.column(1).to_pylist())
            low = np.frombuffer(data, np.uint32).reshape(-1, HASHES).astype(">u2")
            for t in range(ORDERS):
                label = np.ascontiguousarray(low[:, (np.arange(DEPTH) + t * STEP) % HASHES])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(label), t, np.int32)),
                     pa.array([x.tobytes() for x in label], pa.binary()), piece.column(0)],
                    names=["tree", "label", "node"])


def near_pairs(tree: np.ndarray, label: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, ...]:
    """Candidates among sorted rows: ``(a, b, prefix)`` of neighbours with a common prefix."""
    n = len(node)
    found = []
    same = (label[1:] == label[:-1]) & (tree[1:] == tree[:-1])[:, None]
    step = np.where(same.all(axis=1), DEPTH, (~same).argmax(axis=1))
    shared = step
    for apart in range(1, REACH + 1):
        if n <= apart:
            break
        if apart > 1:
            shared = np.minimum(shared[:-1], step[apart - 1:])
        at = np.nonzero((shared >= LEAST_PREFIX) & (node[:n - apart] != node[apart:]))[0]
        found.append((np.minimum(node[at], node[at + apart]), np.maximum(node[at], node[at + apart]), shared[at]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (node[:0], node[:0], node[:0])


def _neighbours(keep_ends: bool):
    """Candidates of a sorted partition, batch after batch; its ends as rows without a pair."""
    def run(batches):
        rest, first = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            whole = table.to_batches()[0]
            tree = whole.column(0).to_numpy()
            label = np.frombuffer(b"".join(whole.column(1).to_pylist()), ">u2").reshape(-1, DEPTH)
            node = whole.column(2).to_numpy()
            a, b, prefix = near_pairs(tree, label, node)
            yield _pairs(a, b, prefix)
            if first and keep_ends:
                yield _ends(whole.slice(0, REACH))
            rest, first = whole.slice(max(0, whole.num_rows - REACH)), False
        if rest is not None and keep_ends:
            yield _ends(rest)

    return run


NEIGHBOUR = "a bigint, b bigint, prefix bigint, tree int, label binary, node bigint"
_NAMES = ["a", "b", "prefix", "tree", "label", "node"]


def _pairs(a, b, prefix):
    none = [pa.nulls(len(a), t) for t in (pa.int32(), pa.binary(), pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(prefix.astype(np.int64)), *none], names=_NAMES)


def _ends(rows):
    none = [pa.nulls(rows.num_rows, pa.int64())] * 3
    return pa.RecordBatch.from_arrays([*none, *rows.columns], names=_NAMES)


def forest_candidates(classes: DataFrame) -> DataFrame:
    """``(a, b, prefixes)`` of ``classes(node, signature)``; summed over the orders."""
    rows = classes.select("node", "signature").mapInArrow(released(_orders), "tree int, label binary, node bigint")
    spark = classes.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = min(MOST_PARTS, max(least, classes.count() * ORDERS // SORTED_ROWS))
    order = ("tree", "label", "node")
    met = []
    while True:
        ranges = rows.coalesce(1) if parts == 1 else rows.repartitionByRange(parts, *order)
        found = cluster.materialise(ranges.sortWithinPartitions(*order).mapInArrow(released(_neighbours(parts > 1)), NEIGHBOUR))
        met.append(found.filter("a IS NOT NULL"))
        if parts == 1:
            break
        # a few rows per range: the neighbours that its ends had cut apart, in ranges again while they are many
        rows = found.filter("node IS NOT NULL").select(*order)
        parts = max(1, min(parts // 2, rows.count() // SORTED_ROWS))
    pairs = reduce(DataFrame.unionByName, met).select("a", "b", "prefix")
    return pairs.groupBy("a", "b").agg(F.sum("prefix").alias("prefixes"))


def _sets_for(size: int, fields: dict[str, pa.DataType]):
    """The set of every text once per target; ``fields`` are those of a target."""
    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                sets = shingle_sets(column_bytes(piece, "text"), size)
                rows = [(*(t[f] for f in fields), doc, len(s), packed) for doc, s, packed, targets in zip(
                    piece.column(0).to_pylist(), sets,
                    (pack(np.diff(np.sort(s >> np.uint64(16)), prepend=np.uint64(0))) for s in sets),
                    piece.column(2).to_pylist()) for t in targets]
                kinds = [*fields.values(), pa.int64(), pa.int64(), pa.binary()]
                columns = list(zip(*rows)) if rows else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)],
                                                 names=[*fields, "node", "n", "items"])

    return run


def sent_sets(docs: DataFrame, needs: DataFrame, size: int, fields: dict[str, pa.DataType]) -> DataFrame:
    """``(fields, node, n, items)``: the sets of the nodes of ``needs(fields, node)``."""
    # a set is sent to as many targets as it has rows there
    wanted = cluster.materialise(needs.groupBy("node").agg(F.collect_list(F.struct(*fields)).alias("targets")))
    entries = wanted.agg(F.count("*"), F.sum(F.size("targets"))).first()
    small = (entries[0] * cluster.ROW_BYTES + (entries[1] or 0) * 24) <= cluster.BROADCAST_BYTES
    schema = ", ".join(f"{f} {needs.schema[f].dataType.simpleString()}" for f in fields)
    return docs.join(F.broadcast(wanted) if small else wanted, F.col("doc_id") == F.col("node")).select(
        "doc_id", "text", "targets").mapInArrow(released(_sets_for(size, fields)), f"{schema}, node bigint, n bigint, items binary")


def _confirm(threshold: int):
    def run(table: pa.Table) -> pa.Table:
        lead = table.column("lead")[0].as_py()
        rows = [(node, np.cumsum(unpack(items, np.uint64)))
                for node, items in zip(table.column("node").to_pylist(), table.column("items").to_pylist())]
        leads = [s for node, s in rows if node == lead]
        linked = set()
        for node, own in rows:
            if node != lead:
                for other in leads:
                    both = len(np.intersect1d(own, other, assume_unique=True))
                    if 100 * both >= threshold * (len(own) + len(other) - both):
                        linked.add(node)
        return pa.table({"a": pa.array([lead] * len(linked), pa.int64()), "b": pa.array(sorted(linked), pa.int64())})

    return run


def confirmed(docs: DataFrame, pairs: DataFrame, threshold: int, size: int) -> DataFrame:
    """The ``pairs(a, b)`` whose full sets are similar enough. ``docs`` has ``doc_id, text``.

    A set goes to the group of every partner that it is compared with. The members of a
    partner with many of them are dealt over several groups, which each get the partner's set.
    """
    many = pairs.groupBy("a").agg(F.count("*").alias("n"))
    salt = F.pmod(F.xxhash64("b"), F.floor(F.col("n") / GROUP_MEMBERS) + 1).cast("int")
    salts = cluster.materialise(pairs.join(many, "a").select(F.col("a").alias("lead"), "b", salt.alias("salt")))
    needs = salts.select("lead", "salt", F.col("b").alias("node")).unionByName(
        salts.select("lead", "salt", F.col("lead").alias("node")).distinct())
    sets = sent_sets(docs, needs, size, {"lead": pa.int64(), "salt": pa.int32()})
    return cluster.materialise(sets.groupBy("lead", "salt").applyInArrow(_confirm(threshold), "a bigint, b bigint"))


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels(node, component)`` after further ``links(a, b)``: only components are joined anew."""
    of = [labels.select(F.col("node").alias(end), F.col("component").alias(f"c{end}")) for end in ("a", "b")]
    between = links.join(of[0], "a", "left").join(of[1], "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    low = components(between).select(F.col("node").alias("component"), F.col("component").alias("low"))
    new = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct().join(
        labels, "node", "left_anti").withColumn("component", F.col("node"))
    return cluster.materialise(labels.unionByName(new.select("node", "component")).join(low, "component", "left").select(
        "node", F.coalesce("low", "component").alias("component")))


def _block_links(threshold: int):
    """For every visitor of a block a member whose full set is similar enough, if there is one."""
    def run(table: pa.Table) -> pa.Table:
        visits = table.column("visits").to_pylist()
        rows = [(node, np.cumsum(unpack(items, np.uint64))) for node, items in zip(
            table.column("node").to_pylist(), table.column("items").to_pylist())]
        members = [r for r, v in zip(rows, visits) if not v]
        found = []
        if members:
            sizes = np.array([len(s) for _, s in members])
            nodes = np.array([node for node, _ in members])
            flat = np.concatenate([s for _, s in members])
            order = np.argsort(flat, kind="stable")
            owner, flat = np.repeat(np.arange(len(members)), sizes)[order], flat[order]
            for node, own in (r for r, v in zip(rows, visits) if v):
                low = np.searchsorted(flat, own, "left")
                many = np.searchsorted(flat, own, "right") - low
                places = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
                both = np.bincount(owner[places], minlength=len(members))
                linked = nodes[(100 * both >= threshold * (len(own) + sizes - both)) & (nodes != node)]
                if len(linked):
                    found.append((node, int(linked.min())))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def border_links(docs: DataFrame, labels: DataFrame, borders: DataFrame, threshold: int, size: int) -> DataFrame:
    """``(a, b)``: the nodes of ``borders(node, component)`` that a member of that component is similar
    enough to, with one such member or a few.

    Members and visitors of a component meet in blocks of bounded size, however many there are, and
    are compared there on their full sets; nothing but links leaves a block.
    """
    visited = borders.groupBy("component").agg(F.count("*").alias("n_visits"))
    sizes = labels.groupBy("component").agg(F.count("*").alias("n")).join(visited, "component")
    rows, columns = (F.floor(F.col(n) / BLOCK_NODES).cast("int") for n in ("n", "n_visits"))
    member = labels.join(sizes, "component").select(
        "node", "component", F.lit(False).alias("visits"), F.pmod(F.xxhash64("node"), rows + 1).cast("int").alias("row"),
        F.explode(F.sequence(F.lit(0), columns)).alias("column"))
    visitor = borders.join(sizes, "component").select(
        "node", "component", F.lit(True).alias("visits"), F.explode(F.sequence(F.lit(0), rows)).alias("row"),
        F.pmod(F.xxhash64("node"), columns + 1).cast("int").alias("column"))
    sets = sent_sets(docs, member.unionByName(visitor), size,
                     {"component": pa.int64(), "row": pa.int32(), "column": pa.int32(), "visits": pa.bool_()})
    return cluster.materialise(sets.groupBy("component", "row", "column").applyInArrow(_block_links(threshold), "a bigint, b bigint"))


def link_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   threshold: int = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """``(doc_id, n_shingles, class_id, component_id, kept)`` of every document.

    ``class_id`` is the least id with the same set. ``kept`` marks one document of each
    component, the one with the least id.
    """
    ship(docs)
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    profiled = cluster.materialise(source.mapInArrow(
        released(_profile("text", size)), "doc_id bigint, n_shingles bigint, key1 bigint, key2 bigint, signature binary"))
    key = ["n_shingles", "key1", "key2"]
    filled = profiled.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = cluster.materialise(filled.groupBy(*key).agg(F.min("doc_id").alias("class_id")))
    heads = cluster.materialise(filled.select("doc_id", "signature", *key).join(classes, key).filter("doc_id = class_id")
                                .select(F.col("doc_id").alias("node"), "signature"))
    pairs = cluster.materialise(forest_candidates(heads))

    # the likeliest partners of each class, as many as connect most of a group
    ways = pairs.withColumn("of", F.col("a")).unionByName(pairs.withColumn("of", F.col("b")))
    order = Window.partitionBy("of").orderBy(F.desc("prefixes"), "a", "b")
    best = ways.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= LIKELY)
    first = cluster.materialise(best.select("a", "b").distinct())
    links = confirmed(source, first, threshold, size)
    labels = cluster.materialise(components(links))

    def across() -> DataFrame:
        a = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        b = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        return (pairs.join(a, "a", "left").join(b, "b", "left")
                .select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"))
                .filter("ca <> cb"))

    # of what is left, the candidates between different components
    left = cluster.materialise(across())
    labels = merged(labels, confirmed(source, left.select("a", "b"), threshold, size))

    # a class that met members of another component in vain: in a crowd, the partners that it has may be
    # others than its neighbours, so it is held against all members. A component's name is a node of it
    now = [labels.select(F.col("node").alias(c), F.col("component").alias(f"now_{c}")) for c in ("ca", "cb")]
    apart = left.join(now[0], "ca", "left").join(now[1], "cb", "left").select(
        "a", "b", F.coalesce("now_ca", "ca").alias("ca"), F.coalesce("now_cb", "cb").alias("cb")).filter("ca <> cb")
    borders = cluster.materialise(apart.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.col("cb").alias("component")),
        F.struct(F.col("b").alias("node"), F.col("ca").alias("component")))).alias("x")).select("x.node", "x.component").distinct())
    labels = merged(labels, border_links(source, labels, borders, threshold, size))
    labels = labels.withColumnRenamed("node", "class_id")

    members = profiled.drop("signature").join(classes, key, "left")
    named = F.coalesce("component", "class_id", "doc_id")
    return members.join(labels, "class_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"), named.alias("component_id"),
        F.col("doc_id").eqNullSafe(named).alias("kept"))
