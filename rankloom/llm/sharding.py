"""Shards by a hierarchical weighted hash tree, in DataFrame functions only.

The tree has regions, racks and shards. A document descends it: at each level every
child draws a number from the hash of (document, child), divided by the child's weight,
and the smallest draw wins. A child's draw depends on nothing but its own name and
weight, so a changed weight moves documents only into or out of that child: movement
stays inside the subtrees whose weights change. A shard that is added in a rack and
region of its own takes documents only into itself.

Rows: a null id counts as one id of its own, so that all such rows share a shard; equal
ids share a shard; a null text has no bytes; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows that are numbered in one sorted group; the number of groups follows the row count.
GROUP_ROWS = 50_000
# Bytes that every document takes besides its text.
ROW_OVERHEAD = 8


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def regular_tree(shards: int, per_rack: int = 2, racks: int = 3) -> list[Leaf]:
    """Shards 0, 1, .. in racks of ``per_rack`` and regions of ``racks`` racks."""
    return [Leaf(s // (per_rack * racks), s // per_rack, s) for s in range(shards)]


def grown_tree(tree: Sequence[Leaf]) -> list[Leaf]:
    """``tree`` with one more shard, which stands in a region and rack of its own."""
    return [*tree, Leaf(1 + max(t.region for t in tree), 1 + max(t.rack for t in tree),
                        1 + max(t.shard for t in tree))]


def _draw(key: Column, name: str, weight: float) -> Column:
    """An exponential draw of rate ``weight``: the smallest one wins with that share."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f"|{name}")).cast("binary")), 1, 12)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16 ** 12)
    return -F.log(uniform) / weight


def _descend(tree: Sequence[Leaf], key: Column, levels: tuple[str, ...]) -> Column:
    level, rest = levels[0], levels[1:]
    parts: dict[int, list[Leaf]] = {}
    for leaf in tree:
        parts.setdefault(getattr(leaf, level), []).append(leaf)

    def below(name: int) -> Column:
        return _descend(parts[name], key, rest) if rest else F.lit(name)

    names = sorted(parts)
    if len(names) == 1:
        return below(names[0])
    draws = [F.struct(_draw(key, f"{level}{n}", sum(t.weight for t in parts[n])).alias("draw"),
                      F.lit(n).alias("name")) for n in names]
    # the winner is bound once, so that each draw is made once
    return F.transform(F.array(F.array_min(F.array(*draws))["name"]), lambda winner: F.coalesce(
        *(F.when(winner == n, below(n)) for n in names)))[0]


def shard_of(tree: Sequence[Leaf], doc_id: Column) -> Column:
    """The shard of an id, as an INT column."""
    key = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return _descend(tree, key, ("region", "rack", "shard")).cast("int")


def assign_shards(docs: DataFrame, tree: Sequence[Leaf], grown: Sequence[Leaf],
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of every document.

    Slots are numbered in sorted groups of about ``GROUP_ROWS`` rows, spread by a hash of
    the row; a group starts where the groups before it end, which a small table of counts
    tells. Texts are read for their size and checksum and never moved. The input is read
    twice, the first time for the counts.
    """
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(doc_id).alias("doc_id"),
                       (F.octet_length(data) + ROW_OVERHEAD).cast("bigint").alias("size"),
                       F.crc32(data).alias("text_crc32"))
    groups = 1 + docs.count() // GROUP_ROWS
    # text and size spread the rows of one hot id as well
    group = F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(groups))
    placed = rows.select("*", shard_of(tree, F.col("doc_id")).alias("shard"), group.alias("part"))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("nth", F.row_number().over(inside) - 1)
    return numbered.join(starts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("start") + F.col("nth")).alias("slot"),
        shard_of(grown, F.col("doc_id")).alias("grown_shard"))
