"""Mixing sources to target weights by a curriculum that changes with time.

Every source has a schedule: a weight over training time 0 to 1, straight between knots. The
integral of a schedule is the source's share of all words; no source gives more than ``most``
times its size, and what it cannot give goes to the others by their shares. The demand for a
source up to a time is its target times the integral up to there. Documents of a source stand
in the order of a digest of id and text, pass after pass; where a document begins in that
order, in words, is put into the inverse of the demand, and that is the time at which it is
trained on: its position. A range sort by position gives the training order.

How it runs. One pass reads the texts and keeps a row of numbers per document; rows alike in
everything are one row with a count. A source is cut into stretches of its order by the first
digits of the digest, with ``STRETCH`` documents at most on average, however large it is; sums per
stretch say where each begins, and documents are added up inside their stretch. The table of
sources is numbered by ranges and shares are found by sums over it, so many sources make no
single task either. Nothing but sums and counts per range reaches the driver.

Rows: a null or wordless text has size 0, is taken 0 times and gets no position; sources are
numbered by code point, a null one last; null or repeated ids are told apart by text; rows alike
in id, source and text follow each other, and take one after the other; an empty table
gives an empty one. Other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom import cluster

# Documents of a source that are added up in one task, on average at most.
STRETCH = 5_000
MOST = 3


@dataclass(frozen=True)
class Schedule:
    """Weights at times; the first time is 0 and the last one 1."""

    knots: tuple[tuple[float, float], ...]

    def __post_init__(self):
        times, weights = zip(*self.knots)
        if times[0] != 0 or times[-1] != 1 or list(times) != sorted(set(times)) or min(weights) < 0 or max(weights) <= 0:
            raise ValueError(f"no schedule over times 0 to 1: {self.knots}")

    def pieces(self) -> list[tuple[float, float, float, float, float]]:
        """``(area before, begin, span, weight at the begin, weight at the end)`` of each piece."""
        out, before = [], 0.0
        for (t, w), (u, v) in zip(self.knots[:-1], self.knots[1:]):
            out.append((before, t, u - t, w, v))
            before += (u - t) * (w + v) / 2
        return out

    def integral(self) -> float:
        return sum(span * (w + v) / 2 for _, _, span, w, v in self.pieces())

    def time_at(self, area: Column) -> Column:
        """The time up to which the weight adds up to ``area``."""
        out = None
        for before, begin, span, w, v in self.pieces()[::-1]:
            here = area - F.lit(before)
            root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w * w) + here * F.lit(2 * (v - w) / span)))
            time = F.when(here <= 0, F.lit(float(begin))).otherwise(
                F.lit(float(begin)) + here * F.lit(2.0) / F.nullif(F.lit(w) + root, F.lit(0.0)))
            out = time if out is None else F.when(area < F.lit(next_before), time).otherwise(out)
            next_before = before
        return F.least(out, F.lit(1.0))


def ramp(weight: float, slope: float = 0.0) -> Schedule:
    """Straight from ``weight * (1 - slope)`` to ``weight * (1 + slope)``; the integral is ``weight``."""
    return Schedule(((0.0, weight * (1 - slope)), (1.0, weight * (1 + slope))))


def numbered(rows: DataFrame, column: str, name: str) -> DataFrame:
    """``rows`` with ``name``, their number from 0 in the order of a column of different values.

    Ranges are numbered each by a task of its own, from where the ranges before them end.
    """
    ranged = cluster.materialise(rows.repartitionByRange(column).withColumn("_range", F.spark_partition_id()))
    sizes = {r["_range"]: r["count"] for r in ranged.groupBy("_range").count().collect()}
    first, offsets = 0, [F.lit(-1).cast("int"), F.lit(0).cast("bigint")]
    for part in sorted(sizes):
        offsets += [F.lit(part), F.lit(first).cast("bigint")]
        first += sizes[part]
    within = F.row_number().over(Window.partitionBy("_range").orderBy(column)) - 1
    return ranged.withColumn(name, within + F.element_at(F.create_map(*offsets), F.col("_range"))).drop("_range")


def source_targets(sources: DataFrame, weights: Sequence[float], most: int = MOST) -> DataFrame:
    """``sources(name, source_size)`` with ``turn``, the number of its weight, and ``target``."""
    turn = (F.col("number") % len(weights)).cast("int")
    table = cluster.materialise(numbered(sources, "name", "number").select(
        "name", "source_size", turn.alias("turn"), F.element_at(F.array(*map(F.lit, map(float, weights))), turn + 1).alias("weight")))
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    limit = F.col("source_size") * most
    full, filled = F.lit(False), None
    while True:  # each round fills the sources whose share is beyond their limit
        groups = table.groupBy("turn", full.alias("full")).agg(F.count("*").alias("n"), F.sum(limit).alias("given")).collect()
        if filled == (now := sum(g.n for g in groups if g.full)):
            break
        left = total - sum(g.given for g in groups if g.full)
        shares = math.fsum(g.n * weights[g.turn] for g in groups if not g.full)
        share, filled = F.lit(float(left)) * F.col("weight") / F.lit(shares or 1.0), now
        full = full | (share > limit)
    return table.select("name", "source_size", "turn",
                        F.when(full, limit.cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, schedules: Sequence[Schedule], most: int = MOST, doc_id: str = "doc_id",
        text: str = "text", source: str = "source") -> DataFrame:
    """One row per document with its source's numbers and its ``passes(position, words)``.

    Sources take the schedules in turn, in the order of their code points.
    """
    spark = docs.sparkSession
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")
    digest = F.md5(F.concat_ws("|", F.col(doc_id).cast("string"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).cast("binary"))
    # "s" before every name, so that "t" stands for the null and sorts last
    name = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("t"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), name.alias("name"), digest.alias("digest"), words.alias("size"))
    sized = cluster.materialise(rows.groupBy("name", "digest", "doc_id", "size").agg(F.count("*").alias("copies")))
    sources = cluster.materialise(sized.groupBy("name").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count("*").alias("n")))
    largest = sources.agg(F.max("n")).first()[0] or 0
    digits = max(0, math.ceil(math.log(max(largest, 1) / STRETCH, 16)))
    targets = source_targets(sources.drop("n"), [s.integral() for s in schedules], most)

    # where each stretch of a source begins
    cut = sized.withColumn("stretch", F.substring("digest", 1, digits))
    sums = cut.groupBy("name", "stretch").agg(F.sum(F.col("size") * F.col("copies")).alias("size"))
    ahead = Window.partitionBy("name").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select("name", "stretch", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("begin")).join(targets, "name")

    order = Window.partitionBy("name", "stretch").orderBy("digest", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(F.col("size") * F.col("copies")).over(order), F.lit(0))
    placed = cut.withColumn("inside", inside).join(begins, ["name", "stretch"])
    each = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    start = F.col("begin") + F.col("inside") + F.col("copy") * F.col("size")
    quota = F.round("target").cast("bigint")
    measured = each.select("*", start.alias("start"), quota.alias("quota"))

    def of(pass_number: Column) -> Column:
        first = pass_number * F.col("source_size") + F.col("start")
        given = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), F.col("quota") - first))
        share = first / F.greatest(F.col("quota"), F.lit(1))
        time = F.lit(None).cast("double")
        for i, schedule in enumerate(schedules):
            time = F.when(F.col("turn") == i, schedule.time_at(share * F.lit(schedule.integral()))).otherwise(time)
        return F.struct(time.alias("position"), given.alias("words"))

    passes = F.filter(F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(most - 1).cast("bigint")), of),
                      lambda p: p["words"] > 0)
    null_name = F.when(F.col("name") != "t", F.substring("name", 2, 1 << 30))
    return measured.select("doc_id", null_name.alias("source"), "size", "source_size", "target",
                           F.when(F.col("size") > 0, passes).otherwise(F.filter(passes, lambda _: F.lit(False))).alias("passes"),
                           "digest")


def training_order(mixed: DataFrame) -> DataFrame:
    """``(position, doc_id, source, words)``, one row per pass over a document, sorted by position."""
    return mixed.select("doc_id", "source", "digest", F.inline("passes")).orderBy("position", "source", "digest").drop("digest")


def by_first_position(mixed: DataFrame) -> DataFrame:
    """``mixed`` with ``taken`` and the ``position`` of the first pass, sorted by it; documents not
    taken come last."""
    taken = F.aggregate("passes", F.lit(0).cast("bigint"), lambda sum_, p: sum_ + p["words"])
    return mixed.select("*", taken.alias("taken"), F.get(F.col("passes.position"), F.lit(0)).alias("position")).orderBy(
        F.asc_nulls_last("position"), "source", "digest")
