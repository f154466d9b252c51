"""Match, score, rank and list.

Every batch of an index is matched and summed where its postings lie, as no document is in
two of them. Where a query set has very many matches, a share of the documents is ranked
first, whose k-th best score no document of the result is below: of all the sums, only those
that reach it become rows. They are made for so many queries at a time as a task can hold.
Bounds are exact, so the ranking is the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom import cluster
from rankloom.functions.models import (Model, collection_probability,
                                       inverse_document_frequency)
from rankloom.functions.numbers import places
from rankloom.functions.text import tokens
from rankloom.operators.terms import query_terms
from rankloom.sources.index import Index

DOC = ("batch_id", "doc_key", "doc_id")
# Up to this many different values a scan filter names each one.
PUSHED_TERMS = 64
PUSHED_DOCS = 1000
# When the query side is shuffled, a term with more postings than this is split into pieces;
# no more terms than this are ever split.
PIECE_POSTINGS, MOST_SPLIT = 1_000_000, 500_000
# Matches per bucket, at most, that are all summed and sorted.
FEW_MATCHES = 2_000_000
# The bound is set by one of so many documents, but by at least so many matches a query, if there are.
PILOT_SHARE, PILOT_MATCHES = 64, 2_000
# What a task's sums may take, in bytes, and what one takes by itself and for each model.
HELD_BYTES, SUM_BYTES, MODEL_BYTES = 300_000_000, 200, 50
# Sums in another order, and rounding, may differ by less than this.
SLACK = 5e-6


@dataclass(frozen=True)
class QuerySide:
    """The terms of a query set with their statistics, and how to join them to postings."""

    weighted: DataFrame
    parts: tuple[DataFrame, ...]  # postings of each batch
    rows: int
    small: bool
    few: bool  # matches
    step: int = PIECE_POSTINGS
    texts: int = 0
    doc_count: int = 0
    buckets: int = 1

    def split_terms(self) -> DataFrame:
        """``(term, pieces)`` of the terms that are split, each in proportion to its postings."""
        return self.weighted.filter(F.col("df") >= self.step).select(
            "term", F.expr(f"cast(1 + df div {self.step} as int)").alias("pieces")).distinct()

    def asked(self) -> DataFrame:
        """The query side once per piece of its term: at most twice its rows."""
        return self.weighted.withColumn("piece", F.explode(F.expr(f"sequence(0, cast(df div {self.step} as int))")))

    def match_part(self, postings: DataFrame) -> DataFrame:
        if self.small:
            return postings.join(F.broadcast(self.weighted), "term")
        piece = F.coalesce(F.pmod(F.xxhash64("doc_key"), F.col("pieces")), F.lit(0)).cast("int")
        pieces = postings.join(F.broadcast(self.split_terms()), "term", "left").withColumn("piece", piece)
        return pieces.drop("pieces").join(self.asked(), ["term", "piece"]).drop("piece")

    def match(self) -> DataFrame:
        return reduce(DataFrame.unionByName, map(self.match_part, self.parts))

    def score_part(self, postings: DataFrame, added: Sequence[Column]) -> DataFrame:
        """``match_part`` with ``added``, which is worked out once per posting, however many queries ask for it."""
        if not self.small:
            return self.match_part(postings).select("*", *added)
        terms = self.weighted.select("term", "p", "idf").distinct()
        scored = postings.join(F.broadcast(terms), "term").select("term", *DOC, *added)
        return scored.join(F.broadcast(self.weighted.drop("p", "idf", "df", "ctf")), "term")

    def pilot(self) -> QuerySide:
        """The same over a share of the documents."""
        share = max(1, min(PILOT_SHARE, self.doc_count // max(1, PILOT_MATCHES)))
        chosen = F.pmod(F.xxhash64("doc_key"), F.lit(share)) == 0
        return replace(self, parts=tuple(part.filter(chosen) for part in self.parts))

    def slices(self, models: int, keys: Sequence[str]) -> list[QuerySide]:
        """The queries in so many portions that a task can hold the sums of one."""
        held = self.texts * (SUM_BYTES + MODEL_BYTES * models) * self.doc_count // max(1, self.buckets)
        n = max(1, -(-held // HELD_BYTES))
        own = F.pmod(F.xxhash64(*keys), F.lit(n))
        return [replace(self, weighted=self.weighted.filter(own == i)) for i in range(n)] if n > 1 else [self]


def query_side(index: Index, queries: DataFrame, keys: Sequence[str] = ("query_id",)) -> QuerySide:
    """Sizes the query set, and finds its terms' statistics in all batches of the index.

    While the query side is small it is broadcast: postings then stay where they are,
    spread by document. A larger one is shuffled with the postings. Terms with many
    postings are then split into pieces in proportion, as they would swamp one task.
    """
    terms = query_terms(queries, keys)
    # words and bytes of the texts: upper bounds of the terms' rows and characters
    words, chars, texts = queries.agg(
        F.sum(F.size(tokens("text"))), F.sum(F.octet_length("text")), F.count("*")).first()
    rows = words or 0
    small = (chars or 0) + rows * cluster.ROW_BYTES <= cluster.BROADCAST_BYTES
    stats, parts = index.term_stats, [b.postings for b in index.batches]
    if 0 < rows <= PUSHED_TERMS:
        wanted = cluster.any_of(
            "term", [r.term for r in terms.select("term").distinct().collect()])
        stats, parts = stats.filter(wanted), [p.filter(wanted) for p in parts]

    # only the query's terms keep their statistics
    known = stats.join(F.broadcast(terms) if small else terms, "term").select(
        *keys, "term", "qtf", "df", "ctf", "max_tf", "min_len", "max_share")
    if len(parts) > 1:  # one row per term and batch: add them up
        known = known.groupBy(*keys, "term", "qtf").agg(
            F.sum("df").alias("df"), F.sum("ctf").alias("ctf"), F.max("max_tf").alias("max_tf"),
            F.min("min_len").alias("min_len"), F.max("max_share").alias("max_share"))
    weighted = known.select(
        "*", collection_probability(F.col("ctf"), index.total_terms).alias("p"),
        inverse_document_frequency(F.col("df"), index.doc_count).alias("idf"))
    step = PIECE_POSTINGS
    if not small:  # read again for its size and for both sides of the join
        weighted = cluster.materialise(weighted)
        n, matches = weighted.agg(F.count("*"), F.sum("df")).first()
        step = max(step, -(-(matches or 0) // max(n, 1)), -(-index.total_terms // MOST_SPLIT))
    # no term has more postings than there are documents
    few = rows * index.doc_count <= FEW_MATCHES * index.buckets
    if small and not few:  # read by every portion
        weighted = cluster.materialise(weighted.coalesce(1))
    return QuerySide(weighted, tuple(parts), rows, small, few, step, texts, index.doc_count, index.buckets)


MATCHED = ("term", *DOC, "tf", "doc_len", "qtf", "df", "ctf", "p", "idf")


def match(index: Index, queries: DataFrame, keys: Sequence[str] = ("query_id",)) -> DataFrame:
    """Every posting of every query term, with the term's statistics."""
    return query_side(index, queries, keys).match().select(*keys, *MATCHED)


def scores(side: QuerySide, models: Sequence[Model],
           keys: Sequence[str] = ("query_id",)) -> DataFrame:
    """A5: one row per matched (keys, document), with one score column per model: s0, s1, ..

    All models are summed in one pass over the matches. The postings are spread by
    document, so the sum needs no shuffle after a broadcast match.
    """
    added = [model.term_score().alias(f"a{i}") for i, model in enumerate(models)]
    sums = [F.sum(F.col("qtf") * F.col(f"a{i}")).alias(f"s{i}") for i in range(len(models))]
    return reduce(DataFrame.unionByName, [
        side.score_part(part, added).groupBy(*keys, *DOC).agg(*sums) for part in side.parts])


def top_k(scored: DataFrame, k: int, keys: Sequence[str] = ("query_id",)) -> DataFrame:
    """Best ``k`` per ``keys``; ties in order of insertion.

    The group limit that Spark derives from the filter keeps ``k`` rows per key and
    task before anything is shuffled.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "batch_id", "doc_id", "doc_key")
    return (scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select(*keys, "rank", *DOC, "score"))


def _each(test, count: int, join=Column.__or__) -> Column:
    return reduce(join, [test(i) for i in range(count)])


def contenders(side: QuerySide, models: Sequence[Model], k: int,
               keys: Sequence[str] = ("query_id",)) -> DataFrame:
    """``scores`` of at least the documents that are among the best ``k`` by some model.

    The columns t0, t1, .. hold a score per model that no document of its result is below, or
    null. Few matches are simply all summed.
    """
    n = len(models)
    if side.few or not side.small or side.rows * n * cluster.ROW_BYTES > cluster.BROADCAST_BYTES:
        every = scores(side, models, keys)
        return every.select("*", *(F.lit(None).cast("double").alias(f"t{i}") for i in range(n)))
    limits = reached(side, models, k, keys)
    every = reduce(DataFrame.unionByName, [scores(own, models, keys) for own in side.slices(n, keys)])
    return every.join(F.broadcast(limits), list(keys), "left").filter(
        _each(lambda i: F.col(f"t{i}").isNull() | (F.col(f"s{i}") >= F.col(f"t{i}")), n))


def reached(side: QuerySide, models: Sequence[Model], k: int, keys: Sequence[str]) -> DataFrame:
    """Per query the scores t0, .. that its k-th best document reaches at least: the k-th best
    of a share of the documents, which no other documents can lower."""
    n, pilot = len(models), side.pilot()
    summed = reduce(DataFrame.unionByName, [scores(own, models, keys) for own in pilot.slices(n, keys)])
    ranked = summed.select(*keys, *DOC, F.posexplode(F.array(*(F.col(f"s{i}") for i in range(n)))).alias("model", "score"))
    last = top_k(ranked, k, (*keys, "model")).filter(F.col("rank") == k)
    return cluster.materialise(last.groupBy(*keys).agg(*(
        (F.max(F.when(F.col("model") == i, F.col("score"))) - SLACK).alias(f"t{i}") for i in range(n))))


def term_split(side: QuerySide, models: Sequence[Model], k: int, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The query terms, ``spare`` or not, and per query the scores t0, .. to reach and what the
    spare terms can add to each: r0, ..

    Terms are spare as long as what they can add together, by the extremes of their postings, is
    less than the k-th best document reaches: a document that holds no other term is not among them.
    """
    n = len(models)
    terms = side.weighted.select("*", *((F.col("qtf") * m.bound()).alias(f"u{i}") for i, m in enumerate(models)))
    limits = reached(side, models, k, keys)
    lower = Window.partitionBy(*keys).orderBy("u0", "term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    least = _each(lambda i: F.coalesce(F.sum(f"u{i}").over(lower) < F.col(f"t{i}"), F.lit(False)), n, Column.__and__)
    split = cluster.materialise(terms.join(F.broadcast(limits), list(keys), "left").withColumn("spare", least).drop(
        *(f"t{i}" for i in range(n))))
    added = split.filter("spare").groupBy(*keys).agg(*(F.sum(f"u{i}").alias(f"r{i}") for i in range(n)))
    return split, limits.join(added, list(keys), "left").fillna(0.0, [f"r{i}" for i in range(n)])


def first_matched(side: QuerySide, k: int, keys: Sequence[str]) -> DataFrame:
    """``(keys, document)`` of at least the first ``k`` matched documents in order of insertion.

    The k-th that matches of a share of the documents bounds what has to be looked at.
    """
    place = F.struct("batch_id", "doc_id", "doc_key")
    order = Window.partitionBy(*keys).orderBy("place")
    matched = reduce(DataFrame.unionByName, [
        own.match_part(part).select(*keys, *DOC).distinct() for own in side.pilot().slices(0, keys) for part in own.parts])
    last = (matched.select(*keys, place.alias("place"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .filter(F.col("rank") == k).select(*keys, F.col("place").alias("last")))
    last = cluster.materialise(last)
    near = [own.match_part(part).join(F.broadcast(last), list(keys), "left").filter(F.col("last").isNull() | (place <= F.col("last")))
            .select(*keys, *DOC).distinct() for own in side.slices(0, keys) for part in own.parts]
    return reduce(DataFrame.unionByName, near)


def scored_rows(side: QuerySide, models: Sequence[Model], labels: Sequence, k: int, keys: Sequence[str]) -> DataFrame:
    """``(keys, document, label, score)`` of at least the best ``k`` of every model."""
    flat = [label for m, label in zip(models, labels) if m.flat and not side.few and side.small]
    sharp = [(m, label) for m, label in zip(models, labels) if label not in flat]
    parts = []
    if sharp:
        scored = contenders(side, [m for m, _ in sharp], k, keys)
        cells = [(F.lit(label), places(F.col(f"s{i}")), F.col(f"t{i}")) for i, (_, label) in enumerate(sharp)]
        names = ("label", "score", "least")
        if len(cells) == 1:
            rows = scored.select(*keys, *DOC, *(c.alias(name) for c, name in zip(cells[0], names)))
        else:  # only here the sums under several models become rows
            rows = scored.select(*keys, *DOC, F.stack(F.lit(len(cells)), *sum(cells, ())).alias(*names))
        parts.append(rows.filter(F.col("least").isNull() | (F.col("score") >= F.col("least"))).drop("least"))
    if flat:
        parts.append(first_matched(side, k, keys).select(*keys, *DOC, F.explode(F.array(*map(F.lit, flat))).alias("label"),
                                                         F.lit(0.0).alias("score")))
    return reduce(DataFrame.unionByName, parts)


def search(index: Index, queries: DataFrame, model: Model, k: int,
           keys: Sequence[str] = ("query_id",)) -> DataFrame:
    """Ranking ``(keys, rank, batch_id, doc_key, doc_id, score)`` of a whole query set."""
    return top_k(scored_rows(query_side(index, queries, keys), [model], [0], k, keys), k, keys)


def stored_documents(index: Index, ranking: DataFrame) -> DataFrame:
    """The contents of the ranked documents, fetched after the top-k.

    ``ranking`` is read twice, so pass a materialised one. Few documents are named
    in the scan's filter, which then reads only their pages; else the ranking is
    moved to where the documents lie, and their texts stay in place.
    """
    found = ranking.select("doc_key").distinct().limit(PUSHED_DOCS + 1).collect()
    if len(found) <= PUSHED_DOCS:
        named = index.docs.select("doc_key", "contents").filter(cluster.any_of("doc_key", [r.doc_key for r in found]))
        return ranking.join(named, "doc_key")
    # batch by batch, as only a batch by itself lies by document
    return reduce(DataFrame.unionByName, [
        b.docs.select("doc_key", "contents").join(ranking.hint("shuffle_hash"), "doc_key") for b in index.batches])


def flag_relevant(ranking: DataFrame, qrels: DataFrame) -> DataFrame:
    """Adds ``relevant``; judgements count as a set."""
    judged = qrels.select("query_id", "doc_id").distinct().withColumn("judged", F.lit(True))
    return (ranking.join(judged, ["query_id", "doc_id"], "left")
            .withColumn("relevant", F.col("judged").isNotNull()).drop("judged"))


def show_ranking(index: Index, ranking: DataFrame, qrels: DataFrame, top: int) -> DataFrame:
    """Rank, score, relevance, id and contents of the best ``top`` documents per query."""
    shown = cluster.materialise(flag_relevant(ranking.filter(F.col("rank") <= top), qrels))
    return stored_documents(index, shown).select(
        "query_id", "rank", "score", "relevant", "doc_id", "contents")
