"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lowers case, replaces look-alike letters of other scripts and digits or signs that
stand for letters, and leaves words with single blanks between them. The lexicon holds whole
words and beginnings of words. Matches inside an exception phrase do not count, and a word
counts by its weightiest match. The weight of all words, plain and per word of the
text, makes the score by logistic regression.

A term is toxic or neutral. A neutral one occurs in toxic documents as often as chance has it,
a toxic one mostly there. Expectation-maximisation over all words finds how many
are toxic, and with it each one's probability to be so, by its numbers of toxic and clean documents. Terms
that are more probable than ``LEAST_BELIEF`` enter, weighted by their log-odds times that
probability: with few labels only what is very frequent in toxic documents, with many also the
rare. Beginnings of words are judged by the words that did not enter themselves. Phrases of a
term and its neighbour that are mostly clean become exceptions. Copies would count as
evidence many times: documents with the same sketch (the least hash of their 5-word shingles)
share one vote.

Lexicon and regression are fitted on a sample of at most ``SAMPLE`` labelled documents per
label, the ones whose ids hash lowest, read whole and written down once; all sizes follow from
that. Scoring reads every document whole.

Rows: a null or wordless text has no match and gets the score of one; labels that are null
or without a document teach nothing; without labels of both kinds every score is 0. Repeated
rows are scored alike. A column that has the name of a result is replaced, others are kept.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field
from math import exp, lgamma, log

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom import cluster
from rankloom.llm.common import column_text, released, ship, slices, with_columns

SAMPLE = 10_000
# Beginnings of words from this to that length may enter the lexicon.
SHORTEST, LONGEST = 4, 8
# A toxic term's documents are toxic with a share of Beta(9, 1), a clean phrase's of Beta(1, 9).
TOXIC_SHARE, CLEAN_SHARE = (9.0, 1.0), (1.0, 9.0)
# Below this probability of being toxic a term is left out; its weight would be that small.
LEAST_BELIEF = 0.05
# Half of a document is added to either count, against certainty.
PRIOR = 0.5
# How strongly the regression's slopes are drawn towards 0.
SHRINKAGE = 3.0
# Terms of whose votes a task holds the sums, until it hands them on as they are.
HELD_TERMS = 150_000

# Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans({
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ı": "i"})
# Digits and signs that stand for letters.
STAND_INS = str.maketrans("0134578@$!|", "oieastbasil")
_STOOD_IN = re.compile(r"[0134578@$!|]+(?=[^\W\d_])")
_OTHER_SCRIPT = re.compile("[Ͱ-ӿı]")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str | None) -> list[str]:
    """The folded words of a text."""
    if not text:
        return []
    text = unicodedata.normalize("NFKC", text).lower()
    if _OTHER_SCRIPT.search(text):
        text = text.translate(LOOKALIKES)
    return _WORD.findall(_STOOD_IN.sub(lambda m: m.group().translate(STAND_INS), text))


def sketch(words: list[str]) -> int:
    """The least hash of the 5-word shingles; copies share it, near ones most often."""
    n = min(5, len(words))
    return min((xxhash.xxh3_64_intdigest(" ".join(words[i:i + n])) >> 1 for i in range(len(words) - n + 1)), default=0)


def _sketches(batches):
    for batch in batches:
        for piece in slices(batch, "text", 1 << 20):
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(1), pa.array([sketch(fold(t)) for t in column_text(piece, "text")], pa.int64())],
                names=["text", "label", "sketch"])


def _beginnings(words: set[str]) -> set[str]:
    return {f" {w[:n]}" for w in words for n in range(SHORTEST, min(LONGEST, len(w) - 1) + 1)}


def _phrases(words: list[str], of: set[str]) -> set[str]:
    """Each given word with the word before it, and with the one after it."""
    return {f" {' '.join(words[max(i, 0):i + 2])} " for k, w in enumerate(words) if w in of
            for i in (k - 1, k) if 0 <= i < len(words) - 1}


def _count_terms(terms_of):
    """Votes of toxic and of clean documents for each of a text's terms."""
    @released
    def run(batches):
        held: dict[str, list[float]] = {}

        def out():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), *(pa.array([v[k] for v in held.values()], pa.float64()) for k in (1, 0))],
                names=["term", "toxic", "clean"])
            held.clear()

        for batch in batches:
            for piece in slices(batch, "text", 1 << 20):
                for t, kind, vote in zip(column_text(piece, "text"), column_text(piece, "label"), column_text(piece, "vote")):
                    for term in terms_of(fold(t)):
                        held.setdefault(term, [0.0, 0.0])[kind] += vote
                if len(held) > HELD_TERMS:
                    yield from out()
        yield from out()

    return run


def evidence(toxic: float, clean: float, base: float, share: tuple[float, float] = TOXIC_SHARE) -> float:
    """Log of how much better a share of toxic documents drawn from a Beta distribution explains
    the counts than the share ``base`` of all documents."""
    a, b = share
    return (lgamma(a + b) - lgamma(a) - lgamma(b) + lgamma(toxic + a) + lgamma(clean + b) - lgamma(toxic + clean + a + b)
            - toxic * log(base) - clean * log(1 - base))


def toxic_share_of_terms(kinds: list[tuple[float, float, int]], base: float) -> float:
    """How large a part of the terms is toxic, by expectation-maximisation over
    ``(toxic, clean, how many terms have these counts)``."""
    odds = np.array([evidence(t, c, base) for t, c, _ in kinds])
    n = np.array([k for _, _, k in kinds], float)
    part = 0.01
    for _ in range(200):
        belief = 1 / (1 + np.exp(-np.clip(odds + log(part / (1 - part)), -500, 500)))
        new = min(0.5, max(1e-9, float((belief * n).sum() / n.sum())))
        if abs(new - part) < 1e-10:
            break
        part = new
    return part


@dataclass(frozen=True)
class Counts:
    """Votes of toxic and clean documents, and the part of the terms that is toxic."""

    toxic: float
    clean: float
    part: float

    @property
    def base(self) -> float:
        return self.toxic / (self.toxic + self.clean)

    def belief(self, toxic: float, clean: float) -> float:
        z = evidence(max(toxic, 0.0), max(clean, 0.0), self.base) + log(self.part / (1 - self.part))
        return 1 / (1 + exp(-max(-500.0, min(500.0, z))))

    def weight(self, toxic: float, clean: float) -> float:
        """The log-odds of the term's documents being toxic, as far as it is believed to be a toxic term."""
        odds = log((max(toxic, 0.0) + PRIOR) / (self.toxic + 2 * PRIOR)) - log((max(clean, 0.0) + PRIOR) / (self.clean + 2 * PRIOR))
        return max(0.0, odds) * self.belief(toxic, clean)


@dataclass
class Model:
    """Weights of terms, exception phrases, and the regression on top."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    coefficients: tuple[float, ...] | None = None

    def automaton(self) -> ahocorasick.Automaton:
        machine = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            machine.add_word(term, (term, weight))
        for phrase in self.exceptions:
            machine.add_word(f" {phrase} ", (f" {phrase} ", None))
        machine.make_automaton()
        return machine


def matches(machine: ahocorasick.Automaton, words: list[str]) -> list[tuple[str, float]]:
    """The terms found outside exception phrases, in order; of several at one word the weightiest."""
    if not words or not len(machine):
        return []
    found = [(end - len(term) + 1, end, term, weight) for end, (term, weight) in machine.iter(f" {' '.join(words)} ")]
    spared = [(a, b) for a, b, _, weight in found if weight is None]
    best: dict[int, tuple[str, float]] = {}
    for a, _, term, weight in found:
        if weight is not None and (a not in best or (best[a][1], best[a][0]) < (weight, term)):
            best[a] = term, weight
    hits, reach, spared = [], 0, sorted(spared, reverse=True)
    for a in sorted(best):
        while spared and spared[-1][0] <= a:  # how far the phrases that begin up to here go
            reach = max(reach, spared.pop()[1])
        if a >= reach:
            hits.append(best[a])
    return hits


def features(hits: list[tuple[str, float]], n_words: int) -> list[float]:
    total = sum(weight for _, weight in hits)
    return [1.0, np.log1p(total), np.log1p(100.0 * total / max(n_words, 1))]


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Weighted logistic regression by Newton steps; slopes are drawn towards 0, which few labels do not outweigh."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        shrink = np.diag([1e-2] + [SHRINKAGE] * (len(beta) - 1))
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + shrink,
                               x.T @ (weight * (y - p)) - shrink @ beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, beta))


def _believed(counted: DataFrame, counts: Counts) -> dict[str, tuple[float, float]]:
    """The terms that enter, with their votes. Each needs several toxic documents of the sample."""
    def run(batches):
        for batch in batches:
            pairs = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            known = {p: counts.belief(*p) for p in set(pairs)}
            yield batch.filter(pa.array([known[p] >= LEAST_BELIEF for p in pairs], pa.bool_()))

    summed = counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    return {r.term: (r.toxic, r.clean) for r in summed.filter("toxic > 0").mapInArrow(released(run), "term string, toxic double, clean double").collect()}


def learn(docs: DataFrame, labels: DataFrame, usable: Column | None = None, text: str = "text",
          doc_id: str = "doc_id", label: str = "toxic", sample: int = SAMPLE,
          exceptions: tuple[str, ...] = ()) -> Model:
    """A model from ``labels(doc_id, label 0/1)``; ``usable`` says which of its rows may teach.

    ``exceptions`` are phrases known to be harmless, besides those that the sample shows.
    """
    ship(docs)
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    if usable is not None:
        known = known.filter(usable)
    sizes = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    folded = tuple(" ".join(fold(e)) for e in exceptions)
    if len(sizes) < 2:
        return Model(exceptions=folded)
    low = [known.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    # at most 2 x sample rows of two numbers
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(low[0].unionByName(low[1])), "doc_id").select("text", "label")
    sketched = cluster.materialise(chosen.mapInArrow(released(_sketches), "text string, label int, sketch bigint"))
    copies = sketched.groupBy("sketch", "label").agg((1 / F.count("*")).alias("vote"))
    drawn = sketched.join(copies, ["sketch", "label"]).select("text", "label", "vote")
    totals = {r.label: (r.votes, r.n) for r in drawn.groupBy("label").agg(F.sum("vote").alias("votes"), F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return Model(exceptions=folded)
    (clean, n_clean), (toxic, n_toxic) = totals[0], totals[1]

    counted = cluster.materialise(drawn.mapInArrow(_count_terms(lambda words: {f" {w} " for w in words}), "term string, toxic double, clean double"))
    summed = counted.groupBy("term").agg(F.round(F.sum("toxic"), 1).alias("toxic"), F.round(F.sum("clean"), 1).alias("clean"))
    kinds = [tuple(r) for r in summed.groupBy("toxic", "clean").count().collect()]
    if not kinds:
        return Model(exceptions=folded)
    counts = Counts(toxic, clean, toxic_share_of_terms(kinds, toxic / (toxic + clean)))
    terms = _believed(counted, counts)
    words = {t.strip() for t in terms}
    others = drawn.mapInArrow(_count_terms(lambda ws: _beginnings(set(ws) - words)), "term string, toxic double, clean double")
    terms |= _believed(others, counts)
    spared = folded + _clean_phrases(drawn, terms, words)
    model = Model({t: counts.weight(*votes) for t, votes in terms.items()}, spared)

    def measure(batches):
        machine = model.automaton()
        for batch in batches:
            for piece in slices(batch, "text", 1 << 20):
                values = []
                for t, kind, vote in zip(column_text(piece, "text"), column_text(piece, "label"), column_text(piece, "vote")):
                    own = (vote, 0.0) if kind else (0.0, vote)
                    ws = fold(t)
                    # without the document's own vote, as for one that was not learnt from
                    hits = [(term, counts.weight(*(v - o for v, o in zip(terms[term], own)))) for term, _ in matches(machine, ws)]
                    values.append(features(hits, len(ws)))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(1), piece.column(2), pa.array(values, pa.list_(pa.float64()))], names=["label", "vote", "x"])

    table = drawn.mapInArrow(released(measure), "label int, vote double, x array<double>").collect()
    y = np.array([r.label for r in table], float)
    share = np.array([sizes[0] / max(n_clean, 1), sizes[1] / max(n_toxic, 1)])
    model.coefficients = _fit(np.array([r.x for r in table]), y, share[y.astype(int)] * np.array([r.vote for r in table]))
    return model


def _clean_phrases(drawn: DataFrame, terms: dict[str, tuple[float, float]], words: set[str]) -> tuple[str, ...]:
    """Phrases of a word of the lexicon and a neighbour that are better explained as mostly clean
    than by the share of toxic documents that the word has by itself."""
    if not words:
        return ()
    rows = drawn.mapInArrow(_count_terms(lambda ws: _phrases(ws, words)), "term string, toxic double, clean double").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter("clean > 0").collect()
    out = []
    for r in rows:
        shares = [(t + PRIOR) / (t + c + 2 * PRIOR) for t, c in (terms[f" {w} "] for w in r.term.split() if w in words)]
        # as rare a thing as a toxic term: it takes more than a single document
        if evidence(r.toxic, r.clean, min(shares), CLEAN_SHARE) > log((1 - LEAST_BELIEF) / LEAST_BELIEF * len(rows)):
            out.append(r.term.strip())
    return tuple(sorted(out))


FIELDS = T.StructType([T.StructField("score", T.DoubleType(), False),
                       T.StructField("predicted", T.IntegerType(), False),
                       T.StructField("terms", T.ArrayType(T.StringType(), False), False)])


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (1 from 0.5 on) and the ``terms`` found."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value
        machine = model.automaton()
        beta = model.coefficients

        def one(words):
            hits = matches(machine, words)
            if beta is None:
                return 0.0, []
            z = sum(b * x for b, x in zip(beta, features(hits, len(words))))
            return float(1 / (1 + np.exp(-np.clip(z, -500, 500)))), [t.strip() for t, _ in hits]

        def step(piece):
            out = [one(fold(t)) for t in column_text(piece, text)]
            scores = [s for s, _ in out]
            return [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                    pa.array([t for _, t in out], pa.list_(pa.string()))]
        return step

    return with_columns(docs, text, FIELDS, start, 1 << 20)
