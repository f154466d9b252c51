"""Language identification by rank-order profiles.

A profile lists the most frequent 1- to 3-grams of the letters of a text, words padded
with blanks, by falling count and then by code. A document gets the language whose
profile has the smallest out-of-place distance: the sum, over the document's n-grams, of
how far their places differ, a missing n-gram counting as far as the profile is long.

Rows: a text that is null or has no letter is ``und`` with score 0; equal distances go to
the language that sorts first; without anything to learn from, every text is ``und``.
Rows without a language, or outside the learning folds, teach nothing. Texts are taken
whole. A column of the input called ``lang_pred`` or ``score`` is replaced.
"""

from __future__ import annotations

import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm.common import column_text, ship, slices, with_columns

PROFILE = 300
# Distinct n-grams that a learning task counts before it hands them on.
HELD_NGRAMS = 500_000
# Profiles go to every executor: 300 rows per language, so this many are about 25 MB.
MOST_LANGUAGES = 5_000

# Letters are what Unicode calls so (category L): the characters of words without number signs as in "½ Ⅷ ²".
# The signs make a class that is slow to test, so they are looked for in what the words hold.
_NUMBER_SIGNS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and unicodedata.category(c)[0] == "N")
_IS_SIGN = np.zeros(sys.maxunicode + 1, np.bool_)
_IS_SIGN[[ord(c) for c in _NUMBER_SIGNS]] = True
PLAIN = re.compile(r"[^\W\d_]+")
LETTERS = re.compile(rf"[^\W\d_{_NUMBER_SIGNS}]+")
STEP_BYTES = 1 << 20


def _letters(words: re.Pattern, text: str) -> np.ndarray:
    """The characters of the words, with blanks around each."""
    return np.frombuffer(f" {' '.join(words.findall(text))} ".encode("utf-32-le"), np.uint32).astype(np.int64)


def ngram_codes(text: str | None) -> np.ndarray:
    """Every 1- to 3-gram of the padded words, as 21 bits per character."""
    lowered = (text or "").lower()
    c = _letters(PLAIN, lowered)
    if not lowered.isascii() and _IS_SIGN[c].any():
        c = _letters(LETTERS, lowered)
    if len(c) < 3:
        return np.empty(0, np.int64)
    pairs = c[:-1] << 21 | c[1:]
    triples = pairs[:-1] << 21 | c[2:]
    # a blank in the middle would join two words
    return np.concatenate([c[c != 32], pairs, triples[c[1:-1] != 32]])


def profile_of(text: str | None, size: int = PROFILE) -> np.ndarray:
    """The codes of the most frequent n-grams, in order."""
    codes, counts = np.unique(ngram_codes(text), return_counts=True)
    return codes[np.lexsort((codes, -counts))[:size]]


def _count_ngrams(text: str, lang: str):
    def run(batches):
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out():
            for name, (codes, counts) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(codes), pa.string()), pa.array(codes), pa.array(counts)],
                    names=["lang", "code", "n"])
            held.clear()

        for batch in batches:
            for piece in slices(batch, text, STEP_BYTES):
                groups: dict[str, list[np.ndarray]] = {}
                for t, name in zip(column_text(piece, text), column_text(piece, lang)):
                    groups.setdefault(name, []).append(ngram_codes(t))
                for name, parts in groups.items():
                    codes, counts = np.unique(np.concatenate(parts), return_counts=True)
                    if name in held:
                        both = np.concatenate([held[name][0], codes])
                        codes, place = np.unique(both, return_inverse=True)
                        counts = np.bincount(place, np.concatenate([held[name][1], counts])).astype(np.int64)
                    held[name] = codes, counts
                if sum(len(c) for c, _ in held.values()) > HELD_NGRAMS:
                    yield from out()
        yield from out()

    return run


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang",
                   size: int = PROFILE) -> DataFrame:
    """``(lang, code, place)`` from all rows of ``docs`` that have a language."""
    ship(docs)
    known = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = (known.mapInArrow(_count_ngrams("text", "lang"), "lang string, code bigint, n bigint")
              .groupBy("lang", "code").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    return (counts.withColumn("place", F.row_number().over(order) - 1)
            .filter(F.col("place") < size).select("lang", "code", "place"))


class Profiles:
    """The places of every n-gram in all profiles, as a table for numpy."""

    def __init__(self, rows: list, size: int):
        self.size = size
        self.langs = sorted({r.lang for r in rows})
        self.codes = np.array(sorted({r.code for r in rows}), np.int64)
        self.places = np.full((len(self.codes) + 1, len(self.langs)), -1, np.int32)
        column = {name: i for i, name in enumerate(self.langs)}
        for r in rows:
            self.places[np.searchsorted(self.codes, r.code), column[r.lang]] = r.place

    def distances(self, text: str | None) -> tuple[np.ndarray, int]:
        """Distance per language, and the largest distance there could be."""
        own = profile_of(text, self.size)
        if not len(own) or not self.langs:
            return np.zeros(0), 0
        at = np.searchsorted(self.codes, own)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != own)] = len(self.codes)
        places = self.places[at]
        apart = np.where(places < 0, self.size, np.abs(places - np.arange(len(own))[:, None]))
        return apart.sum(axis=0), self.size * len(own)

    def predict(self, text: str | None) -> tuple[str, float]:
        apart, most = self.distances(text)
        if not most:
            return "und", 0.0
        best = int(np.argmin(apart))
        return self.langs[best], 1.0 - float(apart[best]) / most


def identify(docs: DataFrame, profiles: DataFrame, text: str = "text",
             size: int = PROFILE) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the closeness to the chosen profile (0 to 1)."""
    rows = profiles.limit(MOST_LANGUAGES * size + 1).collect()
    if len(rows) > MOST_LANGUAGES * size:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    shared = docs.sparkSession.sparkContext.broadcast(Profiles(rows, size))
    fields = T.StructType([T.StructField("lang_pred", T.StringType(), False),
                           T.StructField("score", T.DoubleType(), False)])

    def start():
        model = shared.value

        def step(piece):
            out = [model.predict(t) for t in column_text(piece, text)]
            return [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())]
        return step

    return with_columns(docs, text, fields, start, STEP_BYTES)
