"""M1-M3: what one matched term adds to a document's score, as Column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

IDF_POWER = 1


@dataclass(frozen=True)
class Model:
    """``Model("jm", 0.5)``, ``Model("dir", 2500)`` or ``Model("tfidf")``."""

    kind: str
    param: float | None = None

    def __post_init__(self):
        if self.kind not in ("jm", "dir", "tfidf"):
            raise ValueError(f"model must be jm, dir or tfidf, not {self.kind!r}")
        if self.kind == "jm" and not (self.param is not None and 0 < self.param <= 1):
            raise ValueError("jm needs a lambda above 0 and up to 1")
        if self.kind == "dir" and not (
                self.param is not None and 0 <= self.param and math.isfinite(self.param)):
            raise ValueError("dir needs a mu of 0 or more")

    @property
    def flat(self) -> bool:
        """Whether every match scores 0, so that documents rank by order of insertion."""
        return (self.kind, self.param) in (("jm", 1), ("dir", 0))

    def term_score(self) -> Column:
        """Uses columns ``tf``, ``doc_len``, ``p`` and ``idf`` of a matched posting."""
        if self.kind == "jm":
            return _jelinek_mercer(float(self.param))
        if self.kind == "dir":
            return _dirichlet(float(self.param))
        return F.sqrt("tf") * F.pow("idf", F.lit(float(IDF_POWER))) / F.sqrt("doc_len")

    def bound(self) -> Column:
        """What ``term_score`` cannot exceed, from ``max_tf``, ``min_len``, ``max_share`` (of tf over
        doc_len), ``p`` and ``idf`` of a term; all three models only grow with a term's share."""
        if self.kind == "jm":
            lam = float(self.param)
            return F.log(1.0 + F.lit(1.0 - lam) * F.col("max_share") / (F.lit(lam) * F.col("p")))
        if self.kind == "dir":
            mu = float(self.param)
            if mu == 0:
                return F.lit(0.0)
            # the shortest document that the greatest tf fits into
            least = F.greatest(F.col("min_len"), F.col("max_tf") / F.col("max_share"))
            return F.greatest(F.lit(0.0), F.log((F.lit(mu) + F.col("max_tf") / F.col("p")) / (least + F.lit(mu))))
        return F.sqrt("max_share") * F.pow("idf", F.lit(float(IDF_POWER)))


def _jelinek_mercer(lam: float) -> Column:
    seen = (F.lit(1.0 - lam) * F.col("tf")) / F.col("doc_len")
    return F.log(1.0 + seen / (F.lit(lam) * F.col("p")))


def _dirichlet(mu: float) -> Column:
    if mu == 0:  # infinity minus infinity in the formula; a match then scores nothing
        return F.lit(0.0)
    gain = F.log(1.0 + F.col("tf") / (F.lit(mu) * F.col("p")))
    norm = F.log(F.lit(mu) / (F.col("doc_len") + F.lit(mu)))
    return F.greatest(F.lit(0.0), gain + norm)


def collection_probability(ctf: Column, total_terms: int) -> Column:
    return (ctf + 1.0) / F.lit(total_terms + 1.0)


def inverse_document_frequency(df: Column, doc_count: int) -> Column:
    return 1.0 + F.log(F.lit(doc_count + 1.0) / (df + 1.0))
