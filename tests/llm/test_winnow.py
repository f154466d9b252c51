"""Winnowing against its definition in plain Python, and its match guarantee."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from rankloom.llm import queries, winnow


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]


def polynomial(values, prime, start=None):
    h = values[0] % prime if start is None else start
    for v in values[1 if start is None else 0:]:
        h = (h * winnow.BASE + v % prime) % prime
    return h


def brute(values):
    """Marks ``(hash, place)`` of word hashes: chosen by the first polynomial, told apart by both."""
    if not values:
        return []
    both = lambda part, start=None: [polynomial(part, p, start) for p in (winnow.PRIME, winnow.SECOND_PRIME)]
    if len(values) < winnow.GRAM:
        first, second = both(values, len(values))
        return [(first * 2 ** 31 + second, 0)]
    grams = [both(values[i:i + winnow.GRAM]) for i in range(len(values) - winnow.GRAM + 1)]
    out = []
    for i in range(max(1, len(grams) - winnow.WINDOW + 1)):
        part = [first for first, _ in grams[i:i + winnow.WINDOW]]
        place = i + max(j for j, h in enumerate(part) if h == min(part))
        mark = grams[place][0] * 2 ** 31 + grams[place][1], place
        if mark not in out[-1:]:
            out.append(mark)
    return out


def parsed(text):
    return [(int(h, 16), int(p)) for p, h in (m.split(":") for m in text.split())]


def alike(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def word_table(spark, texts):
    found = {w for t in texts for w in words(t)}
    rows = spark.createDataFrame([(w,) for w in sorted(found)], "w string").select(
        "w", F.xxhash64("w").alias("h")).collect()
    return {r.w: r.h for r in rows}


def test_query(spark, sf, documents):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    ids = sorted(texts, reverse=True)
    following = dict(zip(ids, ids[1:] + ids[:1]))
    edited = {i: t[:len(t) - len(t) // 2] + texts[following[i]][:len(t) // 2] for i, t in texts.items()}
    table = word_table(spark, [*texts.values(), *edited.values()])
    own = {i: brute([table[w] for w in words(t)]) for i, t in texts.items()}
    changed = {i: brute([table[w] for w in words(t)]) for i, t in edited.items()}
    rows = queries.op1_winnow(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        i = r.doc_id
        assert r.n_chars == len(texts[i])
        assert r.edited_sha256 == hashlib.sha256(edited[i].encode()).hexdigest()
        assert parsed(r.fingerprint) == own[i] and parsed(r.edited_fingerprint) == changed[i]
        assert r.near_edited == pytest.approx(alike(own[i], changed[i]))
        assert r.near_next == pytest.approx(alike(own[i], own[following[i]]))


def test_shared_passages_share_a_hash(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    size = winnow.GRAM + winnow.WINDOW - 1
    rows = []
    for i in range(40):
        passage = rng.choices(vocabulary, k=size)
        rows += [(2 * i + k, " ".join(rng.choices(vocabulary, k=rng.randrange(20)) + passage
                                      + rng.choices(vocabulary, k=rng.randrange(20)))) for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: set(r.h) for r in winnow.fingerprints(docs).select("doc_id", winnow.hashes(F.col("marks")).alias("h")).collect()}
    assert all(got[2 * i] & got[2 * i + 1] for i in range(40))


def test_ties_take_the_rightmost(spark):
    docs = spark.createDataFrame([(1, "a " * 20)], "doc_id bigint, text string")
    marks = parsed(winnow.fingerprints(docs).select(winnow.shown(F.col("marks")).alias("m")).first().m)
    assert [p for _, p in marks] == list(range(winnow.WINDOW - 1, 16))


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(5, None, 1), (-9, "One two", 1), (10 ** 15, "x " * 20_000, 1), (10 ** 15, "tie", 1), (None, "no id here at all", 1), (7, "😀é", None)],
        "doc_id bigint, text string, marks int")
    rows = winnow.edited_fingerprints(docs).select("doc_id", "n_chars", "edited", winnow.shown(F.col("marks")).alias("m")).collect()
    assert len(rows) == 6
    got = {(r.doc_id, r.n_chars): r for r in rows}
    assert got[5, 0].m == "" and got[5, 0].edited == ""
    assert got[7, 2].edited == "😀" and got[None, 17].edited == "no id her"
    assert got[-9, 7].edited == "One x x"[:4] + ("x x" if got[-9, 7].edited.endswith("x x") else "tie")
    assert winnow.edited_fingerprints(docs.limit(0)).collect() == []
