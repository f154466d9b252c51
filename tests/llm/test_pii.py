"""Personal data: strict spans against the plain patterns, votes, estimates and masking."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from rankloom.llm import pii, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def strict(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            v, d = m.group(), re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in v.split(".")),
                    "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = pii.find(docs, pii.train(docs)).select(
        "doc_id", pii.listed(F.col("base")).alias("base"), pii.listed(F.col("spans")).alias("spans"))
    return {r.doc_id: (r.base, r.spans) for r in rows.collect()}


def test_query(spark, sf, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = queries.op5_pii(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = strict(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(filter(None, r.spans.split(",")))
        assert r.n_email == sum(b.startswith("email") for b in base) and r.n_card == sum(b.startswith("card") for b in base)


def test_strict_spans_on_tangled_texts(spark):
    rng = random.Random(5)
    parts = ["a@b.c", "x.y_z%@w-1.co.uk", "@", "..", "1.2.3.4", "256.1.1.1", "001.02.3.4", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111",
             "4111-1111-1111-1111", "4111111111111112", "+1 (234) 555-0199", "+49.30.1234567", "+12", "++1 22", "é😀", " ", "-", "_",
             "12", "0", "\n", "%", "", "a b", "7 7 7"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(1500)]
    got = found(spark, texts)
    for i, t in enumerate(texts):
        assert got[i][0] == ",".join(strict(t)), t


def test_edge_cases(spark):
    texts = [None, "", "a" * 300_000 + "@", "1 " * 100_000, "1." * 10_000, "+" * 100_000 + "1", "😀 me@x.org", "a@" + "b." * 100_000 + "b"]
    got = found(spark, texts)
    assert got[0] == got[1] == ("", "")
    assert [got[i][0] for i in range(8)] == [",".join(strict(t) if i != 2 else []) for i, t in enumerate(texts)]
    empty = spark.createDataFrame([], "doc_id bigint, text string, base string")
    assert pii.find(empty, pii.train(empty)).collect() == []


def test_looser_spans_join_the_strict_ones(spark):
    texts = [f"call +1 (212) 555-01{i:02d} or mail me{i}@site.org from 10.{i}.3.4" for i in range(60)]
    texts += [f"phone (212) 555-01{i:02d} or mail me{i} [at] site [dot] org" for i in range(20)]
    texts += ["plain words without any of it"] * 20
    got = found(spark, texts)
    assert all(got[i][0] == got[i][1] != "" for i in range(60))
    assert all(got[i][0] == "" and "email:" in got[i][1] for i in range(60, 80))
    assert all(got[i] == ("", "") for i in range(80, 100))


def test_gazetteers(spark):
    """Listed and unlisted values; a table of the caller's own in place of the common entries."""
    votes = [("email", "a@b.com", 1), ("email", "a@b.CO.UK", 1), ("email", "a@b.zzz", 0), ("email", "x [at] y [dot] org", 1), ("email", "a@b", 0),
             ("ip", "10.1.2.3", -1), ("ip", "172.31.0.1", -1), ("ip", "172.32.0.1", 0), ("ip", "8.8.8.8", 0), ("ip", "ab:cd:1:2:3:4:5:6", 0),
             ("card", "4111 1111 1111 1111", 1), ("card", "2720-9900-0000-0000", 1), ("card", "2721990000000000", 0), ("card", "1234567890123", 0),
             ("phone", "+1 212 555 0100", 1), ("phone", "+212.555.0100", 1), ("phone", "+999 12345678", 0), ("phone", "(212) 555-0100", 0)]
    rows = spark.createDataFrame(votes, "kind string, value string, vote int")

    def got(gazetteer):
        vote = pii._by_kind(F.col("kind"), lambda k: gazetteer.votes(k, F.col("value")))
        return {(r.kind, r.value): r.v for r in rows.select("kind", "value", vote.alias("v")).collect()}

    assert got(pii.common_gazetteer(spark)) == {(k, v): n for k, v, n in votes}
    table = spark.createDataFrame([("email", " ZZZ "), ("email", "zzz"), ("email", None), ("ip", "8.8.0.0/16"), ("card", "1234"), ("phone", "+999"),
                                   ("other", "x"), (None, "y")], "kind string, entry string")
    own = got(pii.read_gazetteer(table))
    assert {k for k, v in own.items() if v} == {("email", "a@b.zzz"), ("ip", "8.8.8.8"), ("card", "1234567890123"), ("phone", "+999 12345678")}
    assert not any(got(pii.read_gazetteer(table.limit(0))).values())
    docs = spark.createDataFrame([(1, "mail a@b.zzz now")], "doc_id bigint, text string")
    assert pii.find(docs, pii.train(docs, gazetteer=pii.read_gazetteer(table))).first().base[0].kind == "email"


def test_masking(spark):
    docs = spark.createDataFrame([("é a@b.org, 10.0.0.1!",), (None,), ("none",)], "text string")
    rows = pii.find(docs, pii.train(docs)).select(pii.masked(F.col("text"), F.col("base")).alias("m")).collect()
    assert [r.m for r in rows] == ["é <EMAIL>, <IP>!", None, "none"]


def test_estimates_tell_reliable_from_unreliable_labelers():
    good, bad = (1, 1, 1, 0, 1), (0, -1, 0, -1, -1)
    beliefs = pii.estimate([("email", good, 1, 900), ("email", bad, 1, 300), ("email", (0, 1, 1, 0, 1), 1, 20)])
    assert beliefs["email", good, 1] > 0.9 > 0.5 > beliefs["email", bad, 1]
    assert beliefs["email", (0, 1, 1, 0, 1), 1] > 0.5
