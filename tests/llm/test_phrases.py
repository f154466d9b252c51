"""Phrases against counts in plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rankloom.llm import phrases
from rankloom.llm.phrases import mine_phrases

SCHEMA = "doc_id bigint, text string, lang string, n bigint"


def brute(rows, least, top, longest=4):
    counts, words = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            ws = re.findall(r"[^\x20\x09]+", piece)
            words[lang or "und"] += len(ws)
            for n in range(1, longest + 1):
                counts[lang or "und"].update(tuple(ws[i:i + n]) for i in range(len(ws) - n + 1))
    out = {}
    for lang, f in counts.items():
        cands = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        rows = []
        for g, a in cands.items():
            if any(100 * b >= 80 * a and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1))
                   for h, b in cands.items() if len(h) > len(g)):
                continue
            score, k = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out[lang, i] = (phrase.decode(), -a, left, right, words[lang], -score)
    return out


def found(df):
    return {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


def texts(seed, count=150):
    rng = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(12)] + ["été", "λόγος", "𝒳", "a b", "\x00"]
    fixed = [rng.choices(vocabulary, k=n) for n in (2, 3, 4, 4, 6)]
    rows = []
    for i in range(count):
        parts = []
        for _ in range(rng.randrange(0, 20)):
            parts += rng.choice(fixed) if rng.random() < 0.4 else [rng.choice(vocabulary)]
            parts.append(rng.choice([" ", "  ", "\t", " ", ", ", "\n", ".", " ;", "\r\n"]))
        rows.append((rng.choice([i, None]), rng.choice(["", " "]).join(" " + p if not p.strip() or p in ",.;" else p + " " for p in parts),
                     rng.choice(["en", "en", "de", None, "und"]), None))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_tangled_texts(spark, monkeypatch, seed):
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 150)
    rows = texts(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for least, top, longest in ((4, 2000, 4), (3, 17, 3)):
        want = brute(rows, least, top, longest)
        assert want and found(mine_phrases(docs, least=least, top=top, longest=longest)) == want


def test_heavy_parts_and_joins_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(phrases.cluster, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(phrases, "HEAVY", 8)
    monkeypatch.setattr(phrases, "RECOUNTED", 10)
    rows = texts(4)
    assert found(mine_phrases(spark.createDataFrame(rows, SCHEMA), least=4)) == brute(rows, 4, 2000)


def test_colliding_fingerprints_are_found(spark, monkeypatch):
    """A count that the texts do not bear out makes another seed do the work again."""
    rows = texts(5)
    docs = spark.createDataFrame(rows, SCHEMA)
    good, seeds = phrases._mine, []

    def broken(blocks, least, top, longest, seed):
        seeds.append(seed)
        result = good(blocks, least, top, longest, seed)
        return result.withColumn("a", result.a + 1) if not seed else result

    monkeypatch.setattr(phrases, "_mine", broken)
    assert found(mine_phrases(docs, least=4)) == brute(rows, 4, 2000) and seeds == [0, 1]


def test_fingerprints():
    row = {"block": 1, "langs": ["x", "y"], "doc_langs": phrases.pack(np.array([0, 1], np.uint32)),
           "sizes": phrases.pack(np.array([5, 5], np.uint32)), "codes": phrases.pack(np.array([1, 2, 1, 2, 0, 1, 2, 1, 2, 0], np.uint32)),
           "words": phrases.zstandard.ZstdCompressor().compress(b"p\nq")}
    block = phrases.Block(row, 0)
    for side in (0, 1):
        two = block.keys(2, side, np.arange(9))
        assert two[0] == two[2] != two[1] and two[5] == two[7] != two[0]
        three = block.keys(3, side, np.array([0, 1, 5]))
        assert three[0] != three[1] and three[0] != three[2] and len(block.keys(11, side, np.arange(0))) == 0
    assert block.whole(2).tolist() == [True, True, True, False, False, True, True, True, False]


def test_edge_cases(spark):
    rows = [(1, None, "en", 1), (2, "", None, 1), (3, " ., ;\n", "en", 1), (4, "a b " * 40_000, "en", 1), (4, "a b " * 40_000, "en", 1),
            (5, "x" * 200_000 + " y", "fr", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(mine_phrases(docs)) == brute(rows, 30, 2000)
    assert mine_phrases(docs.limit(0)).collect() == []
    assert mine_phrases(docs.filter("doc_id < 4")).collect() == []
