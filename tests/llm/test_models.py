"""Language identification, toxicity and sharding: held-out accuracy, laws and edge cases."""

import hashlib
import math
import random
import re
import sys
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from rankloom.llm import langid, queries, sharding, toxicity

SF = "/root/testdata/sf0.01"


def test_languages_on_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in queries.table(spark, SF, "documents").collect()}
    rows = queries.op10_langid(spark, SF).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_profiles_against_plain_counts(spark):
    docs = spark.createDataFrame([("ab ab c", "x"), ("ab", "x"), ("zz", "y"), (None, "y"), ("q", None)], "text string, lang string")
    counts = defaultdict(Counter)
    for text, lang in [("ab ab c", "x"), ("ab", "x"), ("zz", "y")]:
        s = f" {text} "
        grams = [s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)]
        counts[lang].update(g for g in grams if g != " " and not (len(g) == 3 and g[1] == " "))
    code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    want = {(lang, code(g), place) for lang, c in counts.items()
            for place, g in enumerate(sorted(c, key=lambda g: (-c[g], code(g))))}
    assert {tuple(r) for r in langid.learn_profiles(docs).collect()} == want


def test_letters_are_category_l(spark):
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    assert set("".join(langid.LETTERS.findall(every))) == {c for c in every if unicodedata.category(c)[0] == "L"}
    learned = spark.createDataFrame([("la casa", "es"), ("the house", "en")], "text string, lang string")
    docs = spark.createDataFrame([(1, "½ ²"), (2, "Ⅷ ٣ 五"), (3, "Ⅷ ٣ _")], "doc_id bigint, text string")
    rows = langid.identify(docs, langid.learn_profiles(learned)).collect()
    assert [r.lang_pred == "und" for r in rows] == [True, False, True]


def test_predictions_against_plain_distances(spark):
    docs = queries.table(spark, SF, "documents").select("doc_id", "text", "lang")
    plain = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    code = lambda g: [ord(c) for c in g]

    def grams(t):
        s = f" {' '.join(plain(t))} " if plain(t) else ""
        return Counter(g for n in (1, 2, 3) for g in (s[i:i + n] for i in range(len(s) - n + 1)) if g != " " and g[1:2] != " " or len(g) == 2)

    def profile(counts):
        return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], len(x[0]), code(x[0])))[:langid.PROFILE]]

    rows = docs.collect()
    counts = defaultdict(Counter)
    for r in rows:
        if r.lang and not held(r.doc_id):
            counts[r.lang].update(grams(r.text))
    places = {lang: {g: i for i, g in enumerate(profile(c))} for lang, c in sorted(counts.items())}
    want = {}
    for r in rows:
        own = profile(grams(r.text))
        apart = {lang: sum(abs(i - p[g]) if g in p else langid.PROFILE for i, g in enumerate(own)) for lang, p in places.items()}
        best = min(sorted(apart), key=apart.get)
        want[r.doc_id] = (best, 1 - apart[best] / (langid.PROFILE * len(own))) if own else ("und", 0.0)
    got = {r.doc_id: (r.lang_pred, r.score) for r in queries.op10_langid(spark, SF).collect()}
    assert {i: g[0] for i, g in got.items()} == {i: w[0] for i, w in want.items()}
    assert all(abs(got[i][1] - want[i][1]) < 1e-12 for i in want)


def test_language_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "12 !?", 1), (4, "la casa", 1), (4, "la casa", 1), (5, "la " * 50_000, None)],
                                 "doc_id bigint, text string, score int")
    learned = spark.createDataFrame([("la casa de la rosa", "es"), ("the house of the rose", "en")], "text string, lang string")
    rows = langid.identify(docs, langid.learn_profiles(learned)).collect()
    assert [r.lang_pred for r in rows] == ["und", "und", "und", "es", "es", "es"] and rows[0].score == 0
    none = langid.learn_profiles(learned.limit(0))
    assert {r.lang_pred for r in langid.identify(docs, none).collect()} == {"und"}
    assert langid.identify(docs.limit(0), none).collect() == []


def test_toxicity_on_held_out_documents(spark):
    truth = {r.doc_id: r.toxic for r in queries.table(spark, SF, "labels").collect()}
    rows = queries.op6_toxicity(spark, SF).collect()
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    pos, neg = (np.array([s for s, y in held if y == k]) for k in (1, 0))
    auc = np.mean([(p > neg).mean() + (p == neg).mean() / 2 for p in pos])
    assert auc > 0.85


def test_folding_exceptions_and_length():
    assert toxicity.fold("You 1D10T, cl0wn! ѕсum $cum") == ["you", "idiot", "clown", "scum", "scum"]
    assert toxicity.fold(None) == toxicity.fold("!!! 12") == []
    model = toxicity.Model({" trash ": 2.0, " lowe": 3.0}, ("trash can", "lowen"), (-1.0, 1.0, 1.0))
    machine = model.automaton()
    assert [t for t, _ in toxicity.matches(machine, "the trash can is trash loweist lowen".split())] == [" trash ", " lowe"]
    short, long = (toxicity.features([("trash", 2.0)], n)[2] for n in (5, 500))
    assert short > long


def test_matches_and_scores_against_plain_search(spark):
    """Every pattern tried at every word, phrases by splitting, the regression written out."""
    rng = random.Random(7)
    vocabulary = ["tra", "trash", "trashy", "can", "clown", "clo", "fish", "a", "bin", "trasher", "été"]
    weights = {" trash ": 2.0, " tras": 1.5, " clown ": 3.0, " clo": 0.5, " été ": 1.0}
    phrases = ("trash can", "clown fish", "a trash can bin", "can trash")
    model = toxicity.Model(weights, phrases, (-2.0, 0.7, 0.4))
    machine, rows = model.automaton(), []
    for i in range(400):
        words = rng.choices(vocabulary, k=rng.randrange(0, 14))
        spared = {i + j for p in phrases for i in range(len(words)) if words[i:i + len(p.split())] == p.split() for j in range(len(p.split()))}
        want = []
        for at, word in enumerate(words):
            own = [(v, t) for t, v in weights.items() if (t == f" {word} " or (not t.endswith(" ") and word.startswith(t[1:])))]
            if own and at not in spared:
                want.append(max(own)[::-1])
        assert toxicity.matches(machine, words) == want
        total = sum(v for _, v in want)
        z = -2.0 + 0.7 * math.log1p(total) + 0.4 * math.log1p(100 * total / max(len(words), 1))
        rows.append((i, " ".join(words), 1 / (1 + math.exp(-z))))
    got = toxicity.score(spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string"), model).collect()
    assert all(abs(r.score - rows[r.doc_id][2]) < 1e-12 and r.predicted == (rows[r.doc_id][2] >= 0.5) for r in got)


def test_belief_grows_with_evidence_and_copies_count_once(spark):
    counts = toxicity.Counts(10.0, 60.0, 0.003)
    beliefs = [counts.belief(t, 0) for t in range(8)]
    assert beliefs == sorted(beliefs) and beliefs[1] < 0.05 < beliefs[3] and counts.belief(4, 4) < counts.belief(4, 0) / 2
    assert counts.weight(5, 0) > counts.weight(5, 2) > 0 == counts.weight(0, 5)
    words = [f"{a}{b}" for a in "bcdfghklm" for b in "aeiou"]
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(words, k=20) + ["nasty"] * (i % 4 == 0)), int(i % 4 == 0)) for i in range(120)]
    rows += [(1000 + i, " ".join(["copied"] + words[:20]), 1) for i in range(40)]  # one text, 40 times
    rows += [(2000 + i, " ".join(rng.choices(words, k=20) + ["nasty", "weather"]), 0) for i in range(12)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    model = toxicity.learn(docs, labels, exceptions=("Nasty Habit",))
    assert model.weights.get(" copied ", 0) < model.weights[" nasty "] / 5 and " weather " not in model.weights
    assert model.exceptions == ("nasty habit", "nasty weather")
    scores = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(scores[r[0]].predicted == r[2] for r in rows if r[0] < 1000 or r[0] >= 2000)


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "idiot", 1), (3, "x " * 50_000, 1), (3, "idiot", None)],
                                 "doc_id bigint, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (99, 1), (None, 1)], "doc_id bigint, toxic int")
    rows = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
    assert len(rows) == 5 and len({r.score for r in rows[:2]}) == 1
    unlabelled = toxicity.learn(docs, labels.limit(0))
    assert [r.score for r in toxicity.score(docs, unlabelled).collect()] == [0.0] * 5
    assert toxicity.score(docs.limit(0), unlabelled).collect() == []


def test_shards(spark, sf, documents):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    rows = queries.op7_sharding(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(texts)
    slots = defaultdict(list)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 24) and 0 <= r.shard < 24
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_descent_in_plain_python(spark):
    """At every level the child with the least draw for its weight, drawn from its own name alone."""
    rng = random.Random(5)
    tree = [sharding.Leaf(s // 6, s // 2, s, rng.choice([0.5, 1.0, 3.0])) for s in range(24)]

    def shard(key):
        left = tree
        for level in ("region", "rack", "shard"):
            weights = defaultdict(float)
            for t in left:
                weights[getattr(t, level)] += t.weight
            if len(weights) > 1:
                def draw(n):
                    digest = hashlib.md5(f"{key}|{level}{n}".encode()).hexdigest()[:12]
                    return -math.log((int(digest, 16) + 0.5) / 16 ** 12) / weights[n]
                name = min(weights, key=draw)
            else:
                name = next(iter(weights))
            left = [t for t in left if getattr(t, level) == name]
        return left[0].shard

    ids = [*range(300), -5, 2 ** 62, None]
    got = spark.createDataFrame([(i,) for i in ids], "id bigint").select("id", sharding.shard_of(tree, F.col("id")).alias("s")).collect()
    assert {r.id: r.s for r in got} == {i: shard("null" if i is None else i) for i in ids}


def test_shares_follow_weights_and_movement_stays_in_the_changed_subtree(spark):
    ids = spark.range(20_000)
    tree = sharding.regular_tree(24)
    heavier = [sharding.Leaf(t.region, t.rack, t.shard, 3.0 if t.shard == 7 else 1.0) for t in tree]
    rows = ids.select(sharding.shard_of(tree, F.col("id")).alias("a"), sharding.shard_of(heavier, F.col("id")).alias("b")).collect()
    even = Counter(r.a for r in rows)
    assert all(abs(n - 20_000 / 24) < 6 * (20_000 / 24) ** 0.5 for n in even.values()) and len(even) == 24
    region = lambda s: s // 6
    moved = [r for r in rows if r.a != r.b]
    assert moved and all(region(r.b) == region(7) for r in moved)
    assert abs(Counter(r.b for r in rows)[7] / 20_000 - 3 / 26) < 0.02


def test_sharding_edge_cases(spark, monkeypatch):
    docs = spark.createDataFrame([(1, None, 1), (1, "a", 1), (1, "a", 1), (None, "b", 1), (None, None, None)], "doc_id bigint, text string, shard int")
    tree = sharding.regular_tree(3)
    rows = sharding.assign_shards(docs, tree, sharding.grown_tree(tree)).collect()
    assert len(rows) == 5 and len({r.shard for r in rows if r.doc_id == 1}) == 1
    assert sorted(r.size for r in rows) == [8, 8, 9, 9, 9]
    assert sharding.assign_shards(docs.limit(0), tree, sharding.grown_tree(tree)).collect() == []
    monkeypatch.setattr(sharding, "GROUP_ROWS", 50)
    many = sharding.assign_shards(spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")), tree, tree).collect()
    slots = defaultdict(list)
    for r in many:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_letters_cost_no_more_than_words():
    """Number signs are looked for where there may be some, not at every character."""
    import time
    from rankloom.llm import langid

    text = "großes Örtchen, naïve façade ½ " * 2_000 + "Ⅷ"
    plain = text.replace("½", "").replace("Ⅷ", "")
    assert sorted(langid.ngram_codes(text)) == sorted(langid.ngram_codes(plain))

    def fastest(run):
        took = []
        for _ in range(5):
            began = time.perf_counter()
            run()
            took.append(time.perf_counter() - began)
        return min(took)

    assert fastest(lambda: langid.ngram_codes(plain)) < fastest(lambda: langid.LETTERS.findall(plain)) / 2
