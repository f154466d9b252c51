"""The language model against counts and mixing written out in plain Python."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rankloom.llm import lm, queries


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + [None]


def brute(rows, order=2):
    """``rows`` of (id, text, kind) to {id: (n_known, base, score)}."""
    def grams(ws, n):
        padded = ["<s>"] * (n - 1) + ws
        return [tuple(padded[i:i + n]) for i in range(len(ws))]

    def count(kinds):
        chosen = [words(t) for _, t, k in rows if k in kinds]
        counts = {n: Counter(g for ws in chosen for g in grams(ws, n)) for n in range(1, order + 1)}
        for n in range(1, order):
            counts[n][("<s>",) * n] = len(chosen)
        return counts, sum(map(len, chosen))

    def shares(ws, counts, total, v):
        for i in range(len(ws)):
            out, context = [1 / (v + 1), counts[1][(ws[i],)] / max(total, 1)], total
            for n in range(2, order + 1):
                g = grams(ws, n)[i]
                context = counts[n - 1][g[:-1]]
                out.append(counts[n][g] / max(context, 1))
            yield min(lm.BUCKETS - 1, int(math.log2(context + 1))), out[::-1]

    full, total = count({1, 2})
    v = len([g for g in full[1] if g != ("<s>",)])
    rest, left = count({1})
    aside = [s for _, t, k in rows if k == 2 for s in shares(words(t), rest, left, v)]
    weights = [[1 / (order + 1)] * lm.BUCKETS for _ in range(order + 1)]
    for _ in range(lm.ROUNDS):
        expected = [[0.0] * lm.BUCKETS for _ in range(order + 1)]
        for b, ps in aside:
            parts = [weights[k][b] * p for k, p in enumerate(ps)]
            for k, part in enumerate(parts):
                expected[k][b] += part / sum(parts)
        change = 0.0
        for b in range(lm.BUCKETS):
            all_ = sum(e[b] for e in expected)
            new = [max(e[b] / all_ if all_ else weights[k][b], lm.LEAST) for k, e in enumerate(expected)]
            for k, x in enumerate(new):
                change = max(change, abs(x / sum(new) - weights[k][b]))
                weights[k][b] = x / sum(new)
        if change < lm.ENOUGH:
            break
    out = {}
    for i, t, _ in rows:
        ws = words(t)
        out[i] = (sum(full[1][(w,)] > 0 for w in ws),
                  sum(math.log10((full[1][(w,)] + 1) / (total + v + 1)) for w in ws),
                  sum(math.log10(sum(weights[k][b] * p for k, p in enumerate(ps)))
                      for b, ps in shares(ws, full, total, v)))
    return out, total


def kinds(docs, held):
    """The kinds as the operator sets them, but computed apart: only the hash is Spark's."""
    aside = F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(16)) == 0
    return [(r.doc_id, r.text, 0 if r.held else 2 if r.aside else 1)
            for r in docs.select("doc_id", "text", held.alias("held"), aside.alias("aside")).collect()]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_brute_force(documents, order):
    held = F.col("doc_id") % 7 == 2
    expected, total = brute(kinds(documents, held), order)
    got = lm.score_documents(documents, held, order=order).collect()
    assert len(got) == len(expected)
    for r in got:
        n_known, base, score = expected[r.doc_id]
        assert (r.n_known, r.train_tokens) == (n_known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(score, rel=1e-3)


def test_query(spark, sf, documents):
    rows = {r.doc_id: r for r in queries.op4_lm(spark, sf).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2) for i, r in rows.items())
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_blocks_do_not_matter(monkeypatch, documents):
    held = F.col("doc_id") % 7 == 2
    few = {r.doc_id: r for r in lm.score_documents(documents, held).collect()}
    many = {r.doc_id: r for r in lm.score_documents(documents.repartition(7), held).collect()}
    assert all(few[i].score == pytest.approx(many[i].score, rel=1e-6) for i in few)


def test_edge_cases(spark):
    schema = "doc_id bigint, text string, score double, length int"
    docs = spark.createDataFrame(
        [(1, None, 0.0, 1), (2, "", 0.0, 1), (None, "A a b", 0.0, 1), (4, "a b", 0.0, 1), (4, "a b", 0.0, 1),
         (5, "x " * 30000, 0.0, 1), (6, "Été a", None, None)], schema)
    rows = lm.score_documents(docs, F.col("doc_id") == 6).collect()
    assert len(rows) == 7
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {1}
    assert [r.n_tokens for r in rows if r.doc_id is None] == [4]
    assert len({(r.score, r.base_score) for r in rows if r.doc_id == 4}) == 1
    assert next(r for r in rows if r.doc_id == 6).n_known == 2  # a and the end
    assert lm.score_documents(docs.limit(0), F.lit(False)).collect() == []
    untrained = lm.score_documents(docs, F.lit(True)).collect()
    assert all(r.n_known == 0 and math.isfinite(r.score) for r in untrained)


def test_blocks_and_ranges_grow_together():
    for tokens in (0, 10 ** 6, 10 ** 8, 10 ** 11, 10 ** 13, 10 ** 14):
        block = lm.block_tokens(tokens)
        ranges = 2 ** lm.range_bits(tokens, block)
        assert lm.BLOCK_TOKENS <= block <= lm.MOST_BLOCK_TOKENS
        assert tokens / ranges <= max(lm.RANGE_TOKENS, 50 * tokens / block)  # a range fits a task
        if tokens > 10 ** 9:
            assert block / ranges >= lm.FRAME_TOKENS / 2.1  # tokens of a block in a range
