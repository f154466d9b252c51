"""Mixing by a curriculum against targets and demand worked out in plain Python."""

import math
import random
import re
from collections import defaultdict

import pytest

from rankloom.llm import curriculum, queries
from rankloom.llm.curriculum import Schedule, mix, ramp, training_order

SCHEMA = "doc_id bigint, text string, source string, size int"


def filled(sizes, weights, most=3):
    """Targets by handing the excess round until nobody is above the limit."""
    total, full = sum(sizes), set()
    while True:
        left = total - sum(most * sizes[i] for i in full)
        shares = sum(w for i, w in enumerate(weights) if i not in full)
        targets = [most * z if i in full else left * w / shares for i, (z, w) in enumerate(zip(sizes, weights))]
        over = {i for i, (z, t) in enumerate(zip(sizes, targets)) if t > most * z}
        if not over:
            return targets
        full |= over


def test_query(spark, sf, documents):
    rows = queries.op13_curriculum(spark, sf).collect()
    texts = {r.doc_id: r for r in documents.collect()}
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        d = texts[r.doc_id]
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) and 0 <= r.taken <= 3 * r.size
        sizes[d.source] += r.size
        taken[d.source] += r.taken
        target[d.source] = r.target
    names = sorted(sizes)
    want = filled([sizes[s] for s in names], [1 + i % 3 for i in range(len(names))])
    assert [target[s] for s in names] == pytest.approx(want)
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in names) and len(rows) == len(texts)
    at = [r.position for r in rows]
    assert at == sorted(at, key=lambda p: (p is None, p)) and max(p for p in at if p is not None) <= 1
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries.op13_curriculum(spark, sf).collect()))


def test_schedules_and_their_inverse(spark):
    schedule = Schedule(((0, 0.0), (0.25, 2.0), (0.5, 2.0), (1, 0.0)))
    assert schedule.integral() == pytest.approx(0.25 + 0.5 + 0.5)
    areas = [i / 100 * 1.25 for i in range(101)]
    got = [r.t for r in spark.createDataFrame([(a,) for a in areas], "a double").select(
        schedule.time_at(curriculum.F.col("a")).alias("t")).collect()]

    def integral(t, steps=4000):
        def w(u):
            for (a, x), (b, y) in zip(schedule.knots[:-1], schedule.knots[1:]):
                if u <= b:
                    return x + (y - x) * (u - a) / (b - a)
        return sum(w(t * (k + 0.5) / steps) for k in range(steps)) * t / steps

    assert all(integral(t) == pytest.approx(a, abs=1e-4) for a, t in zip(areas, got))
    for knots in (((0, 1.0),), ((0, 1.0), (0.5, 1.0)), ((0, 0.0), (1, 0.0)), ((0, -1.0), (1, 1.0))):
        with pytest.raises(ValueError):
            Schedule(knots)


def test_demand_is_met_at_every_time(spark, monkeypatch):
    monkeypatch.setattr(curriculum, "STRETCH", 20)
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(1, 12), f"s{rng.choice([0, 0, 0, 1, 2, 3])}", 1) for i in range(1500)]
    schedules = (ramp(1.0, 1.0), ramp(2.0, -1.0), Schedule(((0, 6.0), (0.5, 0.0), (1, 6.0))))
    mixed = mix(spark.createDataFrame(rows, SCHEMA), schedules).cache()
    order = training_order(mixed).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    targets = {r.source: (r.target, r.source_size) for r in mixed.collect()}
    areas = (lambda t: t * t, lambda t: 2 * t - t * t, lambda t: 0.5 - 2 * (0.5 - t) ** 2 if t < 0.5 else 0.5 + 2 * (t - 0.5) ** 2)
    for k, s in enumerate(sorted(targets)):
        target, size = targets[s]
        assert target <= 3 * size
        for t in (0.1, 0.35, 0.5, 0.8):
            have = sum(r.words for r in order if r.source == s and r.position < t)
            assert abs(have - target * areas[k % 3](t)) <= 13
    assert math.isclose(sum(t for t, _ in targets.values()), sum(len(r[1].split()) for r in rows))


def test_many_sources_are_filled_round_by_round(spark):
    rng = random.Random(4)
    sizes = {f"s{i:03}": rng.choice([0, 1, 2, 5, 40, 400]) for i in range(60)}
    rows = [(i, "w " * n, s, 0) for i, (s, n) in enumerate(sizes.items())] + [(99, "w " * 7, None, 0)]
    got = {r.source: r.target for r in mix(spark.createDataFrame(rows, SCHEMA), queries.CURRICULUM).collect()}
    names = [*sorted(sizes), None]
    want = filled([*(sizes[s] for s in sorted(sizes)), 7], [1 + i % 3 for i in range(61)])
    assert [got[s] for s in names] == pytest.approx(want)


def test_edge_cases(spark):
    rows = [(1, None, "a", 1), (2, "", "a", 1), (3, "one two", None, 1), (3, "one two", None, 1), (None, "x y z", "b", 1),
            (None, "p", "b", 1), (7, "u " * 50_000, "c", None), (8, "t", "t", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mix(docs, queries.CURRICULUM).collect()
    assert len(got) == 8 and sum(r["size"] for r in got) == 50_009
    assert all(not r.passes for r in got if not r["size"])
    assert {r.source: r.target for r in got}[None] == 12.0  # three times its size
    assert [sum(p.words for p in r.passes) for r in got if r.doc_id == 3] == [6, 6]
    assert mix(docs.limit(0), queries.CURRICULUM).collect() == []
    alone = mix(docs.filter("source = 'a'"), queries.CURRICULUM).collect()
    assert [(r.target, r.passes) for r in alone] == [(0.0, [])] * 2
