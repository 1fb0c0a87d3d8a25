"""The schedule's bound, against a plain earliest-deadline-first run and slot by slot."""

import random

import pytest
from pyspark.sql import functions as F

from cohortlens.llm.mixing import mix_sources, period_schedule, shares, weighted_schedule


def _plain(share, period):
    done, out = dict.fromkeys(share, 0), []
    for t in range(period):
        ready = [
            (-(-(done[s] + 1) * period // a), s)
            for s, a in share.items()
            if done[s] < a and done[s] * period // a <= t
        ]
        s = min(ready)[1]
        out.append((s, done[s], t))
        done[s] += 1
    return out


@pytest.mark.parametrize(
    "weights", [{"a": 0.9, **{f"s{i}": 0.01 for i in range(10)}}, {"x": 3.0, "y": 2.0}, {"only": 5.0}]
)
def test_less_than_one_block_away(frame, weights):
    share = {
        r.source: r.share
        for r in shares(frame(list(weights.items()), "source string, weight double"), 100).collect()
    }
    assert sum(share.values()) == 100 and min(share.values()) >= 1
    plan = period_schedule(frame(list(share.items()), "source string, share long"), 100)
    rows = sorted((r.slot, r.source, r.turn) for r in plan.collect())
    assert [(s, k, t) for t, s, k in rows] == _plain(dict(sorted(share.items())), 100)
    got = dict.fromkeys(share, 0)
    for slot, source, _ in rows:
        got[source] += 1
        assert all(abs(got[s] - (slot + 1) * a / 100) < 1 for s, a in share.items())


def _docs(n, rng):
    rows = [(i, "w" * rng.randint(0, 90), rng.choice("aaab") if i % 7 else None, i) for i in range(n)]
    return rows + [(1, None, "b", 0), (1, None, "b", 0), (None, "tail", "c", 1), (3, "y" * 3_000, "a", 2)]


def test_whole_and_in_blocks(frame):
    rows = _docs(400, random.Random(5))
    docs = frame(rows, "doc_id long, text string, source string, slot int")
    got = mix_sources(docs, period=20, block_chars=500).collect()
    assert sorted(map(str, ((r.doc_id, r.source, r.size) for r in got))) == sorted(
        str((i, s, len(t or ""))) for i, t, s, _ in rows
    )
    slots = {}
    for r in got:
        assert slots.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
    for source in {r.source for r in got}:
        total = sum(r.size for r in got if r.source == source)
        blocks = [r.block for r in got if r.source == source]
        assert min(blocks) == 0 and max(blocks) <= total // 500
        places = sorted({(r.block, r.slot) for r in got if r.source == source})
        assert [s for _, s in places] == sorted(s for _, s in places)


def test_given_weights(frame):
    docs = frame([(i, "x" * 100, s) for i in range(300) for s in "ab"], "doc_id int, text string, source string")
    weights = frame([("a", 3.0), ("b", 1.0), ("z", 9.0), ("c", None)], "source string, weight double")
    got = mix_sources(docs, weights, period=4, block_chars=1_000).where(F.col("slot") < 36)
    counts = {r.source: r["count"] for r in got.select("source", "slot").distinct().groupBy("source").count().collect()}
    assert counts == {"a": 18, "b": 18} or counts == {"a": 27, "b": 9}


def test_edges(frame):
    assert mix_sources(frame([], "doc_id int, text string, source string")).collect() == []
    many = frame([(i, "x", str(i)) for i in range(30)], "doc_id int, text string, source string")
    with pytest.raises(ValueError):
        mix_sources(many, period=20)


@pytest.mark.parametrize(
    "weights",
    [[0.9, 0.1], [0.9, *[0.01] * 10], [0.5, *[0.5 / 199] * 199], [5.0], [1e-7, 3**0.5, 1.0],
     [(304e6) ** 0.5, *((28e6 + 7e4 * i) ** 0.5 for i in range(19))]],
)
def test_less_than_one_block_from_the_weights(weights):
    n, every = 12_000, sum(weights)
    plan = weighted_schedule(weights, [n] * len(weights))
    slots = {t: j for j, own in enumerate(plan) for t in own if t < n}
    assert len(slots) == n and all(list(own) == sorted(own) for own in plan)
    got = [0] * len(weights)
    for t in range(n):
        got[slots[t]] += 1
        if t % 7 == 0 or t == n - 1:
            assert all(abs(g - (t + 1) * w / every) < 1 + 1e-6 for g, w in zip(got, weights))


def test_ended_sources_leave_the_others_their_shares():
    plan = weighted_schedule([2.0, 1.0, 1.0], [10, 400, 0])
    assert sorted(t for own in plan for t in own) == list(range(410)) and len(plan[2]) == 0
    assert max(plan[0]) <= 15


def test_rows_follow_the_target_weights(frame):
    rows = [(i, "x" * 100, s) for s, n in (("a", 1_900), ("b", 250), (None, 10)) for i in range(n)]
    docs = frame(rows, "doc_id int, text string, source string")
    weights = frame([("a", 0.895), ("b", 0.1), (None, 0.005)], "source string, weight double")
    got = mix_sources(docs, weights, block_chars=100).where(F.col("slot") < 2_000)
    counts = {r.source: r["count"] for r in got.groupBy("source").count().collect()}
    assert all(abs(counts[s] - 2_000 * w) < 1 for s, w in (("a", 0.895), ("b", 0.1), (None, 0.005)))
