"""Mixing against one exact earliest-deadline-first run, and the even share of each source."""

from __future__ import annotations

import bisect
import heapq
import random
from fractions import Fraction

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_operators import DOCS
from tidemark.llm.mixing import Runner, Schedule, mix

ODD = random.Random(2)
SOURCES = [
    {"big": (1250, 10_000**0.9), "small": (13, 100**0.9)},
    {f"s{i}": (-(-20_000 // i // 8), (20_000 / i) ** 0.9) for i in range(1, 61)},
    {f"s{i}": (25, 1.0) for i in range(150)} | {"third": (1900, 75.0)},
    {f"s{i:03}": (1, 1.0) for i in range(400)},
    {"x": (50, 0.005), "y": (5000, 0.995)},
    {f"s{i}": (ODD.randint(1, 90), ODD.random() ** 3 + 1e-4) for i in range(30)},
]


def strayed(sources, owner):
    """Most blocks by which a source is off its even share of the slots until it is dry."""
    names = sorted(sources)
    left = np.array([float(sources[s][0]) for s in names])
    weight = np.array([sources[s][1] for s in names])
    due, had, worst = np.zeros(len(names)), np.zeros(len(names)), 0.0
    for s in owner:
        need = 1.0
        while need > 1e-9 and (live := left > 1e-9).any():
            share = np.where(live, weight, 0) / weight[live].sum()
            step = min(need, (left[live] / share[live]).min())
            left, due, need = left - step * share, due + step * share, need - step
        had[names.index(s)] += 1
        worst = max(worst, abs(had - due).max())
    return worst


def earliest_deadlines_first(sources):
    """(source, block) of every slot: all blocks in one queue, their windows in exact fractions."""
    names = sorted(sources)
    weight = {s: Fraction(sources[s][1]) for s in names}
    alive, times, due, rates = sum(weight.values()), [Fraction(0)], [Fraction(0)], []
    for time, s in sorted((sources[s][0] / weight[s], s) for s in names):
        rates.append(alive)
        due.append(due[-1] + (time - times[-1]) * alive)
        times.append(time)
        alive -= weight[s]

    def slot(time):
        k = min(bisect.bisect_right(times, time), len(rates)) - 1
        return due[k] + (time - times[k]) * rates[k]

    jobs = sorted(
        (slot(j / weight[s]).__floor__(), slot((j + 1) / weight[s]).__ceil__(), s, j) for s in names for j in range(sources[s][0])
    )
    ready, out, at = [], [], 0
    for t in range(len(jobs)):
        while at < len(jobs) and jobs[at][0] <= t:
            heapq.heappush(ready, jobs[at][1:])
            at += 1
        deadline, s, j = heapq.heappop(ready)
        assert deadline > t
        out.append((s, j))
    return out


def in_frames(sources, frame):
    plan = Schedule(sources)
    plan.frame, plan.frames = frame, -(-plan.total // frame)
    least = np.array([plan.backlog(n).min() for n in range(plan.frames)])
    name = {first + j: (s, j) for s, first in plan.first.items() for j in range(sources[s][0])}
    # Each frame by a runner of its own: none knows what another has run.
    return [name[u] for n in range(plan.frames) for u in Runner(plan, least).run(n)[0].tolist()]


@pytest.mark.parametrize("sources", SOURCES)
def test_every_source_keeps_its_share_to_the_last_block(sources):
    slots = in_frames(sources, 1 << 14)
    assert sorted(slots) == sorted((s, j) for s, (n, _) in sources.items() for j in range(n))
    assert strayed(sources, [s for s, _ in slots]) < 1 + 1e-6


@pytest.mark.parametrize("frame", [7, 64, 1000])
@pytest.mark.parametrize("sources", [s for s in SOURCES if len(s) < 60 and sum(n for n, _ in s.values()) < 2000])
def test_frames_run_apart_give_one_schedule(sources, frame):
    assert in_frames(sources, frame) == earliest_deadlines_first(sources)


@pytest.mark.parametrize("seed", range(25))
def test_any_sources_run_by_earliest_deadline(seed):
    odd = random.Random(seed)
    sources = {f"s{i}": (odd.randint(1, 60), odd.random() ** odd.choice([1, 4]) + 1e-4) for i in range(odd.randint(1, 25))}
    slots = earliest_deadlines_first(sources)
    assert in_frames(sources, odd.choice([3, 10, 50])) == slots
    assert strayed(sources, [s for s, _ in slots]) < 1 + 1e-6


def test_runners_may_go_on_from_frame_to_frame():
    sources = SOURCES[-1]
    plan = Schedule(sources)
    plan.frame, plan.frames = 20, -(-plan.total // 20)
    runner = Runner(plan, np.array([plan.backlog(n).min() for n in range(plan.frames)]))
    units = [u for n in range(plan.frames) for u in runner.run(n)[0].tolist()]
    assert units == [plan.first[s] + j for s, j in earliest_deadlines_first(sources)]


def sized(spark, sizes):
    rows = [(1000 * n + i, f"t{n}-{i}", "en", f"s{n}", 4) for n, size in enumerate(sizes) for i in range(size)]
    return spark.createDataFrame(rows, DOCS)


def test_a_small_source_has_its_own_target(spark):
    rows = mix(sized(spark, [1600, 30, 20, 10]), weights={"s0": 0.98, "s1": 0.01, "s2": 0.006, "s3": 0.004}).collect()
    assert {r.queue: r.weight for r in rows} == pytest.approx({"s0": 0.98, "s1": 0.01, "s2": 0.006, "s3": 0.004})
    for name, weight in (("s1", 0.01), ("s2", 0.006), ("s3", 0.004)):
        slots = {r.block: r.slot for r in rows if r.source == name and r.in_mix}
        assert slots and all(abs(b + 1 - weight * (t + 1)) < 1 + 1e-6 for b, t in slots.items())


@pytest.mark.parametrize("sizes", [[7], [50] * 20, [1000, 10], [300, 100, 30, 3]])
def test_the_stage_keeps_every_row_in_the_order_of_the_mix(spark, tmp_path, sizes):
    docs = sized(spark, sizes)
    out = corpus_pipeline.mixing(spark, docs, "")
    assert out.columns == docs.columns
    place = {r.doc_id: r.position for r in mix(docs).collect()}
    assert sorted(place.values()) == list(range(sum(sizes)))
    assert [r.doc_id for r in out.collect()] == sorted(place, key=place.get)
    turns = [r.source for r in out.collect()]
    blocks = {f"s{n}": (-(-size // 8), size**0.9) for n, size in enumerate(sizes)}
    owner = []
    while turns:
        n = min(8, turns.count(turns[0]))
        assert len(set(turns[:n])) == 1
        owner.append(turns[0])
        turns = turns[n:]
    assert strayed(blocks, owner) < 1 + 1e-6


def test_rows_that_repeat_an_id_or_have_none_stay(spark):
    docs = spark.createDataFrame([(None, "a", None, "s", 1), (None, "b", None, "s", 1), (2, "b", None, "", 1), (2, "c", None, None, 1)], DOCS)
    assert sorted(map(str, corpus_pipeline.mixing(spark, docs, "").collect())) == sorted(map(str, docs.collect()))
    assert corpus_pipeline.mixing(spark, docs.limit(0), "").count() == 0


def test_frames_change_no_result(spark):
    docs = sized(spark, [300, 100, 30, 3])
    assert sorted(mix(docs, frame=16).collect()) == sorted(mix(docs).collect())
