"""Mixing by target weights: Pfair windows for the blocks of each source, run earliest deadline first.

A source of weight w and n blocks is due min(n, w v) of them at virtual time v: one that has
run dry leaves, and the others go on in the proportion of their weights. Summed over sources
this turns v into slots, of which each holds one block. Block j of a source is released in the
slot in which its due blocks pass j and has its deadline where they reach j + 1. The even
sharing itself keeps these windows, so earliest deadline first meets all of them, and every
source is less than one block from its due at every slot, to the last.

The schedule is cut into frames that are run apart from each other. What has been run before
slot T needs no history: all blocks with deadlines up to T, and of those whose window holds T
(one a source at most) all but e(T), where e(t), the blocks released before t less t, follows
from the weights alone. Earliest deadline first leaves those of the latest deadlines, except
that at least e(T) - e(t) of those left must have been released at t or later, for each t.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import positions

FRAME = 1 << 14
MOST_SOURCES = 100_000
TIE = 1e-6  # in blocks: closer to a whole block than this is whole; 2 * TIE * MOST_SOURCES < 1


class Schedule:
    """Slots of the blocks of sources, given as source to (number of blocks, weight).

    Blocks are numbered through, source by source in the order of their names, from
    ``first``. Frames have ``frame`` slots, and four times as many as there are sources.
    """

    def __init__(self, sources: dict[str, tuple[int, float]], frame: int = FRAME) -> None:
        names = sorted(sources)
        self.blocks = np.array([sources[s][0] for s in names], np.int64)
        self.weights = np.array([sources[s][1] for s in names], np.longdouble)
        starts = np.append(0, self.blocks.cumsum())
        self.first, self.total = dict(zip(names, starts.tolist())), int(starts[-1])
        self.starts = starts[:-1]
        self.frame = max(frame, 4 * len(names))
        self.frames = -(-self.total // self.frame)
        order = np.argsort(self.blocks / self.weights, kind="stable")
        blocks, weights = self.blocks[order], self.weights[order]
        dry = blocks / weights
        alive = weights[::-1].cumsum()[::-1] - weights
        due = blocks.cumsum() + dry * alive
        if names:
            due[-1] = self.total
        # From each of these virtual times on, so many blocks were due and come a unit of time.
        self.times, self.due = np.append(np.longdouble(0), dry), np.append(np.longdouble(0), due)
        self.rates = np.append(weights[::-1].cumsum()[::-1], np.longdouble(0))
        # Slots up to here fall before the first source runs dry.
        self.steady = int(self.due[1] + TIE) if names else 0

    def _time(self, slot: np.ndarray) -> np.ndarray:
        at = np.clip(np.searchsorted(self.due, slot, "right") - 1, 0, max(len(self.blocks) - 1, 0))
        return np.minimum(self.times[at] + (slot - self.due[at]) / self.rates[at], self.times[-1])

    def _slot(self, time: np.ndarray) -> np.ndarray:
        at = np.clip(np.searchsorted(self.times, time, "right") - 1, 0, max(len(self.blocks) - 1, 0))
        return self.due[at] + (time - self.times[at]) * self.rates[at]

    def _due(self, source: np.ndarray, slot: np.ndarray) -> np.ndarray:
        return np.minimum(self.blocks[source], self.weights[source] * self._time(slot))

    def counts(self, slot: int) -> tuple[np.ndarray, np.ndarray]:
        """Blocks of each source released before a slot, and those with deadlines up to it."""
        every = np.arange(len(self.blocks))
        due = self._due(every, np.full(len(every), slot, np.longdouble))
        return np.ceil(due - TIE).astype(np.int64), np.floor(due + TIE).astype(np.int64)

    def windows(self, source: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Release and deadline of blocks."""
        weight = self.weights[source]
        release = np.floor(self._slot(block / weight)).astype(np.int64)
        release += self._due(source, (release + 1).astype(np.longdouble)) <= block + TIE
        deadline = np.ceil(self._slot((block + 1) / weight)).astype(np.int64)
        deadline -= self._due(source, (deadline - 1).astype(np.longdouble)) >= block + 1 - TIE
        return release, deadline

    def released(self, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Source, block, release and deadline of the blocks that a frame releases."""
        low, high = number * self.frame, min((number + 1) * self.frame, self.total)
        before, after = self.counts(low)[0], self.counts(high)[0]
        many = after - before
        source = np.repeat(np.arange(len(many)), many)
        block = np.arange(len(source)) - np.repeat(many.cumsum() - many, many) + before[source]
        release, deadline = self.windows(source, block)
        return source, block, np.clip(release, low, high - 1), deadline

    def backlog(self, number: int) -> np.ndarray:
        """e(t) of the slots t of a frame: blocks released before t, less t."""
        low, high = number * self.frame, min((number + 1) * self.frame, self.total)
        at_start = int(self.counts(low)[0].sum()) - low
        fresh = np.bincount(self.released(number)[2] - low, minlength=high - low)
        return at_start + np.append(0, (fresh - 1).cumsum())[:-1]


class Runner:
    """Runs frames of a schedule; ``least`` is the smallest backlog of each frame."""

    def __init__(self, schedule: Schedule, least: np.ndarray) -> None:
        self.schedule, self.least = schedule, least
        self.held: dict[int, np.ndarray] = {}

    def _smallest(self, low: int, high: int) -> int:
        """Smallest backlog of the slots from low up to, but not with, high."""
        frame = self.schedule.frame
        a, b = low // frame, (high - 1) // frame
        for n in {a, b} - self.held.keys():
            self.held[n] = self.schedule.backlog(n)
        if a == b:
            return self.held[a][low - a * frame : high - a * frame].min()
        ends = min(self.held[a][low - a * frame :].min(), self.held[b][: high - b * frame].min())
        return min(ends, self.least[a + 1 : b].min(initial=ends))

    def waiting(self, slot: int) -> list[tuple[int, int, int]]:
        """(deadline, source, block) released before a slot, the start of a frame, and not yet run."""
        before, ended = self.schedule.counts(slot)
        source = np.flatnonzero(before > ended)
        block = before[source] - 1
        release, deadline = self.schedule.windows(source, block)
        release = np.minimum(release, slot - 1)
        left = int(before.sum()) - slot
        order = np.argsort(-release, kind="stable")
        # Frames whose backlogs no later call can need are let go.
        needed = set((release // self.schedule.frame).tolist()) | {slot // self.schedule.frame - 1}
        needed |= set(((release + 1) // self.schedule.frame).tolist())
        self.held = {n: e for n, e in self.held.items() if n in needed}
        latest: list[tuple[int, int, int]] = []
        out: list[tuple[int, int, int]] = []
        for n, k in enumerate(order.tolist()):
            heapq.heappush(latest, (-int(deadline[k]), -int(source[k]), int(block[k])))
            until = int(release[order[n + 1]]) if n + 1 < len(order) else -1
            if until == release[k] or len(out) == left:
                continue
            need = left - self._smallest(until + 1, int(release[k]) + 1)
            while len(out) < need:
                d, s, b = heapq.heappop(latest)
                out.append((-d, -s, b))
        return out

    def run(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the blocks in the slots of a frame, in the order of the slots, and these."""
        plan = self.schedule
        low, high = number * plan.frame, min((number + 1) * plan.frame, plan.total)
        ready = self.waiting(low) if number else []
        heapq.heapify(ready)
        source, block, release, deadline = plan.released(number)
        order = np.argsort(release, kind="stable")
        fresh = list(zip(deadline[order].tolist(), source[order].tolist(), block[order].tolist()))
        cuts = np.searchsorted(release[order], np.arange(low, high + 1)).tolist()
        unit = np.empty(high - low, np.int64)
        for t in range(high - low):
            for job in fresh[cuts[t] : cuts[t + 1]]:
                heapq.heappush(ready, job)
            due, own, j = heapq.heappop(ready)
            if due <= low + t:
                raise AssertionError("a deadline was missed")
            unit[t] = plan.starts[own] + j
        return unit, np.arange(low, high)


def _least(schedule: Schedule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = [int(schedule.backlog(n).min()) for n in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(least, pa.int64())], ["id", "least"])

    return run


def _slots(schedule: Schedule, least: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runner = Runner(schedule, least)
        for batch in batches:
            for number in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays(list(map(pa.array, runner.run(number))), ["unit", "slot"])

    return run


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    temperature: float = 0.9,
    block: int = 8,
    frame: int = FRAME,
) -> DataFrame:
    """One row per document: doc_id, source, queue, weight, block, slot, position, in_mix.

    ``weights`` gives the target of each source (its sum need not be 1; sources it does not
    name get none, and so no place); without it a source's weight follows the number of its
    documents to the power ``temperature``. ``block`` documents form a block, in the order
    of doc_id; a source's last block may have fewer. Every row of a source with a weight has
    a slot and a position: a source that has run dry leaves, and those that are left share
    the slots by their weights. At every slot each source is less than one block from its
    share. ``in_mix`` holds before the first source runs dry, where each has its target share
    of all. Null and empty sources are one source, ""; ``queue`` is the source so named. Of
    equal deadlines the source of the smaller name goes first. Repeated rows are scheduled
    each for itself. An empty table gives no rows. The driver sees one count per source, of
    which there may be ``MOST_SOURCES``, and one number per frame of ``frame`` slots or more;
    the frames change no result.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "source", F.coalesce("source", F.lit("")).alias("queue"))
    if weights is not None:
        known = spark.createDataFrame([(s,) for s, w in weights.items() if w > 0], "queue string")
        rows = rows.join(known, "queue", "left_semi")
    counted = dict(rows.groupBy("queue").count().limit(MOST_SOURCES + 1).collect())
    if len(counted) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    target = {s: float(weights[s]) if weights is not None else n**temperature for s, n in counted.items()}
    total = sum(target.values())
    shares = {s: w / total for s, w in target.items()}
    plan = Schedule({s: (-(-n // block), shares[s]) for s, n in counted.items()}, frame)
    numbers = spark.range(plan.frames)
    # The first frame waits for nothing, so one frame needs no backlogs.
    found = numbers.mapInArrow(_least(plan), "id long, least long").collect() if plan.frames > 1 else []
    least = np.array([n for _, n in sorted(found)], np.int64)
    slots = numbers.mapInArrow(_slots(plan, least), "unit long, slot long")
    listed, start = [], 0
    for source in sorted(counted):
        listed.append((source, shares[source], start, plan.first[source]))
        start += counted[source]
    sources = spark.createDataFrame(listed, "queue string, weight double, start long, first long")
    laid = positions(rows, ["queue", "doc_id"], "mix-rows").join(sources, "queue")
    number = F.expr(f"(pos - start) div {block}")
    placed = laid.select("doc_id", "source", "queue", "weight", number.alias("block"), (F.col("first") + number).alias("unit"))
    slotted = placed.join(slots, "unit")
    return positions(slotted, ["slot", "queue", "block", "doc_id"], "mix-slots").select(
        "doc_id",
        "source",
        "queue",
        "weight",
        "block",
        "slot",
        F.col("pos").alias("position"),
        (F.col("slot") < plan.steady).alias("in_mix"),
    )
