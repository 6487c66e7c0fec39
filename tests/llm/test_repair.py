"""Conversation repair next to an exhaustive search."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import defaultdict

import pytest

from tidemark.llm.repair import (
    BREAK,
    FIRST_RULE,
    Repairer,
    all_repairs,
    conversation_repairs,
    damaged,
    grammar,
    repaired_turns,
    sequences,
    terminal,
)
from tidemark.llm.repair import Grammar as Rules

SCHEMA = "conv_id long, turn long, role string, text string"
STATES = ("", "s", "u", "a")


def steps(state, initial, fault):
    """(state, cost, edit) of one row, and of one inserted row where ``initial`` is None."""
    other = "a" if state == "u" else "u"
    if initial is None:
        return [(other, 2, "I")]
    out = [(state, 3, "D")]
    if fault not in ("blank", "duplicate"):
        cut = int(fault == "truncated")
        if initial == other or (initial == "s" and state == ""):
            out.append((initial, cut, "K"))
        out.append((other, 2 + cut, "R"))
    return out


def exhaustive(rows):
    """Least (cost, audit) over all edits, with every string kept and compared as a whole."""
    found = {"": {("", 0)}}

    def widened(found):
        out = defaultdict(set)
        for state, ways in found.items():
            for audit, cost in ways:
                now, so_far, text = state, cost, audit
                out[now].add((text, so_far))
                for _ in range(2):
                    ((now, more, edit),) = steps(now, None, None)
                    so_far, text = so_far + more, text + edit
                    out[now].add((text, so_far))
        return out

    for initial, fault in rows:
        after = defaultdict(set)
        for state, ways in widened(found).items():
            for (audit, cost), (to, more, edit) in itertools.product(ways, steps(state, initial, fault)):
                after[to].add((audit + edit, cost + more))
        found = after
    ends = [(cost, audit) for state, ways in widened(found).items() if state in ("", "a") for audit, cost in ways]
    return min(ends)


def expected(rows):
    """The whole row of a conversation from (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda v: (v[0] is not None, v[0] or 0, v[1], hashlib.sha256(v[2].encode()).digest()))
    seen, faults = set(), []
    for _, role, text in rows:
        marks = re.findall(r"[^\x20\x09-\x0D]", text)
        if not marks:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if marks[-1] in ".!?" else "truncated")
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    cost, audit = exhaustive(list(zip(initials, faults)))
    state, out, at = "", [], iter(zip(rows, initials))
    for edit in audit:
        if edit == "I":
            state = "a" if state == "u" else "u"
            out.append(f"{'user' if state == 'u' else 'assistant'}:")
            continue
        (_, role, text), initial = next(at)
        if edit == "D":
            continue
        if edit == "K":
            state = initial
        else:
            state = "a" if state == "u" else "u"
            role = "user" if state == "u" else "assistant"
        out.append(f"{role}:{text}")
    turns = {t for t, _, _ in rows if t is not None}
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest(),
    }


def made(seed, conversations=60, most=6):
    rng, rows = random.Random(seed), []
    for conv in range(conversations):
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice(["Yes.", "No", "Why? ", " \t", "", None, "a.\n", "b ", "Yes."])
            rows.append((conv, None if rng.random() < 0.1 else turn + rng.randint(0, 2), role, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repairs_are_the_cheapest(spark, seed):
    rows = made(seed)
    found = conversation_repairs(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    groups = defaultdict(list)
    for conv, *rest in rows:
        groups[conv].append(rest)
    assert {r.conv_id for r in found} == set(groups)
    for r in found:
        got = r.asDict()
        want = expected(groups[got.pop("conv_id")])
        assert got == want


def test_repaired_rows_give_the_hash(spark):
    turns = spark.createDataFrame(made(3), SCHEMA)
    lines = defaultdict(list)
    for r in sorted(repaired_turns(turns).collect(), key=lambda r: (r.conv_id, r.position)):
        assert r.position == len(lines[r.conv_id])
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    for r in conversation_repairs(turns).collect():
        assert hashlib.sha256("\n".join(lines[r.conv_id]).encode()).hexdigest() == r.repaired_sha256
        assert re.fullmatch(r"(s?(ua)+)?", "".join(x[0] for x in lines[r.conv_id]))


def test_a_long_conversation_lies_in_many_tasks(spark):
    rng = random.Random(4)
    roles = [rng.choice(["user", "assistant", "assistant", "system"]) for _ in range(3000)]
    rows = [(7, i, role, f"{i}." if i % 7 else "again.") for i, role in enumerate(roles)]
    rows += [(8, 0, "user", "x."), (None, None, "user", "y.")]
    (whole,) = [r for r in sequences(spark.createDataFrame(rows, SCHEMA).repartition(8)).collect() if r.conv_id == 7]
    assert len(whole.symbols) == 3000 and whole.gaps == 0 and whole.duplicate > 300
    assert whole.illegal == sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
    plain = Repairer(Rules([], [terminal(s) for s in range(FIRST_RULE)]))
    rules = grammar(sequences(spark.createDataFrame(rows, SCHEMA)))
    assert len(rules.compress(whole.symbols)) < 3000 / 3 and BREAK not in rules.compress(whole.symbols)
    assert Repairer(rules).repair(whole.symbols) == plain.repair(whole.symbols)


def test_rules_never_change_a_result(spark):
    rng = random.Random(5)
    base = spark.createDataFrame(
        [(bytes(rng.choice([0, 1, 3, 4, 5, 6, 7]) for _ in range(rng.randint(0, 40))),) for _ in range(200)],
        "symbols binary",
    )
    rules, plain = Repairer(grammar(base)), Repairer(Rules([], [terminal(s) for s in range(FIRST_RULE)]))
    assert len(rules.grammar.rules) > 20
    for row in base.collect():
        assert rules.repair(row.symbols) == plain.repair(row.symbols)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversation_repairs(empty).count() == 0 and all_repairs(empty, damaged(empty)).count() == 0
    rows = [(1, 0, "user", "x" * 300_000 + "."), (1, 0, "user", "x" * 300_000 + "."), (None, 3, None, None)]
    odd = spark.createDataFrame(
        [(*r, "e", 1, 2.0, "s") for r in rows], SCHEMA + ", audit string, head int, salt double, symbols string"
    )
    by = {r.conv_id: r for r in conversation_repairs(odd).collect()}
    assert (by[1].audit, by[1].cost, by[1].duplicate) == ("KDI", 5, 1)
    assert (by[None].audit, by[None].blank, by[None].cost) == ("D", 1, 3)
    lost = all_repairs(odd, empty).collect()
    nothing = hashlib.sha256().hexdigest()
    assert {r.conv_id for r in lost} == {1, None}
    assert all((r.cost, r.audit, r.gaps, r.repaired_sha256) == (0, "", 0, nothing) for r in lost)
