"""URL verdicts once trust and distrust are spread to the end."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest

from tidemark.llm.oracles import URLS
from tidemark.llm.url_filter import DAMPING, THRESHOLD, Rule, url_verdicts

RULES = [Rule("bad", "/", "block"), Rule("good", "/", "allow")]


def pages_of(spark, links, hosts):
    rows = [(n, f"http://{h}/", " ".join(f'<a href="http://{d}/">' for s, d in links if s == h)) for n, h in enumerate(hosts)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def verdicts(spark, links, hosts):
    return {r.host: r.verdict for r in url_verdicts(pages_of(spark, links, hosts), RULES).collect()}


def solved(links, hosts):
    """Verdicts by solving for the scores."""
    at, n = {h: i for i, h in enumerate(hosts)}, len(hosts)
    counts = np.zeros((n, n))
    for s, d in links:
        counts[at[s], at[d]] += 1
    score = []
    for moved, seed in ((counts, "good"), (counts.T, "bad")):
        part = moved / np.maximum(moved.sum(axis=1, keepdims=True), 1)
        seeds = np.array([float(h.split(".")[-1] == seed) for h in hosts])
        score.append(np.linalg.solve(np.eye(n) - DAMPING * part.T, (1 - DAMPING) * seeds))
    excess = score[1] - score[0] - THRESHOLD * (1 - DAMPING)
    fixed = {"bad": "block", "good": "allow"}
    return {h: fixed.get(h.split(".")[-1], "block" if excess[at[h]] > 0 else "allow") for h in hosts}


def test_two_hosts_that_link_each_other(spark):
    hosts = ["x.bad", "pair", "partner", *(f"o{i}" for i in range(4))]
    links = [(h, "x.bad") for h in hosts if h not in ("x.bad", "partner")] + [("pair", "partner"), ("partner", "pair")]
    got = verdicts(spark, links, hosts)
    assert got == solved(links, hosts)
    assert (got["pair"], got["o0"]) == ("block", "allow")


def test_a_chain_longer_than_the_rounds(spark):
    """Distrust of many blocked hosts goes back along a chain of 14 hosts."""
    bad, chain = [f"b{i}.bad" for i in range(40)], [f"c{i}" for i in range(14)]
    links = [(chain[0], b) for b in bad] + list(zip(chain[1:], chain))
    got = verdicts(spark, links, bad + chain)
    assert got == solved(links, bad + chain) and got["c13"] == "block"


@pytest.mark.parametrize("seed", [1, 2])
def test_verdicts_next_to_the_solution(spark, seed):
    rng = random.Random(seed)
    hosts = [f"h{i}" + rng.choice(["", "", "", ".bad", ".good"]) for i in range(60)]
    links = [tuple(rng.sample(hosts, 2)) for _ in range(150)]
    assert verdicts(spark, links, hosts) == solved(links, hosts)


def test_a_tie_ends(spark):
    """A host exactly at the threshold, in a graph where distrust goes round for ever."""
    hosts = ["x.bad", "half", "p", "q"]
    links = [("p", "x.bad"), ("p", "q"), ("q", "p"), ("q", "half")]
    assert verdicts(spark, links, hosts) == solved(links, hosts)


@pytest.mark.parametrize("seed", [None, 3, 4])
def test_the_sql_on_linked_hosts(spark, seed):
    """A chain that ten rounds do not reach the end of, and random links, under the rules of the query."""
    if seed is None:
        bad, chain = [f"b{i}.net" for i in range(40)], [f"c{i}" for i in range(14)]
        hosts, links = bad + chain, [(chain[0], b) for b in bad] + list(zip(chain[1:], chain))
    else:
        rng = random.Random(seed)
        hosts = [f"h{i}" + rng.choice(["", "", ".net"]) for i in range(60)]
        links = [tuple(rng.sample(hosts, 2)) for _ in range(150)]
    pages = pages_of(spark, links, hosts)
    base = duckdb.connect()
    base.register("pages", pages.toPandas())
    expected = sorted(base.sql(URLS).fetchall())
    assert sorted(tuple(r) for r in url_verdicts(pages).collect()) == expected
    if seed is None:
        assert {r[4] for r in expected if r[1] == "c13"} == {"block"}
