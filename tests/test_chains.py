"""Chains of corrections by path doubling, and ownership as a fixed point."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from tradevault.operators import chains, hierarchy
from tradevault.plans import submission


def ends(links):
    """Brute force: node -> (root, depth, cyclic)."""
    out = {}
    for n in links:
        seen, at = [], n
        while at in links and at not in seen:
            seen.append(at)
            at = links[at]
        out[n] = (min(seen[seen.index(at) :]), None, True) if at in seen else (at, len(seen), False)
    return out


def roots(spark, links, kind="long"):
    df = spark.createDataFrame(list(links.items()), f"id {kind}, ref {kind}")
    return {r["node"]: (r["root"], r["depth"], r["cyclic"]) for r in chains.chain_roots(df, "id", "ref").collect()}


def test_chains_of_many_lengths(spark):
    links = {1: 0, 11: 10, 12: 11, **{100 + i: 99 + i for i in range(40)}, 301: 300, 302: 300, 303: 302}
    assert roots(spark, links) == ends(links)


def test_cycles_and_what_leads_into_them(spark):
    links = {5: 5, 21: 22, 22: 23, 23: 21, 24: 21, 25: 24, **{50 + i: 50 + (i + 1) % 9 for i in range(9)}, 70: 53, 2: 1}
    assert roots(spark, links) == ends(links)


def test_random_pointers(spark):
    rnd = random.Random(3)
    links = {f"n{i}": f"n{rnd.randrange(60)}" for i in rnd.sample(range(60), 50)}
    assert roots(spark, links, "string") == ends(links)


def test_odd_links(spark):
    df = spark.createDataFrame([(None, 1), (2, None), (3, 2), (3, 2), (4, 9), (4, 3)], "id long, ref long")
    assert {tuple(r) for r in chains.chain_roots(df, "id", "ref").collect()} == {(3, 2, 1, False), (4, 2, 2, False)}
    assert chains.chain_roots(df.limit(0), "id", "ref").count() == 0


def test_rounds_grow_with_the_logarithm(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(chains, "doubled", lambda *a, old=chains.doubled: rounds.append(1) or old(*a))
    assert roots(spark, {i + 1: i for i in range(40)})[40] == (0, 40, False)
    assert len(rounds) == math.ceil(math.log2(40))


def test_corrections_of_corrections(spark):
    """An event, a correction, a correction of that, a second chain, a circle, and a correction of an unknown event."""
    rows = [(1, None, 1, "a"), (2, 1, 2, "b"), (3, 2, 3, "c"), (10, None, 1, "d"), (20, None, 1, "e"), (21, 20, 9, "f"), (22, 20, 5, "g"), (30, 31, 1, "h"), (31, 30, 2, "i"), (40, 39, 1, "j")]
    events = spark.createDataFrame(rows, "id long, ref long, ts long, v string")
    got = {r["effective_id"]: (r["id"], r["v"]) for r in submission.effective_events(events, "id", "ref", ["ts"]).collect()}
    assert got == {1: (3, "c"), 10: (10, "d"), 20: (21, "f"), 30: (31, "i"), 39: (40, "j")}
    pairs = {r["id"]: (r["original_v"], r["original_found"], r["effective_id"], r["chain_depth"], r["cyclic"]) for r in submission.pair_corrections(events, "id", "ref", ["ts"]).collect()}
    assert pairs == {
        2: ("a", True, 1, 1, False), 3: ("b", True, 1, 2, False), 21: ("e", True, 20, 1, False), 22: ("e", True, 20, 1, False),
        30: ("i", True, 30, None, True), 31: ("h", True, 30, None, True), 40: (None, False, 39, 1, False),
    }


@pytest.mark.parametrize("n", [1, 2, 40])
def test_long_chains_of_corrections(spark, n):
    events = spark.createDataFrame([(i, i - 1 if i else None, i) for i in range(n + 1)], "id long, ref long, ts long")
    assert [(r["effective_id"], r["id"]) for r in submission.effective_events(events, "id", "ref", ["ts"]).collect()] == [(0, n)]


# ---- ownership


def shares(edges):
    """Brute force: solve x = W x + b for every ultimate owner, on parties that one reaches."""
    owners, owned = {o for o, _, _ in edges}, {p for _, p, _ in edges}
    below = defaultdict(set)
    for o, p, _ in edges:
        below[o].add(p)
    out = {}
    for top in owners - owned:
        seen, todo = set(), [top]
        while todo:
            for p in below[todo.pop()]:
                if p not in seen:
                    seen.add(p)
                    todo.append(p)
        nodes = sorted(seen)
        at = {p: k for k, p in enumerate(nodes)}
        w, b = np.zeros((len(nodes), len(nodes))), np.zeros(len(nodes))
        for o, p, pct in edges:
            if p in at:
                if o == top:
                    b[at[p]] += pct
                elif o in at:
                    w[at[p], at[o]] += pct
        x = np.linalg.solve(np.eye(len(nodes)) - w, b)
        out.update({(p, top): round(float(x[k]), 9) for p, k in at.items()})
    return out


def owned_by(spark, edges):
    got = hierarchy.effective_ownership(spark.createDataFrame(edges, "owner string, owned string, pct double")).collect()
    assert len({(r["party"], r["ultimate_owner"]) for r in got}) == len(got)
    return {(r["party"], r["ultimate_owner"]): (round(r["effective_pct"], 9), r["chain_depth"]) for r in got}


CASES = {
    "diamond": [("t", "a", 0.6), ("t", "b", 0.5), ("a", "c", 0.5), ("b", "c", 0.5), ("u", "b", 0.5)],
    "cycle": [("t", "a", 0.5), ("a", "b", 0.9), ("b", "c", 0.8), ("c", "a", 0.4), ("c", "d", 1.0)],
    "cycle between cycles": [("t", "a", 0.5), ("a", "b", 1.0), ("b", "a", 0.5), ("b", "m", 0.7), ("m", "x", 0.6), ("x", "y", 1.0), ("y", "x", 0.3), ("y", "z", 0.4), ("u", "m", 0.3)],
    "own shares": [("t", "a", 0.9), ("a", "a", 0.1), ("a", "b", 1.0)],
    "strong cycle": [("t", "a", 0.001), ("b", "a", 0.999), ("a", "b", 1.0)],
}


@pytest.mark.parametrize("name", CASES)
def test_shares_equal_the_linear_system(spark, name):
    got = owned_by(spark, CASES[name])
    assert {k: v[0] for k, v in got.items()} == shares(CASES[name])


def test_shortest_walk_and_closed_cycle(spark):
    got = owned_by(spark, CASES["cycle between cycles"])
    assert got["z", "t"][1] == 6 and got["z", "u"][1] == 4
    closed = [("p", "q", 1.0), ("q", "p", 1.0), ("q", "r", 1.0), ("t", "a", 1.0)]
    assert owned_by(spark, closed) == {("a", "t"): (1.0, 1)}
    with pytest.raises(ValueError, match="100 percent"):
        owned_by(spark, [("t", "a", 0.5), ("b", "a", 1.5), ("a", "b", 1.0)])


def test_random_graphs(spark):
    rnd = random.Random(8)
    for _ in range(2):
        parties, weights = [f"p{i}" for i in range(14)], {}
        for p in parties:
            for o in rnd.sample(parties + ["t0", "t1"], 3):
                weights[o, p] = rnd.uniform(0.05, 0.3)
        edges = [(o, p, w) for (o, p), w in weights.items()]
        got, want = owned_by(spark, edges), shares(edges)
        assert set(got) == set(want) and all(got[k][0] == pytest.approx(want[k], abs=2e-9) for k in want)


def test_dense_layers_end(spark):
    """12 layers of 12 parties hold 12**11 simple paths; shares flow layer by layer."""
    edges = [(f"{k}-{i}", f"{k + 1}-{j}", 1 / 12) for k in range(11) for i in range(12) for j in range(12)]
    got = owned_by(spark, edges)
    assert len(got) == 11 * 12 * 12 and got["11-3", "0-5"] == (round(1 / 12, 9), 11)


def test_repeated_and_missing_parties(spark):
    edges = [("t", "a", 0.25), ("t", "a", 0.25), (None, "a", 0.5), ("t", None, 0.5)]
    assert owned_by(spark, edges) == {("a", "t"): (0.5, 1)}
    assert hierarchy.effective_ownership(spark.createDataFrame([], "owner string, owned string, pct double")).count() == 0


@pytest.mark.parametrize("name", ["diamond", "cycle", "own shares"])
def test_large_graphs_are_walked(spark, monkeypatch, name):
    """Shares around a cycle shrink, so no closure of the core is made; a share below the tolerance still has its row."""
    monkeypatch.setattr(hierarchy, "SMALL", 0)
    monkeypatch.setattr(hierarchy, "closure", None)
    edges = [*CASES[name], ("t", "l1", 1e-9), ("l1", "l2", 1e-9), ("l2", "l3", 1.0), ("l3", "l2", 0.01)]
    got = owned_by(spark, edges)
    assert {k: v[0] for k, v in got.items()} == shares(edges)
    assert got["l3", "t"] == (0.0, 3)


@pytest.mark.parametrize("name", ["strong cycle", "cycle between cycles"])
def test_walked_shares_that_do_not_shrink_cross_their_cycles(spark, monkeypatch, name):
    monkeypatch.setattr(hierarchy, "SMALL", 0)
    monkeypatch.setattr(hierarchy, "STRETCH", 3)
    calls = []
    monkeypatch.setattr(hierarchy, "closure", lambda *a, old=hierarchy.closure: calls.append(1) or old(*a))
    got = owned_by(spark, CASES[name])
    assert {k: v[0] for k, v in got.items()} == shares(CASES[name]) and calls
    if name == "cycle between cycles":
        assert got["z", "t"][1] == 6 and got["z", "u"][1] == 4


def test_closed_cycle_that_holds_a_part(spark):
    """A party half owned by a closed cycle passes on the half that an ultimate owner holds."""
    edges = [("c", "d", 1.0), ("d", "c", 1.0), ("d", "p", 0.5), ("t", "p", 0.5), ("p", "x", 0.9), ("x", "y", 0.5), ("y", "x", 0.1)]
    got = owned_by(spark, edges)
    assert {k: v[0] for k, v in got.items()} == shares(edges) and got["x", "t"][1] == 2
