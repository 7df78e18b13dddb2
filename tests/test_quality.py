import datetime as dt

import pytest

from rows_helper import rows
from tradevault.operators import hierarchy, joins, quality
from tradevault.plans import derived, dims, facts, rules, states

R = {"has_id": "id IS NOT NULL", "positive": "v > 0"}


@pytest.fixture(scope="module")
def rowset(spark):
    return spark.createDataFrame([(1, 5), (2, -1), (None, 3), (3, None)], "id int, v int")


def test_null_result_is_a_violation(rowset):
    assert {r["rule"]: r["broken"] for r in quality.violations(rowset, R).collect()} == {"has_id": 1, "positive": 2}


def test_modes(rowset):
    assert rows(quality.expect(rowset, R, "drop"), "id") == [(1,)]
    good, bad = quality.quarantine(rowset, R)
    assert good.count() == 1 and bad.count() == 3
    with pytest.raises(Exception, match="expectation failed: positive"):
        quality.expect(rowset.filter("id = 2"), R, "fail").collect()
    assert quality.expect(rowset.filter("id = 1"), R, "fail").count() == 1


def test_machines_are_well_formed():
    assert len(states.machines()) == 21  # confirmation and match status are two machines of one entity
    for m in states.machines():
        assert all(a and b for a, b in states.moves(m))


def test_transitions(spark):
    t = lambda n: dt.datetime(2024, 1, 1, 0, n)
    path = {"ok": "NEW ACCEPTED WORKING MODIFIED WORKING PARTIALLY_FILLED FILLED BUST", "entry": "ACCEPTED WORKING",
            "jump": "NEW FILLED", "terminal": "NEW REJECTED NEW", "repeat": "NEW NEW ACCEPTED"}
    data = [(k, t(i), s) for k, p in path.items() for i, s in enumerate(p.split())]
    df = spark.createDataFrame(data, "k string, ts timestamp, status string")
    bad = quality.invalid_transitions(quality.state_transitions(df, ["k"], ["ts"]), states.edge_frame(spark), "order")
    assert rows(bad, "k", "from_state", "status") == [("entry", None, "ACCEPTED"), ("jump", "NEW", "FILLED"), ("terminal", "REJECTED", "NEW")]


def test_ownership_diamond_cycle_and_depth(spark):
    e = [("top", "l", 0.5), ("top", "r", 0.4), ("l", "leaf", 0.5), ("r", "leaf", 0.5), ("y", "x", 1.0), ("z", "y", 1.0), ("x", "z", 1.0),
         ("d1", "d0", 0.9), ("d2", "d1", 0.9)]
    edges = spark.createDataFrame(e, "owner string, owned string, pct double")
    out = hierarchy.ownership_chains(edges)
    got = {(r["party"], r["ultimate_owner"], r["chain_depth"], round(r["effective_pct"], 6)) for r in out.collect()}
    assert ("leaf", "top", 2, 0.25) in got and ("leaf", "top", 2, 0.2) in got and ("d0", "d2", 2, 0.81) in got
    assert not any(p in ("x", "y", "z") for p, *_ in got)  # a pure cycle has no ultimate owner


@pytest.mark.parametrize("depth", [15, 40])
def test_long_lines_are_walked_to_their_end(spark, depth):
    edges = spark.createDataFrame([(f"n{i + 1}", f"n{i}", 1.0) for i in range(depth)] + [("a", "b", 1.0), ("b", "a", 1.0)], "owner string, owned string, pct double")
    chains = hierarchy.ownership_chains(edges)
    assert rows(chains, "party", "ultimate_owner", "chain_depth") == sorted([(f"n{i}", f"n{depth}", depth - i) for i in range(depth)], key=repr)
    assert rows(hierarchy.unresolved_parties(edges, chains), "party") == [("a",), ("b",)]
    assert hierarchy.ownership_totals(chains).count() == depth
    tree = spark.createDataFrame([("n0", None)] + [(f"n{i + 1}", f"n{i}") for i in range(depth - 1)], "id string, up string")
    assert hierarchy.hierarchy_paths(tree, "id", "up").agg({"depth": "max"}).first()[0] == depth


def test_bands_above_fifty_legs(spark):
    head = spark.createDataFrame([(n,) for n in (50, 55, 80, 101, 500)], "leg_count int")
    bands = spark.createDataFrame([("WIDE", 60, 100, True), ("ALL", 4, 100, True), ("OPEN", 101, None, True), ("OLD", 1, 999, False)], "multileg_strategy_bk string, leg_count_min int, leg_count_max int, is_current boolean")
    assert rows(facts.match_strategy(head, bands), "leg_count", "multileg_strategy_bk") == sorted([(50, "ALL"), (55, "ALL"), (80, "WIDE"), (80, "ALL"), (101, "OPEN"), (500, "OPEN")], key=repr)


def test_hierarchy_paths(spark):
    n = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("lost", "nobody")], "id string, up string")
    assert rows(hierarchy.hierarchy_paths(n, "id", "up"), "id", "path") == [("a", "a"), ("b", "a/b"), ("c", "a/b/c")]


def test_allocation_adds_up(spark):
    fills = spark.createDataFrame([("f1", "p", 10), ("f2", "p", 1)], "fill_id string, party string, units long")
    ins = spark.createDataFrame(
        [("p", "a1", "EQUAL", None, None), ("p", "a2", "EQUAL", None, None), ("p", "a3", "EQUAL", None, None)],
        "party string, account_id string, allocation_rule string, target_percentage double, target_quantity long",
    )
    out = derived.allocate(fills, ins, "party")
    assert rows(out, "fill_id", "account_id", "allocated_units") == [
        ("f1", "a1", 4), ("f1", "a2", 3), ("f1", "a3", 3), ("f2", "a1", 1), ("f2", "a2", 0), ("f2", "a3", 0)]


def test_leg_bounds(spark):
    h = spark.createDataFrame([(n,) for n in (1, 2, 50, 51)], "leg_count int")
    assert rows(quality.expect(h, rules.MULTILEG_HEADER, "drop"), "leg_count") == [(2,), (50,)]


def test_event_codes_are_disjoint_and_known(spark):
    seen = [c for codes in facts.FACT_CODES.values() for c in codes]
    assert len(seen) == len(set(seen))
    known = {r[0] for r in dims.dim_event_type(spark).select("cat_event_code").collect()}
    assert len(known) == 99 and set(seen) <= known


def test_reconcile_classes(spark):
    i = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 7)], "k string, v int")
    e = spark.createDataFrame([("a", 1), ("b", 5), ("d", 4), (None, 7)], "k string, v int")
    out = joins.reconcile(i, e, ["k"], "v")
    assert rows(out, "k", "break_value", "reconciliation_status") == [("a", 0, "MATCHED"), ("b", 3, "BROKEN"), ("c", -3, "INTERNAL_ONLY"), ("d", 4, "EXTERNAL_ONLY"), (None, 0, "MATCHED")]


def test_derived_link_looks_both_ways(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 10, m)
    o = spark.createDataFrame([(1, "p", "x", t(0)), (2, "p", "y", t(10))], "order_id long, p string, d string, order_ts timestamp")
    e = spark.createDataFrame([("e0", None, "p", "y", t(1)), ("e1", None, "p", "q", t(2)), ("e2", None, "p", "q", t(9)), ("e3", None, "p", "q", t(59))], "fill_id string, order_id long, p string, d string, fill_ts timestamp")
    out = derived.derive_order_link(e, o, ["p", "d"], ["p"], 600)
    assert rows(out, "fill_id", "order_id", "derivation_rule") == [("e0", 2, "EXACT_KEY"), ("e1", 1, "TIMESTAMP_NEAREST"), ("e2", 2, "TIMESTAMP_NEAREST")]
