import datetime as dt
import random

import pytest

from tradevault.operators import interval
from tradevault.plans.risk import adjustment_factors

D = dt.date
OPEN = D(9999, 12, 31)
DIM = [
    ("a", 1, D(2020, 1, 10), D(2020, 3, 31)), ("a", 2, D(2020, 4, 1), D(2020, 4, 1)),
    ("a", 3, D(2020, 6, 1), OPEN), ("b", 4, D(2019, 1, 1), D(2021, 12, 31)),
]
FACT = {
    D(2020, 1, 9): None, D(2020, 1, 10): 1, D(2020, 3, 31): 1, D(2020, 4, 1): 2, D(2020, 5, 1): None, D(2020, 6, 1): 3, D(2024, 2, 29): 3,
}


@pytest.mark.parametrize("span", [None, ("2020-01-01", "2024-12-31")])
@pytest.mark.parametrize("bucket", ["month", "quarter", "year"])
def test_lookup_at_window_edges(spark, span, bucket):
    dim = spark.createDataFrame(DIM, "k string, sk int, effective_start_date date, effective_end_date date")
    fact = spark.createDataFrame([("a", d) for d in FACT] + [("b", D(2021, 12, 31)), ("z", D(2020, 6, 1)), (None, D(2020, 6, 1))], "key string, day date")
    out = interval.pit_lookup(fact, dim, "key", "k", "day", {"sk": "sk"}, span=span, bucket=bucket)
    got = {(r["key"], r["day"]): r["sk"] for r in out.collect()}
    assert len(got) == out.count() == len(FACT) + 3
    assert all(got[("a", d)] == sk for d, sk in FACT.items())
    assert got[("b", D(2021, 12, 31))] == 4 and got[("z", D(2020, 6, 1))] is None and got[(None, D(2020, 6, 1))] is None


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("target", [None, 7])
def test_nearest_in_time_against_brute_force(spark, direction, target):
    rnd = random.Random(3)
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    left = [("h" if i % 3 else f"k{i % 4}", i, at(rnd.randrange(400_000))) for i in range(120)]
    right = [("h" if i % 3 else f"k{i % 5}", i, at(rnd.randrange(400_000))) for i in range(90)]
    right.append(("h", 999, left[1][2]))  # equal time counts
    l = spark.createDataFrame(left, "k string, id int, ts timestamp")
    r = spark.createDataFrame(right, "k string, rid int, rts timestamp")
    out = interval.asof_join(l, r, ["k"], "ts", "rts", {"rid": "rid"}, tie=["rid"], direction=direction, target_rows=target)
    want = {}
    for k, i, ts in left:
        hits = [(rts, rid) for rk, rid, rts in right if rk == k and (rts <= ts if direction == "backward" else rts >= ts)]
        if not hits:
            want[i] = None
        elif direction == "backward":
            want[i] = max(hits)[1]
        else:
            first = min(h[0] for h in hits)
            want[i] = max(h for h in hits if h[0] == first)[1]
    assert {x["id"]: x["rid"] for x in out.collect()} == want


def test_adjustment_factor_counts_only_later_actions(spark):
    a = spark.createDataFrame([("i", D(2020, 2, 1), 0.5), ("i", D(2020, 3, 1), 0.1)], "instrument_id string, ex_date date, adjustment_factor double")
    p = spark.createDataFrame([("i", D(2020, 1, 1)), ("i", D(2020, 2, 1)), ("i", D(2020, 4, 1)), ("j", D(2020, 1, 1))], "instrument_id string, price_date date")
    got = {(r[0], r[1]): r[2] for r in adjustment_factors(a, p).collect()}
    assert got[("i", D(2020, 1, 1))] == pytest.approx(0.05) and got[("i", D(2020, 2, 1))] == pytest.approx(0.1)
    assert got[("i", D(2020, 4, 1))] == 1.0 and got[("j", D(2020, 1, 1))] == 1.0
