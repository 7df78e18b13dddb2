import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rows_helper import rows
from tradevault.operators.joins import expand_left
from tradevault.functions.ordered import large_keys, share_of, with_ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; values include NULLs; order positions have gaps."""
    rnd = random.Random(7)
    data = []
    for i in range(600):
        key = "hot" if i % 3 else f"k{i % 11}"
        data.append((key, rnd.randrange(10_000), i, rnd.choice([None, "a", "b"]), rnd.randrange(-5, 9)))
    return spark.createDataFrame(data, "k string, t long, id long, v string, n long").cache()


OPTIONS = dict(lag={"before": "v", "before_n": "n"}, lead={"after": "v"}, number="no", running={"total": "n"}, fill={"seen": "v"})
COLS = ["k", "t", "id", "before", "before_n", "after", "no", "total", "seen"]


def plain(df):
    w = Window.partitionBy("k").orderBy("t", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(
        "*", F.lag("v").over(w).alias("before"), F.lag("n").over(w).alias("before_n"), F.lead("v").over(w).alias("after"),
        F.row_number().over(w).alias("no"), F.sum("n").over(upto).alias("total"), F.last("v", True).over(upto).alias("seen"),
    )


@pytest.mark.parametrize("target", [3, 40, 10_000])
def test_sized_chunks_equal_the_plain_window(skewed, target):
    out = with_ordered(skewed, ["k"], ["t", "id"], target_rows=target, **OPTIONS)
    assert rows(out, *COLS) == rows(plain(skewed), *COLS)


def test_cuts_computed_before(skewed):
    large = large_keys(skewed, ["k"], ["t", "id"], 50, sizes=skewed.select("k")).cache()
    out = with_ordered(skewed, ["k"], ["t", "id"], large=large, **OPTIONS)
    assert rows(out, *COLS) == rows(plain(skewed), *COLS)


def test_types_do_not_depend_on_size(spark, skewed):
    priced = skewed.withColumn("d", F.col("n").cast("decimal(18,4)"))
    kinds = [with_ordered(priced, ["k"], ["t", "id"], target_rows=t, running={"s": "d"}, number="no").schema for t in (3, 10_000)]
    assert kinds[0] == kinds[1] and kinds[0]["s"].dataType.simpleString() == "decimal(28,4)"


def test_no_job_while_the_plan_is_built(spark, skewed):
    sc = spark.sparkContext
    skewed.count()
    before = max(sc.statusTracker().getJobIdsForGroup(None), default=-1)
    with_ordered(skewed, ["k"], ["t", "id"], target_rows=3, **OPTIONS)
    assert max(sc.statusTracker().getJobIdsForGroup(None), default=-1) == before


def test_given_chunk_equals_the_plain_window(skewed):
    out = with_ordered(skewed, ["k"], ["t", "id"], F.floor(F.col("t") / 700), **OPTIONS)
    assert rows(out, *COLS) == rows(plain(skewed), *COLS)


SHAPES = {
    "even": lambda i: i,
    "outlier": lambda i: 10**15 if i == 7 else i,
    "equal times": lambda i: 5,
    "burst": lambda i: i if i % 10 == 0 else 77,
}


@pytest.mark.parametrize("key", ["hot", None])
@pytest.mark.parametrize("shape", SHAPES)
def test_chunks_of_a_hot_key_are_even(spark, key, shape):
    df = spark.createDataFrame([(key, SHAPES[shape](i), i) for i in range(2000)] + [("few", i, i) for i in range(30)], "k string, t long, id long")
    large = large_keys(df, ["k"], ["t", "id"], 100).collect()
    assert [r["__key"]["c0"] for r in large] == [key]
    cuts = [tuple(c) for c in large[0]["__cuts"]]
    places = sorted((SHAPES[shape](i), i) for i in range(2000))
    sizes = Counter(sum(c <= p for c in cuts) for p in places)
    assert max(sizes.values()) <= 130
    out = with_ordered(df, ["k"], ["t", "id"], target_rows=100, number="no", lag={"before": "id"})
    got = [(r["t"], r["id"], r["no"]) for r in out.filter(F.col("k").eqNullSafe(F.lit(key))).collect()]
    assert sorted(got) == [(t, i, n + 1) for n, (t, i) in enumerate(places)]


def test_null_neighbour_is_not_a_missing_neighbour(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("a", 9, "z")], "k string, t long, v string")
    out = with_ordered(df, ["k"], ["t"], F.col("t"), lag={"before": "v"})
    assert rows(out, "t", "before") == [(1, None), (2, "x"), (9, None)]


def test_share(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 0), (None, 1), (None, 3)], "k string, q int")
    want = [("a", 1, 0.25), ("a", 3, 0.75), ("b", 0, None), (None, 1, 0.25), (None, 3, 0.75)]
    assert rows(share_of(df, ["k"], "q", "s"), "k", "q", "s") == sorted(want, key=repr)


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, i, i) for i in range(30)] + [("a", i, i) for i in range(60)], "k string, t long, id long")
    out = with_ordered(df, ["k"], ["t"], target_rows=10, lag={"before": "id"}, number="no")
    got = {(r["k"], r["t"]): (r["before"], r["no"]) for r in out.collect()}
    assert all(got[(k, i)] == (i - 1 if i else None, i + 1) for k, n in ((None, 30), ("a", 60)) for i in range(n))


@pytest.mark.parametrize("target", [3, 1000])
def test_salted_left_join_equals_plain(spark, target):
    parent = spark.createDataFrame([("hot", 1), ("few", 2), ("none", 3), (None, 4)], "k string, p int")
    child = spark.createDataFrame([("hot", i) for i in range(40)] + [("few", 100), ("stray", 101), (None, 102)], "k string, c int")
    out = expand_left(parent, child, "k", target)
    assert rows(out, "k", "p", "c") == rows(parent.join(child, "k", "left"), "k", "p", "c")
