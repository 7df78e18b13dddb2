import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import clashing
from tradevault.llm import mixing as M

CELLS = [("a", "en", 0, 600), ("a", "de", 1, 200), ("b", "en", 1, 100), ("b", "de", 0, 60), (None, "en", 0, 30), ("a", None, 1, 10)]


def test_raked_marginals_meet_their_targets():
    weight, sweeps = M.rake_local(CELLS, {"source": {"a": 0.5, "b": 0.3, None: 0.2}}, 0.7)
    assert sweeps < M.SWEEPS and abs(weight.sum() - 1) < 1e-9
    by = lambda d, v: sum(w for w, c in zip(weight, CELLS) if c[d] == v)
    assert [round(by(0, s), 5) for s in ("a", "b", None)] == [0.5, 0.3, 0.2]
    goal = M.tempered({"en": 730, "de": 260, None: 10}, 0.7)
    assert all(abs(by(1, v) - g) < 1e-5 for v, g in goal.items())


def test_spark_rakes_like_the_driver(spark):
    cells = spark.createDataFrame([(*c, ) for c in CELLS], "source string, lang string, topic int, tokens long")
    targets = {"topic": {0: 0.65, 1: 0.35}}
    want, _ = M.rake_local(CELLS, targets, 0.9)
    got = {tuple(r)[:3]: r["weight"] for r in M.rake_spark(cells, targets, 0.9, 3e-3).collect()}
    assert all(abs(got[c[:3]] - w) < 1e-2 for c, w in zip(CELLS, want))
    rated = spark.createDataFrame([(c[3], float(w)) for c, w in zip(CELLS, want)], "tokens long, rate double")
    tokens = np.array([c[3] for c in CELLS], float)
    assert abs(M.factor_spark(rated, 0.4) / M.factor_local(tokens, want, 0.4) - 1) < 1e-3


@pytest.mark.parametrize("keep", [0.01, 0.4, 0.9, 1.0])
def test_factor_keeps_the_expected_share(keep):
    rnd = np.random.default_rng(5)
    tokens, rate = rnd.integers(1, 100, 50).astype(float), rnd.random(50) * 3
    factor = M.factor_local(tokens, rate, keep)
    assert abs((tokens * np.minimum(1, factor * rate)).sum() / tokens.sum() - keep) < 1e-9


def test_report_and_sample_agree(documents):
    docs = clashing(documents)
    report = M.report(docs).cache()
    out = M.sample(docs)
    assert out.columns == docs.columns
    assert {r[0] for r in out.select("doc_id").collect()} == {r[0] for r in report.where("kept").select("doc_id").collect()}
    share = report.agg(F.sum(F.col("tokens") * F.col("probability")) / F.sum("tokens")).first()[0]
    assert abs(share - M.KEEP) < 1e-6
    assert out.join(documents, ["doc_id", "text", "lang", "source", "n_chars"], "left_anti").count() == 0


def test_odd_rows(odd, empty):
    got = M.report(odd).collect()
    assert len(got) == odd.count() and all(0 <= r["probability"] <= 1 for r in got)
    assert all((r["topic"] is None) == (r["tokens"] == 0) for r in got)
    assert M.report(empty).count() == 0 and M.sample(empty).count() == 0
    assert M.report(odd.where("doc_id in (1, 2, 3)")).count() == 3


def test_infeasible_and_clipped_targets_are_told(make):
    """Each source has one language, so both targets cannot hold; and a small source cannot grow beyond its own words."""
    words = " ".join(f"w{i}" for i in range(50))
    docs = make(*[(i, words, "de" if i % 10 == 0 else "en", "small" if i % 10 == 0 else "large") for i in range(100)])
    with pytest.warns(M.UnmetTargets):
        M.report(docs, {"source": {"small": 0.5, "large": 0.5}, "lang": {"en": 0.9, "de": 0.1}}).count()
    got = {(r["dimension"], r["category"]): r for r in M.shortfall(docs, {"source": {"small": 0.5, "large": 0.5}, "lang": {"en": 0.5, "de": 0.5}}).collect()}
    small = got["source", "small"]
    assert abs(small["target"] - 0.5) < 1e-9 and abs(small["raked"] - 0.5) < 1e-6 and abs(small["expected"] - 0.2) < 1e-6


@pytest.mark.parametrize("keep", [0.01, 0.4, 0.9, 0.999])
def test_factor_is_the_same_at_every_size(spark, keep):
    rnd = np.random.default_rng(6)
    tokens, rate = rnd.integers(1, 100, 300), rnd.random(300) ** 4 * 30
    cells = spark.createDataFrame(list(zip(tokens.tolist(), rate.tolist())), "tokens long, rate double")
    assert abs(M.factor_spark(cells, keep) / M.factor_local(tokens.astype(float), rate, keep) - 1) < 1e-12
