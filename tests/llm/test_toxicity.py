from pyspark.sql import functions as F

from llm_helpers import clashing
from tradevault.llm import toxicity as X


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = X.report(docs, labels).where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in got}
    assert n.get((1, 1), 0) / (n.get((1, 1), 0) + n.get((1, 0), 0)) >= 0.85
    assert n.get((0, 1), 0) / (n.get((0, 1), 0) + n.get((0, 0), 0)) <= 0.02


def test_pairs_are_learned(spark, make):
    """Insult or group alone is harmless; both together are toxic. No additive weights can tell."""
    texts = ["they are fine people", "grouponia is a place", "the soup was rottenish", "rottenish grouponia folk"]
    docs = make(*[(i, f"{texts[i % 4]} number{i}") for i in range(800)])
    labels = spark.createDataFrame([(i, int(i % 4 == 3)) for i in range(800)], "doc_id long, toxic int")
    got = {(r["k"], r["predicted"]) for r in X.report(docs, labels).select((F.col("doc_id") % 4).alias("k"), "predicted").distinct().collect()}
    assert got == {(0, 0), (1, 0), (2, 0), (3, 1)}


def test_clean_keeps_columns_and_clean_rows(spark, make):
    docs = clashing(make(*[(i, "badword here" if i % 3 == 0 else "good thing there") for i in range(300)]))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)], "doc_id long, toxic int")
    out = X.clean(docs, labels)
    assert out.columns == docs.columns and {r[0] for r in out.select("doc_id").collect()} == {i for i in range(300) if i % 3}


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (4, 0), (4, 1), (6, 0), (99, 1)], "doc_id long, toxic int")
    got = X.report(clashing(odd), labels).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert X.report(empty, labels).count() == 0
    assert {r["score"] < 1e-9 for r in X.report(odd, labels.limit(0)).collect()} == {True}
