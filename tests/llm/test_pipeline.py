from collections import Counter

import pytest

import __spark_entry__ as entry
import check
import corpus_pipeline
from test_decontamination import brute as contaminated
from test_pii import brute as private
from test_simhash import brute_groups, brute_print
from tradevault.llm import toxicity

NAMES = ["op1_decontamination", "op2_language", "op3_token_counts", "op4_mixing", "op5_toxicity", "op6_pii", "op7_substring", "op8_chat", "op9_simhash", "op10_topk", "op11_alignment", "op12_spelling", "op13_winnowing", "pipeline"]


def test_registered():
    assert set(NAMES) <= set(entry.queries())


@pytest.mark.parametrize("name", ["op1_decontamination", "op7_substring", "op8_chat", "op10_topk"])
def test_query_equals_its_sql(spark, sf, name):
    problem, n = check.compare(entry.queries()[name](spark, sf), check.connect(sf), entry.oracle_sql()[name])
    assert problem is None and n > 0


@pytest.mark.parametrize("name", ["op2_language", "op3_token_counts", "op4_mixing", "op5_toxicity", "op6_pii", "op9_simhash", "op11_alignment", "op13_winnowing"])
def test_query_returns_every_document(spark, sf, name, documents):
    assert entry.queries()[name](spark, sf).count() == documents.count()


def test_stages(spark, sf, documents, benchmark):
    """Every stage against a brute-force version on its own input."""
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf).cache()
        assert out.columns == documents.columns
        seen[name] = ({r["doc_id"]: r["text"] for r in docs.collect()}, {r["doc_id"]: r["text"] for r in out.collect()})
        docs = out
    before, after = seen["toxicity"]
    scored = toxicity.report(documents, spark.read.parquet(f"{sf}/labels.parquet"))
    assert after == {r["doc_id"]: before[r["doc_id"]] for r in scored.where("predicted = 0").collect()}
    before, after = seen["near_duplicates"]
    ids = sorted(before)
    groups = brute_groups([brute_print(before[i]) for i in ids])
    assert after == {ids[g]: before[ids[g]] for g in set(groups)}
    before, after = seen["decontamination"]
    items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    hit = {x[0]: (x[1], x[2]) for x in contaminated(before.items(), items)}
    assert set(after) == {i for i, (n, k) in hit.items() if k == 0 or 2 * k < n}
    assert all(after[i] == before[i] for i in after if hit[i][1] == 0)
    assert all(x[5] is False for x in contaminated(after.items(), items))
    before, after = seen["pii"]
    assert set(after) == set(before) and all(not private(t) for t in after.values())
    assert all(after[i] == before[i] for i in after if not private(before[i]) and "<term>" not in after[i])
    before, after = seen["mixing"]
    assert set(after) <= set(before) and all(after[i] == before[i] for i in after)
    assert 0.2 < sum(map(len, after.values())) / sum(map(len, before.values())) < 0.8


def test_run_equals_the_stages(spark, sf, documents):
    docs = documents
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert Counter(corpus_pipeline.run(spark, sf).collect()) == Counter(docs.collect())


def test_stages_take_odd_rows(spark, sf, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
        assert docs.columns == odd.columns and docs.count() <= odd.count()
