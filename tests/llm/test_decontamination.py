import hashlib
from collections import Counter, defaultdict

import pytest

from llm_helpers import alnum_words, clashing
from tradevault.llm import decontamination as D


def brute(docs, items, n=10):
    grams = defaultdict(set)
    for i, t in items:
        w = alnum_words(t)
        size = min(n, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            grams[tuple(w[k : k + size])].add(i)
    sizes = {len(g) for g in grams}
    out = Counter()
    for i, t in docs:
        w, found = alnum_words(t), set()
        hit = [False] * len(w)
        for size in sizes:
            for k in range(len(w) - size + 1):
                if (g := tuple(w[k : k + size])) in grams:
                    hit[k : k + size] = [True] * size
                    found |= grams[g]
        ids = ",".join(sorted(map(str, found)))
        out[(i, len(w), sum(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), any(hit))] += 1
    return out


def pairs(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


@pytest.mark.parametrize("block", [1_000_000, 300])
def test_equals_brute_force(spark, documents, benchmark, block):
    items = spark.createDataFrame(pairs(benchmark, "item_id", "text") + [(900, "Alpha beta, gamma!"), (901, None), (902, ""), (903, "alpha BETA gamma"), (None, "x y")], "item_id long, text string")
    docs = documents.select("doc_id", "text").unionByName(spark.createDataFrame([(5000, "zz Alpha-beta gamma xx alpha beta gamma"), (5001, "alpha beta"), (5001, "alpha beta gamma")], "doc_id long, text string"))
    want = brute(pairs(docs, "doc_id", "text"), [x for x in pairs(items, "item_id", "text") if x[0] is not None])
    if block > 300:
        assert Counter(pairs(D.report(docs, items), "*")) == want
    found = D.find(docs, items, into="c", block_windows=block).select("doc_id", "c.n_words", "c.n_hit", "c.items")
    assert Counter((r[0], r[1], r[2], len(r[3])) for r in found.collect()) == Counter({x[:4]: n for x, n in want.items()})


def test_odd_rows(odd, empty, benchmark):
    assert Counter(pairs(D.report(odd, benchmark), "doc_id", "n_words")) == Counter((i, len(alnum_words(t))) for i, t in pairs(odd, "doc_id", "text"))
    assert D.report(empty, benchmark).count() == 0
    assert D.report(odd, benchmark.limit(0)).where("contaminated").count() == 0


def test_passages_go_and_clean_texts_stay(make, spark):
    passage = " ".join(f"w{i}" for i in range(14))
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    body = " ".join(f"v{i}" for i in range(40))
    docs = clashing(make((1, f"{body}. {passage.upper()}! tail é"), (2, f"{body}\n  x"), (3, passage), (4, None), (5, "")))
    out = D.decontaminate(docs, items)
    assert out.columns == docs.columns
    assert dict(pairs(out, "doc_id", "text")) == {1: f"{body}. ! tail é", 2: f"{body}\n  x", 4: None, 5: ""}
