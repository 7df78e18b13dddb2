import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from llm_helpers import clashing, lower, plain_words
from tradevault.llm import simhash as H
from tradevault.llm.components import components


def brute_print(text, size=4):
    w = plain_words(lower(text))
    shingles = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, radius=4):
    """Component of each position."""
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def test_fingerprints():
    texts = [None, "", " \t", "A b", "a\tB\n c  d e f\x0bg ", "x y z w", "Ä b c d e", " lead and trail  "]
    assert H.fingerprints(pa.array(texts, pa.string())).tolist() == [brute_print(t) for t in texts]


def test_bit_sliced_comparison():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 1 << 63, 150, dtype=np.uint64)
    prints = np.concatenate([base, base ^ np.uint64(0b1011), base ^ np.uint64(0b11111), base ^ np.uint64((1 << 63) + 1)])
    a, b = H.close_pairs(prints[:200], prints, 4)
    want = {(i, j) for i in range(200) for j in range(len(prints)) if bin(int(prints[i]) ^ int(prints[j])).count("1") <= 4}
    assert set(zip(a.tolist(), b.tolist())) == want


@pytest.mark.parametrize("bands,block", [(5, 8192), (5, 7), (6, 64), (7, 16)])
def test_links_connect_all_close_prints(spark, bands, block):
    rnd = random.Random(bands + block)
    prints = {rnd.getrandbits(64) & ~((1 << 40) - 1) for _ in range(20)}
    while len(prints) < 400:
        x = rnd.choice(sorted(prints))
        for _ in range(rnd.randrange(1, 6)):
            x ^= 1 << rnd.randrange(64)
        prints.add(x)
    prints = sorted(prints)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    found = H.links(spark.createDataFrame([(x,) for x in signed], "fp long"), block=block, bands=bands).collect()
    root = {r["node"]: r["root"] for r in components(spark.createDataFrame(found, "a long, b long"), "a", "b").collect()}
    groups = brute_groups(prints)
    assert Counter(Counter(root.get(x, x) for x in signed).values()) == Counter(Counter(groups).values())
    assert all((root.get(signed[i], signed[i]) == root.get(signed[j], signed[j])) == (groups[i] == groups[j]) for i in range(0, 400, 7) for j in range(400))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 130)}, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_documents_equal_brute_force(documents, odd, empty):
    docs = documents.unionByName(odd)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    prints = [brute_print(t) for _, t in rows]
    groups = brute_groups(prints)
    least = {}
    for (i, _), g in zip(rows, groups):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    want = Counter((i, f"{p:016x}", least[g]) for (i, _), p, g in zip(rows, prints, groups))
    assert Counter(tuple(r) for r in H.report(clashing(docs)).collect()) == want
    assert H.report(empty).count() == 0


def test_dedup_keeps_one_row_of_each_group(documents, odd):
    docs = clashing(documents.unionByName(odd))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    groups = brute_groups([brute_print(t, 5) for _, t in rows])
    best = {}
    for (i, _), g in zip(rows, groups):
        best[g] = min((x for x in (best.get(g), i) if x is not None), default=None)
    out = H.dedup(docs, size=5)
    assert out.columns == docs.columns
    assert Counter(r[0] for r in out.select("doc_id").collect()) == Counter(best.values())
