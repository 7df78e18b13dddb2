import hashlib
import random
from collections import Counter

import pytest

from llm_helpers import clashing, plain_words
from tradevault.llm import substring as S


def brute(rows, window):
    low = {}
    for i, t in rows:
        w = plain_words(t)
        for k in range(len(w) - window + 1 if i is not None else 0):
            key = tuple(w[k : k + window])
            low[key] = min(low.get(key, i), i)
    out = Counter()
    for i, t in rows:
        w = plain_words(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1 if i is not None else 0):
            if low[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[(i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


def test_covers_hold_every_difference():
    for period, cover in S.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("window", [4, 12])
def test_small_texts_equal_brute_force(spark, window, monkeypatch):
    rnd = random.Random(window)
    passages = [[rnd.choice("abc") for _ in range(rnd.randrange(3, 40))] for _ in range(6)]
    rows = []
    for i in range(120):
        words = sum((rnd.choice(passages) if rnd.random() < 0.6 else [f"u{rnd.random()}" for _ in range(4)] for _ in range(4)), [])
        rows.append((rnd.randrange(60) if i % 9 else None, rnd.choice([" ", "\n", " \t"]).join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(tuple(r) for r in S.report(docs, window, n_buckets=5).collect()) == brute(rows, window)


def test_documents_equal_brute_force(documents, odd, empty):
    docs = documents.unionByName(odd)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert Counter(tuple(r) for r in S.report(clashing(docs)).collect()) == brute(rows, 50)
    assert S.report(empty).count() == 0


def test_dedup_keeps_columns_and_untouched_texts(make):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = clashing(make((1, f"a\n{passage}  b"), (2, f"c {passage}\td"), (3, "x\n y"), (4, None)))
    out = S.dedup(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: f"a\n{passage}  b", 2: "c d", 3: "x\n y", 4: None}


def test_words_whose_polynomials_collide_are_told_apart(make):
    """A Thue-Morse word of 1,024 letters and its complement: equal modulo 2**64 in every odd base."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    head = " ".join(f"w{i}" for i in range(49))
    docs = make((1, f"{head} {word}"), (2, f"{head} {word.translate(str.maketrans('ab', 'ba'))}"), (3, f"{head} {word}"))
    got = {r["doc_id"]: r["n_removed"] for r in S.report(docs).collect()}
    assert got == {1: 0, 2: 0, 3: 50}
