import hashlib
import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import pytest

from llm_helpers import clashing
from tradevault.llm import alignment as A
from tradevault.llm.tokens import vocabulary

PATHS = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
PARTS = ["a", " ", "  ", "\n", " \n", "\t", "don't", "the", " and", "\x85", "\xa0", "　x", "é", "ﬁ", "中文", "😀", "<|endoftext|>", "<s>", "▁", "<0x41>", "12", "_", "́", "\r\n", "\x00", "​", "½", "unbelievable", "..."]


@pytest.fixture(scope="module")
def vocab():
    return A.Vocabularies(*PATHS)


def links_of(vocab, text):
    """(A ids, B ids, groups, linked index pairs) of a text encoded in one piece, by plain loops; None if not given back."""
    if not text:
        return None
    a = vocab.a.encode(" " + text, add_special_tokens=False).ids
    b = vocab.b.encode(text)
    raw = (" " + text).encode()
    ends = []
    for ids, size in ((a, vocab.bytes_a), (b, vocab.bytes_b)):
        if b"".join(size[i] for i in ids) != raw:
            return None
        at, e = 0, []
        for i in ids:
            at += len(size[i])
            e.append(at)
        ends.append(e)
    cuts = sorted(set(ends[0]) & set(ends[1]))
    groups = [[[], []] for _ in cuts]
    for side, (ids, es) in enumerate(zip((a, b), ends)):
        for i, e in zip(ids, es):
            groups[bisect_left(cuts, e)][side].append(i)
    links, j = [], 0
    for i, e in enumerate(ends[0]):
        s = ends[0][i - 1] if i else 0
        for k in range(j, len(b)):
            if (ends[1][k - 1] if k else 0) >= e:
                break
            if ends[1][k] > s:
                links.append((a[i], b[k]))
            else:
                j = k + 1
    return a, b, groups, links


def brute(vocab, rows):
    made = [(i, links_of(vocab, t)) for i, t in rows]
    count = Counter(p for _, m in made if m for p in set(m[3]))
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    out = []
    for i, m in made:
        if m is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = m
        shown = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        digest = hashlib.sha256(shown.encode()).hexdigest()
        out.append((i, len(a), len(b), len(groups), len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), digest))
    return Counter(out)


def test_special_ids_and_bytes(vocab):
    assert vocab.cuts
    assert vocab.a.token_to_id("<|endoftext|>") not in vocab.a.encode(" <|endoftext|>", add_special_tokens=False).ids
    assert vocab.bytes_b[vocab.b.piece_to_id("<0x0A>")] == b"\n" and vocab.bytes_b[vocab.b.piece_to_id("▁the")] == b" the"


def test_coalescing():
    order, group = A.coalesce(np.array([0, 2, 5, 0, 3, 5]), np.array([2, 5, 6, 3, 5, 6]))
    assert order.tolist() == [0, 3, 1, 4, 2, 5] and group.tolist() == [0, 0, 0, 0, 1, 1]
    a, b = A.expand(np.array([0, 2, 5]), np.array([2, 5, 6]), np.array([0, 3, 5]), np.array([3, 5, 6]))
    assert list(zip(a.tolist(), b.tolist())) == [(0, 0), (1, 0), (1, 1), (2, 2)]


def test_chunks_equal_whole_texts(vocab):
    """Cutting at spaces and remembering chunks changes nothing; a tiny table is emptied over and over."""
    aligner, rnd = A.Aligner(vocab, cache=20), random.Random(5)
    for _ in range(1500):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randrange(14)))
        got, want = aligner.texts([text])[0], links_of(vocab, text)
        if want is None:
            assert got[:5] == (0, 0, 0, 0, ""), repr(text)
        else:
            a, b, groups, links = want
            shown = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
            assert got[:5] == (len(a), len(b), len(groups), len(links), hashlib.sha256(shown.encode()).hexdigest()), repr(text)
            keys = Counter(x * vocab.size_b + y for x, y in links)
            assert dict(zip(np.frombuffer(got[5], np.uint64).tolist(), np.frombuffer(got[6], np.uint32).tolist())) == keys


def test_pair_counts_in_bounded_memory(spark, vocab, documents):
    aligned = A.align(documents.limit(60), *PATHS).cache()
    one = A.pair_counts(aligned, vocab.size_b).collect()
    assert Counter(one) == Counter(A.pair_counts(aligned, vocab.size_b, flush=500).collect()) and len(one) > 500


def test_documents_equal_brute_force(vocab, documents, odd, empty, make):
    more = make((8, "a▁b and more"), (9, "x" * 3000), (10, "the end of a"), (10, "the end of a"))
    docs = documents.unionByName(odd).unionByName(more)
    want = brute(vocab, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert Counter(tuple(r) for r in A.report(clashing(docs), *PATHS).collect()) == want
    assert A.report(empty, *PATHS).count() == 0


def test_blocks_of_pairs(vocab, documents):
    docs = documents.limit(40)
    want = Counter(A.report(docs, *PATHS).collect())
    assert Counter(A.report(docs, *PATHS, block=1500, cache=100).collect()) == want
