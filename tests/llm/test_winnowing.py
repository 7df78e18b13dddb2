import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from llm_helpers import clashing
from tradevault.llm import winnowing as Win

MASK = (1 << 64) - 1


def mixed(h):
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & MASK
    return h ^ (h >> 31)


def brute(text, k=Win.GRAM, w=Win.WINDOW):
    """[(hash, place)] by a rolling hash and a plain minimum per window."""
    points = [ord(c) for c in text or ""]
    if not points:
        return []
    k = min(k, len(points))
    base, h, hashes = int(Win.BASE), 0, []
    # The halves of a gram weigh their code points by powers of the base; rolling is checked against the weights.
    weights = weight(k)
    for i in range(len(points) - k + 1):
        h = sum((p + 1) * x for p, x in zip(points[i : i + k], weights)) & MASK
        hashes.append(mixed(h))
    assert base % 2
    w = min(w, len(hashes))
    picked = {}
    for i in range(len(hashes) - w + 1):
        low = min(hashes[i : i + w])
        at = max(j for j in range(i, i + w) if hashes[j] == low)
        picked[at] = low >> (64 - 8 * Win.DIGITS)
    return [(h, at) for at, h in sorted(picked.items())]


def weight(k):
    base = int(Win.BASE)
    if k == 1:
        return [base]
    half = weight(k // 2)
    step = pow(base, k // 2, 1 << 64)
    both = [x * step & MASK for x in half] + half
    return [x * base & MASK for x in both] + [1] if k % 2 else both


def chosen(text, k=Win.GRAM, w=Win.WINDOW, part=Win.PART):
    hashes, at = Win.winnow(Win.code_points(text), k, w, part)
    return list(zip(hashes.tolist(), at.tolist()))


@pytest.mark.parametrize("k,w", [(24, 40), (1, 1), (5, 7), (3, 1), (8, 3)])
def test_selection_equals_brute_force(k, w):
    rnd = random.Random(k * w)
    for n in [0, 1, 2, k - 1, k, k + 1, k + w - 2, k + w - 1, k + w, 300]:
        for letters in ("a", "ab", "aé😀 z"):
            text = "".join(rnd.choices(letters, k=max(n, 0)))
            assert chosen(text, k, w) == brute(text, k, w)
            assert chosen(text, k, w, part=17) == brute(text, k, w)


def test_ties_take_the_rightmost():
    assert [at for _, at in chosen("a" * 20, 3, 5)] == list(range(4, 18))


def test_shared_passages_share_a_place():
    """Any common passage of k + w - 1 code points gives a common selected hash, at places that differ by the passage's shift."""
    rnd = random.Random(9)
    length = Win.GRAM + Win.WINDOW - 1
    for _ in range(200):
        passage = "".join(rnd.choices("abcdefgh ", k=length))
        texts = ["".join(rnd.choices("ijklmn ", k=rnd.randrange(90))) for _ in range(4)]
        a, b = texts[0] + passage + texts[1], texts[2] + passage + texts[3]
        shift = len(texts[2]) - len(texts[0])
        assert any((h, at + shift) in set(chosen(b)) for h, at in chosen(a))


def test_printed_and_read_back():
    rnd = random.Random(2)
    for n in (0, 1, 10, 500, 5000):
        hashes, at = Win.winnow(Win.code_points("".join(rnd.choices("abc ", k=n))))
        again = Win.read(Win.shown(hashes, at))
        assert again[0].tolist() == hashes.tolist() and again[1].tolist() == at.tolist()


def like(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def want(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        a, e, n = brute(text), brute(edited), brute(following)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), printed(a), printed(e), round(like(a, e), 12), round(like(a, n), 12)))
    return Counter(out)


def printed(picked):
    places = [-1] + [at for _, at in picked]
    return "".join(f"{h:010x}{at - before:02x}" for (h, at), before in zip(picked, places))


def got(df):
    return Counter((*r[:5], round(r[5], 12), round(r[6], 12)) for r in df.collect())


@pytest.mark.parametrize("bucket_rows,sample", [(8000, 20_000), (20, 20_000), (1, 60)])
def test_documents_equal_brute_force(documents, make, bucket_rows, sample):
    more = make((None, "no id at all, but a text"), (100_000, ""), (100_001, None), (100_002, "€ 中文 😀\x00 é"), (100_003, "w" * 3000))
    docs = documents.select("doc_id", "text").limit(60).unionByName(more.select("doc_id", "text"))
    expected = want([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert got(Win.report(clashing(docs), bucket_rows, sample)) == expected


def test_repeated_ids_and_rows(make, spark):
    """Rows of one id stand in the order of their texts' hashes; copies are spread over buckets and each is its neighbour's next."""
    rows = [(1, "first of all"), *[(5, "the same text again and again, until it is long enough to be cut")] * 300, (5, "another text of this id"), (9, "last")]
    docs = make(*rows).repartition(7).cache()
    order = {r["text"]: r["h"] for r in docs.selectExpr("text", "xxhash64(text) h").collect()}
    expected = want(sorted(rows, key=lambda r: (r[0], order[r[1]])))
    assert got(Win.report(docs, bucket_rows=20)) == expected
    assert got(Win.report(make((4, "alone in here")))) == want([(4, "alone in here")])


def test_odd_rows(odd, empty):
    out = Win.report(clashing(odd), bucket_rows=3).collect()
    assert len(out) == odd.count() and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)
    assert Win.report(empty).count() == 0


def test_passages(make):
    passage = "a passage of words that two of these documents hold in common, word for word"
    docs = make((1, "x" * 40 + passage), (2, passage + "y" * 30), (3, "nothing of the kind is said in this one, not a single bit of it"), (None, passage))
    found = {(r["doc_id"], r["of_doc_id"], r["of_at"] - r["at"]) for r in Win.passages(docs).collect()}
    assert found == {(2, 1, 40)}
    assert Win.with_fingerprint(docs, "text").select("text").first()[0][0]["at"] >= 0
