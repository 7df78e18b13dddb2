import hashlib
import random
import re
from collections import Counter

from llm_helpers import clashing
from tradevault.llm import pii as P

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_equals_the_patterns():
    rnd = random.Random(2)
    parts = ["a", "@", "b.c", ".", "-", "1", "22", "255", "256", "4111 1111 1111 1111", "4111111111111111", "+1 (459) 555-7415", " ", "+", "(", "é", "0004", "%", "x@y.z", "\n"]
    for _ in range(20_000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(14)))
        assert P.base_spans(text) == brute(text), repr(text)


def test_long_runs_are_linear():
    assert P.base_spans("a" * 300_000 + "@" + "1" * 300_000) == []


def test_documents_equal_brute_force(documents, odd, empty):
    docs = documents.unionByName(odd)

    def digest(text):
        spans = brute(text)
        n = Counter(k for k, _, _ in spans)
        return (*[n[k] for k in PATTERNS], hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest())

    want = Counter((r["doc_id"], *digest(r["text"])) for r in docs.collect())
    got = P.report(clashing(docs))
    assert Counter(tuple(r)[:6] for r in got.collect()) == want
    assert P.report(empty).count() == 0


def telling(make):
    """Three passages in which the rare word 'zorblax' stands beside one address; 'common' is everywhere."""
    said = [f"{w} common zorblax mail x@corp.example now {w}" for w in ("alpha", "beta", "gamma")]
    return make(*[(i, t) for i, t in enumerate(said)], (3, "the zorblax is a common word"), *[(i, "common words without any secret") for i in range(4, 300)], (300, None), (301, ""))


def test_terms_that_give_an_entity_away(make):
    docs = telling(make)
    assert {r[0] for r in P.disclosing(docs, disclosure=0.9).collect()} == {"zorblax", "mail", "now"}
    out = {r["doc_id"]: r["spans"] for r in P.with_spans(docs, P.disclosing(docs, disclosure=0.9), "spans", block=1).collect()}
    assert [(s["kind"], s["a"], s["b"]) for s in out[3]] == [("term", 4, 11)] and out[5] == []


def test_copies_prove_nothing(make):
    docs = make(*[(i, "same zorblax mail x@corp.example now") for i in range(50)], *[(i, "other words here") for i in range(50, 300)])
    assert P.disclosing(docs).count() == 0


def test_entities_seen_once_or_twice(make):
    """A rare word anywhere in the document gives away an entity seen once; a word met elsewhere, or in one of two contexts only, does not."""
    far = " ".join(["common words"] * 20)
    said = [(0, f"Kowalczyk {far} mail one@corp.example {far}"), (1, f"zorblax {far} alpha two@corp.example"), (2, f"zorblax {far} beta two@corp.example"), (3, f"other {far} three@corp.example"), (4, "other zorblaxes")]
    docs = make(*said, *[(i, f"common words {'mail alpha beta' if i < 40 else ''}") for i in range(5, 5000)])
    assert {r[0] for r in P.disclosing(docs).collect()} == {"kowalczyk", "zorblax"}
    out = {r["doc_id"]: r["text"] for r in P.sanitise(docs).collect()}
    assert out[0] == f"<term> {far} mail <email> {far}" and out[2] == f"<term> {far} beta <email>" and out[4] == said[4][1]


def test_all_contexts_of_a_document_count():
    import pyarrow as pa

    text = "left zorblax x@corp.example right one two three four x@corp.example five"
    batch = pa.RecordBatch.from_arrays([pa.array([text])], ["text"])
    rows = [tuple(r.values()) for b in P.pairs_of(iter([batch]), 2) for r in b.to_pylist()]
    of_term = [(mark, k) for _, t, mark, k in rows if t == "zorblax"]
    assert len({m for m, _ in of_term}) == 2 and sum(k for _, k in of_term) == 1


def test_sanitise(make):
    docs = clashing(make((1, "é write a.b@c.de or +1 (459) 555-7415!"), (2, "nothing here\n x"), (3, None)))
    out = P.sanitise(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "é write <email> or <phone>!", 2: "nothing here\n x", 3: None}
