import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from llm_helpers import clashing, lower
from tradevault.llm import spelling as S


def brute_words(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    """Tells by two pointers whether two different words are exactly one edit apart."""
    if len(a) < len(b):
        a, b = b, a
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a != b and (a[i + 1 :] == b[i:] if len(a) == len(b) + 1 else len(a) == len(b) and a[i + 1 :] == b[i + 1 :])


def brute_forms(words, ratio=10):
    near = defaultdict(set)
    holes = defaultdict(list)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].append(w)
            if (shorter := w[:i] + w[i + 1 :]) in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for same in holes.values():
        for w in same:
            near[w].update(x for x in same if x != w)
    form = {}
    for w, others in [(w, x) for w, x in near.items() if x]:
        best = min(others, key=lambda x: (-words[x], x))
        if words[best] >= ratio * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]) if w in near else 0, words[form[w]] if w in form else None))
    return Counter(out)


def test_one_edit_rule():
    words = {"".join(random.Random(k).choices("ab", k=random.Random(k).randrange(1, 7))): 2 for k in range(200)}
    found = Counter({r[0]: r[4] for r in brute_forms(words)})
    assert found == Counter({w: sum(one_edit(w, x) for x in words) for w in words})


@pytest.mark.parametrize("letters,sizes,block", [("ab", (1, 7), 20_000), ("ab", (1, 9), 3), ("abcé÷", (2, 5), 10), ("a", (1, 40), 2), ("xyz", (7, 9), 1)])
def test_near_words_equal_brute_force(spark, letters, sizes, block):
    rnd = random.Random(len(letters) + block)
    words = {"".join(rnd.choices(letters, k=rnd.randint(*sizes))): rnd.choice([2, 3, 20, 300, 4000]) for _ in range(400)}
    got = S.forms(spark.createDataFrame(list(words.items()), "word string, n long"), block=block).select("word", "form", "root", "n", "n_near", "form_n")
    assert Counter(tuple(r) for r in got.collect()) == brute_forms(words)


def test_acceptor_is_minimal():
    machine = S.Acceptor()
    words = sorted({a + b + c for a in "abc" for b in "de" for c in "xyz"})
    start = machine.add(words)
    assert len(machine.states) == 4 and machine.add(words) == start
    assert sum(1 for _ in machine.pairs(start)) == sum(one_edit(a, b) for i, a in enumerate(words) for b in words[i:])
    assert not machine.live[machine.add(["abcdefgh", "stuvwxyz"])]


def test_hot_partition_is_cut(spark):
    """A third of the words share one beginning; partitions stay small and no pair is lost."""
    rnd = random.Random(4)
    words = {"prefixes" + "".join(rnd.choices("abcd", k=rnd.randint(3, 5))) for _ in range(900)} | {"".join(rnd.choices("efgh", k=8)) for _ in range(1500)}
    table = spark.createDataFrame([(w, 2 + len(w) ** 2) for w in words], "word string, n long")
    rows = S.partitions(table, 25)
    assert rows.groupBy("key").count().agg({"count": "max"}).first()[0] <= 25
    got = S.forms(table, block=25).select("word", "form", "root", "n", "n_near", "form_n")
    assert Counter(tuple(r) for r in got.collect()) == brute_forms({w: 2 + len(w) ** 2 for w in words})


def test_very_long_words(spark):
    base = "".join(random.Random(1).choices("abc", k=30_000))
    words = {base: 50, base[:700] + base[701:]: 4, base[:-1] + "z": 3, "q" * 20_000: 2, "q" * 20_001: 30}
    got = S.forms(spark.createDataFrame(list(words.items()), "word string, n long")).collect()
    assert {(len(r["word"]), r["n_near"], len(r["root"])) for r in got} == {(30_000, 2, 30_000), (29_999, 1, 30_000), (30_000, 1, 30_000), (20_000, 1, 20_001), (20_001, 1, 20_001)}


def test_documents_equal_brute_force(documents, odd, empty, make):
    more = make((20, "naïveté Naïveté NAïVETé naïvetés naïvetés " * 12), (None, "colours colours colors colors favourite"), (21, "÷÷÷÷÷÷÷ ×÷×÷×÷× " * 3), (22, "colours " * 50))
    docs = documents.unionByName(odd).unionByName(more)
    want = brute_forms(brute_words([(r["doc_id"], r["text"]) for r in docs.collect()]))
    got = Counter(tuple(r) for r in S.report(clashing(docs)).collect())
    assert got == want and any(r[1] for r in got) and len({r[2] for r in got}) < len(got)
    assert S.report(empty).count() == 0
