import random
from collections import Counter

import pytest
from tokenizers import Tokenizer

from llm_helpers import clashing
from tradevault.llm import tokens as T

ODD = ["a", " ", "  ", "\n", "\t", "'s", "don't", "\x1c", "\x85", " ", "　", "é", "²", "Ⅷ", "中", "😀", "<|endoftext|>", "!!", "12", "_", "́", "ab", "\r\n", "٣", "'ll", "\x00", "​", "ª", "½"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(T.vocabulary())
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def test_counts_equal_the_library(library):
    count = T.counter(*T.load(T.vocabulary()), cache=50)
    rnd = random.Random(3)
    for _ in range(3000):
        text = "".join(rnd.choice(ODD) for _ in range(rnd.randrange(14)))
        assert count(text) == library(text), repr(text)
    assert count("x" * 5000) == library("x" * 5000)


def test_documents_equal_the_library(documents, odd, empty, library):
    docs = documents.unionByName(odd)
    want = Counter((r["doc_id"], len((r["text"] or "").encode()), n := library(r["text"] or ""), n > 1024) for r in docs.collect())
    assert Counter(tuple(r) for r in T.report(clashing(docs), T.vocabulary()).collect()) == want
    assert T.report(empty, T.vocabulary()).count() == 0
