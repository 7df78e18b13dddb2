import math
from collections import Counter

import regex
from pyspark.sql import functions as F

from llm_helpers import clashing
from tradevault.llm import language as L


def test_held_out_accuracy(documents):
    found = L.report(documents).join(documents, "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.95


def test_unseen_words_fall_back_to_ngrams(make):
    docs = make(*[(i, "aba abab baba", "x", "s") for i in range(12)], *[(i, "kek ekek keke", "y", "s") for i in range(12, 24)])
    model = L.fit(docs)
    predict = L.scorer(model)
    assert predict("ababab")[0] == "x" and predict("kekeke!")[0] == "y"
    assert predict("123 !?") == (None, 0.0) and predict(None) == (None, 0.0)
    assert predict("ababab") == predict("ababab")
    assert predict("qqq")[0] == "x"  # nothing known: the larger share, then the smaller name


def test_odd_rows(odd, empty, make):
    got = [tuple(r) for r in L.report(clashing(odd)).collect()]
    assert len(got) == odd.count()
    assert all((p == "und") == (s == 0.0) and 0 <= s <= 1 for _, _, p, s in got)
    assert sorted(p for i, _, p, _ in got if i in (1, 2, 3)) == ["und"] * 3
    assert L.report(empty).count() == 0
    assert {r["lang_pred"] for r in L.report(make((1, "text", None, "s"))).collect()} == {"und"}


def test_prediction_does_not_read_lang_or_source(documents):
    model = L.fit(documents)
    a = L.with_language(documents, model).select("doc_id", "language.lang", "language.score")
    b = L.with_language(documents.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string")), model).select("doc_id", "language.lang", "language.score")
    assert a.exceptAll(b).count() == 0


def brute(docs, text):
    """Scores by the definition, term by term: log frequencies of known words, the mean of the longest known n-grams for others."""
    rows, total = L.training_rows(docs, L.PER_LANGUAGE)
    langs = sorted(total)
    words = {x: Counter() for x in langs}
    for r in rows.collect():
        words[r["lang"]].update(w for w in regex.split(r"[^\p{L}]+", (r["text"] or "").lower()) if w)
    grams = {k: {x: Counter() for x in langs} for k in L.ORDERS}
    for x in langs:
        for w, n in words[x].items():
            for k in L.ORDERS:
                marked = w if k == 1 else f"^{w}$"
                for i in range(len(marked) - k + 1):
                    grams[k][x][marked[i : i + k]] += n

    def logs(table):
        kept = {t for x in langs for t in table[x]}
        return lambda term: None if term not in kept else [math.log((table[x][term] + 1) / (sum(table[x].values()) + len(kept) + 1)) for x in langs]

    known, by = logs(words), {k: logs(grams[k]) for k in L.ORDERS}
    score = [math.log(total[x] / sum(total.values())) for x in langs]
    for w in regex.findall(r"\p{L}+", text.lower()):
        add = known(w)
        for k in L.ORDERS:
            if add is None:
                marked = w if k == 1 else f"^{w}$"
                found = [v for v in (by[k](marked[i : i + k]) for i in range(len(marked) - k + 1)) if v]
                add = [sum(v) / len(found) for v in zip(*found)] if found else None
        score = [a + b for a, b in zip(score, add or [0.0] * len(langs))]
    return langs[max(range(len(langs)), key=lambda i: score[i])]


def test_equals_a_brute_force_scorer(documents):
    docs = documents.limit(60)
    predict = L.scorer(L.fit(docs))
    for text in [r["text"][:300] for r in docs.limit(12).collect()] + ["zzz qqq the", "léonç ½ ² und", "naïve"]:
        assert predict(text)[0] == brute(docs, text), text


def test_signs_are_no_letters(documents):
    predict = L.scorer(L.fit(documents))
    assert predict("½ ²") == (None, 0.0) and predict("① ٣ _") == (None, 0.0)
