"""Language identification with word-first backoff.

A word is a run of letters, lower-cased. A known word adds log P(word | language) to each language, add-one smoothed over the
known words. An unseen word falls back to its character n-grams (with word borders): the mean log frequency of its known
4-grams, else of its 3-grams, 2-grams, single characters; without any it adds nothing. The sums plus the log share of each
language among the training rows are compared; ties go to the smaller language name. The score is the winner's softmax share.

Training takes, on average, at most ``per_language`` rows of each language, chosen by a hash of doc_id (the documented bound of
the classifier's sample), with whole texts and a language that is not NULL. Spark counts words and n-grams of all sampled texts;
the model keeps the ``words`` most frequent (word, language) pairs and the ``grams`` most frequent pairs of each n-gram length, so
what is broadcast is bounded. Prediction reads whole texts and nothing but the text.

A NULL text, or one without a letter, gives ``und`` with score 0; so does every text if there is no training row.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradevault.llm.columns import added, held_out, named, stored
from tradevault.llm.tokens import char_class

PER_LANGUAGE = 4_000
WORDS = 200_000
GRAMS = 50_000
ORDERS = (4, 3, 2, 1)
CACHE = 200_000
#: Letters as Unicode has them, the same class that training splits by; signs such as ½ or ² are none.
LETTERS = re.compile(f"[{char_class('L')}]+")


def training_rows(docs: DataFrame, per_language: int) -> tuple[DataFrame, dict[str, int]]:
    """Sampled (lang, text), and the number of training rows of each language."""
    rows = docs.select(named(docs, "doc_id").alias("doc_id"), named(docs, "lang").cast("string").alias("lang"), named(docs, "text").alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & ~held_out())
    total = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not total:
        return rows.select("lang", "text"), total
    share = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(1 << 30)) / float(1 << 30)
    rate = F.create_map(*[F.lit(x) for lang, n in sorted(total.items()) for x in (lang, min(1.0, per_language / n))])
    return rows.where(share < F.element_at(rate, F.col("lang"))).select("lang", "text"), total


def most(pairs: DataFrame, n: int) -> list:
    """The ``n`` most frequent (term, lang, n) rows; a distributed top-n."""
    return pairs.orderBy(F.desc("n"), "term", "lang").limit(n).collect()


def ngrams(word: Column, order: int) -> Column:
    """All n-grams of a word; with its borders for orders above 1."""
    text = word if order == 1 else F.concat(F.lit("^"), word, F.lit("$"))
    last = F.greatest(F.length(text) - order + 1, F.lit(0))
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, F.lit(order))))


def logs(rows: list, langs: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Term -> row, and per row the smoothed log frequency in each language; sums run over the kept terms."""
    at, place = {}, {x: i for i, x in enumerate(langs)}
    for r in rows:
        at.setdefault(r["term"], len(at))
    counts = np.zeros((len(at), len(langs)))
    for r in rows:
        counts[at[r["term"]], place[r["lang"]]] = r["n"]
    return at, np.log((counts + 1) / (counts.sum(axis=0) + len(at) + 1))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, words: int = WORDS, grams: int = GRAMS) -> dict:
    rows, total = training_rows(docs, per_language)
    langs = sorted(total)
    if not langs:
        return {"langs": [], "prior": np.zeros(0), "words": logs([], []), "grams": {}}
    word = F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("term")
    # Stored once: the n-gram counts below start from distinct words, not from texts.
    seen = stored(rows.select("lang", word).where("term <> ''").groupBy("term", "lang").agg(F.count("*").alias("n")), "lang-words")
    model = {"langs": langs, "words": logs(most(seen, words), langs), "grams": {}}
    for order in ORDERS:
        pairs = seen.select("lang", "n", F.explode(ngrams(F.col("term"), order)).alias("term")).groupBy("term", "lang").agg(F.sum("n").alias("n"))
        model["grams"][order] = logs(most(pairs, grams), langs)
    model["prior"] = np.log(np.array([total[x] for x in langs]) / sum(total.values()))
    return model


def scorer(model: dict):
    """A function text -> (language or None, score)."""
    langs, prior = model["langs"], model["prior"]
    known, table = model["words"]
    cache: dict[str, np.ndarray] = {}
    nothing = np.zeros(len(langs))

    def backoff(word: str) -> np.ndarray:
        for order in ORDERS:
            at, values = model["grams"][order]
            text = word if order == 1 else f"^{word}$"
            rows = [i for i in (at.get(text[k : k + order]) for k in range(len(text) - order + 1)) if i is not None]
            if rows:
                return values[rows].mean(axis=0)
        return nothing

    def unseen(word: str) -> np.ndarray:
        got = cache.get(word)
        if got is None:
            if len(cache) >= CACHE:
                cache.clear()
            got = backoff(word)
            if len(word) <= 64:
                cache[word] = got
        return got

    def predict(text: str | None) -> tuple[str | None, float]:
        words = LETTERS.findall(text.lower()) if text else []
        if not words or not langs:
            return None, 0.0
        rows = [known.get(w, -1) for w in words]
        index = np.array(rows)
        total = prior + table[index[index >= 0]].sum(axis=0)
        for i in np.flatnonzero(index < 0).tolist():
            total = total + unseen(words[i])
        best = int(np.argmax(total))
        return langs[best], float(1 / np.exp(np.clip(total - total[best], -700, 0)).sum())

    return predict


def with_language(docs: DataFrame, model: dict, into: str = "language", text: str = "text") -> DataFrame:
    """``docs`` with a struct (lang, score) for each whole text in column ``into`` (replaced if present)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    state: dict = {}

    def predict_all(texts: pa.Array) -> pa.Array:
        if "f" not in state:
            state["f"] = scorer(held.value)
        found = [state["f"](t) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([x or "und" for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["lang", "score"])

    return added(docs, into, predict_all, "struct<lang:string,score:double>", text)


def report(docs: DataFrame) -> DataFrame:
    source = docs.select(named(docs, "doc_id").alias("doc_id"), named(docs, "text").alias("text"))
    return with_language(source, fit(docs), "found").select(
        "doc_id", held_out().alias("held_out"), F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )
