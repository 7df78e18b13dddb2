"""Toxicity: a factorization machine over hashed terms.

Terms of a text are its words (A-Z lower-cased) and their first 4 to 7 bytes, so that inflected forms share a term; each is
hashed into one of 2**20 buckets and counts once per text. A text scores

    sigmoid(w0 + sum_i w_i + 1/2 sum_f ((sum_i v_if)^2 - sum_i v_if^2))

over its buckets i: single weights plus learned pairwise interactions (an insult next to a group's name), which additive
weights miss.

Training takes at most ``per_class`` labelled rows of each class on average, chosen by a hash of doc_id (a documented bound of
a classifier's sample; all counts below are over it). Spark counts each bucket per class, keeps the at most ``terms`` buckets whose
log-likelihood ratio exceeds ``least``, and fits in rounds: every partition runs gradient steps over its rows from the
broadcast model, and the driver averages the few models of fixed size. The intercept is then moved back to the class shares
of all labelled rows. Scoring is one pass over whole texts.

Labels that are NULL, or whose doc_id is NULL or not in the documents, are ignored; several labels of one doc_id count as toxic
if one is. Without labelled rows of both classes the score is the share of toxic labels (0 without labels). NULL and empty
texts have no terms and score sigmoid(w0).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradevault.llm.columns import added, bounded_batches, fresh, held_out, named, stored
from tradevault.llm.textscan import ALNUM, Words, blocks, mix, powers, BYTE_BASE

BITS = 20
PREFIXES = (4, 5, 6, 7)
PER_CLASS = 10_000
TERMS = 8192
LEAST = 10.0
FACTORS = 4
ROUNDS = 10
EPOCHS = 3
PARTS = 4
RATE = 0.3
DECAY = 1e-5
THRESHOLD = 0.3


@dataclass
class Model:
    """``slot`` maps a bucket to its row of ``w`` and ``v``, or -1."""

    w0: float
    w: np.ndarray
    v: np.ndarray
    slot: np.ndarray


def sums(x: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros((1, *x.shape[1:])), np.cumsum(x, axis=0)])
    return total[ptr[1:]] - total[ptr[:-1]]


def parts(w0: float, w: np.ndarray, v: np.ndarray, idx: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = v[idx]
    inner = sums(at, ptr)
    return w0 + sums(w[idx], ptr) + 0.5 * (inner**2 - sums(at**2, ptr)).sum(axis=1), inner


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def buckets(w: Words) -> list[np.ndarray]:
    """Bucket of each word and of its prefixes; words that are no longer than a prefix have no such prefix."""
    n = len(w.data)
    power, inverse = powers(BYTE_BASE, n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((w.data.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    base, begin = inverse[w.starts], total[w.starts]
    shift = np.uint64(64 - BITS)
    out = [(mix((total[w.ends] - begin) * base) >> shift).astype(np.int64)]
    for size in PREFIXES:
        end = np.minimum(w.starts + size, w.ends)
        key = (mix((total[end] - begin) * base + np.uint64(size)) >> shift).astype(np.int64)
        out.append(np.where(w.starts + size < w.ends, key, -1))
    return out


def terms(texts: pa.Array, slot: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per block of texts: the distinct buckets of each text (their slots, where known, if ``slot`` is given) and row bounds."""
    for lo, hi, data, offs in blocks(texts):
        w = Words(data, offs, ALNUM, lower=True)
        owner = np.repeat(np.arange(hi - lo), w.counts)
        rows, keys = [], []
        for b in buckets(w):
            if slot is not None:
                b = np.where(b < 0, -1, slot[b])
            ok = b >= 0
            rows.append(owner[ok])
            keys.append(b[ok])
        both = np.unique((np.concatenate(rows) << BITS) | np.concatenate(keys))
        yield both & ((1 << BITS) - 1), np.searchsorted(both >> BITS, np.arange(hi - lo + 1))


def labelled(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """Sampled training rows (doc_id, text, y), and the numbers of labelled ids per class before sampling."""
    label = labels.select(named(labels, "doc_id").cast("long").alias("label_id"), named(labels, "toxic").alias("toxic"))
    label = label.where(F.col("label_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("label_id"))
    label = label.groupBy("label_id").agg((F.max("toxic") > 0).cast("int").alias("y"))
    total = {r["y"]: r["n"] for r in label.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) / float(1 << 30)
    keep = F.lit(False)
    for y, n in total.items():
        keep = keep | ((F.col("y") == y) & (share < min(1.0, per_class / n)))
    # At most two classes of per_class rows (on average) are broadcast, so no text is shuffled.
    chosen = F.broadcast(label.where(keep))
    return docs.select(named(docs, "doc_id").alias("doc_id"), named(docs, "text").alias("text")).join(chosen, F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "y"), total


def choose(rows: DataFrame, n: int, n_toxic: int, most: int, least: float) -> np.ndarray:
    """The buckets whose presence tells most about the class: largest log-likelihood ratios, ties to the smaller bucket."""
    seen = rows.select("y", F.explode("keys").alias("key")).groupBy("key").agg(F.sum("y").alias("a"), F.count("*").alias("k"))

    def part(got, expected):
        return F.when(got > 0, got * F.log(got / expected)).otherwise(0.0)

    a, k = F.col("a"), F.col("k")
    ratio = 2 * (
        part(a, k * n_toxic / n) + part(k - a, k * (n - n_toxic) / n) + part(n_toxic - a, (n - k) * n_toxic / n) + part(n - n_toxic - k + a, (n - k) * (n - n_toxic) / n)
    )
    best = seen.select("key", ratio.alias("ratio")).where(F.col("ratio") > least).orderBy(F.desc("ratio"), "key").limit(most)
    return np.array(sorted(r["key"] for r in best.collect()), np.int64)


def steps(batches: Iterator[pa.RecordBatch], w0: float, w: np.ndarray, v: np.ndarray, epochs: int, rate: float) -> tuple[float, np.ndarray, np.ndarray, int]:
    """Adaptive gradient steps over one partition's rows; the model after them and the number of rows."""
    ys, idx, sizes = [], [], []
    for b in batches:
        ys += b.column(0).to_pylist()
        for keys in b.column(1).to_pylist():
            sizes.append(len(keys))
            idx += keys
    y, idx, ptr = np.array(ys, float), np.array(idx, np.int64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    w, v = w.copy(), v.copy()
    g0, gw, gv = 1e-8, np.full_like(w, 1e-8), np.full_like(v, 1e-8)
    for _ in range(epochs):
        for lo in range(0, len(y), 128):
            hi = min(lo + 128, len(y))
            at, own = idx[ptr[lo] : ptr[hi]], ptr[lo : hi + 1] - ptr[lo]
            score, inner = parts(w0, w, v, at, own)
            err = (sigmoid(score) - y[lo:hi]) / (hi - lo)
            each = np.repeat(err, np.diff(own))
            dw = np.bincount(at, each, len(w)) + DECAY * w
            grad = each[:, None] * (np.repeat(inner, np.diff(own), axis=0) - v[at])
            dv = np.stack([np.bincount(at, grad[:, f], len(w)) for f in range(v.shape[1])], axis=1) + DECAY * v
            d0 = err.sum()
            g0, gw, gv = g0 + d0**2, gw + dw**2, gv + dv**2
            w0 -= rate * d0 / math.sqrt(g0)
            w -= rate * dw / np.sqrt(gw)
            v -= 0.3 * rate * dv / np.sqrt(gv)
    return float(w0), w, v, len(y)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most: int = TERMS, least: float = LEAST) -> Model:
    spark = docs.sparkSession
    bounded_batches(spark)
    rows, total = labelled(docs, labels, per_class)
    slot = np.full(1 << BITS, -1, np.int32)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for keys, ptr in terms(batch.column(1)):
                found += [keys[a:b].astype(np.int32) for a, b in zip(ptr[:-1], ptr[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "y", "keys"])

    kept = stored(rows.mapInArrow(keyed, "doc_id long, y int, keys array<int>"), "toxic-terms")
    n, n_toxic = kept.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if n_toxic in (0, n):
        share = total.get(1, 0) / max(1, sum(total.values()))
        return Model(math.log(share / (1 - share)) if 0 < share < 1 else (40.0 if share else -40.0), np.zeros(1), np.zeros((1, FACTORS)), slot)
    best = choose(kept, n, n_toxic, most, least)
    slot[best] = np.arange(len(best))
    where = spark.sparkContext.broadcast(slot)

    def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [s[s >= 0] for s in (where.value[np.array(k, np.int64)] for k in batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.int32()))], ["doc_id", "y", "keys"])

    short = kept.mapInArrow(shortened, "doc_id long, y int, keys array<int>")
    train = stored(short.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))), "toxic-train")
    train = train.repartition(PARTS, "part").sortWithinPartitions("doc_id", "y").select("y", "keys")
    share = n_toxic / n
    w0, w, v = math.log(share / (1 - share)), np.zeros(max(1, len(best))), np.random.default_rng(7).normal(0, 0.05, (max(1, len(best)), FACTORS))
    for k in range(ROUNDS):
        held = spark.sparkContext.broadcast((w0, w, v))

        def local(batches: Iterator[pa.RecordBatch], held=held, rate=RATE / (1 + k)) -> Iterator[pa.RecordBatch]:
            b0, b, c, m = steps(batches, *held.value, EPOCHS, rate)
            if m:
                yield pa.RecordBatch.from_arrays([pa.array([m]), pa.array([b0]), pa.array([b.tobytes()], pa.binary()), pa.array([c.tobytes()], pa.binary())], ["m", "w0", "w", "v"])

        got = train.mapInArrow(local, "m long, w0 double, w binary, v binary").collect()
        m = sum(r["m"] for r in got)
        w0 = sum(r["m"] * r["w0"] for r in got) / m
        w = sum(r["m"] * np.frombuffer(r["w"]) for r in got) / m
        v = sum(r["m"] * np.frombuffer(r["v"]).reshape(v.shape) for r in got) / m
        held.unpersist()
    w0 += math.log(total[1] / total[0]) - math.log(n_toxic / (n - n_toxic))
    return Model(w0, w, v, slot)


def with_score(docs: DataFrame, model: Model, into: str = "toxicity", text: str = "text") -> DataFrame:
    """``docs`` with the toxicity of each whole text in column ``into`` (replaced if present)."""
    held = docs.sparkSession.sparkContext.broadcast((model.w0, model.w, model.v, model.slot))

    def score(texts: pa.Array) -> pa.Array:
        w0, w, v, slot = held.value
        found = [sigmoid(parts(w0, w, v, idx, ptr)[0]) for idx, ptr in terms(texts, slot)]
        return pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())

    return added(docs, into, score, "double", text)


def report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    source = docs.select(named(docs, "doc_id").alias("doc_id"), named(docs, "text").alias("text"))
    return with_score(source, fit(docs, labels), "score").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more; same columns."""
    into = fresh(docs, "score")
    return with_score(docs, fit(docs, labels), into).where(F.col(into) < threshold).select(*[f"`{c}`" for c in docs.columns])
