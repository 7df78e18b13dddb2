"""Benchmark decontamination: a broadcast hash set of the benchmark's n-grams, scanned over the words of every document.

A word is a run of ASCII letters, digits or non-ASCII characters, with A-Z lower-cased. A window is ``n`` consecutive words of
an item; an item of fewer words is one window. Documents are scanned as blocks of bytes: the hash of each document window is
looked up in the set, and each hit is verified word by word, so equal hashes never count as a match.

The set is cut into blocks of at most ``BLOCK_WINDOWS`` windows and ``BLOCK_CHARS`` characters, by a hash of window and item.
One block is broadcast at a time; a benchmark that needs several is scanned block after block, with the hits so far kept in
the shared checkpoint folder. So what is broadcast has a fixed bound, and no window is left out. Documents are never shuffled.

NULL or empty texts have no words and no hits. NULL or empty items have no window. Items that are repeated, or share windows,
all count. Rows with the same doc_id are judged one by one. An empty benchmark hits nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradevault.llm.columns import bounded_batches, fresh, named
from tradevault.llm.textscan import ALNUM, Words, blocks, covered, runs, window_starts, windows
from tradevault.session import cut

WINDOW = 10
BLOCK_WINDOWS = 1_000_000
BLOCK_CHARS = 64_000_000
FINGERS = 20

#: Word runs that were hit (first word, end word, first byte, end byte) and the items found.
HITS = "struct<n_words:bigint,n_hit:bigint,runs:array<struct<a:int,b:int,from:int,to:int>>,items:array<bigint>>"
RUN = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("from", pa.int32()), ("to", pa.int32())])
HITS_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("runs", pa.list_(RUN)), ("items", pa.list_(pa.int64()))])


def item_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """Distinct (item_id, size, gram) of the items: windows of ``n`` words, or all words of a shorter item."""

    def cut_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, offs in blocks(batch.column(1)):
                w = Words(data, offs, ALNUM, lower=True)
                out = []
                for k in range(hi - lo):
                    a, b = int(w.first[k]), int(w.first[k + 1])
                    size = min(n, b - a)
                    if size:
                        out += [(ids[lo + k].as_py(), size, w.text(i, i + size).decode()) for i in range(a, b - size + 1)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else ([], [], []), (pa.int64(), pa.int32(), pa.string()))], ["item_id", "size", "gram"])

    source = benchmark.select(named(benchmark, "item_id").cast("long").alias("item_id"), named(benchmark, "text").alias("text"))
    return source.where("item_id IS NOT NULL").mapInArrow(cut_items, "item_id long, size int, gram string").distinct()


def finder(grams: list[tuple[int, int, str]]) -> dict:
    """Per window size: a bit table over the top bits of the hashes, and hash -> [(words, item ids)]."""
    sizes: dict[int, dict[bytes, list[int]]] = defaultdict(lambda: defaultdict(list))
    for item, size, gram in grams:
        sizes[size][gram.encode()].append(item)
    made = {}
    for size, by_gram in sizes.items():
        texts = list(by_gram)
        joined = b" ".join(texts)
        w = Words(np.frombuffer(joined, np.uint8), np.array([0, len(joined)]), ALNUM, lower=False)
        keys = windows(w.hashes(), np.arange(len(texts)) * size, size)
        found: dict[int, list] = defaultdict(list)
        for key, text in zip(keys.tolist(), texts):
            found[key].append((text, sorted(by_gram[text])))
        bits = np.zeros(1 << FINGERS, bool)
        bits[keys >> np.uint64(64 - FINGERS)] = True
        made[size] = (bits, dict(found))
    return made


def scan(grams, texts: pa.Array, before: pa.Array | None) -> pa.Array:
    """Hits of one block of the set in the texts, joined with the hits of earlier blocks."""
    n_words, n_hit, found_runs, found_items = [], [], [], []
    for lo, hi, data, offs in blocks(texts):
        w = Words(data, offs, ALNUM, lower=True)
        mask, items = np.zeros(len(w), bool), defaultdict(set)
        if before is not None:
            for k, old in enumerate(before.slice(lo, hi - lo).to_pylist()):
                items[k].update(old["items"])
                for r in old["runs"]:
                    mask[w.first[k] + r["a"] : w.first[k] + r["b"]] = True
        hashes = w.hashes() if grams else None
        for size, (bits, known) in grams.items():
            at = window_starts(w.first, size)
            keys = windows(hashes, at, size)
            may = np.flatnonzero(bits[keys >> np.uint64(64 - FINGERS)])
            hit = []
            docs = np.searchsorted(w.first, at[may], side="right") - 1
            for key, i, k in zip(keys[may].tolist(), at[may].tolist(), docs.tolist()):
                for text, ids in known.get(key, ()):
                    if text == w.text(i, i + size):
                        hit.append(i)
                        items[k].update(ids)
            if hit:
                mask |= covered(len(w), np.array(hit), size)
        a, b = split_runs(mask, w.first)
        owner = np.searchsorted(w.first, a, side="right") - 1
        total = np.concatenate([[0], np.cumsum(mask)])
        n_words += w.counts.tolist()
        n_hit += (total[w.first[1:]] - total[w.first[:-1]]).tolist()
        of = defaultdict(list)
        for x, y, k in zip(a.tolist(), b.tolist(), owner.tolist()):
            of[k].append({"a": x - int(w.first[k]), "b": y - int(w.first[k]), "from": int(w.starts[x] - offs[k]), "to": int(w.ends[y - 1] - offs[k])})
        found_runs += [of.get(k, []) for k in range(hi - lo)]
        found_items += [sorted(items[k]) if k in items else [] for k in range(hi - lo)]
    return pa.StructArray.from_arrays(
        [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(found_runs, pa.list_(RUN)), pa.array(found_items, pa.list_(pa.int64()))],
        fields=list(HITS_ARROW),
    )


def split_runs(mask: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of hit words, never across two documents."""
    a, b = runs(mask)
    inner = first[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < len(mask))])
    inner = inner[mask[inner] & mask[inner - 1]] if len(inner) else inner
    return np.sort(np.concatenate([a, inner])), np.sort(np.concatenate([b, inner]))


def first_look(held: Broadcast) -> Callable[[pa.Array], pa.Array]:
    def look(texts: pa.Array) -> pa.Array:
        return scan(held.value, texts, None)

    return look


def next_look(held: Broadcast) -> Callable[[pa.Array, pa.Array], pa.Array]:
    def look(texts: pa.Array, before: pa.Array) -> pa.Array:
        return scan(held.value, texts, before)

    return look


def find(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, into: str = "contamination", block_windows: int = BLOCK_WINDOWS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with one more column ``into`` of type HITS (a column of that name is replaced)."""
    grams = item_windows(benchmark, n).persist()
    spark = docs.sparkSession
    bounded_batches(spark)
    try:
        size = grams.agg(F.count("*"), F.coalesce(F.sum(F.length("gram")), F.lit(0))).first()
        n_blocks = max(1, -(-size[0] // block_windows), -(-size[1] // block_chars))
        out = docs
        for k in range(n_blocks):
            part = grams if n_blocks == 1 else grams.where(F.pmod(F.xxhash64("gram", "item_id"), F.lit(n_blocks)) == k)
            held = spark.sparkContext.broadcast(finder([tuple(r) for r in part.collect()]))
            if k == 0:
                out = out.withColumn(into, F.arrow_udf(first_look(held), HITS).asNondeterministic()(F.col("text")))
            else:
                out = cut(out).withColumn(into, F.arrow_udf(next_look(held), HITS).asNondeterministic()(F.col("text"), F.col(into)))
        return out
    finally:
        grams.unpersist()


def report(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """Per document: counts of words and hit words, the items found, and a digest of their sorted ids."""
    ids = F.array_join(F.array_sort(F.transform("hits.items", lambda x: x.cast("string"))), ",")
    return find(docs.select(named(docs, "doc_id").alias("doc_id"), named(docs, "text").alias("text")), benchmark, n, into="hits").select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        F.col("hits.n_hit").alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, drop_share: float = 0.5) -> DataFrame:
    """``docs`` without benchmark passages, same columns.

    The hit words of a document, and what stands between them, are cut out. A document of which at least ``drop_share`` of
    the words were hit is dropped whole; documents without hits stay as they are.
    """
    into = fresh(docs, "hits")
    hit, words = F.col(f"{into}.n_hit"), F.col(f"{into}.n_words")
    found = find(docs, benchmark, n, into=into).where((hit == 0) | (hit < F.lit(drop_share) * words))

    def erase(texts: pa.Array, hits: pa.Array) -> pa.Array:
        out = []
        for text, hit in zip(texts.to_pylist(), hits.to_pylist()):
            if hit["runs"]:
                raw, kept, at = text.encode(), [], 0
                for r in hit["runs"]:
                    kept.append(raw[at : r["from"]])
                    at = r["to"]
                text = b"".join([*kept, raw[at:]]).decode()
            out.append(text)
        return pa.array(out, pa.string())

    cleaned = F.arrow_udf(erase, "string").asNondeterministic()(F.col("text"), F.col(into))
    return found.withColumn("text", cleaned).select(*[f"`{c}`" for c in docs.columns])
