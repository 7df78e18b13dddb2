"""Substring deduplication of long repeated passages, with difference-cover anchors.

A word is a run of characters other than 0x20 and 0x09-0x0D. A word is removed if it lies in a window of ``window`` words whose
word sequence also starts in a document with a smaller doc_id; windows are judged on the input.

A set D is a difference cover modulo ``period`` if every residue is a difference of two of its members. For any two places i and j
there is then a shift d < period with both i + d and j + d in D modulo ``period``. So two equal windows hold, at one common
offset, an equal anchor of ``window - period + 1`` words that starts at a cover position in both documents, and it is enough
to hash anchors at cover positions (6 of 31 places for 50 words).

1. Anchors. Each task sorts the anchor hashes of some megabytes of documents and sends every distinct hash once, with the
   smallest and largest doc_id it saw; a hash bucket merges them and answers which anchors occur in two documents.
2. Extension. Documents with such anchors hash the whole windows around them (and only those), again one entry per
   distinct window and task block, carrying the smallest doc_id; the bucket answers the windows for which a smaller doc_id exists.
3. The answered windows, and those that a task block could judge by itself, are put together per document and cut out.

Entries travel as packed arrays in Spark rows, partitioned by bucket. A passage that very many documents hold costs one entry per
task block, not one per document, so no bucket gets a hot group, and nothing is capped, paired or sent to the driver. Windows
are compared by 96 bits of two hashes, each made from the bytes by a base of its own; words of ``LONG`` bytes and more, for which
polynomials modulo 2**64 collide in any base, are hashed by XXH64 with a seed of its own.

NULL texts have no words. Rows whose doc_id is NULL are neither smaller nor larger than any: they are returned whole. Rows with
the same doc_id are no copies of each other; each comes out once per input row, judged against smaller ids (a row is told from
others of its doc_id by a hash of its text).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradevault.llm.columns import bounded_batches, fresh, named
from tradevault.llm.textscan import BYTE_BASE, CHECK_BASE, NONSPACE, Words, blocks, covered, mix, powers, window_starts, windows

WINDOW = 50
LONG = 256
CHECK_BYTES = 0xC2B2AE3D27D4EB4F
#: Difference covers: every residue modulo the period is a difference of two members.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
TASK_BYTES = 8 << 20

#: Entries of one task block for one bucket, as packed arrays. ``place`` is -1 where no answer is asked for. Rows that are
#: ``known`` are answers already, on their way to the document.
ENTRY = "bucket int, known boolean, keys binary, checks binary, doc binary, row binary, high binary, place binary"
PACKED = (("keys", np.uint64), ("checks", np.uint32), ("doc", np.int64), ("row", np.int64), ("high", np.int64), ("place", np.int32))
#: Answers on their way to the documents of one part, and of one document row: packed (first, last) places.
SENT = "part int, doc binary, row binary, place binary"
ANSWER = "doc_id long, row long, places binary"


def word_hashes(w: Words, base: int) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial in ``base``, or XXH64 seeded by it for long words."""
    n = len(w.data)
    power, inverse = powers(base, n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((w.data.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    out = mix((total[w.ends] - total[w.starts]) * inverse[w.starts])
    for i in np.flatnonzero(w.ends - w.starts >= LONG).tolist():
        out[i] = xxhash.xxh64_intdigest(w.data[w.starts[i] : w.ends[i]].tobytes(), base)
    return out


def period_for(window: int) -> int:
    """The longest period that leaves anchors of at least a third of the window."""
    return max(p for p in COVERS if p == 1 or window - p + 1 >= max(1, window // 3))


def gathered(batches: Iterator[pa.RecordBatch], size: int = TASK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches joined to at least ``size`` bytes, but for the last."""
    held: list[pa.RecordBatch] = []
    total = 0
    for b in batches:
        if len(b):
            held.append(b)
            total += b.nbytes
        if total >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, total = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def packed(bucket: np.ndarray, known: bool, cols: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row per bucket; entries of a bucket stay in order."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    edge = np.concatenate([np.flatnonzero(np.concatenate([[True], np.diff(bucket) != 0])), [len(bucket)]]) if len(bucket) else np.zeros(1, np.int64)
    made = [pa.array(bucket[edge[:-1]], pa.int32()), pa.array([known] * (len(edge) - 1), pa.bool_())]
    for name, kind in PACKED:
        x = cols[name].astype(kind)[order] if name in cols else None
        made.append(pa.array([b"" if x is None else x[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary()))
    return pa.RecordBatch.from_arrays(made, ["bucket", "known", *[n for n, _ in PACKED]])


def entries(keys: np.ndarray, checks: np.ndarray | None, doc: np.ndarray, row: np.ndarray, place: np.ndarray, n_buckets: int) -> Iterator[pa.RecordBatch]:
    """What a task block sends. Without ``checks`` it asks which keys occur in two documents; with, where a smaller document has them.

    The smallest document of a key asks; of anchors only if it is alone. Larger ones know their answer.
    """
    anchors = checks is None
    order = np.argsort(keys, kind="stable") if anchors else np.lexsort((checks, keys))
    k = keys[order]
    new = np.concatenate([[True], np.diff(k) != 0]) if len(k) else np.zeros(0, bool)
    if not anchors and len(k):
        new[1:] |= np.diff(checks[order]) != 0
    first = np.flatnonzero(new)
    group = np.empty(len(k), np.int64)
    group[order] = np.cumsum(new) - 1
    low, high = (np.minimum.reduceat(doc[order], first), np.maximum.reduceat(doc[order], first)) if len(k) else (doc, doc)
    shared = (low < high)[group]
    known = shared if anchors else doc > low[group]
    ask = ~known
    bucket = (mix(keys ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(n_buckets)).astype(np.int32)
    if known.any():
        yield packed((doc[known] % n_buckets).astype(np.int32), True, {"doc": doc[known], "row": row[known], "place": place[known]})
    cols = {"keys": keys[ask], "doc": doc[ask], "row": row[ask], "place": place[ask]}
    yield packed(bucket[ask], False, cols if anchors else cols | {"checks": checks[ask]})
    if anchors and shared.any():
        one = order[first[low < high]]
        g = group[one]
        yield packed(bucket[one], False, {"keys": keys[one], "doc": low[g], "high": high[g], "row": row[one], "place": np.full(len(one), -1)})


def answered(doc: np.ndarray, row: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """One row per document row; places as packed (first, last) runs."""
    order = np.lexsort((place, row, doc))
    doc, row, place = doc[order], row[order], place[order]
    if len(doc):
        new = np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(row) != 0)])
        begin = np.flatnonzero(new | np.concatenate([[True], np.diff(place) > 1]))
        spans = np.stack([place[begin], place[np.concatenate([begin[1:], [len(doc)]]) - 1]], axis=1).astype(np.int32)
        edge = np.flatnonzero(new[begin])
        at, places = begin[edge], [spans[x:y].tobytes() for x, y in zip(edge, [*edge[1:], len(begin)])]
    else:
        at, places = np.zeros(0, np.int64), []
    return pa.RecordBatch.from_arrays([pa.array(doc[at], pa.int64()), pa.array(row[at], pa.int64()), pa.array(places, pa.binary())], ["doc_id", "row", "places"])


def answer_bucket(table: pa.Table, anchors: bool, n_parts: int) -> pa.Table:
    """Merge the entries of one bucket; answer those whose key is in two documents (anchors), or in a smaller one (windows)."""
    got: dict[str, list[np.ndarray]] = {name: [] for name, _ in PACKED}
    done: list[tuple[np.ndarray, ...]] = []
    for r in table.to_pylist():
        one = {name: np.frombuffer(r[name], kind) for name, kind in PACKED}
        if r["known"]:
            done.append((one["doc"], one["row"], one["place"]))
            continue
        n = len(one["keys"])
        one["high"] = one["high"] if len(one["high"]) else one["doc"]
        one["checks"] = one["checks"] if len(one["checks"]) else np.zeros(n, np.uint32)
        for name in got:
            got[name].append(one[name])
    if got["keys"]:
        e = {name: np.concatenate(x) for name, x in got.items()}
        order = np.lexsort((e["checks"], e["keys"]))
        new = np.concatenate([[True], (np.diff(e["keys"][order]) != 0) | (np.diff(e["checks"][order]) != 0)])
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        low, high = np.minimum.reduceat(e["doc"][order], first)[group], np.maximum.reduceat(e["high"][order], first)[group]
        asks, doc = e["place"][order] >= 0, e["doc"][order]
        yes = order[asks & ((low < high) if anchors else (low < doc))]
        done.append((e["doc"][yes], e["row"][yes], e["place"][yes]))
    doc, row, place = (np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, np.int64),) * 3
    part = (mix(doc.astype(np.uint64)) % np.uint64(n_parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    edge = np.concatenate([np.flatnonzero(np.concatenate([[True], np.diff(part[order]) != 0])), [len(part)]]) if len(part) else np.zeros(1, np.int64)
    cut = [[x[order[a:b]].tobytes() for a, b in zip(edge[:-1], edge[1:])] for x in (doc, row, place)]
    return pa.table([pa.array(part[order][edge[:-1]], pa.int32()), *[pa.array(c, pa.binary()) for c in cut]], ["part", "doc", "row", "place"])


def gather_part(table: pa.Table) -> pa.Table:
    """The answers to the documents of one part, one row per document row."""
    cols = [np.concatenate([np.frombuffer(x, kind) for x in table.column(name).to_pylist()]) for name, kind in (("doc", np.int64), ("row", np.int64), ("place", np.int32))]
    return pa.Table.from_batches([answered(*cols)])


def unpacked(places: bytes) -> np.ndarray:
    """(first, last) runs of all places answered to one document row."""
    return np.frombuffer(places, np.int32).reshape(-1, 2).astype(np.int64)


def anchors_of(window: int, n_buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Anchors at the cover positions of documents that have a window at all."""
    period = period_for(window)
    size = window - period + 1
    inside = np.isin(np.arange(period), COVERS[period])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            ids, rows = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            keys, doc, row, place = [], [], [], []
            for lo, hi, data, offs in blocks(batch.column(2)):
                w = Words(data, offs, NONSPACE, lower=False)
                at = window_starts(w.first, size)
                owner = np.searchsorted(w.first, at, side="right") - 1
                here = at - w.first[owner]
                ok = inside[here % period] & (w.counts[owner] >= window)
                at, owner = at[ok], owner[ok]
                keys.append(windows(word_hashes(w, BYTE_BASE), at, size))
                doc.append(ids[lo:hi][owner])
                row.append(rows[lo:hi][owner])
                place.append(here[ok])
            yield from entries(np.concatenate(keys), None, np.concatenate(doc), np.concatenate(row), np.concatenate(place), n_buckets)

    return work


def windows_of(window: int, n_buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Whole windows that hold one of the document's answered anchors at a cover offset."""
    reach = period_for(window) - 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(b.filter(b.column(3).is_valid()) for b in batches):
            ids, rows = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            keys, checks, doc, row, place = [], [], [], [], []
            for lo, hi, data, offs in blocks(batch.column(2)):
                w = Words(data, offs, NONSPACE, lower=False)
                edge = np.zeros(len(w) + 1, np.int64)
                for k, places in enumerate(batch.column(3).slice(lo, hi - lo).to_pylist()):
                    span = unpacked(places)
                    np.add.at(edge, w.first[k] + np.maximum(span[:, 0] - reach, 0), 1)
                    np.add.at(edge, w.first[k] + span[:, 1] + 1, -1)
                near = np.cumsum(edge[:-1]) > 0
                at = window_starts(w.first, window)
                at = at[near[at]]
                owner = np.searchsorted(w.first, at, side="right") - 1
                keys.append(windows(word_hashes(w, BYTE_BASE), at, window))
                checks.append((windows(word_hashes(w, CHECK_BYTES), at, window, CHECK_BASE) >> np.uint64(32)).astype(np.uint32))
                doc.append(ids[lo:hi][owner])
                row.append(rows[lo:hi][owner])
                place.append(at - w.first[owner])
            yield from entries(*(np.concatenate(x) for x in (keys, checks, doc, row, place)), n_buckets)

    return work


def asked(entry: DataFrame, anchors: bool, n_buckets: int) -> DataFrame:
    """The answers of all buckets, gathered per document row. They travel packed, by parts of the documents."""

    def answer(table: pa.Table) -> pa.Table:
        return answer_bucket(table, anchors, n_buckets)

    return entry.groupBy("bucket").applyInArrow(answer, SENT).groupBy("part").applyInArrow(gather_part, ANSWER)


def repeated(docs: DataFrame, window: int = WINDOW, n_buckets: int | None = None) -> tuple[DataFrame, str, str]:
    """``docs`` with a row hash and, where a smaller document has some of its windows, the packed places of those; and both names."""
    bounded_batches(docs.sparkSession)
    n_buckets = n_buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row, places = fresh(docs, "row"), fresh(docs, "places")
    # One shuffle of the texts, used by both joins below.
    laid = docs.withColumn(row, F.xxhash64("text")).repartition("doc_id", row)
    slim = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), F.col("text"))

    def joined(answer: DataFrame) -> DataFrame:
        got = answer.select(F.col("doc_id").alias("of_doc"), F.col("row").alias("of_row"), F.col("places").alias(places))
        return laid.join(got, (laid["doc_id"] == got["of_doc"]) & (laid[row] == got["of_row"]), "left").drop("of_doc", "of_row")

    near = joined(asked(slim.mapInArrow(anchors_of(window, n_buckets), ENTRY), True, n_buckets))
    near = near.select(F.col("doc_id").cast("long"), row, "text", places)
    return joined(asked(near.mapInArrow(windows_of(window, n_buckets), ENTRY), False, n_buckets)), row, places


def kept(text: str | None, places: bytes | None, window: int) -> tuple[int, int, list[bytes]]:
    """Number of words, of removed words, and the words that stay."""
    words = (text or "").encode().split()
    if not places:
        return len(words), 0, words
    span = unpacked(places)
    mask = covered(len(words), span[:, 0], span[:, 1] - span[:, 0] + window)
    return len(words), int(mask.sum()), list(compress(words, (~mask).tolist()))


def report(docs: DataFrame, window: int = WINDOW, n_buckets: int | None = None) -> DataFrame:
    source = docs.select(named(docs, "doc_id").alias("doc_id"), named(docs, "text").alias("text"))
    found, _, places = repeated(source, window, n_buckets)

    def digest(texts: pa.Array, parts: pa.Array) -> pa.Array:
        out = [kept(t, p, window) for t, p in zip(texts.to_pylist(), parts.to_pylist())]
        return pa.StructArray.from_arrays(
            [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([hashlib.sha256(b" ".join(x[2])).hexdigest() for x in out], pa.string())],
            ["n_words", "n_removed", "kept_sha256"],
        )

    made = F.arrow_udf(digest, "struct<n_words:bigint,n_removed:bigint,kept_sha256:string>").asNondeterministic()
    return found.withColumn("out", made("text", places)).select("doc_id", "out.n_words", "out.n_removed", "out.kept_sha256")


def dedup(docs: DataFrame, window: int = WINDOW, n_buckets: int | None = None) -> DataFrame:
    """``docs`` with repeated passages cut out, same columns. Changed texts are their kept words joined by one space; others stay as they are."""
    found, _, places = repeated(docs, window, n_buckets)

    def erase(texts: pa.Array, parts: pa.Array) -> pa.Array:
        return pa.array([b" ".join(kept(t, p, window)[2]).decode() if p else t for t, p in zip(texts.to_pylist(), parts.to_pylist())], pa.string())

    made = F.arrow_udf(erase, "string").asNondeterministic()
    return found.withColumn("text", made("text", places)).select(*[f"`{c}`" for c in docs.columns])
