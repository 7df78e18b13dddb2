"""Document fingerprints by winnowing.

The code points of a text form k-grams, each hashed by a polynomial modulo 2**64 (k is far too short for the words whose
hashes collide in any base). Hashes of k-grams are made from those of half the length, doubled up to ``GRAM``. Of every
``WINDOW`` consecutive hashes the smallest is selected, the rightmost one if several are smallest; each selected place is kept once, with
its hash. So any passage of ``GRAM + WINDOW - 1`` code points that two texts share has a selected hash in common, at places
that tell where it stands, and no window goes without a selected hash.

A text shorter than a k-gram is one gram; one with fewer grams than a window is one window. A long text is worked in overlapping
parts, so memory does not grow with it beyond the text and its fingerprint.

A fingerprint is printed as twelve hex digits per selected place: ten of the hash, two of the distance from the place before (from
-1 for the first). Likeness is the share of common hashes among all hashes of both (Jaccard); two empty fingerprints are alike.

Edited texts need the next document in ascending doc_id order. Bounds from a sample of at most ``SAMPLE`` sort keys cut that order into
buckets; a copy of each bucket's first document is added to the end of the bucket before (of the last one, for the first). Then one
shuffle of the texts brings every document next to its neighbour, and tasks stream through their sorted buckets. The bounds
balance the work only; any bounds give the same rows.

Defined results: a NULL text is empty: empty fingerprint, 0 code points. A NULL doc_id comes before all others. Rows of one doc_id are
ordered by a hash of their text; rows alike in both may stand in any order, which shows in no result, and are spread over
buckets by the task that read them. A single document is its own next one. An empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradevault.llm.columns import added, bounded_batches, named
from tradevault.llm.textscan import mix

GRAM = 24
WINDOW = 40
BASE = np.uint64(0x9E3779B97F4A7C15)
DIGITS = 5  # bytes of a hash that are kept
PART = 1 << 18
SAMPLE = 20_000
BUCKET_ROWS = 8_000

PLACES = "array<struct<hash:long,at:long>>"
REPORT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k code points from each place: from halves, doubled, with one more code point where k is odd."""
    if k == 1:
        return (points.astype(np.uint64) + np.uint64(1)) * BASE
    half = gram_hashes(points, k // 2)
    step = np.uint64(pow(int(BASE), k // 2, 1 << 64))
    n = len(points) - 2 * (k // 2) + 1
    out = half[:n] * step + half[k // 2 : k // 2 + n]
    return out[: n - 1] * BASE + points[k - 1 :].astype(np.uint64) + np.uint64(1) if k % 2 else out


def least_places(hashes: np.ndarray, w: int) -> np.ndarray:
    """Places of the rightmost smallest hash of every window of ``w``, ascending, each once."""
    value, at, size = hashes, np.arange(len(hashes)), 1
    while size < w:
        step = min(size, w - size)
        other = value[step:]
        right = other <= value[: len(other)]
        at = np.where(right, at[step:], at[: len(other)])
        value = np.where(right, other, value[: len(other)])
        size += step
    return at[np.concatenate([[True], at[1:] != at[:-1]])]


def winnow(points: np.ndarray, k: int = GRAM, w: int = WINDOW, part: int = PART) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) selected from a text's code points."""
    n = len(points)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k = min(k, n)
    w = min(w, n - k + 1)
    found_h, found_at = [], []
    for lo in range(0, n - k - w + 2, part):
        hashes = mix(gram_hashes(points[lo : lo + part + k + w - 2], k))
        at = least_places(hashes, w)
        found_h.append(hashes[at])
        found_at.append(at + lo)
    hashes, at = np.concatenate(found_h), np.concatenate(found_at)
    new = np.concatenate([[True], at[1:] != at[:-1]])  # a place may be selected in two parts
    return hashes[new] >> np.uint64(64 - 8 * DIGITS), at[new]


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le"), np.uint32)


def shown(hashes: np.ndarray, at: np.ndarray) -> str:
    """The printed fingerprint. Places are at most a window apart, so a distance takes one byte."""
    packed = np.empty((len(hashes), DIGITS + 1), np.uint8)
    packed[:, :DIGITS] = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - DIGITS :]
    packed[:, DIGITS] = np.diff(at, prepend=-1)
    return packed.tobytes().hex()


def read(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of a printed fingerprint."""
    packed = np.frombuffer(bytes.fromhex(fingerprint), np.uint8).reshape(-1, DIGITS + 1)
    wide = np.zeros((len(packed), 8), np.uint8)
    wide[:, 8 - DIGITS :] = packed[:, :DIGITS]
    return wide.reshape(-1).view(">u8").astype(np.uint64), np.cumsum(packed[:, DIGITS].astype(np.int64)) - 1


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common ones among all distinct hashes; both arrays are sorted and distinct."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def with_fingerprint(docs: DataFrame, into: str = "places", text: str = "text", k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """``docs`` with the selected (hash, place) of each whole text in column ``into`` (replaced if present)."""

    def select(texts: pa.Array) -> pa.Array:
        made = [winnow(code_points(t), k, w) for t in texts.to_pylist()]
        flat = pa.StructArray.from_arrays([pa.array(np.concatenate([m[i] for m in made]).astype(np.int64)) for i in range(2)], ["hash", "at"])
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *[len(m[0]) for m in made]]), pa.int32()), flat)

    return added(docs, into, select, PLACES, text)


def passages(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """(doc_id, at, of_doc_id, of_at, hash): each selected place whose hash is selected in a smaller doc_id, with its first place there.

    By the match guarantee every passage of ``k + w - 1`` code points shared with a smaller doc_id shows at least once. The first
    place of a hash is an aggregate that is combined before the shuffle, so a hash that very many documents share stays one row.
    """
    source = docs.select(named(docs, "doc_id").cast("long").alias("doc_id"), named(docs, "text").alias("text")).where("doc_id IS NOT NULL")
    places = with_fingerprint(source, "places", "text", k, w).select("doc_id", F.explode("places").alias("p")).select("doc_id", "p.hash", "p.at")
    first = places.groupBy("hash").agg(F.min(F.struct("doc_id", "at")).alias("first"))
    return places.join(first, "hash").where(F.col("first.doc_id") < F.col("doc_id")).select("doc_id", "at", F.col("first.doc_id").alias("of_doc_id"), F.col("first.at").alias("of_at"), "hash")


def not_after(bounds: list[tuple]) -> Column:
    """The number of sorted bounds (some, doc_id, h, part) that do not come after a row's key; NULL ids come first.

    Looked up in two steps, first among every ``step``-th bound, so a row meets few of many bounds.
    """
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    key = F.struct(F.col("doc_id").isNotNull().alias("some"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "h", "part")

    def known(some: list, kind: str) -> Column:
        return F.from_json(F.lit(json.dumps(some)), kind)

    def dicts(part: list[tuple]) -> list[dict]:
        return [{"some": s, "doc_id": d or 0, "h": h, "part": p} for s, d, h, p in part]

    one = "array<struct<some:boolean,doc_id:bigint,h:bigint,part:int>>"
    ends = known(dicts(bounds[step - 1 :: step]), one)
    full = F.size(F.filter(ends, lambda b: b <= key))
    runs = known([dicts(bounds[i : i + step]) for i in range(0, len(bounds) + 1, step)], f"array<{one}>")
    return full * step + F.size(F.filter(F.get(runs, full), lambda b: b <= key))


def edit(text: str, following: str) -> str:
    """The last quarter of the code points gives way to the first ones of the text that follows."""
    many = len(text) // 4
    return text[: len(text) - many] + following[:many]


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Report rows of sorted buckets; the last row of a bucket is the copy of the next bucket's first document."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    before = None
    for batch in batches:
        out = []
        for bucket, copy, doc_id, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            text = text or ""
            hashes, at = winnow(code_points(text))
            now = (bucket, doc_id, text, np.unique(hashes), shown(hashes, at))
            if before is not None and before[0] == bucket:
                edited = edit(before[2], text)
                e_hashes, e_at = winnow(code_points(edited))
                out.append((before[1], len(before[2]), hashlib.sha256(edited.encode()).hexdigest(), before[4], shown(e_hashes, e_at), likeness(before[3], np.unique(e_hashes)), likeness(before[3], now[3])))
            before = None if copy else now
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 7, kinds)], names)


def report(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, sample: int = SAMPLE) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and how alike its fingerprint is to that and to the next document's."""
    spark = docs.sparkSession
    bounded_batches(spark)
    source = docs.select(named(docs, "doc_id").cast("long").alias("doc_id"), named(docs, "text").alias("text"))
    keyed = source.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.spark_partition_id().alias("part"))
    some = F.col("doc_id").isNotNull().alias("some")
    rows = source.count()
    n_buckets = max(1, min(sample, -(-rows // bucket_rows)))
    bounds = []
    if n_buckets > 1:
        picked = keyed.select(some, "doc_id", "h", "part").where(F.rand(7) < sample / rows).limit(2 * sample).collect()
        picked = sorted((r["some"], r["doc_id"] or 0, r["h"], r["part"]) for r in picked)
        bounds = [picked[len(picked) * i // n_buckets] for i in range(1, n_buckets)] if picked else []
    placed = keyed.withColumn("bucket", not_after(bounds))
    # The first key of each bucket, one text for each, and every bucket gets a copy of the first document after it.
    firsts = placed.groupBy("bucket").agg(F.min(F.struct(some, "doc_id", "h")).alias("first")).collect()
    head = {r["bucket"]: (r["first"]["doc_id"], r["first"]["h"]) for r in firsts}
    if not head:
        return spark.createDataFrame([], REPORT)
    following, last = [], head[min(head)]
    for b in range(len(bounds), -1, -1):
        following.append((*last, b))
        last = head.get(b, last)
    wanted = spark.createDataFrame(following, "want_id long, want_h long, bucket int")
    same = F.col("doc_id").eqNullSafe(F.col("want_id")) & (F.col("h") == F.col("want_h"))
    copies = keyed.select("doc_id", "text", "h").join(F.broadcast(wanted), same).groupBy("bucket").agg(F.first(F.struct("doc_id", "text")).alias("r"))
    copies = copies.select("bucket", F.lit(True).alias("copy"), "r.doc_id", "r.text", F.lit(0).cast("long").alias("h"), F.lit(0).alias("part"))
    together = placed.select("bucket", F.lit(False).alias("copy"), "doc_id", "text", "h", "part").unionByName(copies).repartitionById(len(bounds) + 1, F.col("bucket"))
    within = together.sortWithinPartitions("bucket", "copy", F.col("doc_id").asc_nulls_first(), "h", "part")
    return within.select("bucket", "copy", "doc_id", "text").mapInArrow(neighbours, REPORT)
