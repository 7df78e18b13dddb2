"""SimHash near-duplicates, compared bit-sliced.

Fingerprint: the words of a text (runs without 0x20 and 0x09-0x0D, A-Z lower-cased) form shingles of ``size`` consecutive words, joined by
one space, repeats included; a text of fewer words is one shingle. A bit of the fingerprint is 1 if it is 1 in over half the
shingles' XXH64 values (seed 42). A text without words has fingerprint 0, which links like any other; so has a NULL text.

Links: fingerprints with at most ``radius`` differing bits. Equal fingerprints are folded first. The 64 bits are cut into more
bands than ``radius``, so that linked fingerprints agree on all bits of at least one choice of ``bands - radius`` bands; each
choice is a table, and fingerprints that share a table's key form a bucket. Buckets are counted, and one of more than
``block`` fingerprints is cut into sub-blocks that meet pairwise in cells, so that no task holds more than one cell at a time
and no bucket is capped. The number of bands grows with the number of fingerprints.

A cell is compared bit-sliced: the candidates' bits are stored as 64 planes of packed words; a query's plane differences are
added to carry-save counters of three bits, 64 candidates at a time, and words all of whose lanes exceed the radius are
abandoned. A cell returns a spanning forest of its links, not its pairs. Links are joined by ``components``.

component_id is the smallest doc_id of the component; rows with a NULL doc_id are compared, but never name a component (NULL if
all of its ids are NULL). Repeated rows come out as often as they go in.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tradevault.llm.columns import added, fresh, named, stored
from tradevault.llm.components import components
from tradevault.llm.textscan import NONSPACE, Words, blocks

SIZE = 4
RADIUS = 4
SEED = 42
BLOCK = 8192
JOIN_UP = 256
CHECK_EVERY = 8


def fingerprints(texts: pa.Array, size: int = SIZE) -> np.ndarray:
    """Fingerprint of each text."""
    out = []
    hash64 = xxhash.xxh64_intdigest
    for lo, hi, data, offs in blocks(texts):
        w = Words(data, offs, NONSPACE, lower=True)
        raw = w.data.tobytes()
        # With single spaces between words a shingle is a slice of the text itself.
        gaps = w.starts[1:] - w.ends[:-1] if len(w) else np.zeros(0, np.int64)
        single = np.concatenate([[0], np.cumsum((gaps != 1) | (data[w.ends[:-1]] != 32))]) if len(gaps) else np.zeros(1, np.int64)
        starts, ends = w.starts.tolist(), w.ends.tolist()
        for k in range(hi - lo):
            a, b = int(w.first[k]), int(w.first[k + 1])
            if a == b:
                out.append(0)
                continue
            n = min(size, b - a)
            if single[b - 1] == single[a]:
                hashes = [hash64(raw[x:y], SEED) for x, y in zip(starts[a : b - n + 1], ends[a + n - 1 : b])]
            else:
                words = [raw[x:y] for x, y in zip(starts[a:b], ends[a:b])]
                hashes = [hash64(b" ".join(words[i : i + n]), SEED) for i in range(len(words) - n + 1)]
            out.append(majority(np.array(hashes, np.uint64)))
    return np.array(out, np.uint64)


def majority(hashes: np.ndarray) -> int:
    """Bits that are 1 in over half of the hashes."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def planes(prints: np.ndarray) -> np.ndarray:
    """64 bit planes, each of ceil(n / 64) packed words; lane j of a plane is bit b of fingerprint j."""
    n = -(-len(prints) // 64) * 64
    bits = np.zeros((n, 64), np.uint8)
    bits[: len(prints)] = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def close_pairs(queries: np.ndarray, candidates: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (query, candidate) of all pairs within ``radius`` (at most 6) differing bits."""
    sliced = planes(candidates)
    width = sliced.shape[1]
    found_q, found_c = [], []
    rows = max(1, (1 << 15) // max(1, width))
    for lo in range(0, len(queries), rows):
        part = queries[lo : lo + rows]
        flips = [np.where((part >> np.uint64(b)) & np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0)) for b in range(64)]
        q, word = np.divmod(np.arange(len(part) * width), width)
        ones, twos, fours, over = (np.zeros(len(q), np.uint64) for _ in range(4))
        for b in range(64):
            d = sliced[b][word] ^ flips[b][q]
            carry = ones & d
            ones ^= d
            d = twos & carry
            twos ^= carry
            over |= fours & d
            fours ^= d
            if b % CHECK_EVERY == CHECK_EVERY - 1 or b == 63:
                far = over | beyond(ones, twos, fours, radius)
                alive = far != np.uint64(0xFFFFFFFFFFFFFFFF)
                if not alive.all():
                    q, word, ones, twos, fours, over = (x[alive] for x in (q, word, ones, twos, fours, over))
                    if not len(q):
                        break
        if len(q):
            near = ~(over | beyond(ones, twos, fours, radius))
            lanes = np.unpackbits(near.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            pair, lane = np.nonzero(lanes)
            c = word[pair] * 64 + lane
            ok = c < len(candidates)
            found_q.append(q[pair][ok] + lo)
            found_c.append(c[ok])
    none = np.zeros(0, np.int64)
    return (np.concatenate(found_q), np.concatenate(found_c)) if found_q else (none, none)


def beyond(ones: np.ndarray, twos: np.ndarray, fours: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose three-bit counter exceeds ``radius``."""
    out = np.zeros_like(ones)
    for value in range(radius + 1, 8):
        lane = np.full_like(ones, 0xFFFFFFFFFFFFFFFF)
        for bit, plane in enumerate((ones, twos, fours)):
            lane &= plane if value >> bit & 1 else ~plane
        out |= lane
    return out


def forest(n: int, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of the links."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        if x != y:
            rx, ry = root(x), root(y)
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
                yield x, y


def cell_links(prints: np.ndarray, cross: int, radius: int) -> list[tuple[int, int]]:
    """Links inside a cell; of a cell of two sub-blocks, the first ``cross`` against the others."""
    a, b = close_pairs(prints[:cross], prints[cross:], radius) if cross else close_pairs(prints, prints, radius)
    return [(int(prints[x]), int(prints[y])) for x, y in forest(len(prints), a, b + cross)]


def link_cells(radius: int):
    """Links of all cells of a task. Rows come sorted by cell; small cells are joined to fill a comparison."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        held = 0

        def compare(rows: np.ndarray, cross: int) -> pa.RecordBatch:
            found = np.array(cell_links(rows, cross, radius), np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

        def done(cell: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal kept, held
            prints = cell[:, 2].view(np.uint64)
            other = int(cell[-1, 1])
            if other:  # sorted: first the rows of the first sub-block, marked 0
                yield compare(prints, int(np.searchsorted(cell[:, 1], 1)))
                return
            kept.append(prints)
            held += len(prints)
            if held >= JOIN_UP:
                yield compare(np.unique(np.concatenate(kept)), 0)
                kept, held = [], 0

        rest = np.zeros((0, 3), np.int64)
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)
            rows = np.concatenate([rest, rows])
            edge = np.flatnonzero(np.diff(rows[:, 0])) + 1
            at = 0
            for e in edge.tolist():
                yield from done(rows[at:e])
                at = e
            rest = rows[at:]
        if len(rest):
            yield from done(rest)
        if kept:
            yield compare(np.unique(np.concatenate(kept)), 0)

    return work


def key(bands: int, chosen: tuple[int, ...]) -> Column:
    """The bits of the chosen bands of column ``fp``."""
    edge = [64 * i // bands for i in range(bands + 1)]
    mask = sum(((1 << (edge[c + 1] - edge[c])) - 1) << edge[c] for c in chosen)
    return F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def bands_for(n: int, radius: int) -> int:
    """The fewest bands for which an even bucket holds at most a few thousand of ``n`` fingerprints."""
    bands = radius + 1
    while bands < radius + 4 and n > 4096 << (64 * (bands - radius) // bands):
        bands += 1
    return bands


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK, bands: int | None = None) -> DataFrame:
    """(a, b): enough links between the distinct fingerprints ``fp`` to connect all that are within ``radius``."""
    bands = bands or bands_for(prints.count(), radius)
    tables = [F.struct(F.lit(i).alias("t"), key(bands, c).alias("k")) for i, c in enumerate(combinations(range(bands), bands - radius))]
    rows = prints.select("fp", F.explode(F.array(*tables)).alias("x")).select("fp", "x.t", "x.k")
    count = rows.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1")
    many = F.ceil(F.col("n") / block).cast("int")
    rows = rows.join(count, ["t", "k"]).select("fp", "t", "k", many.alias("parts"))
    own = F.pmod(F.xxhash64("fp", "t"), F.col("parts")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    first, second = F.least("own", "other"), F.greatest("own", "other")
    rows = rows.select(F.xxhash64("t", "k", first, second).alias("cell"), (F.col("own") > F.col("other")).cast("long").alias("side"), "fp")
    return rows.repartition("cell").sortWithinPartitions("cell", "side").mapInArrow(link_cells(radius), "a long, b long")


def with_fingerprint(docs: DataFrame, into: str = "fp", text: str = "text", size: int = SIZE) -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of each whole text in column ``into`` (replaced if present)."""

    def prints(texts: pa.Array) -> pa.Array:
        return pa.array(fingerprints(texts, size).view(np.int64))

    return added(docs, into, prints, "long", text)


def grouped(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of ``docs``."""
    source = docs.select(named(docs, "doc_id").alias("doc_id"), named(docs, "text").alias("text"))
    marked = stored(with_fingerprint(source).select("doc_id", "fp"), "simhash")
    folded = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("doc")), "prints")
    root = components(links(folded.select("fp"), radius), "a", "b")
    placed = folded.join(root, folded["fp"] == root["node"], "left").select("fp", "doc", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("doc").alias("component_id"))
    return marked.join(placed.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def report(docs: DataFrame) -> DataFrame:
    return grouped(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def dedup(docs: DataFrame, radius: int = RADIUS, size: int = SIZE) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id; same columns.

    Of rows with that same doc_id one stays, the smallest by hash of the row. Components without any doc_id keep one row as well.
    """
    columns = docs.columns
    fp, comp, row = (fresh(docs, c) for c in ("fp", "component", "row"))
    # The row hash stands for the row, so that only hashes and ids are compared, and text is joined once.
    marked = with_fingerprint(docs, fp, size=size).withColumn(row, F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in columns]))
    small = stored(marked.select(F.col("doc_id").alias("doc"), F.col(fp).alias("fp"), F.col(row).alias("row")), "simhash")
    folded = stored(small.groupBy("fp").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "row")).alias("best")), "prints")
    root = components(links(folded.select("fp"), radius), "a", "b")
    placed = folded.join(root, folded["fp"] == root["node"], "left").select("best", F.coalesce("root", "fp").alias("root"))
    keep = placed.groupBy("root").agg(F.min("best").alias("best")).select("best.doc", "best.row")
    copies = small.groupBy("doc", "row").agg(F.count("*").alias("copies"))
    same = keep["doc"].eqNullSafe(copies["doc"]) & (keep["row"] == copies["row"])
    keep = stored(keep.join(copies, same).select(keep["doc"].alias("keep_id"), keep["row"].alias("keep_row"), "copies"), "keep")
    this = docs.withColumn(row, F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in columns]))

    def kept(some: str) -> DataFrame:
        chosen = keep.where(some)
        return this.join(chosen, this["doc_id"].eqNullSafe(chosen["keep_id"]) & (this[row] == chosen["keep_row"]), "left_semi")

    # Rows that are alike in all columns share id and hash; of those, usually none, one stays.
    out = kept("copies = 1").unionByName(kept("copies > 1").dropDuplicates(["doc_id", row]))
    return out.select(*[f"`{c}`" for c in columns])
