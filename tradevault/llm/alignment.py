"""Cross-tokenizer alignment by interval coalescing, and how often token pairs of two vocabularies meet in a corpus.

A text, with a space before it, is encoded by a byte-level BPE vocabulary (A) and, without that space, by a piece model that adds
it (B). Both give intervals over the same bytes. All intervals of both sides are sorted by start, the running maximum of their
ends is taken, and a group breaks where a start reaches that maximum: there tokens of both sides end. Inside a group each A
token expands to the run of B tokens that overlap it; such a pair is a link.

A text is cut at single spaces between two characters that are no white space. No piece of either vocabulary reaches over such a
place (checked for B when its model is read), so both encodings break there and a chunk's groups and links never change. They
are computed once per distinct chunk and kept in a table of at most ``CACHE`` chunks per worker, which is emptied when full.
Chunks that are new in a block of texts are encoded and aligned together, as one text with a space before each. A chunk that one of
the vocabularies does not give back byte by byte sends its whole text to the direct way: encode the text at
once, compare the bytes, align it if they are equal.

A pair's count is the number of documents (rows) that hold it linked. Counts are summed in each task, then by Spark. They come
back to the documents as sorted arrays of at most ``BLOCK`` pairs, one pass over the stored pairs of the documents each: a broadcast
never exceeds a block, and the vocabularies bound how many blocks there are, however large the corpus is.

Defined results: a text that is NULL, empty, or not given back exactly by both vocabularies has no tokens: zeros and an empty
digest. Rows with a NULL doc_id and repeated rows are documents like any other. An empty table gives no rows; columns other
than the id and the text play no part. A long text is processed chunk by chunk; only a run without a place to cut is encoded
in one piece. The vocabulary files are parameters.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradevault.llm.columns import bounded_batches, named, stored
from tradevault.llm.tokens import byte_signs

CACHE = 200_000
KEEP_CHARS = 64
PART_CHARS = 1 << 19
FIELD = 64  # bits for each of the numbers that are added up in one integer
BLOCK = 4_000_000
FLUSH = 2_000_000
SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
WITH_COUNTS = ALIGNED + ", n_best long, count_sum long"


class Vocabularies:
    """Both tokenizers, the bytes of each of their ids, and the printed ids with the sign that follows each."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        with open(path_a, encoding="utf-8") as f:
            special = {t["id"] for t in json.load(f)["added_tokens"]}
        byte_of = {sign: b for b, sign in enumerate(byte_signs())}
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [b""] * (max(names) + 1)
        for i, t in names.items():
            self.bytes_a[i] = t.encode() if i in special else bytes(byte_of[c] for c in t)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        #: Texts may be cut at single spaces if no piece holds a space after something else.
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        self.size_b = len(pieces)
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        signs = [[f"{i}{end}" for i in range(n)] for n, ends in ((len(self.bytes_a), ",|"), (self.size_b, ",;")) for end in ends]
        self.signs = np.array([s.encode() for part in signs for s in part])
        self.sign_at = np.cumsum([0, *[len(part) for part in signs]])
        self.sign_len = np.array([len(s) for part in signs for s in part], np.int64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides; A reads a space before the text."""
        (a,) = self.a.encode_batch_fast([" " + text], add_special_tokens=False)
        return np.array(a.ids, np.int64), np.array(self.b.encode(text), np.int64)

    def exact(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        raw = b" " + text.encode()
        return b"".join([self.bytes_a[i] for i in a.tolist()]) == raw and b"".join([self.bytes_b[i] for i in b.tolist()]) == raw


def coalesce(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group) of intervals: the order by start, and each ordered interval's group number.

    A group ends where the next start reaches the running maximum of the ends.
    """
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    return order, np.cumsum(breaks) - 1


def expand(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (a, b) of all overlapping pairs; both sides are sorted and free of overlaps among themselves."""
    low = np.searchsorted(ends_b, starts_a, side="right")
    many = np.searchsorted(starts_b, ends_a, side="left") - low
    a = np.repeat(np.arange(len(starts_a)), many)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)


class Aligner:
    """Aligns texts; remembers the groups and links of frequent chunks."""

    def __init__(self, vocab: Vocabularies, cache: int = CACHE) -> None:
        self.vocab, self.cache = vocab, cache
        #: chunk -> (groups as text, pair keys, numbers of A tokens, B tokens and groups), or None if it is not given back
        self.known: dict[str, tuple[bytes, bytes, int] | None] = {}
        self.long: list[str] = []

    def align(self, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[bytes, bytes, int]]:
        """Groups and links of texts that lie one after another on one axis of bytes, up to ``ends``; a text's end ends a group.

        ``a`` and ``b`` are the ids of both sides over the whole axis.
        """
        v = self.vocab
        ends_a, ends_b = np.cumsum(v.len_a[a]), np.cumsum(v.len_b[b])
        starts_a, starts_b = ends_a - v.len_a[a], ends_b - v.len_b[b]
        order, group = coalesce(np.concatenate([starts_a, starts_b]), np.concatenate([ends_a, ends_b]))
        of = np.empty(len(order), np.int64)
        of[order] = group
        group_a, group_b = of[: len(a)], of[len(a) :]
        # Signs in the order group, side, place: a comma inside a side, a bar after the last A, a semicolon after the last B.
        last_a, last_b = np.append(np.diff(group_a) != 0, True), np.append(np.diff(group_b) != 0, True)
        sign = np.concatenate([v.sign_at[last_a.astype(int)] + a, v.sign_at[2 + last_b.astype(int)] + b])
        side = np.repeat([0, 1], [len(a), len(b)])
        sign = sign[np.lexsort((np.arange(len(sign)), side, of))]
        shown = v.signs[sign].tobytes().translate(None, b"\0")
        link_a, link_b = expand(starts_a, ends_a, starts_b, ends_b)
        keys = (a[link_a] * v.size_b + b[link_b]).astype(np.uint64).tobytes()
        # Where each text ends among the A tokens, B tokens, groups, printed signs and links.
        at_a, at_b = np.searchsorted(ends_a, ends, side="right"), np.searchsorted(ends_b, ends, side="right")
        n_a, n_b, n_groups = (np.diff(x, prepend=0).tolist() for x in (at_a, at_b, group_a[at_a - 1] + 1))
        at_sign = np.cumsum(v.sign_len[sign])[at_a + at_b - 1].tolist()
        at_link = (8 * np.searchsorted(link_a, at_a)).tolist()
        out, s, k = [], 0, 0
        for x, y, g, s_end, k_end in zip(n_a, n_b, n_groups, at_sign, at_link):
            out.append((shown[s:s_end], keys[k:k_end], x | y << FIELD | g << 2 * FIELD))
            s, k = s_end, k_end
        return out

    def learn(self, chunks: list[str]) -> None:
        """Align chunks that are not known, all at once as one text with a space before each.

        Both vocabularies break at such a space, unless the chunk before it ends in white space. If the text is not given back whole,
        the chunk that is to blame is found by halving.
        """
        if not chunks:
            return
        joined = " ".join(chunks)
        a, b = self.vocab.encode(joined)
        if self.vocab.exact(joined, a, b):
            ends = np.cumsum([len(c.encode()) + 1 for c in chunks])
            self.known.update(zip(chunks, self.align(ends, a, b)))
        elif len(chunks) == 1:
            self.known[chunks[0]] = None
        else:
            half = len(chunks) // 2
            self.learn(chunks[:half])
            self.learn(chunks[half:])

    def whole(self, text: str) -> list[tuple[bytes, bytes, int]] | None:
        """The direct way, for a text with a chunk that is not given back: all of it at once."""
        a, b = self.vocab.encode(text)
        return self.align(np.array([len(text.encode()) + 1]), a, b) if self.vocab.exact(text, a, b) else None

    def chunks(self, texts: list[str | None]) -> list[list[str]]:
        """The chunks of each text, all of them known afterwards; what was known before may be forgotten."""
        cut = [[] if not t else SAFE_SPACE.split(t) if self.vocab.cuts else [t] for t in texts]
        asked = dict.fromkeys(c for part in cut for c in part)
        new = [c for c in asked if c not in self.known]
        if len(self.known) + len(new) > self.cache:
            self.known.clear()
            new = list(asked)
        together = [c for c in new if self.vocab.cuts and not c[-1].isspace()]
        self.learn(together)
        for c in new:
            if c not in self.known:
                self.learn([c])
        self.long = [c for c in new if len(c) > KEEP_CHARS]
        return cut

    def texts(self, texts: list[str | None]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, digest, distinct pair keys, how often each is linked) of each text."""
        none = (0, 0, 0, 0, "", b"", b"")
        out, mask = [], (1 << FIELD) - 1
        for text, chunks in zip(texts, self.chunks(texts)):
            parts = [self.known[c] for c in chunks]
            if None in parts:
                parts = self.whole(text)
            if not parts:
                out.append(none)
                continue
            shown, links, numbers = zip(*parts)
            total = sum(numbers)
            digest = hashlib.sha256(b"".join(shown)[:-1]).hexdigest()
            links = np.frombuffer(b"".join(links), np.uint64)
            keys, times = np.unique(links, return_counts=True)
            out.append((total & mask, total >> FIELD & mask, total >> 2 * FIELD, len(links), digest, keys.tobytes(), times.astype(np.uint32).tobytes()))
        for c in self.long:
            self.known.pop(c, None)
        self.long = []
        return out


def in_parts(texts: list[str | None], size: int) -> Iterator[list[str | None]]:
    """Consecutive texts of about ``size`` characters together, or one longer text."""
    part, held = [], 0
    for t in texts:
        if part and held + len(t or "") > size:
            yield part
            part, held = [], 0
        part.append(t)
        held += len(t or "")
    if part:
        yield part


def align(docs: DataFrame, path_a: str, path_b: str, cache: int = CACHE) -> DataFrame:
    """Per document its numbers of tokens, groups and links, the digest of its groups, and its distinct linked pairs.

    ``pairs`` holds sorted 64-bit keys (A id times the size of B, plus B id), ``times`` how many links of the document each has.
    """
    bounded_batches(docs.sparkSession)
    state: dict = {}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "aligner" not in state:
            state["aligner"] = Aligner(Vocabularies(path_a, path_b), cache)
        aligner = state["aligner"]
        for batch in batches:
            rows = [row for part in in_parts(batch.column(1).to_pylist(), PART_CHARS) for row in aligner.texts(part)]
            kinds = (*[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary())
            made = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    source = docs.select(named(docs, "doc_id").cast("long").alias("doc_id"), named(docs, "text").alias("text"))
    return source.mapInArrow(work, ALIGNED)


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    unique, at = np.unique(np.concatenate(keys), return_inverse=True)
    return unique, np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)


def pair_counts(aligned: DataFrame, size_b: int, flush: int = FLUSH) -> DataFrame:
    """(a, b, n): the number of documents that hold each pair linked. Tasks sum what fits in memory before the shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, fresh, held = [], [], [], 0

        def sum_up() -> None:
            nonlocal keys, counts, fresh, held
            if fresh:
                unique, n = merged([*keys, *fresh], [*counts, *[np.ones(len(f), np.int64) for f in fresh]])
                keys, counts, fresh, held = [unique], [n], [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys[0].astype(np.int64)), pa.array(counts[0])], ["pair", "n"])

        for batch in batches:
            part = np.frombuffer(b"".join([p for p in batch.column(0).to_pylist() if p]), np.uint64)
            fresh.append(part)
            held += len(part)
            if held >= flush:
                sum_up()
                if len(keys[0]) >= flush:
                    yield out()
                    keys, counts = [], []
        sum_up()
        if keys:
            yield out()

    summed = aligned.select("pairs").mapInArrow(work, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return summed.select(F.expr(f"pair div {size_b}").cast("int").alias("a"), (F.col("pair") % size_b).cast("int").alias("b"), "n")


def look_up(held: Broadcast):
    """Adds one block of counts to ``n_best`` and ``count_sum`` of the documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = held.value
        for batch in batches:
            pairs = [p or b"" for p in batch.column(6).to_pylist()]
            mine = np.frombuffer(b"".join(pairs), np.uint64)
            times = np.frombuffer(b"".join([t or b"" for t in batch.column(7).to_pylist()]), np.uint32).astype(np.int64)
            edge = np.cumsum([0, *[len(p) // 8 for p in pairs]])
            at = np.minimum(np.searchsorted(keys, mine), max(len(keys) - 1, 0))
            here = keys[at] == mine if len(keys) else np.zeros(len(mine), bool)
            totals = []
            for value in (best, counts):
                got = np.where(here, value[at], 0) * times if len(keys) else np.zeros(len(mine), np.int64)
                run = np.concatenate([[0], np.cumsum(got)])
                totals.append(run[edge[1:]] - run[edge[:-1]])
            columns = batch.columns[:8] + [pa.array(batch.column(8 + i).to_numpy() + totals[i]) for i in range(2)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return work


def with_counts(aligned: DataFrame, pairs: DataFrame, size_b: int, block: int = BLOCK) -> DataFrame:
    """``aligned`` with ``n_best`` (links whose count is the highest of their A id) and ``count_sum`` (counts over all links).

    ``pairs`` is cut by hash into blocks of about ``block`` pairs; each is looked up in a pass over the documents' own pairs.
    """
    spark = aligned.sparkSession
    n_blocks = max(1, -(-pairs.count() // block))
    top = pairs.groupBy("a").agg(F.max("n").alias("top"))  # at most one row per id of A
    marked = pairs.join(F.broadcast(top), "a").select((F.col("a").cast("long") * size_b + F.col("b")).alias("pair"), "n", (F.col("n") == F.col("top")).alias("best"))
    out = aligned.select("*", F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))
    for k in range(n_blocks):
        part = marked if n_blocks == 1 else marked.where(F.pmod(F.xxhash64("pair"), F.lit(n_blocks)) == k)
        local = part.toArrow().combine_chunks()
        keys = local["pair"].to_numpy().astype(np.uint64)
        order = np.argsort(keys)
        held = spark.sparkContext.broadcast((keys[order], local["n"].to_numpy()[order], local["best"].to_numpy()[order].astype(np.int64)))
        out = (out if k == 0 else stored(out, "align-counts")).mapInArrow(look_up(held), WITH_COUNTS)
    return out


def report(docs: DataFrame, path_a: str, path_b: str, block: int = BLOCK, cache: int = CACHE) -> DataFrame:
    """Per document: tokens, groups and links, how many links are the best of their A id, the sum of counts, and the digest."""
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    aligned = stored(align(docs, path_a, path_b, cache), "aligned")
    pairs = stored(pair_counts(aligned, size_b), "pair-counts")
    return with_counts(aligned, pairs, size_b, block).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
