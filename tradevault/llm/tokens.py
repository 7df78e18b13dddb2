"""Token counts of a byte-level BPE vocabulary, by heap and linked list, without making token ids.

A text is cut at the special strings of the vocabulary, each of which is one token, as the tokenizer library does by default.
What lies between is cut into pieces by the vocabulary's pattern. The bytes of a piece form a linked list; a heap holds the
adjacent pairs that have a merge rank. The lowest rank (leftmost if equal) is popped, the pair becomes one symbol and its two
new neighbour pairs are pushed; stale heap entries are skipped. The count of a piece is its bytes minus its merges.

Counts of pieces are kept per worker in a table of at most ``CACHE`` entries that is emptied when full, so memory is bounded and
frequent words cost one look-up. A text is first split at single spaces, each of which belongs to the word after it, and
words are looked up whole. NULL counts as an empty text: 0 bytes, 0 tokens. The vocabulary file is a parameter; its merge list
(a fixed 50,000 pairs here) is broadcast.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradevault.llm.columns import added, fresh, named

CACHE = 400_000
OVER = 1024

#: Unicode white space, as the pattern's \s means it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
ODD_SPACE = re.compile("[\\t\\x0b-\\r\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")


def char_class(major: str) -> str:
    """Body of a regular-expression class with all characters of a major Unicode category (L or N)."""
    out, start = [], None
    for c in range(sys.maxunicode + 2):
        inside = c <= sys.maxunicode and unicodedata.category(chr(c))[0] == major
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}" if c - 1 > start else f"\\U{start:08x}")
            start = None
    return "".join(out)


def piece_pattern() -> re.Pattern:
    """The pre-tokenizer's pattern: contractions, words, numbers, other signs, white space."""
    letter, number = char_class("L"), char_class("N")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{SPACE}{letter}{number}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def byte_signs() -> list[str]:
    """The sign that stands for each byte in a byte-level vocabulary: itself if printable, else the next free one from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(others)) for b in range(256)]


def load(path: str) -> tuple[dict[tuple[str, str], int], list[str]]:
    """(merge ranks, special strings) of a byte-level BPE vocabulary file."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    if model["model"]["type"] != "BPE" or model["pre_tokenizer"]["type"] != "ByteLevel" or model["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError(f"{path} is not a byte-level BPE vocabulary without prefix space")
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["model"]["merges"]]
    return {pair: rank for rank, pair in enumerate(pairs)}, [t["content"] for t in model["added_tokens"]]


def count_piece(piece: str, ranks: dict[tuple[str, str], int], signs: list[str]) -> int:
    """Symbols of one piece after all merges."""
    symbols = [signs[b] for b in piece.encode("utf-8", "surrogatepass")]
    n = len(symbols)
    heap = []
    for i in range(n - 1):
        rank = ranks.get((symbols[i], symbols[i + 1]))
        if rank is not None:
            heap.append((rank, i))
    if not heap:
        return n
    heapq.heapify(heap)
    left, right, merges = list(range(-1, n - 1)), list(range(1, n + 1)), 0
    while heap:
        rank, i = heapq.heappop(heap)
        j = right[i]
        if symbols[i] is None or j >= n or ranks.get((symbols[i], symbols[j])) != rank:
            continue
        symbols[i] += symbols[j]
        symbols[j] = None
        merges += 1
        k = right[i] = right[j]
        if k < n:
            left[k] = i
            rank = ranks.get((symbols[i], symbols[k]))
            if rank is not None:
                heapq.heappush(heap, (rank, i))
        k = left[i]
        if k >= 0:
            rank = ranks.get((symbols[k], symbols[i]))
            if rank is not None:
                heapq.heappush(heap, (rank, k))
    return n - merges


class Memo(dict):
    """A dict that computes what it lacks and is emptied when it holds too much."""

    def __init__(self, make: Callable[[str], int], limit: int) -> None:
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self.make(key)
        if len(key) <= 64:
            self[key] = value
        return value


def counter(ranks: dict[tuple[str, str], int], special: list[str], cache: int = CACHE) -> Callable[[str], int]:
    """A function text -> number of tokens."""
    signs, pattern = byte_signs(), piece_pattern()
    specials = re.compile("|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
    pieces = Memo(lambda p: count_piece(p, ranks, signs), cache)
    chunk = Memo(lambda c: sum(map(pieces.__getitem__, pattern.findall(c))), cache)
    after_space = Memo(lambda c: sum(map(pieces.__getitem__, pattern.findall(" " + c))), cache)

    def plain(text: str) -> int:
        if "  " in text or " \n" in text or "\n " in text or ODD_SPACE.search(text):
            return sum(map(pieces.__getitem__, pattern.findall(text)))
        first, *others = text.split(" ")
        return chunk[first] + sum(map(after_space.__getitem__, others))

    def count(text: str) -> int:
        if specials is None:
            return plain(text)
        parts = specials.split(text)
        return sum(map(plain, parts)) + len(parts) - 1

    return count


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def with_token_counts(docs: DataFrame, path: str, into: str = "n_tokens", text: str = "text") -> DataFrame:
    """``docs`` with the number of tokens of each whole text in column ``into`` (replaced if present)."""
    spark: SparkSession = docs.sparkSession
    held = spark.sparkContext.broadcast(load(path))

    def count_all(texts: pa.Array) -> pa.Array:
        if "count" not in state:
            state["count"] = counter(*held.value)
        count = state["count"]
        return pa.array([count(t) if t else 0 for t in texts.to_pylist()], pa.int64())

    state: dict = {}
    return added(docs, into, count_all, "long", text)


def report(docs: DataFrame, path: str, over: int = OVER) -> DataFrame:
    source = docs.select(named(docs, "doc_id").alias("doc_id"), named(docs, "text").alias("text"))
    counted = with_token_counts(source, path, fresh(source, "n_tokens"))
    return counted.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > over).alias("over_limit"),
    )
