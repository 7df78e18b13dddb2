"""Personal data: base patterns, and terms that the corpus shows to give a protected entity away.

Base: e-mail addresses, IPv4 addresses, card numbers (13 to 19 digits, Luhn) and phone numbers (9 to 15 digits), leftmost and
non-overlapping per kind; a match that fails its test is dropped without a retry. The scan is linear in the text.

Information-theoretic part: every distinct base value is a protected entity c. Terms t are words of at least three letters anywhere in
a document that holds c, outside base spans. Over all N documents, with documents as the unit,

    IC(c) = log2(N / n(c))        PMI(c; t) = log2(N p(c | t) / n(c))

and t discloses c if PMI(c; t) >= ``disclosure`` * IC(c), that is if p(c | t) is close to 1. n(c, t) counts documents. The evidence is the
number d of different contexts (the ``near`` words either side of c) of c in documents that hold t, so that copies of one passage are one
observation, and p(c | t) is n(c, t) / n(t) with d observations in which t meets c and ``SMOOTH`` more in which it does not:

    p(c | t) = d / (d n(t) / n(c, t) + SMOOTH)

t needs ``support`` contexts, or all contexts of c if c has fewer: entities seen once or twice are judged by p alone. A term seen in one
context of one document reaches 2/3, which suffices from about 3,300 documents on. Every occurrence of a disclosing term becomes a span of
kind ``term``, except inside base spans. Base spans always stay.

Counts run over all documents. A document gives one pair for each of its entities, contexts and words. Disclosing terms are broadcast in
blocks of at most ``BLOCK_TERMS``; further blocks take further passes, so none is dropped and the broadcast has a fixed bound. Entities
travel as 64-bit hashes.

Spans are code points, end exclusive. NULL and empty texts have no spans. Documents are counted by row, repeated rows too.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradevault.llm.columns import bounded_batches, fresh, named, stored
from tradevault.session import cut

KINDS = ("email", "ip", "card", "phone")
NEAR = 5
SUPPORT = 3
DISCLOSURE = 0.95
SMOOTH = 0.5
BLOCK_TERMS = 500_000
PAIR_ROWS = 100_000
HELD_TERMS = 200_000

#: Fixed values of the contract: the base patterns. The look-behinds and possessive quantifiers only skip starts that cannot match.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TERM = re.compile(r"[^\W\d_]{3,}")
SPANS = "array<struct<kind:string,a:int,b:int>>"
SPAN = pa.struct([("kind", pa.string()), ("a", pa.int32()), ("b", pa.int32())])


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ back to the start of its local part, so that long runs of letters are read once."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            done = m.end()
            yield start, done
        # A local part cannot reach over an @, so a failed one ends here; a domain holds none.
        done = max(done, at + 1)
        at = text.find("@", done)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            yield m.span()


FINDERS = (("email", emails), ("ip", ips), ("card", cards), ("phone", phones))


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end), by kind as listed, then start."""
    return [(kind, a, b) for kind, find in FINDERS for a, b in find(text)] if text else []


def hash64(value: str) -> int:
    return xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass")) - (1 << 63)


def words_of(text: str) -> set[str]:
    """The distinct terms of a text, lower-cased one by one, as their spans are."""
    return {w.lower() for w in set(TERM.findall(text))}


def pairs_of(batches: Iterator[pa.RecordBatch], near: int) -> Iterator[pa.RecordBatch]:
    """Per document: its distinct (entity, term, context), and (entity, NULL, context) for the entity itself.

    ``k`` is 1 in one row of each (entity, term) of the document and 0 in its other contexts, so that its sum counts documents.
    """
    rows: list[tuple] = []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        c, t, mark, k = zip(*rows) if rows else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(t, pa.string()), pa.array(mark, pa.int64()), pa.array(k, pa.int64())], ["entity", "term", "context", "k"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            spans = base_spans(text)
            if not spans:
                continue
            taken = sorted((a, b) for _, a, b in spans)
            words = [m for m in TERM.finditer(text) if not overlaps(taken, m.start(), m.end())]
            starts = [m.start() for m in words]
            lower = [m[0].lower() for m in words]
            marks: dict[int, dict[int, None]] = {}
            for _, a, b in spans:
                i = bisect_left(starts, a)
                marks.setdefault(hash64(text[a:b].lower()), {})[hash64(" ".join(lower[max(0, i - near) : i + near]))] = None
            terms = [None, *set(lower)]
            for c, of_c in marks.items():
                for k, mark in enumerate(of_c):
                    rows += [(c, t, mark, int(k == 0)) for t in terms]
                    if len(rows) >= PAIR_ROWS:
                        yield batch_of(rows)
                        rows = []
    yield batch_of(rows)


def overlaps(taken: list[tuple[int, int]], a: int, b: int) -> bool:
    """True if a sorted list of spans of several kinds touches [a, b)."""
    i = bisect_right(taken, (b, -1))
    return any(y > a and x < b for x, y in taken[max(0, i - 8) : i])


def in_blocks(terms: DataFrame, block: int) -> Iterator[set[str]]:
    """The terms in sets of at most about ``block``, by hash."""
    n = terms.count()
    n_blocks = max(1, -(-n // block))
    for k in range(n_blocks if n else 0):
        part = terms if n_blocks == 1 else terms.where(F.pmod(F.xxhash64("term"), F.lit(n_blocks)) == k)
        yield {r["term"] for r in part.collect()}


def document_counts(texts: DataFrame) -> DataFrame:
    """(term, n): in how many texts each term occurs; partial counts per task, then one shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["term", "k"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for t in words_of(text) if text else ():
                    total[t] = total.get(t, 0) + 1
                if len(total) >= HELD_TERMS:
                    yield flush()
                    total = {}
        yield flush()

    return texts.mapInArrow(count, "term string, k long").groupBy("term").agg(F.sum("k").alias("n"))


def disclosing(docs: DataFrame, near: int = NEAR, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """Distinct terms that disclose at least one entity."""
    texts = docs.select(named(docs, "text").alias("text"))
    bounded_batches(docs.sparkSession)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from pairs_of(batches, near)

    seen = stored(texts.mapInArrow(pairs, "entity long, term string, context long, k long"), "pii-pairs")
    # Two levels: copies of a context are folded before contexts are counted.
    each = seen.groupBy("entity", "term", "context").agg(F.sum("k").alias("k")).groupBy("entity", "term").agg(F.sum("k").alias("n_ct"), F.count("*").alias("d"))
    entity = each.where("term IS NULL").select("entity", F.col("n_ct").alias("n_c"), F.least(F.col("d"), F.lit(support)).alias("floor"))
    n_all = float(texts.count())
    p = F.col("d") / (F.col("d") * F.col("n_t") / F.col("n_ct") + F.lit(SMOOTH))
    told = each.where("term IS NOT NULL").join(document_counts(texts).withColumnRenamed("n", "n_t"), "term").withColumn("p", p)
    # No entity is rarer than one document: what fails for that fails for all, and is left out before entities are joined.
    told = told.where(F.col("p") >= F.lit(0.999 * max(n_all, 1.0) ** (min(disclosure, 1.0) - 1)))
    ic = F.log2(F.lit(n_all) / F.col("n_c"))
    pmi = F.log2(F.lit(n_all) * F.col("p") / F.col("n_c"))
    joined = told.join(entity, "entity").where((F.col("d") >= F.col("floor")) & (ic > 0) & (pmi >= F.lit(disclosure) * ic))
    # Stored, because it is counted before it is broadcast and stands on two passes over the corpus.
    return stored(joined.select("term").distinct(), "pii-terms")


def with_spans(docs: DataFrame, terms: DataFrame, into: str, block: int = BLOCK_TERMS, kind: str = SPANS, finish: Callable | None = None) -> DataFrame:
    """``docs`` with all spans of each text in column ``into`` (replaced if present): base spans by kind and start, then terms by start.

    With ``finish`` the column holds what that makes of the texts and their spans, as type ``kind``. A text passes Python once per block of
    terms, and once in all for most corpora: every step more would be one more Python worker beside each task.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    out, so_far, blocks = docs, None, in_blocks(terms, block)
    now = next(blocks, frozenset())
    while True:
        after = next(blocks, None)
        last = after is None
        name = into if last else fresh(docs, "spans_so_far")
        first, later = spans_of(spark.sparkContext.broadcast(now), finish if last else None)
        step = F.arrow_udf(later if so_far else first, kind if last else SPANS).asNondeterministic()
        out = out.withColumn(name, step(F.col("text"), *[F.col(f"`{c}`") for c in (so_far,) if c]))
        if last:
            return out.drop(so_far) if so_far and so_far != into else out
        out, so_far, now = cut(out), name, after


def spans_of(held: Broadcast, finish: Callable | None) -> tuple[Callable[[pa.Array], pa.Array], Callable[[pa.Array, pa.Array], pa.Array]]:
    """Base spans, or those found before, with the spans of one block of disclosing terms."""

    def find(texts: pa.Array, before: pa.Array | None = None) -> pa.Array:
        read = texts.to_pylist()
        known = before.to_pylist() if before is not None else [[{"kind": k, "a": a, "b": b} for k, a, b in base_spans(t)] for t in read]
        got = []
        for text, spans in zip(read, known):
            if text and held.value and not held.value.isdisjoint(words_of(text)):
                taken = sorted((s["a"], s["b"]) for s in spans if s["kind"] != "term")
                new = [{"kind": "term", "a": m.start(), "b": m.end()} for m in TERM.finditer(text) if m[0].lower() in held.value and not overlaps(taken, *m.span())]
                old = [s for s in spans if s["kind"] == "term"]
                spans = [s for s in spans if s["kind"] != "term"] + sorted(old + new, key=lambda s: s["a"])
            got.append(spans)
        return finish(read, got) if finish else pa.array(got, pa.list_(SPAN))

    def first(texts: pa.Array) -> pa.Array:
        return find(texts)

    def later(texts: pa.Array, before: pa.Array) -> pa.Array:
        return find(texts, before)

    return first, later


def listed(spans: list[dict]) -> str:
    return ",".join(f"{s['kind']}:{s['a']}:{s['b']}" for s in spans)


def report(docs: DataFrame) -> DataFrame:
    source = docs.select(named(docs, "doc_id").alias("doc_id"), named(docs, "text").alias("text"))

    def digest(_: list, rows: list) -> pa.Array:
        base = [[s for s in spans if s["kind"] in KINDS] for spans in rows]
        counts = [pa.array([sum(s["kind"] == k for s in spans) for spans in base], pa.int64()) for k in KINDS]
        hashes = pa.array([hashlib.sha256(listed(spans).encode()).hexdigest() for spans in base], pa.string())
        return pa.StructArray.from_arrays([*counts, hashes, pa.array([listed(s) for s in rows], pa.string())], ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    kind = "struct<n_email:bigint,n_ip:bigint,n_card:bigint,n_phone:bigint,base_sha256:string,spans:string>"
    return with_spans(source, disclosing(source), "out", kind=kind, finish=digest).select("doc_id", "out.*")


def merged(spans: list[dict]) -> list[tuple[int, int, str]]:
    """Non-overlapping spans in order; overlapping ones are joined and keep the first one's kind."""
    out: list[list] = []
    for s in sorted(spans, key=lambda s: (s["a"], -s["b"])):
        if out and s["a"] < out[-1][1]:
            out[-1][1] = max(out[-1][1], s["b"])
        else:
            out.append([s["a"], s["b"], s["kind"]])
    return [tuple(x) for x in out]


def sanitise(docs: DataFrame, remove: bool = False) -> DataFrame:
    """``docs`` with every span generalised to its kind in angle brackets (or removed); same columns. Texts without spans stay as they are."""

    def replace(texts: list, spans: list) -> pa.Array:
        out = []
        for text, found in zip(texts, spans):
            if found:
                made, at = [], 0
                for a, b, kind in merged(found):
                    made += [text[at:a], "" if remove else f"<{kind}>"]
                    at = b
                text = "".join([*made, text[at:]])
            out.append(text)
        return pa.array(out, pa.string())

    return with_spans(docs, disclosing(docs), "text", kind="string", finish=replace).select(*[f"`{c}`" for c in docs.columns])
