"""Spelling variants: words one edit apart, by composing the vocabulary's acceptor with a one-edit transducer and the acceptor again.

Two words are near if one inserted, deleted or replaced code point turns one into the other. The leftmost place at which they differ is
their edit place; the longer one (or both) has ``m`` code points, and both agree before the place and after it. So the
composed machine is partitioned by the state that its identity part reaches: a partition is a class ``m``, a range of places, and
the letters before and after the range, which its words share. A word enters class ``m`` for its own length and the next one, first
with the two halves of the places. A partition of more than ``block`` words is cut into the halves of its range, again and again;
with a single place left it holds at most one word per letter and one more. No partition is dropped or capped, and each pair is
accepted in exactly one.

A partition keeps only the letters inside its range. Its words become a minimised acyclic acceptor, built from the sorted words with a
register of states that all partitions of a task share. The composition is taken per state, once: an arc label replaced by another, or
deleted, followed by what the right languages of both targets have in common. Accepted pairs are read off by walking from the
partition's initial state through states with pairs below them.

Defined results: a NULL text has no words, a NULL doc_id counts as empty text, repeated rows count as often as they stand there, an
empty table gives no rows, and other columns play no part. A word of any length is processed, without recursion. Ties between
forms go to the smallest word in code-point order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradevault.llm.columns import bounded_batches, named, stored

LEAST = 7
OCCURS = 2
RATIO = 10
NOISE = 31
BLOCK = 20_000
REGISTER = 400_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NEAR = "word string, n_near long, best_n long, best string"


def vocabulary(docs: DataFrame, least: int = LEAST, occurs: int = OCCURS, noise: int = NOISE) -> DataFrame:
    """(word, n): lower-cased runs of letters of at least ``least`` code points that occur ``occurs`` times or more.

    Where ``noise`` divides the checksum of "doc_id:run", the run loses one code point first (0 turns this off).
    """
    pattern = f"[A-Za-zÀ-ÿ]{{{least},}}"  # a shorter run cannot give a word: a code point is only ever lost
    runs = docs.select(
        F.coalesce(named(docs, "doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(named(docs, "text"), F.lit(pattern), F.lit(0))).alias("run"),
    ).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    if noise:
        h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        at = (F.col("h") % F.length("run")).cast("int")
        lost = F.overlay("run", F.lit(""), at + 1, F.lit(1))
        runs = runs.withColumn("h", h).select(F.when(F.col("h") % noise == 0, lost).otherwise(F.col("run")).alias("run"))
    return runs.where(F.length("run") >= least).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= occurs)


def halves(lo: Column, hi: Column) -> Column:
    """The two halves of a range of places; a single place stays as it is."""
    mid = F.floor((lo + hi + 1) / 2).cast("int")
    return F.when(lo == hi, F.array(F.struct(lo.alias("lo"), hi.alias("hi")))).otherwise(
        F.array(F.struct(lo.alias("lo"), (mid - 1).alias("hi")), F.struct(mid.alias("lo"), hi.alias("hi")))
    )


def keyed(rows: DataFrame) -> DataFrame:
    """Rows (word, n, m, lo, hi) with the key of their partition: class, range, and the letters before and after the range."""
    after = F.col("m") - 1 - F.col("hi")
    suffix = F.substring("word", F.length("word") - after + 1, after)
    return rows.withColumn("key", F.concat_ws(":", "m", "lo", "hi", F.substring("word", F.lit(1), F.col("lo")), suffix))


def partitions(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows (word, n, m, lo, hi, key), every partition of at most ``block`` words or a single place."""
    size = F.length("word")
    rows = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("m"))
    rows = rows.select("word", "n", "m", F.explode(halves(F.lit(0), F.col("m") - 1)).alias("r"))
    done, rows = None, keyed(rows.select("word", "n", "m", "r.lo", "r.hi"))
    while True:
        large = stored(rows.where("lo < hi").groupBy("key").agg(F.count("*").alias("many")).where(F.col("many") > block).select("key"), "large")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, "key", "left_anti")
        done = small if done is None else done.unionByName(small)
        cut = rows.join(large, "key", "left_semi").select("word", "n", "m", F.explode(halves(F.col("lo"), F.col("hi"))).alias("r"))
        rows = keyed(cut.select("word", "n", "m", "r.lo", "r.hi"))


class Acceptor:
    """Minimised acyclic acceptors over one register of states, and the one-edit composition of each state with itself.

    A state is (final, arcs); equal states are one. Arcs lead to states of smaller number, so states can be treated in order.
    """

    def __init__(self) -> None:
        self.register: dict[tuple, int] = {}
        self.states: list[tuple[bool, tuple[tuple[str, int], ...]]] = []
        self.local: list[list[tuple[str, str]]] = []
        self.live: list[bool] = []

    def state(self, final: bool, arcs: list[tuple[str, int]]) -> int:
        key = (final, tuple(arcs))
        at = self.register.get(key)
        if at is None:
            at = self.register[key] = len(self.states)
            self.states.append(key)
            self.local.append(self.edits(key))
            self.live.append(bool(self.local[at]) or any(self.live[t] for _, t in arcs))
        return at

    def add(self, words: list[str]) -> int:
        """The initial state for sorted distinct words."""
        path: list[list] = [[False, []]]
        before = ""
        for word in [*words, ""]:
            same = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                same += 1
            while len(path) > same + 1:
                final, arcs = path.pop()
                path[-1][1].append((before[len(path) - 1], self.state(final, arcs)))
            path += [[False, []] for _ in word[same:]]
            if word:
                path[-1][0] = True
            before = word
        if words and not words[0]:
            path[0][0] = True
        return self.state(*path[0])

    def shared(self, a: int, b: int) -> Iterator[str]:
        """Words that both states accept."""
        todo = [(a, b, "")]
        while todo:
            a, b, read = todo.pop()
            final_a, arcs_a = self.states[a]
            final_b, arcs_b = self.states[b]
            if final_a and final_b:
                yield read
            if a == b:
                todo += [(t, t, read + x) for x, t in arcs_a]
            elif arcs_a and arcs_b:
                others = dict(arcs_b)
                todo += [(t, others[x], read + x) for x, t in arcs_a if x in others]

    def edits(self, key: tuple) -> list[tuple[str, str]]:
        """(longer or equal, other) words that a state accepts and that first differ at their first letter by one edit."""
        final, arcs = key
        out = []
        targets = dict(arcs)
        for i, (x, t) in enumerate(arcs):
            for y, u in arcs[i + 1 :]:
                out += [(x + s, y + s) for s in self.shared(t, u)]
            # x deleted: what follows it must be accepted here as well, and must not start with x, else the edit comes later.
            t_final, t_arcs = self.states[t]
            if t_final and final:
                out.append((x, ""))
            out += [(x + y + s, y + s) for y, u in t_arcs if y != x and y in targets for s in self.shared(u, targets[y])]
        return out

    def pairs(self, start: int) -> Iterator[tuple[str, str, str]]:
        """(letters read alike, longer or equal rest, other rest) of all pairs accepted from an initial state."""
        todo: list[tuple[int, int, str]] = [(start, 0, "")]
        read: list[str] = []
        while todo:
            at, depth, last = todo.pop()
            if not self.live[at]:
                continue
            del read[max(depth - 1, 0) :]
            if depth:
                read.append(last)
            if self.local[at]:
                before = "".join(read)
                for a, b in self.local[at]:
                    yield before, a, b
            todo += [(t, depth + 1, x) for x, t in self.states[at][1]]


def accept(machine: Acceptor, words: list[str], counts: list[int], m: int, lo: int, hi: int) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, largest count of them, that word) of the words of one partition that have near words in it."""
    after = m - 1 - hi
    width = hi - lo + 1
    inner = {w[lo : len(w) - after]: k for k, w in enumerate(words)}
    next_sign = words[0][len(words[0]) - after] if after else ""
    found: dict[int, list] = {}
    for read, a, b in machine.pairs(machine.add(sorted(inner))):
        if len(read) + len(a) != width or (not b and a == next_sign):
            continue  # a pair of the class below, or one whose edit place lies behind this range
        x, y = inner[read + a], inner[read + b]
        for k, j in ((x, y), (y, x)):
            rank = (-counts[j], words[j])
            mine = found.get(k)
            if mine is None:
                found[k] = [1, rank]
            else:
                mine[0] += 1
                if rank < mine[1]:
                    mine[1] = rank
    for k, (many, (count, best)) in found.items():
        yield words[k], many, -count, best


def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of all partitions of a task, whose rows come sorted by key; a register is dropped when it grows large."""
    machine = Acceptor()
    rest: pa.Table | None = None

    def work(rows: pa.Table) -> pa.RecordBatch:
        nonlocal machine
        keys = rows["key"].combine_chunks()
        edge = np.flatnonzero(np.concatenate([[True], pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False), [True]]))
        several = np.diff(edge) > 1
        use = rows.filter(pa.array(np.repeat(several, np.diff(edge))))
        words, counts, m, lo, hi = (use[c].to_pylist() for c in ("word", "n", "m", "lo", "hi"))
        out, at = [], 0
        for size in np.diff(edge)[several].tolist():
            if len(machine.states) > REGISTER:
                machine = Acceptor()
            out += accept(machine, words[at : at + size], counts[at : at + size], m[at], lo[at], hi[at])
            at += size
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, kinds)], ["word", "n_near", "best_n", "best"])

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows])
        if not len(rows):
            continue
        last = pc.index(rows["key"], rows["key"][len(rows) - 1]).as_py()
        rest = rows.slice(last)
        if last:
            yield work(rows.slice(0, last))
    if rest is not None and len(rest):
        yield work(rest)


def near(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best_n, best) of the words of (word, n) that have near words; best has the largest n."""
    bounded_batches(words.sparkSession)
    rows = partitions(words, block).select("key", "word", "n", "m", "lo", "hi")
    found = rows.repartition("key").sortWithinPartitions("key").mapInArrow(compose, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top")).select("word", "n_near", (-F.col("top.less")).alias("best_n"), "top.best")


def forms(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of (word, n).

    A form has at least ``ratio`` times its word's count, so a chain of forms is no longer than the logarithm of the largest
    count; its end is found by doubling the step, that logarithm's logarithm times.
    """
    words = stored(words.select("word", "n"), "words")
    joined = words.join(near(words, block), "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    told = stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "near")
    largest = words.agg(F.max("n")).first()[0] or 1
    steps, reach = 0, ratio
    while reach <= largest:
        steps, reach = steps + 1, reach * ratio
    jump = told.where("form IS NOT NULL").select(F.col("word").alias("w"), F.col("form").alias("r"))
    covered = 1
    while covered < steps:
        onward = jump.select(F.col("w").alias("via"), F.col("r").alias("end"))
        jump = stored(jump.join(onward, jump["r"] == onward["via"], "left").select("w", F.coalesce("end", "r").alias("r")), "roots")
        covered *= 2
    return told.join(jump, told["word"] == jump["w"], "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("r", "word").alias("root"))


def report(docs: DataFrame) -> DataFrame:
    return forms(vocabulary(docs)).select("word", "form", "root", "n", "n_near", "form_n")
