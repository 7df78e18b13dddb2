"""Mixing sources to target weights by iterative proportional fitting (raking).

Documents fall into cells (source, lang, topic); a cell's weight is its number of words. The weights are scaled in turn so that the
sums per source, per language and per topic meet their targets, until all do or ``SWEEPS`` have run: targets that empty cells make
infeasible (each source in one language, say) are never all met. A document's rate is its cell's raked share over its cell's share
of the words; documents are kept with probability min(1, factor * rate), where the factor makes the expected words kept ``keep`` of
all, so that a category whose documents are all kept stays under its target. ``shortfall`` lists the target, raked and expected
share of each category, and a warning gives the largest gap that raking and clipping leave wherever documents are sampled. The
draw is a hash of doc_id and text, so it is the same on every run and retry.

The topic is the group of hashed words that is most over-represented in a document, compared with all documents (``TOPICS`` groups;
ties go to the smaller group). Targets are the observed shares to the power ``temper``, which lifts small categories, unless
given as {category: share}; categories that a given target leaves out get weight 0, and targets of absent categories are shared out.

Cells are counted with combined aggregates. Up to ``LOCAL_CELLS`` cells (checked) are raked on the driver; beyond, the same steps run as
Spark jobs over the cell table, each written to the shared checkpoint folder. Probabilities come back by a join on the cell, whose large
side adaptive execution splits, so a source that owns a third of the documents is no hot task.

NULL sources and languages are categories of their own. A NULL or empty text has 0 words, topic NULL and rate 1. Rows with equal
doc_id and text are kept or dropped together. Without any words every rate is 1.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradevault.llm.columns import added, fresh, named, stored
from tradevault.llm.textscan import ALNUM, Words, blocks
from tradevault.session import cut

DIMENSIONS = ("source", "lang", "topic")
TOPICS = 8
TEMPER = 0.7
KEEP = 0.5
LOCAL_CELLS = 200_000
SWEEPS = 200
TOLERANCE = 1e-6
PROFILE = "struct<tokens:bigint,groups:array<bigint>>"

Targets = dict[str, dict]


class UnmetTargets(UserWarning):
    """Targets that raking or the sample does not meet."""


def profile(texts: pa.Array) -> pa.Array:
    """Words of each text, in all and per hashed group."""
    counts = []
    for lo, hi, data, offs in blocks(texts):
        w = Words(data, offs, ALNUM, lower=True)
        owner = np.repeat(np.arange(hi - lo), w.counts)
        group = (w.hashes() % np.uint64(TOPICS)).astype(np.int64)
        counts.append(np.bincount(owner * TOPICS + group, minlength=(hi - lo) * TOPICS).reshape(-1, TOPICS))
    table = np.concatenate(counts) if counts else np.zeros((0, TOPICS), np.int64)
    groups = pa.ListArray.from_arrays(pa.array(np.arange(0, table.size + 1, TOPICS), pa.int32()), pa.array(table.ravel(), pa.int64()))
    return pa.StructArray.from_arrays([pa.array(table.sum(axis=1), pa.int64()), groups], ["tokens", "groups"])


def shares(rows: DataFrame, groups: str) -> list[int]:
    """Words of all documents per group."""
    return list(rows.agg(*[F.coalesce(F.sum(F.element_at(groups, i + 1)), F.lit(0)) for i in range(TOPICS)]).first())


def topic_of(groups: Column, total: list[int]) -> Column:
    """The most over-represented group; NULL without words."""
    rate = [F.element_at(groups, i + 1) / float(n) if n else F.lit(0.0) for i, n in enumerate(total)]
    best = F.greatest(*rate)
    which = F.lit(None).cast("int")
    for i in reversed(range(TOPICS)):
        which = F.when(rate[i] == best, F.lit(i)).otherwise(which)
    return F.when(best > 0, which)


def tempered(total: dict, temper: float) -> dict:
    raw = {c: (n**temper if n else 0.0) for c, n in total.items()}
    whole = sum(raw[c] for c in sorted(raw, key=repr))
    return {c: x / whole for c, x in raw.items()} if whole else raw


def fitted(given: dict | None, total: dict, temper: float) -> dict:
    """Target share of each present category; given ones are rescaled to the categories that have words."""
    if given is None:
        return tempered(total, temper)
    there = {c: float(given.get(c, 0.0)) if n else 0.0 for c, n in total.items()}
    whole = sum(there[c] for c in sorted(there, key=repr))
    if whole <= 0:
        raise ValueError("no category of a given target has documents")
    return {c: x / whole for c, x in there.items()}


def rake_local(cells: list[tuple], targets: Targets | None, temper: float) -> tuple[np.ndarray, int]:
    """Raked weight of each (source, lang, topic, tokens), summing to 1; and the sweeps taken."""
    tokens = np.array([c[3] for c in cells], float)
    weight = tokens / tokens.sum()
    codes, goals = [], []
    for d, name in enumerate(DIMENSIONS):
        values = sorted({c[d] for c in cells}, key=repr)
        code = {v: i for i, v in enumerate(values)}
        index = np.array([code[c[d]] for c in cells])
        total = dict(zip(values, np.bincount(index, tokens, len(values)).tolist()))
        goal = fitted((targets or {}).get(name), total, temper)
        codes.append(index)
        goals.append(np.array([goal[v] for v in values]))
    for sweep in range(SWEEPS):
        worst = 0.0
        for index, goal in zip(codes, goals):
            now = np.bincount(index, weight, len(goal))
            worst = max(worst, float(np.abs(now - goal).max()))
            weight = weight * np.divide(goal, now, out=np.zeros_like(goal), where=now > 0)[index]
        if worst < TOLERANCE:
            break
    return weight, sweep + 1


def off(now: DataFrame, name: str, goal: DataFrame) -> DataFrame:
    """Per category of a dimension: the factor that meets its goal, and the gap to it."""
    sums = now.groupBy(F.col(name).alias("of")).agg(F.sum("weight").alias("sum"))
    factor = F.when(F.col("sum") > 0, F.col("goal") / F.col("sum")).otherwise(0.0)
    return sums.join(goal, F.col("of").eqNullSafe(F.col("category"))).select("of", factor.alias("factor"), F.abs(F.col("sum") - F.col("goal")).alias("gap"))


def rake_spark(cells: DataFrame, targets: Targets | None, temper: float, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` with their raked weight, as Spark jobs over the cell table."""
    whole = cells.agg(F.sum("tokens")).first()[0]
    now = cells.withColumn("weight", F.col("tokens") / float(whole))
    goals = {}
    for name in DIMENSIONS:
        total = cells.groupBy(name).agg(F.sum("tokens").cast("double").alias("n"))
        given = (targets or {}).get(name)
        if given is None:
            total = total.withColumn("raw", F.when(F.col("n") > 0, F.pow("n", F.lit(temper))).otherwise(0.0))
        else:
            listed = cells.sparkSession.createDataFrame([(c, float(x)) for c, x in given.items()], f"category {cells.schema[name].dataType.simpleString()}, raw double")
            total = total.join(listed, F.col(name).eqNullSafe(F.col("category")), "left").select(name, F.when(F.col("n") > 0, F.coalesce("raw", F.lit(0.0))).otherwise(0.0).alias("raw"))
        sum_raw = total.agg(F.sum("raw")).first()[0]
        if not sum_raw:
            raise ValueError("no category of a given target has documents")
        goals[name] = cut(total.select(F.col(name).alias("category"), (F.col("raw") / sum_raw).alias("goal")))
    for _ in range(SWEEPS):
        for name in DIMENSIONS:
            now = cut(now.join(off(now, name, goals[name]).select("of", "factor"), F.col(name).eqNullSafe(F.col("of"))).select(*DIMENSIONS, "tokens", (F.col("weight") * F.col("factor")).alias("weight")))
        # The last dimension was just met; the others tell how far the sweep is off.
        if all(off(now, name, goals[name]).agg(F.max("gap")).first()[0] < tolerance for name in DIMENSIONS[:-1]):
            break
    return now


def factor_local(tokens: np.ndarray, rate: np.ndarray, keep: float) -> float:
    """The factor for which sum(tokens * min(1, factor * rate)) is ``keep`` of the tokens; infinite if nothing less will do."""
    ok = (rate > 0) & (tokens > 0)
    tokens_ok, rate_ok = tokens[ok], rate[ok]
    wanted = keep * tokens.sum()
    if tokens_ok.sum() <= wanted:
        return math.inf
    order = np.argsort(-rate_ok, kind="stable")
    t, r = tokens_ok[order], rate_ok[order]
    # With the first j cells at probability 1, the others share what is wanted beyond them.
    full = np.concatenate([[0.0], np.cumsum(t)])[:-1]
    rest = np.cumsum((t * r)[::-1])[::-1]
    factor = (wanted - full) / rest
    good = np.flatnonzero((factor * r <= 1 + 1e-12) & (factor >= 0))
    return float(factor[good[0]])


def factor_spark(cells: DataFrame, keep: float) -> float:
    """The same as Spark jobs: the words kept are concave and piecewise linear in the factor, so tangents reach it from below in finitely many steps."""
    ok = (F.col("rate") > 0) & (F.col("tokens") > 0)
    total, possible, linear = cells.agg(F.sum("tokens"), F.sum(F.when(ok, F.col("tokens"))), F.sum(F.when(ok, F.col("tokens") * F.col("rate")))).first()
    if not possible or possible <= keep * total:
        return math.inf
    wanted, full, factor = keep * total, 0, 0.0
    while True:
        # With the cells that the last factor fills at probability 1, the others share what is wanted beyond them.
        factor = max(factor, (wanted - full) / linear)
        filled = F.lit(factor) * F.col("rate") >= 1
        now, rest = cells.where(ok).agg(F.coalesce(F.sum(F.when(filled, F.col("tokens"))), F.lit(0)), F.sum(F.when(~filled, F.col("tokens") * F.col("rate")))).first()
        if now == full or not rest:
            return factor
        full, linear = now, rest


def expected(cells: DataFrame, factor: float) -> DataFrame:
    """``cells`` (tokens, rate) with the raked words ``raked`` and the words ``kept`` that are expected after clipping."""
    chance = F.when(F.col("rate") > 0, F.lit(1.0)).otherwise(0.0) if math.isinf(factor) else F.least(F.lit(1.0), F.lit(factor) * F.col("rate"))
    return cells.withColumn("raked", F.col("tokens") * F.col("rate")).withColumn("kept", F.col("tokens") * chance)


def category_shares(cells: DataFrame, factor: float, targets: Targets | None, temper: float) -> DataFrame:
    """(dimension, category, target, raked, expected) shares of each category of ``cells`` (source, lang, topic, tokens, rate)."""
    each = expected(cells, factor)
    out = None
    for name in DIMENSIONS:
        given = (targets or {}).get(name)
        by = each.groupBy(name).agg(*[F.sum(c).alias(c) for c in ("tokens", "raked", "kept")])
        if given is None:
            by = by.withColumn("raw", F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(temper))).otherwise(0.0))
        else:
            listed = cells.sparkSession.createDataFrame([(c, float(x)) for c, x in given.items()], f"of {cells.schema[name].dataType.simpleString()}, raw double")
            by = by.join(F.broadcast(listed), F.col(name).eqNullSafe(F.col("of")), "left").withColumn("raw", F.when(F.col("tokens") > 0, F.coalesce("raw", F.lit(0.0))).otherwise(0.0)).drop("of")
        sums = by.agg(*[F.sum(c).alias(f"all_{c}") for c in ("raw", "raked", "kept")])
        part = [F.try_divide(F.col(c), F.col(f"all_{c}")).alias(n) for c, n in (("raw", "target"), ("raked", "raked"), ("kept", "expected"))]
        got = by.crossJoin(F.broadcast(sums)).select(F.lit(name).alias("dimension"), F.col(name).cast("string").alias("category"), *part)
        out = got if out is None else out.unionByName(got)
    return out


def shortfall(docs: DataFrame, targets: Targets | None = None, temper: float = TEMPER, keep: float = KEEP, local_cells: int = LOCAL_CELLS) -> DataFrame:
    """Per category its target share, the share that raking reached, and the share expected in the sample."""
    rows, _ = profiled(docs)
    cells, factor = rates(rows, targets, temper, keep, local_cells)
    if "tokens" not in cells.columns:
        raise ValueError("no words")
    return category_shares(cells, factor, targets, temper)


def warned(cells: DataFrame, factor: float, targets: Targets | None, temper: float) -> None:
    """Warn of the largest gaps between targets and what raking and the sample reach, if they exceed the tolerance."""
    if "tokens" not in cells.columns:
        return
    gap = lambda c: F.max(F.abs(F.col(c) - F.col("target")))
    raked, sampled = category_shares(cells, factor, targets, temper).agg(gap("raked"), gap("expected")).first()
    # A sweep meets its last dimension only after the gaps were taken, hence ten times the tolerance.
    if max(raked or 0.0, sampled or 0.0) > 10 * TOLERANCE:
        warnings.warn(f"targets are missed by up to {raked:.2g} of the words after raking and {sampled:.2g} in the sample; see mixing.shortfall", UnmetTargets, stacklevel=3)


def rates(rows: DataFrame, targets: Targets | None = None, temper: float = TEMPER, keep: float = KEEP, local_cells: int = LOCAL_CELLS) -> tuple[DataFrame, float]:
    """(source, lang, topic, tokens, rate) of all cells of ``rows`` (with ``tokens``) that have words, and the factor; no tokens column without words."""
    cells = stored(rows.where("tokens > 0").groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    kind = ", ".join(f"{name} {cells.schema[name].dataType.simpleString()}" for name in DIMENSIONS)
    n = cells.count()
    if n == 0:
        return cells.select(*DIMENSIONS, F.lit(1.0).alias("rate")), keep
    if n <= local_cells:
        got = sorted((tuple(r) for r in cells.select(*DIMENSIONS, "tokens").collect()), key=repr)
        tokens = np.array([c[3] for c in got], float)
        rate = rake_local(got, targets, temper)[0] * tokens.sum() / tokens
        made = [(*c, float(x)) for c, x in zip(got, rate)]
        return cells.sparkSession.createDataFrame(made, f"{kind}, tokens long, rate double"), factor_local(tokens, rate, keep)
    raked = rake_spark(cells, targets, temper)
    whole = raked.agg(F.sum("tokens"), F.sum("weight")).first()
    raked = cut(raked.withColumn("rate", F.col("weight") / whole[1] / (F.col("tokens") / float(whole[0]))))
    return raked.select(*DIMENSIONS, "tokens", "rate"), factor_spark(raked, keep)


def probability(rows: DataFrame, keys: list[str], cells: DataFrame, factor: float, into: str) -> DataFrame:
    """``rows`` with the probability of being kept in column ``into``; ``keys`` name their source, lang and topic."""
    names = [fresh(rows, f"of_{c}") for c in (*DIMENSIONS, "rate")]
    other = cells.select(*[F.col(c).alias(n) for c, n in zip((*DIMENSIONS, "rate"), names)])
    same = [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    rate = F.coalesce(names[3], F.lit(1.0))
    chance = F.when(rate > 0, F.lit(1.0)).otherwise(0.0) if math.isinf(factor) else F.least(F.lit(1.0), F.lit(factor) * rate)
    return rows.join(other, same[0] & same[1] & same[2], "left").withColumn(into, chance).drop(*names)


def draw(doc_id: str, text_hash: str) -> Column:
    """A number from 0 to 1 that depends on the row alone."""
    return F.pmod(F.xxhash64(F.lit(11), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col(text_hash)), F.lit(1 << 52)) / float(1 << 52)


def profiled(docs: DataFrame) -> tuple[DataFrame, list[int]]:
    """(doc_id, source, lang, text_hash, tokens, topic) of all documents, without texts; and the group counts behind topics."""
    rows = docs.select(*[named(docs, c).alias(c) for c in ("doc_id", "source", "lang", "text")])
    made = added(rows, "p", profile, PROFILE, "text").select("doc_id", "source", "lang", F.xxhash64("text").alias("text_hash"), "p.tokens", "p.groups")
    slim = stored(made, "mix-profile")
    total = shares(slim, "groups")
    return slim.withColumn("topic", topic_of(F.col("groups"), total)).drop("groups"), total


def report(docs: DataFrame, targets: Targets | None = None, temper: float = TEMPER, keep: float = KEEP, local_cells: int = LOCAL_CELLS) -> DataFrame:
    """Per document its cell, words, probability and whether it is kept."""
    rows, _ = profiled(docs)
    cells, factor = rates(rows, targets, temper, keep, local_cells)
    warned(cells, factor, targets, temper)
    out = probability(rows, list(DIMENSIONS), cells, factor, "probability")
    return out.select("doc_id", "source", "lang", "topic", "tokens", "probability", (draw("doc_id", "text_hash") < F.col("probability")).alias("kept"))


def sample(docs: DataFrame, targets: Targets | None = None, temper: float = TEMPER, keep: float = KEEP, local_cells: int = LOCAL_CELLS) -> DataFrame:
    """The documents kept, with the same columns. Texts are never shuffled: the cell is computed again beside the text."""
    rows, total = profiled(docs)
    cells, factor = rates(rows, targets, temper, keep, local_cells)
    warned(cells, factor, targets, temper)
    made, topic, text_hash, chance = (fresh(docs, c) for c in ("profile", "topic_of", "text_hash", "chance"))
    marked = added(docs, made, profile, PROFILE, "text").withColumn(text_hash, F.xxhash64("text")).withColumn(topic, topic_of(F.col(f"{made}.groups"), total))
    out = probability(marked, ["source", "lang", topic], cells, factor, chance)
    return out.where(draw("doc_id", text_hash) < F.col(chance)).select(*[f"`{c}`" for c in docs.columns])
