"""Ownership and desk hierarchies, walked level by level with a checkpoint per level until no path can grow."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradevault.session import cut


def ownership_chains(edges: DataFrame) -> DataFrame:
    """Every simple ownership path from a party up to an owner that nobody owns.

    ``edges``: owner, owned, pct (fraction as double). The share multiplies along the path; a path never visits a party
    twice, so cycles end and so does the walk. Each level is one equi join on the frontier. ``ownership_totals`` folds the paths per
    party and owner; ``unresolved_parties`` lists those without an owner outside of cycles.
    """
    up = edges.select(F.col("owned").alias("__at"), F.col("owner").alias("__to"), F.col("pct").alias("__pct"))
    owned = edges.select(F.col("owned").alias("owner")).distinct()
    frontier = cut(
        edges.select(
            F.col("owned").alias("party"), "owner", F.col("pct").alias("effective_pct"), F.lit(1).alias("chain_depth"),
            F.array("owned", "owner").alias("path"),
        ).filter("owner <> party")
    )
    done = []
    while True:
        done.append(frontier.join(owned, "owner", "left_anti").select(*frontier.columns))
        step = (
            frontier.join(up, F.col("owner") == F.col("__at"))
            .filter(~F.expr("array_contains(path, __to)"))
            .select(
                "party", F.col("__to").alias("owner"), (F.col("effective_pct") * F.col("__pct")).alias("effective_pct"),
                (F.col("chain_depth") + 1).alias("chain_depth"), F.array_append("path", F.col("__to")).alias("path"),
            )
        )
        frontier = cut(step)
        if frontier.isEmpty():
            break
    return reduce(DataFrame.unionByName, done).withColumnRenamed("owner", "ultimate_owner")


def ownership_totals(chains: DataFrame) -> DataFrame:
    """Share, shortest chain and number of chains per party and ultimate owner."""
    return chains.groupBy("party", "ultimate_owner").agg(
        F.sum("effective_pct").alias("effective_pct"), F.min("chain_depth").alias("chain_depth"), F.count("*").alias("chains")
    )


def unresolved_parties(edges: DataFrame, chains: DataFrame) -> DataFrame:
    """Owned parties without a chain: all their owners sit in a cycle."""
    owned = edges.filter("owner <> owned").select(F.col("owned").alias("party")).distinct()
    return owned.join(chains.select("party").distinct(), "party", "left_anti")


def cyclic_core(edges: DataFrame) -> DataFrame:
    """Edges on cycles or on walks between cycles: parties that nobody owns, or that own nobody, are peeled off until none is left."""
    core = cut(edges)
    many = core.count()
    while many:
        owned, owners = core.select(F.col("owned").alias("owner")).distinct(), core.select(F.col("owner").alias("owned")).distinct()
        core = cut(core.join(owned, "owner", "left_semi").join(owners, "owned", "left_semi").select(*edges.columns))
        left = core.count()
        if left == many:
            break
        many = left
    return core


def product(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sparse matrix product of (i, j, w, d): weights multiply and add up, distances add and the shortest stays."""
    right = b.select(F.col("i").alias("__i"), F.col("j").alias("__j"), F.col("w").alias("__w"), F.col("d").alias("__d"))
    rows = a.join(right, F.col("j") == F.col("__i")).select("i", F.col("__j").alias("j"), (F.col("w") * F.col("__w")).alias("w"), (F.col("d") + F.col("__d")).alias("d"))
    return rows.groupBy("i", "j").agg(F.sum("w").alias("w"), F.min("d").alias("d"))


def closure(steps: DataFrame, tolerance: float, rounds: int = 60) -> DataFrame:
    """Sum of all powers of a matrix (i, j, w, d), the zeroth included: walks of up to 2**r edges after r rounds.

    Ends when no walk of 2**r edges carries more than ``tolerance``. A matrix whose powers grow has no such sum: that stops the job.
    """
    ends = steps.select(F.col("i").alias("n")).union(steps.select(F.col("j").alias("n"))).distinct()
    power = cut(steps)
    total = cut(ends.select(F.col("n").alias("i"), F.col("n").alias("j"), F.lit(1.0).alias("w"), F.lit(0).alias("d")))
    for _ in range(rounds):
        top = power.agg(F.max("w")).first()[0]
        if top is None or top < tolerance:
            return total
        if top > 1e6:
            break
        both = total.unionByName(product(power, total))
        total = cut(both.groupBy("i", "j").agg(F.sum("w").alias("w"), F.min("d").alias("d")))
        power = cut(product(power, power).where(F.col("w") > tolerance * tolerance))
    raise ValueError("ownership around a cycle does not converge: its parties are owned by more than 100 percent")


#: Up to so many edges the core is closed at once. Above, shares are walked first, and every STRETCH levels it is seen whether they shrink.
SMALL, STRETCH = 1_000, 32
PAIR = ["party", "ultimate_owner"]


def effective_ownership(edges: DataFrame, tolerance: float = 1e-16) -> DataFrame:
    """(party, ultimate_owner, effective_pct, chain_depth): what each party's ultimate owners hold of it over all walks.

    ``edges``: owner, owned, pct (fraction); repeated edges add up, rows with a NULL party are left out. An ultimate owner is one that
    nobody owns. The share is the fixed point x = W x: shares flow down edge by edge, folded per (party, owner) at each
    level, so walks that meet are one row however many there are. Around a cycle they shrink with every turn, and are walked until no more
    than ``tolerance`` is left (``walked``); where they shrink too slowly, and in small graphs, what is left crosses the cycles in one
    step (``crossed``). A party's own shares are a cycle of one. Cycles that no ultimate owner reaches hold nothing and are
    left out; their parties have no row. ``chain_depth`` is the shortest walk.
    """
    edges = edges.where("owner IS NOT NULL AND owned IS NOT NULL").groupBy("owner", "owned").agg(F.sum(F.col("pct").cast("double")).alias("pct"))
    edges = cut(edges.repartition(int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")), "owner"))
    owned = edges.select(F.col("owned").alias("owner")).distinct()
    tops = edges.select("owner").distinct().join(owned, "owner", "left_anti")
    left = tops.select(F.col("owner").alias("party"), F.col("owner").alias("ultimate_owner"), F.lit(1.0).alias("w"), F.lit(0).alias("d"))
    done = []
    if edges.count() > SMALL:
        done, left = walked(edges, left, tolerance)
    if left is not None:
        done += crossed(edges, left, tolerance)
    total = reduce(DataFrame.unionByName, done).where("d > 0")
    return total.groupBy(*PAIR).agg(F.sum("w").alias("effective_pct"), F.min("d").alias("chain_depth"))


def flow(now: DataFrame, edges: DataFrame) -> DataFrame:
    """Shares one edge further down, folded per (party, ultimate owner)."""
    rows = now.join(edges, F.col("party") == F.col("owner")).select(
        F.col("owned").alias("party"), "ultimate_owner", (F.col("w") * F.col("pct")).alias("w"), (F.col("d") + 1).alias("d")
    )
    return rows.groupBy(*PAIR).agg(F.sum("w").alias("w"), F.min("d").alias("d"))


def walked(edges: DataFrame, now: DataFrame, tolerance: float) -> tuple[list[DataFrame], DataFrame | None]:
    """The shares of each level, and those that are left where they do not shrink (None if nothing is left).

    A share of at most ``tolerance`` is dropped, unless it is the first of its pair: each pair that a walk reaches has a row, however
    little is held. A level that brings no new pair is followed by none that does.
    """
    now = cut(now)
    seen, done, before, growing, level = now.select(*PAIR), [], 1.0, True, 0
    while True:
        step, big = flow(now, edges), F.abs("w") > tolerance
        if growing:
            step = step.join(seen.withColumn("known", F.lit(True)), PAIR, "left").withColumn("new", F.col("known").isNull()).drop("known")
        else:
            step = step.withColumn("new", F.lit(False))
        now = cut(step.where(big | F.col("new")))
        many, top, new = now.agg(F.count("*"), F.max(F.abs("w")), F.count_if("new")).first()
        if not many:
            return done, None
        growing, level = new > 0, level + 1
        if growing:
            seen = seen.unionByName(now.where("new").select(*PAIR))
        now = now.drop("new")
        if level % STRETCH == 0:
            if top is not None and not top <= before / 1000:
                return done, now
            before = top or 0.0
        done.append(now)


def crossed(edges: DataFrame, now: DataFrame, tolerance: float) -> list[DataFrame]:
    """The given shares, and all that flows from them, level by level. Parties on cycles, or between cycles, form the core: there all
    walks are summed by repeated squaring of its sparse matrix, and a share that enters the core crosses it in one step."""
    edges = reached(edges, now)
    core = cyclic_core(edges)
    walks = closure(core.select(F.col("owned").alias("i"), F.col("owner").alias("j"), F.col("pct").alias("w"), F.lit(1).alias("d")), tolerance)
    members = core.select(F.col("owned").alias("party")).distinct()
    outer = edges.join(core.select("owner", "owned"), ["owner", "owned"], "left_anti")
    done = []
    while True:
        now = cut(now)
        entering = now.join(members, "party", "left_semi").select(F.col("party").alias("i"), F.col("ultimate_owner").alias("j"), "w", "d")
        over = product(walks, entering).select(F.col("i").alias("party"), F.col("j").alias("ultimate_owner"), "w", "d")
        now = cut(now.join(members, "party", "left_anti").select(*PAIR, "w", "d").unionByName(over))
        done.append(now)
        if now.isEmpty():
            return done
        now = flow(now, outer)


def reached(edges: DataFrame, start: DataFrame) -> DataFrame:
    """Edges whose owner the given parties reach; without this, closed cycles of full ownership would never converge."""
    seen = cut(start.select("party").distinct())
    new = seen
    while True:
        step = new.join(edges, F.col("party") == F.col("owner")).select(F.col("owned").alias("party")).distinct()
        new = cut(step.join(seen, "party", "left_anti"))
        if new.isEmpty():
            return cut(edges.join(seen, edges["owner"] == seen["party"], "left_semi"))
        seen = cut(seen.unionByName(new))


def hierarchy_paths(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """Slash-separated path from the root for every node reachable from a root (parent NULL).

    A node under several parents has one path per parent; what is reached from a root holds no cycle only if no path repeats
    a node, so a path stops where it would.
    """
    level = cut(
        nodes.filter(F.col(parent).isNull()).select(
            F.col(node), F.lit(1).alias("depth"), F.col(node).cast("string").alias("path"), F.array(F.col(node)).alias("__seen")
        )
    )
    kids = nodes.filter(F.col(parent).isNotNull()).select(F.col(node).alias("__kid"), F.col(parent).alias("__up"))
    levels = []
    while True:
        levels.append(level.drop("__seen"))
        level = cut(
            level.join(kids, F.col(node) == F.col("__up")).filter(~F.expr("array_contains(__seen, __kid)")).select(
                F.col("__kid").alias(node), (F.col("depth") + 1).alias("depth"),
                F.concat_ws("/", "path", F.col("__kid").cast("string")).alias("path"), F.array_append("__seen", F.col("__kid")).alias("__seen"),
            )
        )
        if level.isEmpty():
            return reduce(DataFrame.unionByName, levels)
