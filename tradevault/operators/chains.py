"""Ends of pointer chains (a correction of a correction, a replaced order, a renamed code), by path doubling.

Every node points to at most one other. A round replaces each pointer by the pointer of the node it leads to, so after r rounds it
has skipped 2**r nodes: a chain of a million links takes 20 rounds. A round is one equi join of the open nodes with the pointers, each
of which is unique, so a node that very many others point to is a skewed many-to-one join that adaptive execution splits.
Nodes whose chain has ended are written once and leave the work.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradevault.session import cut

COLUMNS = ["node", "at", "steps", "low"]


def doubled(open_nodes: DataFrame, pointers: DataFrame) -> DataFrame:
    """Open nodes with the pointer, the number of links and the smallest node of the node they led to added to their own."""
    onward = pointers.select(F.col("node").alias("__via"), F.col("at").alias("__at"), F.col("steps").alias("__steps"), F.col("low").alias("__low"), F.col("ended").alias("__ended"))
    return open_nodes.join(onward, F.col("at") == F.col("__via")).select(
        "node", F.col("__at").alias("at"), (F.col("steps") + F.col("__steps")).alias("steps"), F.least("low", "__low").alias("low"), F.col("__ended").alias("ended")
    )


def chain_roots(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, root, depth, cyclic) of every node that points to another.

    ``root`` is the end of the chain, also if no row describes it; ``depth`` is the number of links to it. Nodes on a cycle, or on
    a chain that leads into one, have no end: they are ``cyclic``, their root is the smallest node of the cycle and their depth is
    NULL. Rows with a NULL node or parent are left out; a node listed with several parents points to the smallest of them.

    Where some open chain ends at all, the open ones of 2**r + 1 links end in the next round. So a round in which no chain ends
    proves that all open nodes are cyclic.
    """
    links = nodes.select(F.col(node).alias("node"), F.col(parent).alias("at")).where("node IS NOT NULL AND at IS NOT NULL").groupBy("node").agg(F.min("at").alias("at"))
    first = links.select(F.col("node").alias("__link"))
    start = links.join(first, F.col("at") == F.col("__link"), "left").select(
        "node", "at", F.lit(1).cast("long").alias("steps"), F.col("node").alias("low"), F.col("__link").isNull().alias("ended")
    )
    start = cut(start)
    closed, open_nodes, reach = [start.where("ended")], start.where("not ended"), 1
    many = open_nodes.count()
    while many:
        moved = cut(doubled(open_nodes, reduce(DataFrame.unionByName, [*closed, open_nodes])))
        reach *= 2
        left = moved.where("not ended").count()
        closed.append(moved.where("ended"))
        open_nodes = moved.where("not ended")
        if left == many:
            break
        many = left
    while many and reach < many:  # the smallest node of a cycle is known once the walk is as long as the cycle
        open_nodes = cut(doubled(open_nodes, open_nodes))
        reach *= 2
    ends = reduce(DataFrame.unionByName, closed).select("node", F.col("at").alias("root"), F.col("steps").alias("depth"), F.lit(False).alias("cyclic"))
    if not many:
        return ends
    on_cycle = open_nodes.select(F.col("node").alias("__on"), F.col("low").alias("root"))
    cycles = open_nodes.join(on_cycle, F.col("at") == F.col("__on")).select("node", "root", F.lit(None).cast("long").alias("depth"), F.lit(True).alias("cyclic"))
    return ends.unionByName(cycles)
