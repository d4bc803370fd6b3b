"""Connected components of a table of links, by contraction.

In each round every node points to its smallest neighbour, pointers are followed to their ends
by doubling, and the links are carried over to the ends. Links inside a component that has been
found disappear, so the tables shrink from round to round: a chain in order is done in one, and
any graph in about as many rounds as the logarithm of its nodes. A node with very many
neighbours is a partial minimum and a spread join, never one task.

Every step writes its table and removes the one it replaces.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators.joins import lookup_join
from textmill.sources.storage import cut_lineage, remove


def _ends(pointers: DataFrame) -> DataFrame:
    """(node, to) with every pointer followed to its end, where to = node."""
    while True:
        ahead = pointers.select(F.col("node").alias("to"), F.col("to").alias("next"))
        further = cut_lineage(lookup_join(pointers, ahead, ["to"], ["node"]).select("node", "to", "next"), "pointers")
        remove(pointers)
        moved = further.where("next != to").limit(1).count()
        pointers = further.select("node", F.col("next").alias("to"))
        if not moved:
            return pointers


def components(links: DataFrame) -> DataFrame:
    """(node, root): for each node of the links (a, b), the smallest node of its component.

    Links may go either way, repeat, and join a node to itself; nodes are not null.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = cut_lineage(both.distinct(), "links")
    roots = None
    while True:
        lowest = edges.groupBy("a").agg(F.min("b").alias("b"))
        pointers = _ends(cut_lineage(lowest.select(F.col("a").alias("node"), F.least("a", "b").alias("to")), "pointers"))
        if roots is None:
            merged = pointers.select("node", F.col("to").alias("root"))
        else:
            ahead = pointers.select(F.col("node").alias("root"), F.col("to").alias("further"))
            merged = lookup_join(roots, ahead, ["root"], ["node"], "left").select(
                "node", F.coalesce("further", "root").alias("root")
            )
        merged = cut_lineage(merged, "roots")
        first = lookup_join(edges, pointers.select(F.col("node").alias("a"), F.col("to").alias("__a")), ["a"], ["b"])
        first = first.select(F.col("__a").alias("a"), "b")
        second = lookup_join(first, pointers.select(F.col("node").alias("b"), F.col("to").alias("__b")), ["b"], ["a"])
        left = cut_lineage(second.select("a", F.col("__b").alias("b")).where("a != b").distinct(), "links")
        for old in (edges, pointers, *([roots] if roots is not None else [])):
            remove(old)
        edges, roots = left, merged
        if edges.isEmpty():
            return roots
