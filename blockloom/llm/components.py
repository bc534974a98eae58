"""Connected components of a graph given as edges, and candidate pairs from buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import keep, release


def _roots(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``: every node points at its least neighbour, unless it
    is less itself; pointers are then followed, twice as far each time."""
    ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pointers = keep(ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "pointers")
    while True:
        onward = pointers.select(F.col("node").alias("via"), F.col("root").alias("beyond"))
        moved = keep(
            pointers.join(onward, F.col("root") == F.col("via")).select("node", F.col("beyond").alias("root"), (F.col("beyond") != F.col("root")).alias("moved")), "pointers"
        )
        release(pointers)
        pointers = moved
        if moved.where("moved").isEmpty():
            return moved.drop("moved")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) for all nodes of ``edges`` (a, b).

    Union by contraction: trees of one round become the nodes of the next, until
    no edge joins two of them. Each round at least halves what is left. Only
    joins and aggregations on nodes are used, nothing is collected.
    """
    edges = keep(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    found = None
    while True:
        roots = keep(_roots(edges), "roots")
        if found is None:
            found = roots.withColumnRenamed("root", "component")
        else:
            nearer = roots.select(F.col("node").alias("of"), "root")
            step = keep(found.join(nearer, F.col("component") == F.col("of"), "left").select("node", F.coalesce("root", "component").alias("component")), "components")
            release(found)
            found = step
        left, right = roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        rest = keep(
            edges.join(left, "a").join(right, "b").where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges"
        )
        release(edges)
        edges = rest
        if edges.isEmpty():
            return found


def first_pairs(entries: DataFrame, order: list[str], condition: Column | None = None) -> DataFrame:
    """Pairs (a, b) of every bucket's first node with its others. ``entries`` has
    ``key``, ``node`` and what ``order`` and ``condition`` name; the condition
    reads the first node's columns by the prefix ``p_``."""
    others = [c for c in entries.columns if c != "key"]
    first = entries.groupBy("key").agg(F.min_by(F.struct(*others), F.struct(*order, "node")).alias("p"), F.count("*").alias("n")).where("n > 1")
    paired = entries.join(first.select("key", *(F.col(f"p.{c}").alias(f"p_{c}") for c in others)), "key").where("node <> p_node")
    if condition is not None:
        paired = paired.where(condition)
    return paired.select(F.least("node", "p_node").alias("a"), F.greatest("node", "p_node").alias("b")).distinct()


def remaining_pairs(entries: DataFrame, found: DataFrame, condition: Column | None = None, more: DataFrame | None = None) -> DataFrame:
    """Pairs of nodes that share a bucket and are not yet in one component.
    Buckets within one component drop out before anything is joined. To the
    entries that are left come the columns of ``more``, a row a ``node``, so that
    the condition holds pairs back inside the join, before they are rows."""
    marked = entries.join(found.select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = marked.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    left = marked.join(mixed, "key")
    if more is not None:
        left = left.join(more, "node")
    right = left.select(F.col("key").alias("p_key"), *(F.col(c).alias(f"p_{c}") for c in left.columns if c != "key"))
    on = (F.col("key") == F.col("p_key")) & (F.col("component") != F.col("p_component")) & (F.col("node") < F.col("p_node"))
    if condition is not None:
        on = on & condition
    return left.join(right, on).select(F.col("node").alias("a"), F.col("p_node").alias("b")).distinct()
