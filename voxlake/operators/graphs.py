"""Global labelling of blocks, contraction and paths."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spark import store
from .components import components
from .overlap import dense_rank


def global_components(nodes: DataFrame, edges: DataFrame, *, max_connections: int | None = None) -> DataFrame:
    """(node, global): components of `edges` (u, v) over all `nodes` (node), numbered from 1 by their smallest node.

    With `max_connections`, nodes of more distinct neighbours keep none of their edges.
    """
    if max_connections is not None:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u != v").distinct()
        busy = store(both.groupBy("u").agg(F.count("*").alias("n")).where(F.col("n") > max_connections).select("u"))
        edges = edges.join(busy, "u", "left_anti").join(busy.withColumnRenamed("u", "v"), "v", "left_anti")
    loops = nodes.select(F.col("node").alias("u"), F.col("node").alias("v"))
    roots = store(components(edges.select("u", "v").unionByName(loops)))
    numbers = dense_rank(roots.select("root"), "root", "global")
    return roots.join(numbers, "root").select("node", "global")


def rebase(local_to_one: DataFrame, local_to_two: DataFrame) -> DataFrame:
    """(one, two): where labels of the first global numbering went in the second, by shared (block, local); the first block decides."""
    met = local_to_one.join(local_to_two, ["block", "local"])
    return met.groupBy("one").agg(F.min_by("two", F.struct("block", "local")).alias("two"))


def contract(nodes: DataFrame, edges: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, size) and edges (u, v, size, weight, preserve, false_edge) after joining nodes by `mapping` (node, root).

    Sizes add up, parallel edges become one, preserve holds if any holds, false_edge if all hold, the least weight stays.
    """
    to = lambda df, c: df.join(mapping.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")), c, "left").withColumn(c, F.coalesce(f"root_{c}", c)).drop(f"root_{c}")
    joined = to(nodes, "node").groupBy("node").agg(F.sum("size").alias("size"))
    moved = to(to(edges, "u"), "v").where("u != v").withColumns({"u": F.least("u", "v"), "v": F.greatest("u", "v")})
    return joined, moved.groupBy("u", "v").agg(F.sum("size").alias("size"), F.min("weight").alias("weight"), F.bool_or("preserve").alias("preserve"), F.bool_and("false_edge").alias("false_edge"))


def flat_agglomeration(nodes: DataFrame, edges: DataFrame, threshold: float) -> DataFrame:
    """(node, root) after joining along every edge of at most `threshold` that isn't to be preserved or false."""
    kept = edges.where((F.col("weight") <= threshold) & ~F.col("preserve") & ~F.col("false_edge"))
    return components(kept.select("u", "v").unionByName(nodes.select(F.col("node").alias("u"), F.col("node").alias("v"))))


def affinity(edges: DataFrame, sources: DataFrame, *, threshold: float, depth: int | None = None) -> DataFrame:
    """(source, node, affinity): the largest product of edge affinities (over at most `depth` edges, if that is given), from `threshold` on.

    A round extends only what the last one improved.
    """
    both = edges.select("u", "v", "affinity").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"), "affinity"))
    both = store(both.where(F.col("affinity") >= threshold))
    best = store(sources.select(F.col("node").alias("source"), "node", F.lit(1.0).alias("affinity")))
    front = best
    for _ in count() if depth is None else range(depth):
        step = front.join(both.select(F.col("u").alias("node"), F.col("v").alias("next"), F.col("affinity").alias("edge")), "node")
        step = step.select("source", F.col("next").alias("node"), (F.col("affinity") * F.col("edge")).alias("affinity")).where(F.col("affinity") >= threshold)
        step = step.groupBy("source", "node").agg(F.max("affinity").alias("affinity"))
        known = best.select("source", "node", F.col("affinity").alias("had"))
        front = store(step.join(known, ["source", "node"], "left").where(F.col("had").isNull() | (F.col("affinity") > F.col("had"))).select("source", "node", "affinity"))
        if not front.take(1):
            break
        best = store(best.unionByName(front).groupBy("source", "node").agg(F.max("affinity").alias("affinity")))
    return best


def shortest_paths(edges: DataFrame, cost: DataFrame, source: DataFrame, *, depth: int | None = None) -> DataFrame:
    """(node, distance) from the source nodes (over at most `depth` edges, if that is given); a step costs what `cost` (node, area) says of the node it enters."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    step_cost = store(both.join(cost.select(F.col("node").alias("v"), "area"), "v").select("u", "v", "area"))
    best = store(source.select("node", F.lit(0).cast("long").alias("distance")))
    front = best
    for _ in count() if depth is None else range(depth):
        step = front.join(step_cost, front["node"] == step_cost["u"]).groupBy(F.col("v").alias("node")).agg(F.min(F.col("distance") + F.col("area")).alias("distance"))
        known = best.select("node", F.col("distance").alias("had"))
        front = store(step.join(known, "node", "left").where(F.col("had").isNull() | (F.col("distance") < F.col("had"))).select("node", "distance"))
        if not front.take(1):
            break
        best = store(best.unionByName(front).groupBy("node").agg(F.min("distance").alias("distance")))
    return best


def both_ways(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(u, v): every edge forward and backward, and every node with itself, once."""
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    return edges.select("u", "v").unionByName(back).unionByName(nodes.select(F.col("node").alias("u"), F.col("node").alias("v"))).distinct()


def assigned_after(counts: DataFrame, merged: DataFrame) -> DataFrame:
    """(label, other, n): each label's best match after merges (node, root), from overlap counts (label, other, n) before them; of equal ones the smallest other. Voxels aren't read again."""
    to = merged.select(F.col("node").alias("label"), "root")
    summed = counts.join(to, "label", "left").groupBy(F.coalesce("root", "label").alias("label"), "other").agg(F.sum("n").alias("n"))
    best = summed.groupBy("label").agg(F.max(F.struct("n", (-F.col("other")).alias("rank"))).alias("m"))
    return best.select("label", (-F.col("m.rank")).alias("other"), F.col("m.n").alias("n"))


def reassigned(nodes: DataFrame, steps: list[DataFrame]) -> DataFrame:
    """(node, label): where each node is after the steps (node, root), one after the other; a node that a step doesn't name stays."""
    told = nodes.select("node", F.col("node").alias("label"))
    for step in steps:
        to = step.select(F.col("node").alias("label"), "root")
        told = told.join(to, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    return told


def history(nodes: DataFrame, steps: list[DataFrame]) -> DataFrame:
    """(label, node): what each label has taken in."""
    return reassigned(nodes, steps).where("label <> node").select("label", "node")


def split(told: DataFrame, apart: DataFrame) -> DataFrame:
    """(node, label) with the labels of the nodes in `apart` (node, piece) replaced."""
    return told.join(apart, "node", "left").select("node", F.coalesce("piece", "label").alias("label"))
