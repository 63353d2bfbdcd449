"""Joining regions in rounds, what keeps them apart, and the orders in which people look at them."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spark import store
from .components import _plain, _typed, components

#: Nodes and edges that one task joins at once, by the same rounds.
AT_ONCE = 1 << 20


def _mean(edges: list[tuple]) -> tuple:
    """(weight, size) of parallel edges; a single one stays as it is."""
    if len(edges) == 1:
        return edges[0]
    sizes = [s for _, s in edges if s is not None]
    costs = [w * s for w, s in edges if w is not None and s is not None]
    return (math.fsum(costs) / sum(sizes) if costs else None, sum(sizes) if sizes else None)


def _joined_in_rounds(nodes: list, edges: list[tuple], threshold: float) -> list:
    """The root of each of `nodes`, from edges (u, v, weight, size): the rounds of `rounds`. After the first, only the nodes around a join look for their cheapest edge again."""
    around: dict = {}
    for u, v, weight, size in edges:
        both = around.setdefault(u, {}).setdefault(v, [])
        around.setdefault(v, {})[u] = both
        both.append((weight, size))
    cheapest: dict = {}
    moved: dict = {}
    touched, first = set(around), True
    while True:
        for x in touched:
            cheapest[x] = min(((w, min(x, y), max(x, y)) for y, both in around[x].items() for w, _ in both if w is not None and w <= threshold), default=None)
        joined = {e for e in map(cheapest.get, touched) if e and cheapest[e[1]] == cheapest[e[2]] == e}
        if not joined:
            break
        into = {v: u for _, u, v in joined}
        parallel: dict = {}
        for x in {x for _, *ends in joined for x in ends}:
            for y, both in around.pop(x).items():
                if y in around:
                    del around[y][x]
                ends = tuple(sorted((into.get(x, x), into.get(y, y))))
                if ends[0] != ends[1]:
                    parallel.setdefault(ends, {})[min(x, y), max(x, y)] = both
        if first:
            for x, others in around.items():
                for both in others.values():
                    both[:] = [_mean(both)]
            touched, first = set(around), False
        else:
            touched = set()
        for u in into.values():
            around[u] = {}
            touched.add(u)
        for (u, v), parts in parallel.items():
            around[u][v] = around[v][u] = [_mean([e for both in parts.values() for e in both])]
            touched |= {u, v}
        moved |= into

    def last(x):
        way = []
        while x in moved:
            way.append(x)
            x = moved[x]
        moved.update(dict.fromkeys(way, x))
        return x

    return [last(x) for x in nodes]


def _rounds_at_once(nodes: DataFrame, edges: DataFrame, threshold: float) -> DataFrame:
    """As `rounds`, in one task."""
    rows = nodes.select(F.col("node").alias("u"), F.col("node").alias("v"), F.lit(None).cast("double").alias("weight"), F.lit(None).cast(edges.schema["size"].dataType).alias("size"), F.lit(False).alias("edge"))
    rows = rows.unionByName(edges.select("u", "v", F.col("weight").cast("double").alias("weight"), "size", F.lit(True).alias("edge")))
    kind = rows.schema["u"].dataType

    def run(batches):
        names, links = [], []
        for b in batches:
            for u, v, weight, size, edge in zip(_plain(b.column(0)), _plain(b.column(1)), *(b.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                if edge:
                    links.append((u, v, weight, size))
                else:
                    names.append(u)
        roots = _joined_in_rounds(names, links, threshold)
        for i in range(0, len(names), 10_000):
            yield pa.RecordBatch.from_arrays([_typed(x[i : i + 10_000], arrow) for x in (names, roots)], names=["node", "root"])

    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(kind)
    return rows.repartition(1).mapInArrow(run, T.StructType([T.StructField("node", kind), T.StructField("root", kind)]))


def rounds(nodes: DataFrame, edges: DataFrame, threshold: float, *, at_once: int = AT_ONCE) -> DataFrame:
    """(node, root): joins every edge that is the cheapest of both its ends and costs at most `threshold`, again and again.

    Such edges share no node, so a round joins them all at once; each round's cheapest edge is among them. Parallel edges
    become one of size-weighted mean weight, and others keep theirs. Ties go to the smaller ends. Where costs rise or tie along a
    chain of nodes, a round joins one edge of it, so there may be as many rounds as the chain has edges: up to `at_once` nodes and edges go through them in one task.
    """
    roots = store(nodes.select("node", F.col("node").alias("root")))
    left = store(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), "weight", "size").where("u != v"))
    if roots.count() + left.count() <= at_once:
        return store(_rounds_at_once(roots, left, threshold))
    while True:
        cheap = left.where(F.col("weight") <= threshold)
        ends = cheap.select(F.col("u").alias("node"), F.struct("weight", "u", "v").alias("e")).unionByName(cheap.select(F.col("v").alias("node"), F.struct("weight", "u", "v").alias("e")))
        first = ends.groupBy("node").agg(F.min("e").alias("e"))
        joined = store(first.groupBy("e").agg(F.count("*").alias("n")).where("n = 2").select("e.u", "e.v"))
        if not joined.take(1):
            break
        into = joined.select(F.col("v").alias("node"), F.col("u").alias("to"))
        roots = store(roots.join(into, roots["root"] == into["node"], "left").select(roots["node"], F.coalesce("to", "root").alias("root")))
        for end in ("u", "v"):
            moved = into.select(F.col("node").alias(end), F.col("to").alias("moved"))
            left = left.join(moved, end, "left").withColumn(end, F.coalesce("moved", end)).drop("moved")
        left = left.where("u != v").groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        mean = F.when(F.count("*") == 1, F.first("weight")).otherwise(F.sum(F.col("weight") * F.col("size")) / F.sum("size"))
        left = store(left.agg(mean.alias("weight"), F.sum("size").alias("size")))
    return roots


def without_small(voxels: DataFrame, label: str, minimum: int) -> DataFrame:
    """Labels of fewer than `minimum` voxels to 0."""
    small = voxels.where(F.col(label) != 0).groupBy(label).agg(F.count("*").alias("area")).where(F.col("area") < minimum).select(F.col(label).alias("small"))
    return voxels.join(small, voxels[label] == small["small"], "left").withColumn(label, F.when(F.col("small").isNotNull(), 0).otherwise(F.col(label))).drop("small")


def best_locations(touch: DataFrame, place: tuple[str, ...] = ("z", "y", "x")) -> DataFrame:
    """(u, v, place): where each edge's contact is least likely a membrane; of ties the first place."""
    keyed = touch.select(F.least("node", "other").alias("u"), F.greatest("node", "other").alias("v"), "value", *place)
    return keyed.groupBy("u", "v").agg(F.min_by(F.struct(*place), F.struct("value", *place)).alias("m")).select("u", "v", *[f"m.{p}" for p in place])


def kept_apart(points: DataFrame) -> DataFrame:
    """(u, v) label pairs that one synapse has points on (synapse, label): edges between them are to be preserved."""
    one = points.where("label <> 0").select("synapse", F.col("label").alias("u")).distinct()
    return one.join(one.select("synapse", F.col("u").alias("v")), "synapse").where("u < v").select("u", "v").distinct()


def body_exclusions(edges: DataFrame, bodies: DataFrame) -> DataFrame:
    """Edges without those at an excluded body (label)."""
    return edges.join(bodies.select(F.col("label").alias("u")), "u", "left_anti").join(bodies.select(F.col("label").alias("v")), "v", "left_anti")


def by_uncertainty(edges: DataFrame, k: int) -> DataFrame:
    """The k edges whose weight is nearest to one half: a report."""
    return edges.orderBy(F.abs(F.col("weight") - 0.5), "u", "v").limit(k)


def by_impact(edges: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """The k edges whose smaller node is largest: a report (u, v, weight, smaller)."""
    one, two = nodes.select(F.col("node").alias("u"), F.col("size").alias("size_u")), nodes.select(F.col("node").alias("v"), F.col("size").alias("size_v"))
    return edges.join(one, "u").join(two, "v").select("u", "v", "weight", F.least("size_u", "size_v").alias("smaller")).orderBy(F.desc("smaller"), "u", "v").limit(k)


def orphans(voxels: DataFrame, label: str, minimum: int) -> DataFrame:
    """(label, area): labels of at least `minimum` voxels that the volume's faces don't cut."""
    ends = voxels.agg(*[f(c).alias(f"{c}_{n}") for c in "zyx" for n, f in (("low", F.min), ("high", F.max))])
    at = lambda c: (F.col(c) == F.col(f"{c}_low")) | (F.col(c) == F.col(f"{c}_high"))
    told = voxels.where(F.col(label) != 0).crossJoin(F.broadcast(ends)).groupBy(F.col(label).alias("label"))  # one row
    return told.agg(F.count("*").alias("area"), F.bool_or(at("z") | at("y") | at("x")).alias("cut")).where(~F.col("cut") & (F.col("area") >= minimum)).select("label", "area")


def unsegmented(voxels: DataFrame, label: str, minimum: int) -> DataFrame:
    """(label, z, piece): each label cut between planes where fewer than `minimum` of its places go on to the next plane; pieces from 0 up."""
    from pyspark.sql.window import Window

    own = voxels.where(F.col(label) != 0).select("z", "y", "x", F.col(label).alias("label"))
    planes = own.groupBy("label", "z").agg(F.count("*").alias("n"))
    on = own.join(own.withColumn("z", F.col("z") - 1), ["z", "y", "x", "label"]).groupBy("label", (F.col("z") + 1).alias("z")).agg(F.count("*").alias("shared"))
    w = Window.partitionBy("label").orderBy("z")  # a row a plane
    cut = planes.join(on, ["label", "z"], "left").withColumn("cut", ((F.coalesce("shared", F.lit(0)) < minimum) & (F.row_number().over(w) > 1)).cast("int"))
    return cut.select("label", "z", F.sum("cut").over(w).alias("piece"))


def merged_blocks(labelled: DataFrame, *, percent: float = 50) -> DataFrame:
    """(block, local, global) from blocks that overlap (block, z, y, x, local): labels of two blocks join where they share `percent` of either's overlap."""
    from .overlap import dense_rank

    seen = labelled.where("local <> 0")
    name = F.struct("block", "local")
    one, two = seen.select("z", "y", "x", "block", name.alias("a")), seen.select("z", "y", "x", F.col("block").alias("other"), name.alias("b"))
    met = one.join(two, ["z", "y", "x"]).where("block < other")
    counts = met.groupBy("block", "other", "a", "b").agg(F.count("*").alias("n"))
    row = counts.groupBy("block", "other", "a").agg(F.sum("n").alias("row_n"))
    col = counts.groupBy("block", "other", "b").agg(F.sum("n").alias("col_n"))
    good = counts.join(row, ["block", "other", "a"]).join(col, ["block", "other", "b"]).where((F.col("n") * 100 >= F.col("row_n") * percent) | (F.col("n") * 100 >= F.col("col_n") * percent))
    loops = seen.select(name.alias("u")).distinct().select("u", F.col("u").alias("v"))
    roots = store(components(good.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(loops)))
    return roots.join(dense_rank(roots.select("root"), "root", "global"), "root").select("node.block", "node.local", "global")


def mito_joined(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root): each mitochondrion (`mito`) goes to the cell around it with which it shares the largest contact (`size`), of equal ones to the smallest; other nodes stay, as does one without such a neighbour."""
    mito = nodes.where("mito").select(F.col("node").alias("m"))
    both = edges.select(F.col("u").alias("m"), F.col("v").alias("cell"), "size").unionByName(edges.select(F.col("v").alias("m"), F.col("u").alias("cell"), "size"))
    met = both.join(mito, "m", "left_semi").join(mito.select(F.col("m").alias("cell")), "cell", "left_anti")
    best = met.groupBy("m").agg(F.min_by("cell", F.struct(-F.col("size"), "cell")).alias("root"))
    return nodes.join(best, nodes["node"] == best["m"], "left").select("node", F.coalesce("root", "node").alias("root"))


def absorbed(voxels: DataFrame, label: str, minimum: int) -> DataFrame:
    """`voxels` (z, y, x, label) with labels of fewer than `minimum` voxels taken in by the labels around them: round by round, a voxel of theirs takes the smallest label of its six neighbours. Background stays; what only background surrounds becomes 0."""
    from .stencil import AXIS_STEPS

    keys = ["z", "y", "x"]
    small = voxels.where(F.col(label) != 0).groupBy(label).agg(F.count("*").alias("n")).where(F.col("n") < minimum).select(label)
    free = store(voxels.join(small, label, "left_semi").select(*keys))
    around = F.explode(F.array(*[F.struct(*[F.lit(s).cast("long").alias(c) for c, s in zip(keys, step, strict=True)]) for step in AXIS_STEPS])).alias("d")
    fixed = voxels.join(small, label, "left_anti").select(*keys, label)
    front, parts = fixed.where(F.col(label) != 0), [fixed]
    while True:
        sent = front.select(*keys, label, around).select(*[(F.col(c) + F.col(f"d.{c}")).alias(c) for c in keys], label)
        front = store(free.join(sent, keys).groupBy(*keys).agg(F.min(label).alias(label)))
        if not front.take(1):
            break
        parts.append(front)
        free = store(free.join(front, keys, "left_anti"))
    out = free.select(*keys, F.lit(0).cast("long").alias(label))
    for p in parts:
        out = out.unionByName(p)
    return out
