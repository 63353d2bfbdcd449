"""Segmentation from affinities: basins of steepest links, and their joining by size or by mean affinity.

An affinity (z, y, x, az, ay, ax) is how surely a voxel belongs with the one before it on each axis, 0 to 255.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spark import store
from .components import components
from .overlap import dense_rank
from .voxels import KEYS


def affinity_links(affinities: DataFrame) -> DataFrame:
    """(z, y, x, before, affinity): a row for each voxel and the one before it on an axis, where both are there."""
    steps = [F.struct(*[F.lit(int(c == axis)).cast("long").alias(f"d{c}") for c in KEYS], F.col(f"a{axis}").alias("affinity")) for axis in KEYS]
    sent = affinities.select(*KEYS, F.explode(F.array(*steps)).alias("s")).where("s.affinity is not null")
    met = sent.select(F.struct(*KEYS).alias("node"), *[(F.col(c) - F.col(f"s.d{c}")).alias(c) for c in KEYS], F.col("s.affinity").alias("affinity"))
    return met.join(affinities.select(*KEYS), list(KEYS), "left_semi").select("node", F.struct(*KEYS).alias("before"), "affinity")


def steepest(links: DataFrame, low: float) -> DataFrame:
    """(node, to): each voxel's link of the highest affinity above `low`, of equal ones that to the smallest place; a voxel without any has none."""
    both = links.select("node", F.col("before").alias("to"), "affinity").unionByName(links.select(F.col("before").alias("node"), F.col("node").alias("to"), "affinity"))
    return both.where(F.col("affinity") > low).groupBy("node").agg(F.min_by("to", F.struct(-F.col("affinity"), "to")).alias("to"))


def basins(affinities: DataFrame, *, low: float, high: float) -> tuple[DataFrame, DataFrame]:
    """(z, y, x, basin), numbered from 1 by their smallest place, and the links. Voxels join where one's steepest link leads to the other, and over every affinity of `high` or more; those without an affinity above `low` are in none."""
    links = store(affinity_links(affinities))
    always = links.where(F.col("affinity") >= high).select(F.col("node").alias("u"), F.col("before").alias("v"))
    up = steepest(links, low)
    roots = store(components(up.select(F.col("node").alias("u"), F.col("to").alias("v")).unionByName(always)))
    told = roots.join(dense_rank(roots.select("root"), "root", "basin"), "root").select("node", "basin")
    return store(told), links


def basin_graph(told: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, size) and edges (u, v, most, mean, size) of basins: the highest and the mean affinity over the faces where two meet."""
    nodes = told.groupBy(F.col("basin").alias("node")).agg(F.count("*").alias("size"))
    one, two = told.select("node", F.col("basin").alias("a")), told.select(F.col("node").alias("before"), F.col("basin").alias("b"))
    met = links.join(one, "node").join(two, "before").where("a <> b")
    edges = met.groupBy(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).agg(F.max("affinity").alias("most"), F.avg("affinity").alias("mean"), F.count("*").alias("size"))
    return nodes, edges


#: Edges that one task joins at once, with the same result: 24 bytes each.
AT_ONCE = 1 << 20


def _joined_at_once(nodes: DataFrame, edges: DataFrame, size: int) -> DataFrame:
    """As `joined_by_size`, in one task."""

    def run(batches):
        count: dict[int, int] = {}
        links = []
        for b in batches:
            for node, n, u, v, affinity in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if node is not None:
                    count[node] = n
                else:
                    links.append((-affinity, u, v))
        around: dict[int, dict[int, float]] = {x: {} for x in count}
        for w, u, v in links:
            around[u][v] = around[v][u] = w
        heapq.heapify(links)
        into: dict[int, int] = {}
        while links:
            w, u, v = heapq.heappop(links)
            if u in into or v in into or around[u].get(v) != w or min(count[u], count[v]) >= size:
                continue
            into[v] = u
            count[u] += count[v]
            del around[u][v]
            for x, other in around.pop(v).items():
                if x == u:
                    continue
                del around[x][v]
                if other < around[u].get(x, 1.0):
                    around[u][x] = around[x][u] = other
                    heapq.heappush(links, (other, min(u, x), max(u, x)))

        def last(x: int) -> int:
            while x in into:
                x = into[x]
            return x

        yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.int64()), pa.array([last(x) for x in count], pa.int64())], names=["node", "root"])

    none = F.lit(None).cast("long")
    rows = nodes.select("node", "size", none.alias("u"), none.alias("v"), F.lit(None).cast("double").alias("affinity"))
    rows = rows.unionByName(edges.select(none.alias("node"), none.alias("size"), "u", "v", F.col("affinity").cast("double").alias("affinity")))
    return rows.repartition(1).mapInArrow(run, "node long, root long")


def joined_by_size(nodes: DataFrame, edges: DataFrame, *, least: float, size: int, at_once: int = AT_ONCE) -> DataFrame:
    """(node, root): from the highest affinity (`most`) down to `least`, joins two regions of which one has fewer than `size` voxels. Of equal affinities the smaller ends come first.

    A round joins every edge that is the best of those still allowed at both its ends, which is what one edge at a time would join: parallel edges keep
    the highest affinity, so a join makes no better one, and what size forbids once it forbids ever after.
    """
    sizes, left = store(nodes.select("node", "size")), store(edges.select("u", "v", F.col("most").alias("affinity")).where(F.col("most") >= least))
    if sizes.count() + left.count() <= at_once:
        return store(_joined_at_once(sizes, left, size))
    roots = store(nodes.select("node", F.col("node").alias("root")))
    while True:
        one, two = (sizes.select(F.col("node").alias(end), F.col("size").alias(f"size_{end}")) for end in ("u", "v"))
        allowed = store(left.join(one, "u").join(two, "v").where(F.least("size_u", "size_v") < size).select("u", "v", "affinity"))
        key = F.struct(-F.col("affinity"), "u", "v").alias("e")
        ends = allowed.select(F.col("u").alias("node"), key).unionByName(allowed.select(F.col("v").alias("node"), key))
        best = ends.groupBy("node").agg(F.min("e").alias("e"))
        joined = store(best.groupBy("e").agg(F.count("*").alias("n")).where("n = 2").select(F.col("e.u").alias("to"), F.col("e.v").alias("node")))
        if not joined.take(1):
            return roots
        roots = store(roots.join(joined, roots["root"] == joined["node"], "left").select(roots["node"], F.coalesce("to", "root").alias("root")))
        sizes = store(sizes.join(joined, "node", "left").groupBy(F.coalesce("to", "node").alias("node")).agg(F.sum("size").alias("size")))
        for end in ("u", "v"):
            moved = joined.select(F.col("node").alias(end), F.col("to").alias("moved"))
            left = left.join(moved, end, "left").withColumn(end, F.coalesce("moved", end)).drop("moved")
        left = store(left.where("u <> v").groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(F.max("affinity").alias("affinity")))


def segments(affinities: DataFrame, *, low: float = 1, high: float = 254, size: int = 40_000, threshold: float | None = None, minimum: int = 0, at_once: int = AT_ONCE) -> DataFrame:
    """(z, y, x, segment) of all voxels, 0 for background: basins joined while one of two is under `size` voxels or, with `threshold`, while their mean affinity is at least that; segments of fewer than `minimum` voxels to 0."""
    from .agglomerate import rounds

    told, links = basins(affinities, low=low, high=high)
    nodes, edges = basin_graph(told, links)
    if threshold is None:
        roots = joined_by_size(nodes, edges, least=low, size=size, at_once=at_once)
    else:
        roots = rounds(nodes, edges.select("u", "v", (255 - F.col("mean")).alias("weight"), "size"), 255 - threshold, at_once=at_once)
    joined = told.join(roots.withColumnRenamed("node", "basin"), "basin").select("node.*", "root")
    kept = joined.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") >= minimum)
    numbers = dense_rank(store(kept.select("root")), "root", "segment")
    return affinities.select(*KEYS).join(joined.join(numbers, "root").select(*KEYS, "segment"), list(KEYS), "left").select(*KEYS, F.coalesce("segment", F.lit(0)).alias("segment"))
