"""Connected components of links that may outgrow any one machine: alternating large and small stars."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spark import store


def _stamp(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


#: Links that one task settles at once, with the same result: 16 bytes each.
AT_ONCE = 1 << 20


def _settled(edges: DataFrame) -> DataFrame:
    """(node, root) by union-find in one task, for a bounded number of links."""
    kind = edges.schema["u"].dataType

    def run(batches):
        sets: dict = {}

        def top(x):
            while sets.setdefault(x, x) != x:
                sets[x] = x = sets[sets[x]]
            return x

        for b in batches:
            for u, v in zip(*(_plain(b.column(i)) for i in (0, 1)), strict=True):
                a, c = top(u), top(v)
                sets[max(a, c)] = min(a, c)
        nodes = list(sets)
        for i in range(0, len(nodes), 10_000):
            part = nodes[i : i + 10_000]
            yield pa.RecordBatch.from_arrays([_typed(part, edges_type), _typed([top(x) for x in part], edges_type)], names=["node", "root"])

    from pyspark.sql.pandas.types import to_arrow_type

    edges_type = to_arrow_type(kind)
    return edges.select("u", "v").repartition(1).mapInArrow(run, T.StructType([T.StructField("node", kind), T.StructField("root", kind)]))


def _plain(column: pa.Array) -> list:
    """Values that compare: structs as tuples."""
    if pa.types.is_struct(column.type):
        return list(zip(*(_plain(f) for f in column.flatten()), strict=True))
    return column.to_pylist()


def _typed(values: list, kind: pa.DataType) -> pa.Array:
    if pa.types.is_struct(kind):
        parts = list(zip(*values, strict=True)) or [[] for _ in range(kind.num_fields)]
        return pa.StructArray.from_arrays([_typed(list(p), kind.field(i).type) for i, p in enumerate(parts)], fields=[kind.field(i) for i in range(kind.num_fields)])
    return pa.array(values, kind)


def components(links: DataFrame, *, at_once: int = AT_ONCE) -> DataFrame:
    """(node, root) for every node of `links` (columns u, v of one type); root is the component's smallest node.

    Each round hangs nodes on the smallest node known around them, and a component's depth falls
    geometrically, so the rounds grow as the logarithm of its diameter. Rounds are written to the shared
    folder; nothing is collected but a count. A hub's links are joined, not gathered, so a skewed join can
    split them. A loop makes its node known; repeated links don't matter; no links give no rows.
    """
    order = lambda a, b: (F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    links = store(links.select("u", "v"))
    edges = store(links.where("u != v").select(*order("u", "v")).distinct())
    alone = links.where("u = v").select(F.col("u").alias("node")).distinct()
    stamp = _stamp(edges)
    if 0 < stamp[0] <= at_once:
        found = store(_settled(edges))
        return found.unionByName(alone.join(found, "node", "left_anti").select("node", F.col("node").alias("root")))
    while stamp[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        edges = store(both.join(least, both["u"] == least["k"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        met = edges.join(least, edges["u"] == least["k"])
        small = met.where("v != m").select(*order("v", "m")).unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v")))
        edges = store(small.distinct())
        before, stamp = stamp, _stamp(edges)
        if stamp == before:
            break
    found = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    found = found.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    return found.unionByName(alone.join(found, "node", "left_anti").select("node", F.col("node").alias("root")))
