"""Result documents and small-file sinks: synapse tables, connection files, CSV of JSONs, SWC and PLY, tile indexes."""

from __future__ import annotations

import struct
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYNAPSES = "neuron_1 array<long>, neuron_2 array<long>, score array<double>, synapse_center struct<x:array<long>,y:array<long>,z:array<long>>"


def synapse_rows(documents: DataFrame) -> DataFrame:
    """Rows of a synapse document's columns; missing columns are null."""
    zipped = F.arrays_zip("neuron_1", "neuron_2", "score", F.col("synapse_center.x").alias("x"), F.col("synapse_center.y").alias("y"), F.col("synapse_center.z").alias("z"))
    return documents.select(F.explode(zipped).alias("r")).select("r.*")


def synapse_document(rows: DataFrame, order: str = "id", by: Sequence = ()) -> DataFrame:
    """A JSON document of columns, in the order given: one of all rows, or one for each value of `by`. A document is a row, so `by` has to bound it in a large table."""
    one = rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(order, "neuron_1", "neuron_2", "score", "x", "y", "z"))).alias("r"))
    pick = lambda c: F.transform("r", lambda s: s[c])
    centre = F.struct(*[pick(c).alias(c) for c in "xyz"]).alias("synapse_center")
    return one.select(F.to_json(F.struct(pick("neuron_1").alias("neuron_1"), pick("neuron_2").alias("neuron_2"), pick("score").alias("score"), centre)).alias("document"))


def _met(by: Sequence[str], *parts: DataFrame) -> DataFrame:
    """Parts with a row for each value of `by` (one row without) side by side."""
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, list(by), "full") if by else out.crossJoin(p)
    return out


def connection_document(pairs: DataFrame, areas_1: DataFrame, areas_2: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, document): a JSON document of the connections between two blocks: pairs and counts, and each block's labels and areas."""
    p = pairs.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("a", "b", "n"))).alias("p"))
    side = lambda df, c: df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("label", "area"))).alias(c))
    all_ = _met(by, p, side(areas_1, "one"), side(areas_2, "two"))
    labels = lambda c: F.struct(F.transform(c, lambda s: s["label"]).alias("labels"), F.transform(c, lambda s: s["area"]).alias("areas"))
    return all_.select(*by, F.to_json(F.struct(F.transform("p", lambda s: F.array(s["a"], s["b"])).alias("connections"), F.transform("p", lambda s: s["n"]).alias("counts"), labels("one").alias("1"), labels("two").alias("2"))).alias("document"))


def united(frames: list[DataFrame], excluded: tuple[str, ...] = ()) -> DataFrame:
    """Rows of several JSON tables under the sorted union of their keys, as text; a missing value is empty."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in sorted(out.columns) if c not in excluded])


RAG = "nodes array<struct<node:long,size:long>>, edges array<struct<u:long,v:long,size:long,weight:double>>"


def rag_document(nodes: DataFrame, edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, document): a JSON document of a region graph, one of the whole or one for each value of `by`."""
    n = nodes.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("node", "size"))).alias("nodes"))
    e = edges.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("u", "v", "size", "weight"))).alias("edges"))
    return _met(by, n, e).select(*by, F.to_json(F.struct("nodes", "edges")).alias("document"))


def rag_tables(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of region graphs in JSON (document)."""
    read = documents.select(F.from_json("document", RAG).alias("g"))
    return read.select(F.explode("g.nodes").alias("n")).select("n.*"), read.select(F.explode("g.edges").alias("e")).select("e.*")


def swc(nodes: DataFrame) -> DataFrame:
    """(label, swc): each skeleton's nodes (label, node, x, y, z, radius, parent) as SWC text."""
    line = F.concat_ws(" ", F.col("node").cast("string"), F.lit("0"), *[F.col(c).cast("string") for c in ("x", "y", "z", "radius", "parent")])
    return nodes.groupBy("label").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", line.alias("line")))), lambda s: s["line"]), "\n").alias("swc"))


def ply(triangles: DataFrame) -> DataFrame:
    """(label, ply): binary PLY of each label's triangles (label, and x1..z3), equal vertices once."""

    def run(rows: pa.Table) -> pa.Table:
        corners = list(zip(*[rows.column(f"{c}{i}").to_pylist() for i in (1, 2, 3) for c in "xyz"], strict=True))
        index: dict[tuple, int] = {}
        faces = [[index.setdefault(t[3 * i : 3 * i + 3], len(index)) for i in range(3)] for t in sorted(corners)]
        head = f"ply\nformat binary_little_endian 1.0\nelement vertex {len(index)}\nproperty float x\nproperty float y\nproperty float z\nelement face {len(faces)}\nproperty list uchar int vertex_indices\nend_header\n"
        body = b"".join(struct.pack("<fff", *v) for v in index) + b"".join(struct.pack("<Biii", 3, *f) for f in faces)
        return pa.table({"label": [rows.column("label")[0].as_py()], "ply": [head.encode() + body]})

    return triangles.groupBy("label").applyInArrow(run, "label long, ply binary")


def surface(voxels: DataFrame, label: str) -> DataFrame:
    """Two triangles for each voxel face that bounds its label (label, x1..z3), in voxel corners; faces of a cube are found by a join with the neighbours."""
    from ..operators.voxels import KEYS

    own = voxels.where(F.col(label) != 0).select(*KEYS, F.col(label).alias("label"))
    sides = []
    for axis in "zyx":
        for far in (0, 1):
            other = own.select(*[(F.col(c) + ((1 - 2 * far) if c == axis else 0)).alias(c) for c in KEYS], "label")
            bare = own.join(other, [*KEYS, "label"], "left_anti")
            u, v = [c for c in "zyx" if c != axis]
            at = lambda du, dv, axis=axis, far=far, u=u, v=v: {axis: F.col(axis) + far, u: F.col(u) + du, v: F.col(v) + dv}
            for corners in (((0, 0), (1, 0), (1, 1)), ((0, 0), (1, 1), (0, 1))):
                sides.append(bare.select("label", *[at(*d)[c].cast("double").alias(f"{c}{i}") for i, d in enumerate(corners, 1) for c in "xyz"]))
    out = sides[0]
    for s in sides[1:]:
        out = out.unionByName(s)
    return out


def tile_index(grid: DataFrame, pattern: str) -> DataFrame:
    """(column, row, z, location) of a tile grid, location from a pattern of {column}, {row} and {z}."""
    place = F.lit(pattern)
    for name in ("column", "row", "z"):
        place = F.replace(place, F.lit("{" + name + "}"), F.col(f"tile_{name}").cast("string"))
    return grid.select(F.col("tile_column").alias("column"), F.col("tile_row").alias("row"), F.col("tile_z").alias("z"), place.alias("location")).distinct()


def pipeline_index(blocks: DataFrame) -> DataFrame:
    """(dataset_name, blocks): every dataset's volumes and paths."""
    return blocks.groupBy("dataset_name").agg(F.array_sort(F.collect_list(F.struct("x", "y", "z", "x1", "y1", "z1", "path"))).alias("blocks"))
