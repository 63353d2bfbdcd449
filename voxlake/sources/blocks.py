"""Blocked volumes on disk: chunk tables, storage and loading plans, repair reads, deletion."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.boxes import Box
from ..operators.voxels import KEYS

DTYPES = {"uint8": "short", "uint16": "int", "uint32": "long", "uint64": "decimal(20,0)", "float32": "float", "float64": "double"}
CHUNK = "dataset string, x long, y long, z long, x1 long, y1 long, z1 long, dtype string, data binary"


def write_chunks(voxels: DataFrame, path: str, *, dataset: str, value: str, block: tuple[int, int, int], dtype: str = "uint32") -> None:
    """Voxels as dense chunks (z, y, x order, 0 where there is none), a Parquet row a block, partitioned by dataset. The write's commit is the done mark."""
    bz, by, bx = block
    df = voxels.select(*KEYS, F.col(value).alias("v")).withColumns({f"b{c}": F.floor(F.col(c) / b) for c, b in zip("zyx", block, strict=True)})

    def pack(rows: pa.Table) -> pa.Table:
        z, y, x, v = (rows.column(n).to_numpy() for n in ("z", "y", "x", "v"))
        low = [int(rows.column(f"b{c}")[0].as_py()) * b for c, b in zip("zyx", block, strict=True)]
        dense = np.zeros(block, dtype)
        dense[z - low[0], y - low[1], x - low[2]] = v
        cells = [dataset, low[2], low[1], low[0], low[2] + bx, low[1] + by, low[0] + bz, dtype, dense.tobytes()]
        return pa.table({n.split()[0]: [c] for n, c in zip(CHUNK.split(", "), cells, strict=True)})

    df.groupBy("bz", "by", "bx").applyInArrow(pack, CHUNK).write.mode("append").partitionBy("dataset").parquet(path)


def read_chunks(spark: SparkSession, path: str, *, dataset: str, box: tuple[int, int, int, int, int, int] | None = None) -> DataFrame:
    """(z, y, x, value) of a dataset in a box; chunks outside it are skipped by the scan's filters, and only covered voxels come."""
    chunks = spark.read.schema(CHUNK).parquet(path).where(F.col("dataset") == dataset)
    if box:
        chunks = chunks.where(Box(chunks).overlaps(Box.of(*box)))

    def unpack(batches):
        for b in batches:
            for row in b.to_pylist():
                shape = (row["z1"] - row["z"], row["y1"] - row["y"], row["x1"] - row["x"])
                v = np.frombuffer(row["data"], row["dtype"]).reshape(shape)
                z, y, x = (a.ravel() + row[c] for a, c in zip(np.indices(shape), "zyx", strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(z), pa.array(y), pa.array(x), pa.array(v.ravel().astype(np.int64))], names=["z", "y", "x", "value"])

    out = chunks.mapInArrow(unpack, "z long, y long, x long, value long")
    return out.where(Box.of(*box).contains(F.col("x"), F.col("y"), F.col("z"))) if box else out


def storage_plan(blocks: DataFrame, *, dataset_id: str = "dataset_id") -> DataFrame:
    """A JSON document a dataset: dimensions, origin, blocks as [volume, path], datatype, name, id."""
    volume = F.struct(*"xyz", (F.col("x1") - F.col("x")).alias("width"), (F.col("y1") - F.col("y")).alias("height"), (F.col("z1") - F.col("z")).alias("depth"))
    per = blocks.groupBy(dataset_id, "dataset_name", "datatype").agg(
        F.array_sort(F.collect_list(F.struct(volume.alias("volume"), F.col("path")))).alias("blocks"), *[F.min(c).alias(c) for c in "xyz"], *[F.max(f"{c}1").alias(f"{c}1") for c in "xyz"]
    )
    dims = F.array(*[F.col(f"{c}1") - F.col(c) for c in "zyx"]).alias("dimensions")
    return per.select(F.to_json(F.struct(dims, *"xyz", "blocks", "datatype", "dataset_name", F.col(dataset_id).alias("dataset_id"))).alias("plan"))


def loading_plan(plan: str, plan_id: int, done_files: list[str]) -> str:
    """A storage plan turned into the one to read by: [path, volume] pairs and the files to wait for."""
    doc = json.loads(plan)
    doc["blocks"] = [{"path": b["path"], "volume": b["volume"]} for b in doc["blocks"]]
    return json.dumps(doc | {"loading_plan_id": plan_id, "dataset_done_files": done_files}, sort_keys=True)


def loading_plans(plans: DataFrame, plan_id: Column, done_files: Column) -> DataFrame:
    """(value): the loading plan of each storage plan in `plan`, as JSON."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([loading_plan(r["plan"], r["id"], r["done"]) for r in b.to_pylist()], pa.string())], names=["value"])

    return plans.select("plan", plan_id.alias("id"), done_files.alias("done")).mapInArrow(run, "value string")


def find_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """(path, length) of the files under a folder whose names match, by a recursive listing; their contents aren't read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder).select("path", "length")


def read_plans(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    """(plan columns, volume, path) of JSON plans, a row a block; a plan is a file, or with `lines` a line of one."""
    plans = spark.read.option("multiLine", not lines).json(path)
    return plans.select("dataset_name", "datatype", "dimensions", F.explode("blocks").alias("block")).select("dataset_name", "datatype", "dimensions", "block.volume", "block.path")


def find_plans(paths: DataFrame, prefix: str) -> DataFrame:
    """Plan files (path) whose name begins with a prefix."""
    return paths.where(F.element_at(F.split("path", "/"), -1).startswith(prefix))


def delete_dataset(spark: SparkSession, path: str, dataset: str) -> bool:
    """Removes a dataset's chunks and leaves a `.deleted` mark; call it once all readers are done. Through Hadoop's file system, wherever the path is."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/dataset={dataset}")
    fs = at.getFileSystem(conf)
    gone = fs.delete(at, True)
    fs.create(jvm.org.apache.hadoop.fs.Path(f"{path}/_{dataset}.deleted")).close()
    return bool(gone)


def repair_scan(coarse: DataFrame, box: tuple[int, int, int, int, int, int], offset: tuple[int, int, int], factor: tuple[int, int, int]) -> DataFrame:
    """The voxels of a box from a coarser volume: each takes the coarse voxel at (place - offset) div factor (x, y, z)."""
    spark = coarse.sparkSession
    x, y, z, w, h, d = box
    grid = spark.range(z, z + d).select(F.col("id").alias("z")).select("z", F.explode(F.sequence(F.lit(y).cast("long"), F.lit(y + h - 1).cast("long"))).alias("y")).select("z", "y", F.explode(F.sequence(F.lit(x).cast("long"), F.lit(x + w - 1).cast("long"))).alias("x"))
    keys = {c: F.floor((F.col(c) - o) / n).cast("long").alias(f"c{c}") for c, o, n in zip("xyz", offset, factor, strict=True)}
    small = coarse.select(*[F.col(c).alias(f"c{c}") for c in "xyz"], "value")
    return grid.select("*", *keys.values()).join(small, ["cx", "cy", "cz"], "left").select("z", "y", "x", F.coalesce("value", F.lit(0)).alias("value"))


def write_stitched(blocks: DataFrame, mapping: DataFrame, path: str, *, dataset: str, pad: int, whole: tuple[int, int, int, int, int, int], chunk: tuple[int, int, int]) -> None:
    """Blocks with halos (block, box_x to box_z1, z, y, x, local) as one volume of global labels: faces inside lose half the padding, labels are looked up by (block, local)."""
    kept = Box(blocks, "box_").trimmed(pad, Box.of(*whole))
    inside = None
    for c in "xyz":
        one = (F.col(c) >= kept[c]) & (F.col(c) < kept[f"{c}1"])
        inside = one if inside is None else inside & one
    told = blocks.where(inside).join(mapping, ["block", "local"], "left").select(*KEYS, F.coalesce("global", F.lit(0)).alias("global"))
    write_chunks(told, path, dataset=dataset, value="global", block=chunk)


def copy_path(spark: SparkSession, source: str, target: str) -> bool:
    """Copies a file or folder through Hadoop's file systems."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    a, b = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    return bool(jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, conf))


def png_planes(voxels: DataFrame, value: str, *, tile: tuple[int, int]) -> DataFrame:
    """(name, content): PNG tiles of each plane, named x_y_z, labels in three channels."""
    from .tiles import encode_png

    df = voxels.select(*KEYS, F.col(value).cast("long").alias("v")).withColumns({"by": F.floor(F.col("y") / tile[1]), "bx": F.floor(F.col("x") / tile[0])})

    def run(rows: pa.Table) -> pa.Table:
        z, y, x, v = (rows.column(n).to_numpy() for n in (*KEYS, "v"))
        y0, x0 = int(rows.column("by")[0].as_py()) * tile[1], int(rows.column("bx")[0].as_py()) * tile[0]
        image = np.zeros((tile[1], tile[0], 3), np.uint8)
        for k in range(3):
            image[y - y0, x - x0, k] = (v >> (8 * k)) & 255
        return pa.table({"name": [f"{x0:04d}_{y0:04d}_{int(z[0]):04d}.png"], "content": [encode_png(image)]})

    return df.groupBy("z", "by", "bx").applyInArrow(run, "name string, content binary")
