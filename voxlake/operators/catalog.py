"""The catalog: datasets in boxes, who reads what, and how datasets are cut so that readers load whole pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.boxes import AXES, Box
from .joins import range_join

BOX = [*AXES, *[f"{a}1" for a in AXES]]


def find_datasets(datasets: DataFrame, requests: DataFrame) -> DataFrame:
    """(request, dataset): datasets of a request's type (and source task, where it names one) whose box overlaps its box strictly.

    datasets: id, type, task and a box; requests: id, type, src_task (null: any) and a box.
    """
    met = range_join(requests, datasets).where((F.col("l_type") == F.col("r_type")) & (F.col("l_src_task").isNull() | (F.col("l_src_task") == F.col("r_task"))))
    return met.select(F.col("l_id").alias("request"), F.col("r_id").alias("dataset"))


def contained(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """(outside, inside): boxes that lie in others wholly, but for themselves."""
    met = range_join(outer, inner)
    return met.where(Box(met, "l_").covers(Box(met, "r_")) & (F.col("l_id") != F.col("r_id"))).select(F.col("l_id").alias("outside"), F.col("r_id").alias("inside"))


def dependencies(tasks: DataFrame, datasets: DataFrame, dependents: DataFrame, plans: DataFrame) -> DataFrame:
    """(task, needs): the tasks that made the datasets which a task's loading plans read."""
    makers = dependents.join(datasets.select(F.col("id").alias("dataset"), F.col("task").alias("needs")), "dataset")
    readers = makers.join(plans.select(F.col("id").alias("plan"), "task"), "plan")
    return readers.join(tasks.select(F.col("id").alias("task")), "task").select("task", "needs").distinct()


def subvolumes(producers: DataFrame, readers: DataFrame) -> DataFrame:
    """(producer, box): each producer's box cut at every face of a reader inside it, so that each reader loads whole pieces.

    A producer's cuts on an axis are the distinct faces of its own readers, so a row holds three short lists; the pieces
    come from exploding their neighbours.
    """
    met = range_join(producers, readers)
    two = Box(met, "r_")
    cuts = [F.sort_array(F.array_distinct(F.filter(F.flatten(F.collect_set(F.array(two.low[a], two.high[a], F.col(f"l_{a}"), F.col(f"l_{a}1")))), lambda c: c.isNotNull()))).alias(a) for a in AXES]
    per = met.groupBy(F.col("l_id").alias("producer"), *[F.col(f"l_{c}") for c in BOX]).agg(*cuts)
    inside = lambda a: F.filter(a, lambda c: (c >= F.col(f"l_{a}")) & (c <= F.col(f"l_{a}1")))
    for a in AXES:
        held = inside(a)
        pairs = F.arrays_zip(F.slice(held, F.lit(1), F.size(held) - 1).alias("low"), F.slice(held, F.lit(2), F.size(held) - 1).alias("high"))
        per = per.withColumn(f"piece_{a}", F.explode(pairs))
    return per.select("producer", *[F.col(f"piece_{a}.low").alias(a) for a in AXES], *[F.col(f"piece_{a}.high").alias(f"{a}1") for a in AXES])


def links(pieces: DataFrame, readers: DataFrame) -> DataFrame:
    """(reader, producer, box): the pieces that a reader's box holds."""
    ids = pieces.withColumn("id", F.struct("producer", *BOX))
    met = range_join(readers, ids)
    return met.where(Box(met, "l_").covers(Box(met, "r_"))).select(F.col("l_id").alias("reader"), "r_id.*")


def tile_grid(box: DataFrame, tile: tuple[int, int, int]) -> DataFrame:
    """(z, row, column) of the tiles that cover each box."""
    for name, axis, size in (("z", "z", tile[2]), ("row", "y", tile[1]), ("column", "x", tile[0])):
        box = box.withColumn(f"tile_{name}", F.explode(F.sequence(F.floor(F.col(axis) / size), F.floor((F.col(f"{axis}1") - 1) / size))))
    return box.select("id", *[F.col(f"tile_{n}").cast("long").alias(f"tile_{n}") for n in ("z", "row", "column")])
