"""Label co-occurrence of two segmentations and what follows from it. Label 0 is background."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def contingency(voxels: DataFrame, a: str = "a", b: str = "b", *, keep_zero: bool = False) -> DataFrame:
    """(a, b, n): voxels of each label pair; pairs with background go unless `keep_zero`."""
    if not keep_zero:
        voxels = voxels.where((F.col(a) != 0) & (F.col(b) != 0))
    return voxels.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("n"))


def normalised(table: DataFrame, ignore_a: Sequence[int] = (), ignore_b: Sequence[int] = ()) -> DataFrame:
    """`table` with p, each cell's share; cells of ignored labels count 0 before the division."""
    kept = F.when(F.col("a").isin(list(ignore_a)) | F.col("b").isin(list(ignore_b)), F.lit(0)).otherwise(F.col("n")).cast("double")
    total = table.agg(F.sum(kept).alias("total"))
    return table.crossJoin(F.broadcast(total)).select("a", "b", "n", (kept / F.nullif("total", F.lit(0.0))).alias("p"))  # one row


def areas(voxels: DataFrame, label: str) -> DataFrame:
    return voxels.where(F.col(label) != 0).groupBy(F.col(label).alias("label")).agg(F.count("*").alias("area"))


def with_marginals(table: DataFrame) -> DataFrame:
    """`table` with row_n and col_n. Marginals are joined, not windowed, so that a large label's row doesn't meet in one task."""
    rows = table.groupBy("a").agg(F.sum("n").alias("row_n"))
    cols = table.groupBy("b").agg(F.sum("n").alias("col_n"))
    return table.join(rows, "a").join(cols, "b").select("a", "b", "n", "row_n", "col_n")


def overlap_match(table: DataFrame, percent: float = 50, *, both: bool = False) -> DataFrame:
    """Pairs that share `percent` of either label's overlapping area, or of both; all pairs at 0."""
    shares = [F.col("n") * 100 >= F.col(c) * percent for c in ("row_n", "col_n")]
    keep = F.lit(True) if percent == 0 else shares[0] & shares[1] if both else shares[0] | shares[1]
    return with_marginals(table).where(keep).select("a", "b", "n")


def excluded(pairs: DataFrame, one: DataFrame | None = None, two: DataFrame | None = None, both: DataFrame | None = None) -> DataFrame:
    """Pairs without the labels of `one` (a), `two` (b) and the pairs of `both` (a, b)."""
    for frame, on in ((one, ["a"]), (two, ["b"]), (both, ["a", "b"])):
        if frame is not None:
            pairs = pairs.join(frame.select(*on).distinct(), on, "left_anti")
    return pairs


def dense_rank(labels: DataFrame, label: str, to: str) -> DataFrame:
    """(label, to): labels numbered from 1 in their order.

    Sorted in ranges; each range's labels are counted and numbered on from those before, so no single task sees them all.
    """
    spark = labels.sparkSession
    from ..spark import store

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = store(labels.select(label).distinct().repartitionByRange(parts, label).withColumn("part", F.spark_partition_id()))
    sizes = ranged.groupBy("part").agg(F.count("*").alias("size"))
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))  # a row a range
    within = F.row_number().over(Window.partitionBy("part").orderBy(label))
    return ranged.withColumn("nth", within).join(F.broadcast(before), "part").select(label, (F.col("nth") + F.col("before")).cast("long").alias(to))


def area_filter(voxels: DataFrame, label: str, minimum: int) -> DataFrame:
    """(label, area, renumbered): labels of more than `minimum` voxels, numbered from 1 in their order."""
    kept = areas(voxels, label).where(F.col("area") > minimum)
    return kept.join(dense_rank(kept, "label", "renumbered"), "label")


def best(table: DataFrame, group: str, other: str, *, last: bool = True) -> DataFrame:
    """The `other` of most voxels for each `group`; of ties the largest label, or the smallest."""
    tie: Column = F.col(other) if last else -F.col(other)
    return table.groupBy(group).agg(F.max_by(F.struct(other, "n"), F.struct(F.col("n"), tie)).alias("m")).select(group, f"m.{other}", "m.n")


def ground_truth_match(table: DataFrame) -> DataFrame:
    """(a, b, n, share, matched): each segment's best ground-truth label; matched if it has at least half of the segment."""
    rows = table.groupBy("a").agg(F.sum("n").alias("row_n"))
    return best(table, "a", "b", last=False).join(rows, "a").select("a", "b", "n", (F.col("n") / F.col("row_n")).alias("share"), (F.col("n") * 2 >= F.col("row_n")).alias("matched"))
