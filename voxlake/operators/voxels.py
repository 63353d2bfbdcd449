"""Voxelwise operators on long volumes (z, y, x, value), all in built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.boxes import Box

KEYS = ("z", "y", "x")


def scan(voxels: DataFrame, box: tuple[int, int, int, int, int, int], *, local: bool = False, label: str | None = None, offset: int = 0) -> DataFrame:
    """The voxels in a box (x, y, z, w, h, d), in its own coordinates if `local`; `offset` is added to the labels that aren't 0."""
    out = voxels.where(Box.of(*box).contains(F.col("x"), F.col("y"), F.col("z")))
    if label:
        out = out.withColumn(label, F.when(F.col(label) != 0, F.col(label) + offset).otherwise(F.col(label)))
    if local:
        for axis, start in zip("xyz", box, strict=False):
            out = out.withColumn(axis, F.col(axis) - start)
    return out


def planned(box: tuple[int, int, int, int, int, int], layers: Sequence[DataFrame], value: str) -> DataFrame:
    """Every voxel of a box (x, y, z, w, h, d): the value of the last layer that has it, 0 where none has."""
    from .joins import overlay

    x, y, z, w, h, d = box
    grid = layers[0].sparkSession.range(z, z + d).select(F.col("id").alias("z"))
    for c, low, n in (("y", y, h), ("x", x, w)):
        grid = grid.withColumn(c, F.explode(F.sequence(F.lit(low).cast("long"), F.lit(low + n - 1).cast("long"))))
    known = overlay(*[scan(v, box) for v in layers], keys=KEYS, value=value)
    return grid.join(known, list(KEYS), "left").select(*KEYS, F.coalesce(value, F.lit(0)).alias(value))


def masked(voxels: DataFrame, label: str, mask: DataFrame) -> DataFrame:
    """Labels where `mask` (z, y, x) has a voxel; 0 elsewhere."""
    return voxels.join(mask.select(*KEYS, F.lit(True).alias("inside")).distinct(), list(KEYS), "left").withColumn(label, F.when(F.col("inside"), F.col(label)).otherwise(0)).drop("inside")


def threshold(value: Column, *, at: float | None = None, higher: bool = False, classes: Sequence[int] | None = None) -> Column:
    """Foreground: value among the classes, else above or below the threshold."""
    if classes is not None:
        return value.isin(list(classes))
    return value > at if higher else value < at


def combined(volumes: Sequence[DataFrame], value: str, how: str) -> DataFrame:
    """One value a voxel over several volumes: sum, product, mean (rounded down), median, min or max."""
    all_ = volumes[0].select(*KEYS, value)
    for v in volumes[1:]:
        all_ = all_.unionByName(v.select(*KEYS, value))
    ways = {"sum": F.sum(value), "product": F.product(F.col(value)), "mean": F.floor(F.sum(value) / F.count("*")), "median": F.median(value), "min": F.min(value), "max": F.max(value)}
    return all_.groupBy(*KEYS).agg(ways[how].alias(value))


def merged_predictions(volumes: Sequence[DataFrame], value: str, how: str, *, inverted: bool = False, most: int = 255) -> DataFrame:
    """mean, min or max of predictions, each turned round first if `inverted`."""
    if inverted:
        volumes = [v.withColumn(value, F.lit(most) - F.col(value)) for v in volumes]
    return combined(volumes, value, how)


def filled_tiles(box: tuple[int, int, int, int, int, int], tile: tuple[int, int], tiles: DataFrame, sections: int, value: str) -> DataFrame:
    """(z, row, column, value) of every tile of a box's grid; 255 where a tile is missing or z is beyond the sections."""
    x, y, z, w, h, d = box
    spark = tiles.sparkSession
    grid = spark.range(z, z + d).select(F.col("id").alias("z"))
    grid = grid.withColumn("row", F.explode(F.sequence(F.lit(y // tile[1]), F.lit(-(-(y + h) // tile[1]) - 1)))).withColumn("column", F.explode(F.sequence(F.lit(x // tile[0]), F.lit(-(-(x + w) // tile[0]) - 1))))
    met = grid.select("z", F.col("row").cast("long").alias("row"), F.col("column").cast("long").alias("column")).join(tiles, ["z", "row", "column"], "left")
    return met.select("z", "row", "column", F.when(F.col("z") < sections, F.coalesce(value, F.lit(255))).otherwise(F.lit(255)).cast("long").alias(value))


def neighbour_extremes(voxels: DataFrame, value: str, *, reach: tuple[int, int, int] = (1, 1, 1), cross: bool = True) -> DataFrame:
    """`voxels` with low and high of `value` over the six neighbours and the voxel itself, or over the box of `reach` (z, y, x).

    A voxel sends its value to the places around it; extremes are aggregated before the shuffle. Places without a voxel count for nothing.
    """
    around = [(0, 0, 0), (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)] if cross else [
        (a, b, c) for a in range(-reach[0], reach[0] + 1) for b in range(-reach[1], reach[1] + 1) for c in range(-reach[2], reach[2] + 1)
    ]
    places = F.explode(F.array(*[F.struct(*[F.lit(s).alias(c) for c, s in zip("zyx", step, strict=True)]) for step in around])).alias("d")
    sent = voxels.select(*KEYS, F.col(value).alias("v"), places).groupBy(*[(F.col(c) + F.col(f"d.{c}")).alias(c) for c in KEYS]).agg(F.min("v").alias("low"), F.max("v").alias("high"))
    return voxels.join(sent, list(KEYS))


def eroded(voxels: DataFrame, label: str) -> DataFrame:
    """Labels of voxels that have only their own label around (among voxels there are); 0 elsewhere."""
    return neighbour_extremes(voxels, label).select(*KEYS, F.when(F.col("low") == F.col("high"), F.col(label)).otherwise(F.lit(0)).cast("long").alias(label))


def dilated(voxels: DataFrame, value: str, reach: tuple[int, int, int]) -> DataFrame:
    return neighbour_extremes(voxels, value, reach=reach, cross=False).select(*KEYS, F.col("high").alias(value))


def stretched(value: Column, low: float, high: float, most: int = 255) -> Column:
    """Clipped to low..high and stretched to 0..most, rounded down."""
    held = F.least(F.greatest(value.cast("double"), F.lit(float(low))), F.lit(float(high)))
    return F.floor((held - low) * most / (high - low)).cast("long")


def saturated(voxels: DataFrame, value: str, saturation: float) -> DataFrame:
    """`value` stretched between the order statistics at saturation / 2 from either end. Positions come from the histogram of values, not from sorted voxels."""
    ends = order_statistics(voxels, value, saturation)
    v = F.least(F.greatest(F.col(value), F.col("low")), F.col("high"))
    return voxels.crossJoin(F.broadcast(ends)).select(*KEYS, F.floor((v - F.col("low")) * 255.0 / F.greatest(F.col("high") - F.col("low"), F.lit(1))).cast("long").alias(value))  # one row


def order_statistics(voxels: DataFrame, value: str, saturation: float) -> DataFrame:
    """One row: the values at positions floor(n s / 2) from below and from above, from 0."""
    from pyspark.sql.window import Window

    counts = voxels.groupBy(F.col(value).alias("v")).agg(F.count("*").alias("n"))  # as many rows as intensities
    run = counts.withColumn("upto", F.sum("n").over(Window.orderBy("v"))).withColumn("total", F.sum("n").over(Window.partitionBy()))
    skip = F.floor(F.col("total") * (saturation / 2))
    return run.agg(F.min(F.when(F.col("upto") > skip, F.col("v"))).alias("low"), F.max(F.when(F.col("total") - (F.col("upto") - F.col("n")) > skip, F.col("v"))).alias("high"))


def matched_histogram(voxels: DataFrame, value: str, template: DataFrame) -> DataFrame:
    """`value` moved so that its distribution follows the template's: each value to the first template value of at least its cumulated share.

    The lookup has a row an intensity: both sides' shares in one order, and the smallest template value from each on; the voxels meet it in one equi join.
    """
    from pyspark.sql.window import Window

    def shares(df: DataFrame, mine: bool) -> DataFrame:
        counts = df.groupBy(F.col(value).alias("k")).agg(F.count("*").alias("n"))
        share = F.sum("n").over(Window.orderBy("k")) / F.sum("n").over(Window.partitionBy())
        return counts.select(share.alias("share"), F.lit(mine).alias("mine"), F.col("k").alias("v"), F.lit(None).cast("long").alias("t")) if mine else counts.select(share.alias("share"), F.lit(mine).alias("mine"), F.lit(None).cast("long").alias("v"), F.col("k").cast("long").alias("t"))

    both = shares(voxels, True).unionByName(shares(template, False))
    later = Window.orderBy(F.desc("share"), "mine").rowsBetween(Window.unboundedPreceding, 0)  # of equal shares the template's first
    lookup = both.withColumn("to", F.min("t").over(later)).where("mine and to is not null").select("v", "to")
    return voxels.join(lookup, voxels[value] == lookup["v"]).select(*KEYS, F.col("to").alias(value))


def repaired(voxels: DataFrame, label: str, broken: Sequence[int], repair: DataFrame) -> DataFrame:
    """Broken labels to 0, then the repair's labels (where not 0) over them."""
    kept = voxels.select(*KEYS, F.when(F.col(label).isin(list(broken)), 0).otherwise(F.col(label)).alias(label))
    fix = repair.where(F.col(label) != 0).select(*KEYS, F.col(label).alias("fix"))
    return kept.join(fix, list(KEYS), "left").select(*KEYS, F.coalesce("fix", label).alias(label))


#: Steps (z, y, x) to half of a voxel's neighbours: the 4 of its plane, the 6 with which it shares a face, the 18 with which it shares a face or an edge.
PLANE_STEPS = ((0, 1, 0), (0, 0, 1))
FACE_STEPS = ((1, 0, 0), *PLANE_STEPS)
SIDE_STEPS = (*FACE_STEPS, (0, 1, 1), (0, 1, -1), (1, 0, 1), (1, 0, -1), (1, 1, 0), (1, -1, 0))


def plane_components(voxels: DataFrame, label: str) -> DataFrame:
    """(z, y, x, root): each plane's 4-connected pieces of one label, named by their smallest place; background has none."""
    return pieces(voxels, label, PLANE_STEPS)


def volume_components(voxels: DataFrame, label: str) -> DataFrame:
    """(z, y, x, root): 6-connected pieces of one label in the whole volume."""
    return pieces(voxels, label, FACE_STEPS)


def pieces(voxels: DataFrame, label: str, steps: Sequence[tuple[int, int, int]]) -> DataFrame:
    """(z, y, x, root): pieces of one label that the steps connect, named by their smallest place."""
    from .components import components

    own = voxels.where(F.col(label) != 0).select(*KEYS, F.col(label).alias("l"), F.struct(*KEYS).alias("node"))
    around = F.explode(F.array(*[F.struct(*[F.lit(by).cast("long").alias(c) for c, by in zip(KEYS, step, strict=True)]) for step in steps])).alias("d")
    moved = own.select(*KEYS, "l", F.col("node").alias("before"), around).select(*[(F.col(c) + F.col(f"d.{c}")).alias(c) for c in KEYS], "l", "before")
    met = own.join(moved, [*KEYS, "l"]).select(F.col("node").alias("u"), F.col("before").alias("v"))
    return components(met.unionByName(own.select(F.col("node").alias("u"), F.col("node").alias("v")))).select("node.*", F.col("root"))
