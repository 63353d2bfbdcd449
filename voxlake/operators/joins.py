"""Joins on grid cells where the plain form would be a nested loop, and look-up joins."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.boxes import AXES, Box


def _tiles(df: DataFrame, tile: Sequence[int], prefix: str) -> DataFrame:
    """A row for each tile of the grid that a box touches (at least the one of its low corner)."""
    for a, t in zip(AXES, tile, strict=True):
        low, high = F.floor(F.col(a) / t), F.floor((F.col(f"{a}1") - 1) / t)
        df = df.withColumn(f"{prefix}{a}", F.explode(F.sequence(low, F.greatest(low, high))))
    return df


def range_join(left: DataFrame, right: DataFrame, *, tile: Sequence[int] = (32, 32, 16)) -> DataFrame:
    """Pairs of boxes (columns x, y, z, x1, y1, z1) that overlap on every axis; columns as l_... and r_...

    Boxes meet in the tiles of a grid that both touch, in an equi join; a pair is kept only in the tile that holds the low corner of
    its intersection, so no distinct is needed. Both sides are sorted and merged: the planner takes a side for as small as it was before it
    was dealt to its tiles, and would broadcast what is too large. Tiles should be about as large as the larger boxes: a box costs as many rows
    as the tiles that it touches.
    """
    a = left.select(*[F.col(c).alias(f"l_{c}") for c in left.columns], *AXES, *[f"{x}1" for x in AXES])
    b = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns], *AXES, *[f"{x}1" for x in AXES])
    plain = [*AXES, *[f"{x}1" for x in AXES]]
    a = _tiles(a, tile, "t").drop(*plain)
    b = _tiles(b, tile, "t").drop(*plain)
    met = a.hint("merge").join(b, [f"t{x}" for x in AXES])
    one, two = Box(met, "l_"), Box(met, "r_")
    low = one.intersection(two)
    owner = [F.col(f"t{x}") == F.floor(low[x] / t) for x, t in zip(AXES, tile, strict=True)]
    return met.where(one.overlaps(two) & owner[0] & owner[1] & owner[2]).drop(*[f"t{x}" for x in AXES])


def distance_join(points: DataFrame, radius: float, scale: dict[str, float], key: str = "id") -> DataFrame:
    """Pairs of points at most `radius` apart, each once (l_key < r_key), with dist2; `scale` has the unit of each coordinate column.

    Points go to the cells of a grid of the radius, one side also to the cells around that come later in the grid's order (13 of 26),
    and meet in a sorted join; two points of neighbouring cells thus meet once, and are put in the order of their keys then.
    """
    axes = list(scale)
    cell = {c: F.floor(F.col(c) * s / radius) for c, s in scale.items()}
    a = points.select(*[F.col(c).alias(f"a_{c}") for c in points.columns], *[v.alias(f"cell_{c}") for c, v in cell.items()])
    later = [o for o in itertools.product((-1, 0, 1), repeat=len(axes)) if o >= (0,) * len(axes)]
    shift = F.explode(F.array(*[F.struct(*[F.lit(d).alias(c) for c, d in zip(axes, o, strict=True)]) for o in later])).alias("shift")
    b = points.select(*[F.col(c).alias(f"b_{c}") for c in points.columns], *[v.alias(f"cell_{c}") for c, v in cell.items()], shift)
    own = F.lit(True)
    for c in axes:
        own = own & (F.col(f"shift.{c}") == 0)
    b = b.select(*[f"b_{c}" for c in points.columns], *[(F.col(f"cell_{c}") + F.col(f"shift.{c}")).alias(f"cell_{c}") for c in axes], own.alias("own"))
    dist2 = sum((((F.col(f"a_{c}") - F.col(f"b_{c}")) * s) * ((F.col(f"a_{c}") - F.col(f"b_{c}")) * s) for c, s in scale.items()), F.lit(0.0))
    first = F.col(f"a_{key}") < F.col(f"b_{key}")
    met = a.hint("merge").join(b, [f"cell_{c}" for c in axes]).where((first | ~F.col("own")) & (dist2 <= radius * radius) & (F.col(f"a_{key}") != F.col(f"b_{key}")))
    pick = lambda c, one, two: F.when(first, F.col(f"{one}_{c}")).otherwise(F.col(f"{two}_{c}"))
    return met.select(*[pick(c, "a", "b").alias(f"l_{c}") for c in points.columns], *[pick(c, "b", "a").alias(f"r_{c}") for c in points.columns], dist2.alias("dist2"))


def star_join(one: DataFrame, two: DataFrame, mid: str, a: str, b: str) -> DataFrame:
    """Pairs (a, b) through `mid` that connect all that meet there: the first of each side with all of the other, not all with all.

    The firsts are aggregates, a row for each `mid`, so neither side is ranked and the joins grow as their larger side.
    """
    one, two = one.select(mid, a).distinct(), two.select(mid, b).distinct()
    first = lambda df, c: df.groupBy(mid).agg(F.min(c).alias(c))
    return first(one, a).join(two, mid).select(a, b).union(one.join(first(two, b), mid).select(a, b)).distinct()


def relabel(voxels: DataFrame, mapping: DataFrame, label: str, to: str, *, on: Sequence[str] = (), otherwise: Column | None = None) -> DataFrame:
    """`voxels` with `label` looked up in `mapping` (on..., label, to) as `to`; 0, or `otherwise`, where it isn't there.

    A left equi join: Spark broadcasts the mapping where its size allows, and splits a label of many voxels where not.
    """
    keys = [*on, label]
    return voxels.join(mapping.select(*keys, to), keys, "left").withColumn(to, F.coalesce(F.col(to), otherwise if otherwise is not None else F.lit(0).cast("long")))


def nearest_upsample(fine: DataFrame, coarse: DataFrame, factor: dict[str, int], value: str) -> DataFrame:
    """Each voxel of `fine` with `value` of the coarse voxel that covers it; null where there is none."""
    cells = {c: F.floor(F.col(c) / n).cast("long").alias(f"coarse_{c}") for c, n in factor.items()}
    keyed = fine.select("*", *cells.values())
    small = coarse.select(*[F.col(c).alias(f"coarse_{c}") for c in factor], value)
    return keyed.join(small, [f"coarse_{c}" for c in factor], "left").drop(*[f"coarse_{c}" for c in factor])


def overlay(*layers: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One value a voxel: of the last layer that has it."""
    all_ = None
    for n, layer in enumerate(layers):
        one = layer.select(*keys, value, F.lit(n).alias("layer"))
        all_ = one if all_ is None else all_.unionByName(one)
    return all_.groupBy(*keys).agg(F.max_by(value, "layer").alias(value))


def face_match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Faces that belong together by `keys`, and what is left on either side (nulls on the other)."""
    return left.join(right, list(keys), "full_outer")
