"""Surfaces of labels as triangles: each cube of eight voxels falls into six tetrahedra, whose corners inside and outside a label give its faces."""

from __future__ import annotations

from itertools import permutations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .voxels import KEYS

CORNERS = [(z, y, x) for z in (0, 1) for y in (0, 1) for x in (0, 1)]


def tetrahedra() -> list[list[int]]:
    """Corners of the six tetrahedra around the diagonal from the first corner to the last: a path along the axes in each order. Cubes side by side cut their faces alike."""
    out = []
    for order in permutations(range(3)):
        at, path = [0, 0, 0], [(0, 0, 0)]
        for axis in order:
            at[axis] = 1
            path.append(tuple(at))
        out.append([CORNERS.index(p) for p in path])
    return out


def _faces(inside: list[int], outside: list[int]) -> list[list[tuple[int, int]]]:
    """Triangles of a tetrahedron's cut, corners as (inside, outside) edges."""
    if len(inside) == 1:
        return [[(inside[0], o) for o in outside]]
    if len(outside) == 1:
        return [[(i, outside[0]) for i in inside]]
    (a, b), (c, d) = inside, outside
    return [[(a, c), (a, d), (b, d)], [(a, c), (b, d), (b, c)]]


def cube_triangles() -> list[list[list[tuple[float, float, float]]]]:
    """For each set of inside corners (bit k for corner k) its triangles in half places (z, y, x) of the cube, their normals towards the outside."""
    places, out = np.array(CORNERS, float), []
    for mask in range(256):
        own = []
        for corners in tetrahedra():
            inside, outside = [c for c in corners if mask >> c & 1], [c for c in corners if not mask >> c & 1]
            if not inside or not outside:
                continue
            away = places[outside].mean(0) - places[inside].mean(0)
            for face in _faces(inside, outside):
                p = [(places[i] + places[o]) / 2 for i, o in face]
                if np.dot(np.cross(p[1] - p[0], p[2] - p[0]), away) < 0:
                    p[1], p[2] = p[2], p[1]
                own.append([tuple(map(float, q)) for q in p])
        out.append(own)
    return out


def cubes(voxels: DataFrame, label: str) -> DataFrame:
    """(label, z, y, x, mask): cubes of 2 x 2 x 2 voxels, named by their first, that a label has some corners of, and which."""
    each = F.explode(F.array(*[F.struct(*[F.lit(d).cast("long").alias(c) for c, d in zip(KEYS, corner, strict=True)], F.lit(1 << k).alias("bit")) for k, corner in enumerate(CORNERS)])).alias("d")
    sent = voxels.where(F.col(label) != 0).select(F.col(label).alias("label"), *KEYS, each)
    return sent.select("label", *[(F.col(c) - F.col(f"d.{c}")).alias(c) for c in KEYS], F.col("d.bit").alias("bit")).groupBy("label", *KEYS).agg(F.sum("bit").cast("int").alias("mask")).where("mask < 255")


def marching_surface(voxels: DataFrame, label: str) -> DataFrame:
    """(label, x1, y1, z1, ..., z3): the closed surface of each label between the centres of its voxels and those around them; the table of 256 cubes is joined."""
    spark = voxels.sparkSession
    names = [f"{c}{i}" for i in (1, 2, 3) for c in "xyz"]
    rows = [(mask, *(p[k] for p in t for k in (2, 1, 0))) for mask, ts in enumerate(cube_triangles()) for t in ts]
    table = spark.createDataFrame(rows, "mask int, " + ", ".join(f"d{n} double" for n in names))
    met = cubes(voxels, label).join(F.broadcast(table), "mask")
    return met.select("label", *[(F.col(n[0]) + F.col(f"d{n}")).alias(n) for n in names])
