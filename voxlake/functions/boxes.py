"""Column functions on half-open 3-D boxes (x, y, z to x1, y1, z1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AXES = ("x", "y", "z")


class Box:
    """The box of a row: columns prefix + x, y, z, x1, y1, z1."""

    def __init__(self, at, prefix: str = ""):
        self.low = {a: at[f"{prefix}{a}"] for a in AXES}
        self.high = {a: at[f"{prefix}{a}1"] for a in AXES}

    @classmethod
    def of(cls, x: int, y: int, z: int, w: int, h: int, d: int) -> Box:
        values = {"x": x, "y": y, "z": z, "x1": x + w, "y1": y + h, "z1": z + d}
        return cls({k: F.lit(v).cast("long") for k, v in values.items()})

    def contains(self, x: Column, y: Column, z: Column) -> Column:
        return _all((p >= self.low[a]) & (p < self.high[a]) for a, p in zip(AXES, (x, y, z), strict=True))

    def overlaps(self, other: Box) -> Column:
        """Strictly, on every axis: boxes that touch don't."""
        return _all((self.low[a] < other.high[a]) & (other.low[a] < self.high[a]) for a in AXES)

    def covers(self, other: Box) -> Column:
        return _all((self.low[a] <= other.low[a]) & (other.high[a] <= self.high[a]) for a in AXES)

    def intersection(self, other: Box) -> dict[str, Column]:
        """Starts and extents, which are negative on an axis where the boxes are apart."""
        low = {a: F.greatest(self.low[a], other.low[a]) for a in AXES}
        return low | {e: F.least(self.high[a], other.high[a]) - low[a] for a, e in zip(AXES, "whd", strict=True)}

    def union(self, other: Box) -> dict[str, Column]:
        low = {a: F.least(self.low[a], other.low[a]) for a in AXES}
        return low | {e: F.greatest(self.high[a], other.high[a]) - low[a] for a, e in zip(AXES, "whd", strict=True)}

    def trimmed(self, pad: int, whole: Box) -> dict[str, Column]:
        """Half the padding off the faces inside `whole`; faces on its border stay."""
        low = {a: F.when(self.low[a] > whole.low[a], self.low[a] + pad // 2).otherwise(self.low[a]) for a in AXES}
        high = {f"{a}1": F.when(self.high[a] < whole.high[a], self.high[a] - pad // 2).otherwise(self.high[a]) for a in AXES}
        return low | high


def _all(parts) -> Column:
    out = None
    for p in parts:
        out = p if out is None else out & p
    return out
