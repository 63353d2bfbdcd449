"""Scalar column functions: paths, packing, ordering keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plan_path(root: str, name: Column, box: dict[str, Column], dataset: Column, suffix: str = "storage.plan") -> Column:
    """root/x/y/z/name_x-x1_y-y1_z-z1_dataset.suffix with nine digits a coordinate."""
    spans = [F.concat(F.lpad(box[a].cast("string"), 9, "0"), F.lit("-"), F.lpad(box[f"{a}1"].cast("string"), 9, "0")) for a in "xyz"]
    leaf = F.concat_ws("_", name, *spans, dataset.cast("string"))
    return F.concat_ws("/", F.lit(root), box["x"].cast("string"), box["y"].cast("string"), box["z"].cast("string"), F.concat(leaf, F.lit(f".{suffix}")))


def with_suffix(path: Column, old: str, new: str) -> Column:
    """The path with its ending changed, as from .plan to .done."""
    return F.when(path.endswith(old), F.concat(F.substring(path, F.lit(1), F.length(path) - len(old)), F.lit(new))).otherwise(path)


def path_shard(x: Column, y: Column, z: Column, n: int) -> Column:
    """Which of n roots has a place: from the first two bytes of the md5 of its coordinates."""
    digest = F.md5(F.concat_ws(",", *[c.cast("string") for c in (x, y, z)]))
    byte = lambda i: F.conv(F.substring(digest, 2 * i + 1, 2), 16, 10).cast("long")
    return (byte(0) + 255 * byte(1)) % n


def rgb_pack(r: Column, g: Column, b: Column) -> Column:
    return r * 65536 + g * 256 + b


def rgb_unpack(packed: Column) -> tuple[Column, Column, Column]:
    byte = lambda s: F.shiftright(packed, s).bitwiseAND(F.lit(255))
    return byte(16), byte(8), byte(0)


def morton(x: Column, y: Column, z: Column, bits: int = 16) -> Column:
    """The bits of three coordinates interleaved, x lowest."""
    out = F.lit(0).cast("long")
    for i in range(bits):
        for k, c in enumerate((x, y, z)):
            out = out + F.shiftleft(F.shiftright(c.cast("long"), i).bitwiseAND(F.lit(1).cast("long")), 3 * i + k)
    return out


def pairing(a: Column, b: Column) -> Column:
    """Cantor's pairing of two numbers from 0."""
    return ((a + b) * (a + b + 1) / 2).cast("long") + b


def bits_to_nats(x: Column) -> Column:
    return x * F.ln(F.lit(2.0))


def task_class(task_id: Column) -> Column:
    """A task id without its namespace and what follows the first underscore."""
    return F.substring_index(F.substring_index(task_id, ".", -1), "_", 1)


def quantised(value: Column, *, low: float = 0.0, high: float = 1.0, inverted: bool = False) -> Column:
    """Values of low..high as 0..255."""
    part = F.least(F.greatest((value - low) / (high - low), F.lit(0.0)), F.lit(1.0))
    out = F.floor(part * 255 + 0.5).cast("int")
    return F.lit(255) - out if inverted else out


def memory_model(voxels: Column, one: tuple[float, float], two: tuple[float, float]) -> Column:
    """Bytes by a line through two measured (voxels, bytes)."""
    slope = (two[1] - one[1]) / (two[0] - one[0])
    return voxels * slope + (one[1] - slope * one[0])


def cut_points(start: int, end: int, n: int) -> list[int]:
    """n + 1 places from start to end, evenly apart and rounded down."""
    return [start + (end - start) * i // n for i in range(n + 1)]


def random_priority(key: Column, salt: str = "") -> Column:
    """A priority of 32 bits that looks random, the same for a key in every run: the first four bytes of its MD5."""
    return F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(salt))), 1, 8), 16, 10).cast("long")


def scaled_distance(one: list[Column], two: list[Column], bandwidths: list[Column], least: float = 1e-6) -> Column:
    """Squared distance of two feature vectors, each feature in units of its bandwidth; one of no bandwidth doesn't count."""
    out = F.lit(0.0)
    for a, b, w in zip(one, two, bandwidths, strict=True):
        out = out + F.when(w > least, (a - b) * (a - b) / (w * w)).otherwise(0.0)
    return out


def steady_sum(value: Column) -> Column:
    """Aggregate: the sum of a group's doubles, the smallest first, null if all are null.

    Equal to the last bit however the rows are dealt to tasks, which a plain sum isn't; it decides where sums are compared that may tie. The group's values meet in one task.
    """
    values = F.array_sort(F.collect_list(value.cast("double")))
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda s, x: s + x))
