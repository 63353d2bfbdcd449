"""Neighbourhood kernels on dense blocks (z, y, x) in numpy, and their run over a blocked volume with halos."""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AXIS_STEPS = [(s if a == 0 else 0, s if a == 1 else 0, s if a == 2 else 0) for a in range(3) for s in (-1, 1)]


def shifted(a: np.ndarray, step: tuple[int, int, int], fill) -> np.ndarray:
    """`a` moved by `step`; what comes in from outside is `fill`."""
    out = np.full_like(a, fill)
    src = tuple(slice(max(0, -s), a.shape[i] - max(0, s)) for i, s in enumerate(step))
    dst = tuple(slice(max(0, s), a.shape[i] - max(0, -s)) for i, s in enumerate(step))
    out[dst] = a[src]
    return out


def _swept(a: np.ndarray, reach: tuple[int, int, int], pick) -> np.ndarray:
    for axis, r in enumerate(reach):
        if r:
            edge = np.pad(a, [(r, r) if i == axis else (0, 0) for i in range(3)], mode="edge")
            views = np.lib.stride_tricks.sliding_window_view(edge, 2 * r + 1, axis=axis)
            a = pick(views, axis=-1)
    return a


def grey_dilation(a: np.ndarray, reach: tuple[int, int, int] = (1, 1, 1)) -> np.ndarray:
    return _swept(a, reach, np.max)


def grey_erosion(a: np.ndarray, reach: tuple[int, int, int] = (1, 1, 1)) -> np.ndarray:
    return _swept(a, reach, np.min)


def erode_labels(a: np.ndarray) -> np.ndarray:
    """0 where one of the six neighbours (inside the block) has another label."""
    out = a.copy()
    for step in AXIS_STEPS:
        moved, inside = shifted(a, step, 0), shifted(np.ones(a.shape, bool), step, False)
        out[inside & (moved != a)] = 0
    return out


def gaussian(a: np.ndarray, sigma: tuple[float, float, float], truncate: float = 4.0) -> np.ndarray:
    """Separable, mirrored at the border with the edge value repeated."""
    out = a.astype(float)
    for axis, s in enumerate(sigma):
        if s > 0:
            r = int(truncate * s + 0.5)
            w = np.exp(-0.5 * (np.arange(-r, r + 1) / s) ** 2)
            edge = np.pad(out, [(r, r) if i == axis else (0, 0) for i in range(3)], mode="symmetric")
            out = np.lib.stride_tricks.sliding_window_view(edge, 2 * r + 1, axis=axis) @ (w / w.sum())
    return out


def distance_transform(mask: np.ndarray, sampling: tuple[float, float, float] = (1, 1, 1)) -> np.ndarray:
    """Exact Euclidean distance of each True voxel to the nearest False one; infinite if there is none."""
    best = np.where(mask, np.inf, 0.0)
    for axis, unit in enumerate(sampling):
        n = best.shape[axis]
        place = np.arange(n) * unit
        lines = np.moveaxis(best, axis, -1)
        out = np.empty_like(lines)
        for i in range(n):
            out[..., i] = (lines + (place - place[i]) ** 2).min(-1)
        best = np.moveaxis(out, -1, axis)
    return np.sqrt(best)


def label(mask: np.ndarray, *, diagonal: int = 1, planes: bool = False) -> tuple[np.ndarray, int]:
    """Connected pieces of True voxels, numbered in scan order. `diagonal`: 1 for 6 neighbours, 2 for 18, 3 for 26; `planes`: each z apart."""
    steps = [s for s in np.ndindex(3, 3, 3) if (0 < sum(x != 1 for x in s) <= diagonal) and (not planes or s[0] == 1)]
    steps = [tuple(x - 1 for x in s) for s in steps if s > (1, 1, 1)]
    idx = np.where(mask, np.arange(mask.size).reshape(mask.shape), mask.size)
    while True:
        before = idx.copy()
        for step in steps:
            back = tuple(-x for x in step)
            for s in (step, back):
                idx = np.where(mask, np.minimum(idx, shifted(idx, s, mask.size)), mask.size)
        flat = np.append(idx.ravel(), mask.size)
        idx = np.where(mask, flat[flat[idx.ravel()]].reshape(idx.shape), mask.size)
        if (before == idx).all():
            break
    roots, out = np.unique(idx[mask], return_inverse=True)
    result = np.zeros(mask.shape, np.int64)
    result[mask] = out + 1
    return result, len(roots)


def watershed(image: np.ndarray, markers: np.ndarray, *, planes: bool = False) -> np.ndarray:
    """Seeded flooding by intensity, first come first served among equals; markers stay, and the scan order settles ties.

    A queue for each intensity, emptied from the lowest up. What a queue holds is flooded at once, which gives what one voxel at a time would: its
    neighbours, in the queue's order, go to the end of their own intensity's queue, or of this one if theirs is lower.
    """
    shape = tuple(n + 2 for n in markers.shape)
    inner = (slice(1, -1),) * 3
    out, level = np.full(shape, -1, np.int64), np.zeros(shape, np.int64)
    out[inner], level[inner] = markers, image
    flat, level = out.ravel(), level.ravel()
    steps = np.array([np.dot(s, (shape[1] * shape[2], shape[2], 1)) for s in AXIS_STEPS if not planes or s[0] == 0])
    z, y, x = np.nonzero(markers)
    first = np.lexsort((z, y, x))
    start = np.ravel_multi_index((z[first] + 1, y[first] + 1, x[first] + 1), shape)
    queues: dict[int, list[np.ndarray]] = {}

    def put(places: np.ndarray, levels: np.ndarray) -> None:
        for v in np.unique(levels):
            if int(v) not in queues:
                heapq.heappush(order, int(v))
            queues.setdefault(int(v), []).append(places[levels == v])

    order: list[int] = []
    put(start, level[start])
    while order:
        now = heapq.heappop(order)
        wave = np.concatenate(queues.pop(now))
        while len(wave):
            to = (wave[:, None] + steps).ravel()
            source = np.repeat(wave, len(steps))
            free = flat[to] == 0
            to, source = to[free], source[free]
            one = np.sort(np.unique(to, return_index=True)[1])  # who comes first
            to, source = to[one], source[one]
            flat[to] = flat[source]
            higher = level[to] > now
            put(to[higher], level[to[higher]])
            wave = to[~higher]
    return flat.reshape(shape)[inner]


def _smooth(prob: np.ndarray, sigma: tuple[float, float, float], planes: bool) -> np.ndarray:
    """Rounded, so that equal places are equal however their sums were ordered."""
    return np.round(gaussian(prob, (0 if planes else sigma[0], sigma[1], sigma[2])), 6)


def find_seeds(prob: np.ndarray, *, sigma: tuple[float, float, float] = (1, 2, 2), threshold: float = 128, by_distance: bool = False, minimum: float = 2.0, planes: bool = False) -> tuple[np.ndarray, int]:
    """Numbered seeds: minima of the smoothed membrane probability under the threshold, or maxima of the distance to membrane from `minimum` on."""
    smooth = _smooth(prob, sigma, planes)
    reach = (0 if planes else 1, 1, 1)
    if by_distance:
        d = np.stack([distance_transform(p[None] < threshold)[0] for p in smooth]) if planes else distance_transform(smooth < threshold)
        d = np.where(np.isinf(d), d.shape[1] + d.shape[2], d)
        peak = (d == grey_dilation(d, reach)) & (d >= minimum)
    else:
        peak = (smooth == grey_erosion(smooth, reach)) & (smooth < threshold)
    return label(peak, diagonal=3, planes=planes)


def segment(prob: np.ndarray, *, threshold: float = 128, sigma: tuple[float, float, float] = (1, 2, 2), planes: bool = False) -> np.ndarray:
    """Seeds, flooding of the smoothed probability, and membrane masked out."""
    smooth = _smooth(prob, sigma, planes)
    seeds, _ = find_seeds(prob, sigma=sigma, threshold=threshold, planes=planes)
    return np.where(smooth < threshold, watershed(np.clip(smooth, 0, 255).astype(np.uint8), seeds, planes=planes), 0)


def vesicle(prob: np.ndarray, *, threshold: float = 128, sigma: tuple[float, float, float] = (0.5, 1, 1), area: tuple[int, int] = (2, 100_000), size: int = 4, planes: int = 2) -> tuple[np.ndarray, int]:
    """Synapse objects: smoothed probability over the threshold, plane pieces of an area in the band, volume pieces of a least size and extent in z."""
    mask = gaussian(prob, sigma) > threshold
    flat, n = label(mask, planes=True)
    count = np.bincount(flat.ravel(), minlength=n + 1)
    good = (count >= area[0]) & (count <= area[1])
    good[0] = False
    pieces, n = label(good[flat], diagonal=2)
    count = np.bincount(pieces.ravel(), minlength=n + 1)
    z = np.broadcast_to(np.arange(mask.shape[0])[:, None, None], mask.shape)
    first, last = np.full(n + 1, mask.shape[0]), np.full(n + 1, -1)
    np.minimum.at(first, pieces.ravel(), z.ravel())
    np.maximum.at(last, pieces.ravel(), z.ravel())
    keep = (count >= size) & (last - first + 1 >= planes)
    keep[0] = False
    number = np.cumsum(keep) * keep
    return number[pieces], int(keep.sum())


def nearest_labels(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each voxel the label of the nearest foreground voxel or, of equally near ones, the smallest label, and the squared distance; 0 and a huge one where there is no foreground."""
    kinds, rank = np.unique(labels, return_inverse=True)
    bits = int(len(kinds)).bit_length()
    best = np.where(labels != 0, rank.reshape(labels.shape), 1 << 60)
    for axis, n in enumerate(labels.shape):
        lines = np.moveaxis(best, axis, -1)
        out = np.empty_like(lines)
        place = np.arange(n)
        for i in range(n):
            out[..., i] = (lines + ((place - i) ** 2 << bits)).min(-1)
        best = np.moveaxis(out, -1, axis)
    none = best >= 1 << 60
    return np.where(none, 0, kinds[np.where(none, 0, best & ((1 << bits) - 1))]), np.where(none, 1 << 60, best >> bits)


def thin_boundaries(labels: np.ndarray) -> np.ndarray:
    """Background takes the label of the nearest foreground voxel or, of equally near ones, the smallest label."""
    return nearest_labels(labels)[0]


def clahe(image: np.ndarray, *, tiles: int = 4, clip: float = 0.01) -> np.ndarray:
    """Contrast-limited adaptive histogram equalisation of each plane, 0..255; bilinear between the tiles' lookups."""
    out = np.empty_like(image, dtype=np.uint8)
    for k, plane in enumerate(image):
        h, w = plane.shape
        ys, xs = (np.linspace(0, n, tiles + 1).astype(int) for n in (h, w))
        luts = np.empty((tiles, tiles, 256))
        for i in range(tiles):
            for j in range(tiles):
                part = plane[ys[i] : max(ys[i + 1], ys[i] + 1), xs[j] : max(xs[j + 1], xs[j] + 1)]
                hist = np.bincount(part.ravel().astype(int), minlength=256).astype(float)
                limit = max(1.0, clip * part.size)
                spare = np.maximum(hist - limit, 0).sum()
                luts[i, j] = np.cumsum(np.minimum(hist, limit) + spare / 256) * 255 / part.size
        fy, fx = (np.clip((np.arange(n) + 0.5) * tiles / n - 0.5, 0, tiles - 1) for n in (h, w))
        y0, x0 = np.minimum(fy.astype(int), tiles - 1), np.minimum(fx.astype(int), tiles - 1)
        y1, x1 = np.minimum(y0 + 1, tiles - 1), np.minimum(x0 + 1, tiles - 1)
        v, dy, dx = plane.astype(int), (fy - y0)[:, None], (fx - x0)[None]
        pick = lambda a, b: luts[a[:, None], b[None], v]  # noqa: B023, E731
        out[k] = np.clip((1 - dy) * ((1 - dx) * pick(y0, x0) + dx * pick(y0, x1)) + dy * ((1 - dx) * pick(y1, x0) + dx * pick(y1, x1)), 0, 255)
    return out


def spine_necks(mask: np.ndarray, radius: float, *, sampling: tuple[float, float, float] = (1, 1, 1), minimum: int = 10) -> tuple[np.ndarray, int]:
    """Thin parts of an object, numbered: what an opening by `radius` doesn't give back, in pieces of at least `minimum` voxels."""
    core = distance_transform(np.pad(mask, 1), sampling)[1:-1, 1:-1, 1:-1] > radius
    opened = core if not core.any() else mask & (distance_transform(~core, sampling) <= radius)
    pieces, n = label(mask & ~opened, diagonal=3)
    keep = np.bincount(pieces.ravel(), minlength=n + 1) >= minimum
    keep[0] = False
    return (np.cumsum(keep) * keep)[pieces], int(keep.sum())


def skeleton(mask: np.ndarray) -> list[tuple[int, int, int, int, float, int]]:
    """(node, z, y, x, radius, parent) of a tree: breadth-first from the voxel farthest from the border, pruned to centre voxels by layer."""
    if not mask.any():
        return []
    d = distance_transform(np.pad(mask, 1))[1:-1, 1:-1, 1:-1]
    root = np.unravel_index(np.argmax(np.where(mask, d, -1)), mask.shape)
    layer, front, seen = {tuple(map(int, root)): 0}, [tuple(map(int, root))], 0
    parent: dict[tuple, tuple] = {}
    while front:
        seen += 1
        following = []
        for at in front:
            for s in AXIS_STEPS:
                to = tuple(a + b for a, b in zip(at, s, strict=True))
                if all(0 <= a < n for a, n in zip(to, mask.shape, strict=True)) and mask[to] and to not in layer:
                    layer[to], parent[to] = seen, at
                    following.append(to)
        front = following
    leaves = set(layer) - set(parent.values())
    keep, out = {tuple(map(int, root))}, []
    for leaf in sorted(leaves, key=lambda p: (-layer[p], p)):
        path, at = [], leaf
        while at not in keep:
            path.append(at)
            at = parent[at]
        if len(path) > d[at] + 1:
            keep.update(path)
    number = {p: i + 1 for i, p in enumerate(sorted(keep, key=lambda p: (layer[p], p)))}
    for p, i in number.items():
        out.append((i, *p, float(d[p]), number.get(parent.get(p), -1)))
    return out


def volume_ends(voxels: DataFrame) -> list[tuple[int, int]]:
    """First place and the one after the last, in z, y and x; of no voxels (0, 0)."""
    row = voxels.agg(*[f(c) for c in "zyx" for f in (F.min, F.max)]).first()
    return [(row[2 * i] or 0, -1 if row[2 * i + 1] is None else row[2 * i + 1] + 1) for i in range(3)]


def _spread(voxels: DataFrame, value: str, block: tuple[int, int, int], halo: tuple[int, int, int]) -> DataFrame:
    """(z, y, x, v, bz, by, bx): each voxel in every block whose halo holds it: one, but near faces."""
    df = voxels.select("z", "y", "x", F.col(value).cast("double").alias("v"))
    for c, b, h in zip("zyx", block, halo, strict=True):
        df = df.withColumn(f"b{c}", F.explode(F.sequence(F.floor((F.col(c) - h) / b), F.floor((F.col(c) + h) / b))))
    return df


def _dense(rows: pa.Table, block: tuple[int, int, int], halo: tuple[int, int, int], ends: list[tuple[int, int]], mirror: bool) -> tuple[list[int], list[np.ndarray], np.ndarray, np.ndarray]:
    """The block's place, the rows' places in the dense array, the array itself (mirrored beyond the volume's ends, or 0), and which rows are the block's own."""
    at = [int(rows.column(f"b{c}")[0].as_py()) for c in "zyx"]
    low = [a * b - h for a, b, h in zip(at, block, halo, strict=True)]
    shape = [b + 2 * h for b, h in zip(block, halo, strict=True)]
    places = [rows.column(c).to_numpy() - s for c, s in zip("zyx", low, strict=True)]
    dense = np.zeros(shape)
    dense[tuple(places)] = rows.column("v").to_numpy()
    if mirror:
        there = [(max(0, a - s), min(n, b - s)) for (a, b), s, n in zip(ends, low, shape, strict=True)]
        dense = np.pad(dense[tuple(slice(*t) for t in there)], [(a, n - b) for (a, b), n in zip(there, shape, strict=True)], mode="symmetric")
    own = np.ones(len(rows), bool)
    for p, b, h in zip(places, block, halo, strict=True):
        own &= (p >= h) & (p < h + b)
    return at, places, dense, own


def over_blocks(voxels: DataFrame, value: str, kernel: Callable[[np.ndarray], np.ndarray], *, block: tuple[int, int, int], halo: tuple[int, int, int], mirror: bool = True, name: str = "out", kind: str = "double", only: DataFrame | None = None) -> DataFrame:
    """(z, y, x, name): a kernel run on blocks that see `halo` voxels around them; only a block's own voxels come out.

    Beyond the volume's ends the halo mirrors it (or is 0), as do voxels that the volume lacks inside (0). Rows of a block come sorted, and a task holds one
    block at a time, of a size fixed by `block` and `halo`. Right results need a halo of the kernel's reach. `only` (bz, by, bx) names the blocks to run.
    """
    df, ends = _spread(voxels, value, block, halo), volume_ends(voxels) if mirror else []
    if only is not None:
        df = df.join(only, ["bz", "by", "bx"], "left_semi")

    def run(rows: pa.Table) -> pa.Table:
        _, places, dense, own = _dense(rows, block, halo, ends, mirror)
        result = kernel(dense)[tuple(p[own] for p in places)]
        return pa.table({**{c: rows.column(c).filter(pa.array(own)) for c in "zyx"}, name: pa.array(result).cast(pa.float64() if kind == "double" else pa.int64())})

    return df.groupBy("bz", "by", "bx").applyInArrow(run, f"z long, y long, x long, {name} {kind}")


def label_blocks(voxels: DataFrame, value: str, kernel: Callable[[np.ndarray], np.ndarray], *, block: tuple[int, int, int], halo: tuple[int, int, int]) -> DataFrame:
    """(block, z, y, x, local, own): a labelling of every block with its halo, mirrored at the volume's ends; `own` marks the block's own voxels. Labels are the block's: (block, local) is one label."""
    ends = volume_ends(voxels)

    def run(rows: pa.Table) -> pa.Table:
        at, places, dense, own = _dense(rows, block, halo, ends, True)
        local = np.asarray(kernel(dense))[tuple(places)].astype(np.int64)
        return pa.table({"block": ["_".join(map(str, at))] * len(rows), **{c: rows.column(c) for c in "zyx"}, "local": local, "own": own})

    return _spread(voxels, value, block, halo).groupBy("bz", "by", "bx").applyInArrow(run, "block string, z long, y long, x long, local long, own boolean")


def thinned(voxels: DataFrame, label: str, *, block: tuple[int, int, int], halo: int = 4) -> DataFrame:
    """(z, y, x, label): background takes the label of the volume's nearest foreground voxel or, of equally near ones, the smallest label; 0 in a volume without foreground.

    What a halo shows within its width is the nearest; blocks with voxels farther from foreground are run again with twice the halo.
    """
    from ..spark import store

    reach = max(b - a for a, b in volume_ends(voxels))
    only, parts = None, []
    while True:
        last, h = halo >= reach, halo

        def nearest(a: np.ndarray, last: bool = last, h: int = h) -> np.ndarray:
            found, far = nearest_labels(a.astype(np.int64))
            return found if last else np.where(far <= h * h, found, -1)

        told = store(over_blocks(voxels, label, nearest, block=block, halo=(halo,) * 3, mirror=False, name=label, kind="long", only=only))
        open_ = told.where(F.col(label) == -1).select(*[F.floor(F.col(c) / b).alias(f"b{c}") for c, b in zip("zyx", block, strict=True)]).distinct()
        more = store(open_)
        mine = told.select("*", *[F.floor(F.col(c) / b).alias(f"b{c}") for c, b in zip("zyx", block, strict=True)])
        parts.append(mine.join(more, ["bz", "by", "bx"], "left_anti").select("z", "y", "x", label))
        if last or not more.take(1):
            break
        only, halo = more, 2 * halo
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def vesicles(voxels: DataFrame, value: str, *, threshold: float = 128, sigma: tuple[float, float, float] = (0.5, 1, 1), area: tuple[int, int] = (2, 100_000), size: int = 4, planes: int = 2, block: tuple[int, int, int] = (8, 64, 64)) -> DataFrame:
    """(z, y, x, out): the objects that `vesicle` finds, in a volume of any size and numbered over all of it: only smoothing works on blocks, the pieces are connected components."""
    from ..spark import store
    from .overlap import dense_rank
    from .voxels import PLANE_STEPS, SIDE_STEPS, pieces

    smooth = over_blocks(voxels, value, lambda a: gaussian(a, sigma), block=block, halo=tuple(int(4 * s + 0.5) for s in sigma))
    mask = store(smooth.where(F.col("out") > threshold).select("z", "y", "x", F.lit(1).alias("on")))
    flat = store(pieces(mask, "on", PLANE_STEPS))
    good = flat.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n").between(*area)).select("root")
    solid = store(pieces(flat.join(good, "root", "left_semi").select("z", "y", "x", F.lit(1).alias("on")), "on", SIDE_STEPS))
    kept = solid.groupBy("root").agg(F.count("*").alias("n"), (F.max("z") - F.min("z") + 1).alias("depth")).where((F.col("n") >= size) & (F.col("depth") >= planes)).select("root")
    kept = store(kept)
    return solid.join(dense_rank(kept, "root", "out"), "root").select("z", "y", "x", "out")
