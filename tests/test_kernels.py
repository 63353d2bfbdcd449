"""numpy kernels against brute force."""

import itertools

import numpy as np
import pytest

from voxlake.operators import matching, stencil

draw = np.random.default_rng(5)


def test_distance_transform():
    mask = draw.random((4, 7, 6)) < 0.8
    zero = np.argwhere(~mask)
    scale = np.array((3.0, 1.0, 2.0))
    want = np.array([[[np.sqrt((((zero - p) * scale) ** 2).sum(1)).min() for p in row] for row in plane] for plane in np.moveaxis(np.indices(mask.shape), 0, -1)])
    assert np.allclose(stencil.distance_transform(mask, tuple(scale)), want)


@pytest.mark.parametrize(("diagonal", "planes"), [(1, False), (2, False), (3, False), (1, True)])
def test_label(diagonal, planes):
    mask = draw.random((4, 9, 8)) < 0.45
    got, n = stencil.label(mask, diagonal=diagonal, planes=planes)
    want, k = np.zeros(mask.shape, int), 0
    for p in map(tuple, np.argwhere(mask)):
        if want[p]:
            continue
        k, todo = k + 1, [p]
        want[p] = k
        while todo:
            at = todo.pop()
            for s in itertools.product((-1, 0, 1), repeat=3):
                if 0 < sum(map(abs, s)) <= diagonal and not (planes and s[0]):
                    to = tuple(a + b for a, b in zip(at, s))
                    if all(0 <= a < m for a, m in zip(to, mask.shape)) and mask[to] and not want[to]:
                        want[to] = k
                        todo.append(to)
    assert n == k and (got == want).all()


def test_gaussian_keeps_a_constant_and_a_sum():
    assert np.allclose(stencil.gaussian(np.full((3, 5, 5), 7.0), (1, 2, 2)), 7)
    a = draw.random((3, 20, 20))
    assert np.isclose(stencil.gaussian(a, (0, 1, 1)).sum(), a.sum())


def test_dilation_and_erosion():
    a = draw.integers(0, 9, (3, 6, 6))
    edge = np.pad(a, 1, mode="edge")
    around = [edge[1 + i : 4 + i, 1 + j : 7 + j, 1 + k : 7 + k] for i, j, k in itertools.product((-1, 0, 1), repeat=3)]
    assert (stencil.grey_dilation(a) == np.max(around, 0)).all() and (stencil.grey_erosion(a) == np.min(around, 0)).all()


def test_watershed_floods_to_the_ridge():
    image = np.array([[[0, 1, 5, 1, 0]]], np.uint8)
    markers = np.array([[[1, 0, 0, 0, 2]]])
    out = stencil.watershed(image, markers)[0, 0].tolist()
    assert out[:2] == [1, 1] and out[3:] == [2, 2] and out[2] in (1, 2)


def test_watershed_keeps_markers_and_fills():
    image, markers = draw.integers(0, 255, (2, 8, 8)).astype(np.uint8), np.zeros((2, 8, 8), int)
    markers[0, 0, 0], markers[1, 7, 7] = 3, 4
    out = stencil.watershed(image, markers)
    assert (out > 0).all() and out[0, 0, 0] == 3 and out[1, 7, 7] == 4


def test_vesicle_drops_small_and_flat_objects():
    prob = np.zeros((5, 12, 12))
    prob[1:4, 2:6, 2:6] = 255
    prob[2, 9:11, 9:11] = 255
    out, n = stencil.vesicle(prob, sigma=(0, 0, 0))
    assert n == 1 and out[2, 3, 3] == 1 and out[2, 9, 9] == 0


def test_skeleton_is_a_tree_within_the_object():
    mask = np.zeros((3, 5, 30), bool)
    mask[1, 1:4, 1:29] = True
    nodes = stencil.skeleton(mask)
    ids = {n[0] for n in nodes}
    assert all(mask[n[1:4]] for n in nodes) and sum(n[5] == -1 for n in nodes) == 1 and all(n[5] in ids | {-1} for n in nodes) and len(nodes) > 10


def test_assignment_is_cheapest():
    for _ in range(20):
        cost = draw.random((4, 5))
        best = min(sum(cost[i, p[i]] for i in range(4)) for p in itertools.permutations(range(5), 4))
        assert np.isclose(cost[np.arange(4), matching.assignment(cost)].sum(), best)


def test_assign_by_overlap_and_distance():
    assert matching.assign_by_overlap({(1, 7): 9, (2, 7): 3, (2, 8): 5}, {1: 10, 2: 10, 3: 4}, {7: 12, 8: 6}) == [(1, 7), (2, 8)]
    assert matching.assign_by_distance({1: (0, 0), 2: (10, 0)}, {5: (1, 0), 6: (50, 0)}, 5) == [(1, 5)]


def test_stable_pairs():
    counts = {(1, 1): 5, (1, 2): 9, (2, 1): 7, (2, 2): 8}
    assert matching.stable_pairs(counts, minimum=1) == [(1, 2), (2, 1)]
    assert matching.stable_pairs(counts, minimum=8) == [(1, 2)]
    assert matching.stable_pairs(counts, minimum=8, areas=({1: 14, 2: 8}, {1: 12, 2: 17})) == [(1, 2), (2, 2)]
    assert matching.stable_pairs(counts, minimum=1, partners=2) == [(1, 1), (1, 2), (2, 1), (2, 2)]


def test_greedy_agglomeration():
    got = matching.greedy_agglomeration({(1, 2): (0.1, 1), (2, 3): (0.15, 1), (1, 3): (0.9, 3), (4, 5): (0.5, 1)}, 0.2)
    assert got == {2: 1}  # 1-3 is (0.15 + 2.7) / 4 then
    assert matching.greedy_agglomeration({(1, 2): (0.1, 1), (2, 3): (0.15, 1)}, 0.2, keep={3}) == {2: 1}


def test_inclusions_and_colouring():
    edges = {(0, 1), (0, 2), (1, 2), (2, 3), (3, 4)}
    assert matching.inclusions(edges) == {3: 2, 4: 2}
    assert matching.inclusions(edges, preserved={4}) == {}
    colours = matching.colouring(edges, {0, 1, 2, 3, 4})
    assert all(colours[a] != colours[b] for a, b in edges) and colours[0] == 1


def test_kernels_over_blocks_see_their_halo(spark):
    shape = (5, 40, 37)
    dense = draw.integers(0, 255, shape)
    z, y, x = (p.ravel().tolist() for p in np.indices(shape))
    df = spark.createDataFrame(list(zip(z, y, x, dense.ravel().tolist())), "z long, y long, x long, p long")
    got = np.zeros(shape)
    for r in stencil.over_blocks(df, "p", lambda a: stencil.grey_dilation(a, (1, 2, 2)), block=(2, 16, 16), halo=(1, 2, 2)).collect():
        got[r.z, r.y, r.x] = r.out
    assert (got == stencil.grey_dilation(dense, (1, 2, 2))).all()


def test_thin_boundaries():
    a = np.array([[[1, 0, 0, 0, 2], [1, 0, 0, 0, 2]]])
    assert stencil.thin_boundaries(a)[0, 0].tolist() == [1, 1, 1, 2, 2]
    assert (stencil.thin_boundaries(np.zeros((1, 3, 3), int)) == 0).all()


def test_spine_necks():
    mask = np.zeros((7, 12, 30), bool)
    mask[:, 1:11, 1:10] = mask[:, 2:10, 18:28] = True
    mask[3, 5, 10:18] = True
    out, n = stencil.spine_necks(mask, 2, minimum=4)
    assert out[3, 5, 14] > 0 and out[3, 5, 5] == 0 and n >= 1
    assert stencil.spine_necks(np.zeros((3, 3, 3), bool), 1)[1] == 0


def volume(spark, dense, low=(0, 0, 0), name="p"):
    rows = [(*(int(a + b) for a, b in zip(p, low)), int(v)) for p, v in np.ndenumerate(dense)]
    return spark.createDataFrame(rows, f"z long, y long, x long, {name} long")


def gathered(df, shape, low=(0, 0, 0), name="out"):
    out = np.zeros(shape)
    for r in df.collect():
        out[tuple(int(a - b) for a, b in zip((r.z, r.y, r.x), low))] = r[name]
    return out


def test_flooding_equals_one_voxel_at_a_time():
    import heapq

    for planes in (False, True):
        image = draw.integers(0, 6, (3, 12, 11)).astype(np.uint8)
        markers = np.where(draw.random(image.shape) < 0.05, draw.integers(1, 9, image.shape), 0)
        want, heap, n = markers.copy(), [], 0
        for z, y, x in sorted(zip(*np.nonzero(markers)), key=lambda p: p[::-1]):
            heap.append((int(image[z, y, x]), n, (int(z), int(y), int(x))))
            n += 1
        heapq.heapify(heap)
        while heap:
            level, _, at = heapq.heappop(heap)
            for s in [s for s in stencil.AXIS_STEPS if not planes or s[0] == 0]:
                to = tuple(a + b for a, b in zip(at, s))
                if all(0 <= a < m for a, m in zip(to, want.shape)) and not want[to]:
                    want[to] = want[at]
                    heapq.heappush(heap, (max(level, int(image[to])), n, to))
                    n += 1
        assert (stencil.watershed(image, markers, planes=planes) == want).all()


def test_blocks_smooth_as_the_whole_volume(spark):
    dense, low = draw.integers(0, 256, (7, 21, 18)), (5, 3, 2)
    got = gathered(stencil.over_blocks(volume(spark, dense, low), "p", lambda a: stencil.gaussian(a, (0.5, 1, 1)), block=(4, 8, 8), halo=(2, 4, 4)), dense.shape, low)
    assert np.allclose(got, stencil.gaussian(dense, (0.5, 1, 1)))
    flat = volume(spark, np.full((4, 9, 9), 200), low)
    assert np.allclose(gathered(stencil.over_blocks(flat, "p", lambda a: stencil.gaussian(a, (0.5, 1, 1)), block=(4, 8, 8), halo=(2, 4, 4)), (4, 9, 9), low), 200)
    assert not stencil.label_blocks(flat, "p", lambda a: stencil.segment(a, sigma=(0.5, 1, 1)), block=(4, 8, 8), halo=(3, 5, 5)).where("local > 0").take(1)


def test_blocks_have_the_seeds_of_the_whole_volume(spark):
    dense = draw.integers(0, 256, (6, 20, 20))
    told = stencil.label_blocks(volume(spark, dense), "p", lambda a: stencil.find_seeds(a, sigma=(0.5, 1, 1))[0], block=(4, 8, 8), halo=(3, 5, 5)).where("own")
    whole = stencil.find_seeds(dense, sigma=(0.5, 1, 1))[0]
    assert ((gathered(told, dense.shape, name="local") > 0) == (whole > 0)).all() and whole.max() > 3
    one = told.where("local > 0").groupBy("block", "local").count().count()
    assert one >= whole.max()


def test_vesicles_across_blocks_equal_the_whole_volume(spark):
    dense = stencil.gaussian(np.random.default_rng(3).integers(0, 256, (6, 24, 24)), (0.7, 1.5, 1.5))
    dense = ((dense - dense.min()) / np.ptp(dense) * 255).astype(int)
    want, n = stencil.vesicle(dense, threshold=165)
    got = gathered(stencil.vesicles(volume(spark, dense), "p", threshold=165, block=(4, 8, 8)), dense.shape)
    assert n > 2 and (got == want).all()


@pytest.mark.parametrize("share", [0.3, 0.002, 0.0])
def test_thinned_volume_has_the_nearest_labels(spark, share):
    dense = np.where(draw.random((5, 18, 17)) < share, draw.integers(1, 9, (5, 18, 17)), 0)
    fore = np.argwhere(dense)
    want = dense.copy()
    if len(fore):
        for p in np.argwhere(dense == 0):
            far = ((fore - p) ** 2).sum(1)
            want[tuple(p)] = min(dense[tuple(q)] for q in fore[far == far.min()])
    got = stencil.thinned(volume(spark, dense, name="a"), "a", block=(4, 8, 8), halo=2)
    assert got.count() == dense.size and (gathered(got, dense.shape, name="a") == want).all()
    assert (stencil.nearest_labels(dense)[0] == want).all()


def test_spine_necks_are_what_an_opening_takes():
    mask = np.zeros((9, 9, 40), bool)
    mask[1:8, 1:8, 2:12] = mask[1:8, 1:8, 28:38] = True
    mask[4, 4, 12:28] = True
    necks, n = stencil.spine_necks(mask, 2.0)
    assert n >= 1 and len(set(necks[4, 4, 14:26].tolist())) == 1 and (necks[4, 4, 14:26] > 0).all() and not necks[4, 4, 6] and not necks[~mask].any()
    core = np.argwhere(stencil.distance_transform(np.pad(mask, 1))[1:-1, 1:-1, 1:-1] > 2.0)
    for p in np.argwhere(necks):
        assert ((core - p) ** 2).sum(1).min() > 4


def test_convolution_and_pooling_equal_loops():
    from voxlake.operators import network

    a, w, b = draw.normal(size=(2, 3, 6, 7)), draw.normal(size=(3, 2, 1, 3, 2)), draw.normal(size=3)
    want = np.array([[[[(a[:, z : z + 1, y : y + 3, x : x + 2] * w[o]).sum() + b[o] for x in range(6)] for y in range(4)] for z in range(3)] for o in range(3)])
    assert np.allclose(network.convolved(a, w, b), want)
    assert np.allclose(network.pooled(a, (1, 2, 3)), [[[[a[c, z, 2 * y : 2 * y + 2, 3 * x : 3 * x + 3].max() for x in range(2)] for y in range(3)] for z in range(3)] for c in range(2)])
    assert np.allclose(network.softmax(a).sum(0), 1)
    deep = draw.normal(size=(8, 2, 3, 4))
    out = network.depth_to_space(deep, 2)
    assert out.shape == (2, 2, 6, 8) and all(out[c, z, 2 * y + i, 2 * x + j] == deep[4 * c + 2 * i + j, z, y, x] for c in range(2) for z in range(2) for y in range(3) for x in range(4) for i in range(2) for j in range(2))
    parts = {(0, i, j): a[:, :, i::2, j::2][:, :, :3, :3] for i in range(2) for j in range(2)}
    assert np.allclose(network.interwoven(parts, (1, 2, 2)), a[:, :, :6, :6])


def test_network_on_blocks_equals_the_whole_volume(spark, tmp_path):
    from voxlake.operators import classify, network

    layer = lambda o, i: (draw.normal(0, 0.3, (o, i, 1, 3, 3)), draw.normal(size=o))
    net = network.u_net([layer(3, 1), layer(4, 3), layer(3, 7), (draw.normal(size=(2, 3, 1, 1, 1)), np.zeros(2))], ["one", "two"])
    net.pad = (0, 8, 8)
    net.save(str(tmp_path / "net.json"))
    net = network.load(str(tmp_path / "net.json"))
    assert network.load(str(tmp_path / "net.json")) is net
    dense = draw.integers(0, 256, (2, 16, 24))
    got = classify.classified(volume(spark, dense), "p", net.classifier(), block=(2, 8, 8)).collect()
    for name in ("one", "two"):
        found = np.zeros(dense.shape)
        for r in got:
            if r.channel == name:
                found[r.z, r.y, r.x] = r.value
        for y in (0, 8):
            for x in (0, 8, 16):
                edge = np.pad(dense, [(0, 0), (8, 8), (8, 8)], mode="symmetric")[:, y : y + 24, x : x + 24].astype(float)
                image = net.classifier().run(edge, 0, 0, 0)[name]
                off = [(n - 8) // 2 for n in image.shape[1:]]
                assert (found[:, y : y + 8, x : x + 8] == image[:, off[0] : off[0] + 8, off[1] : off[1] + 8]).all()


def test_surfaces_are_closed(spark):
    from collections import Counter

    from voxlake.operators import surfaces

    ball = sum((np.indices((9, 9, 9))[k] - 4) ** 2 for k in range(3)) <= 9
    ball[0, 0, 0] = True
    rows = surfaces.marching_surface(volume(spark, np.where(ball, 7, 0), name="a"), "a").collect()
    faces = [tuple((r[f"z{i}"], r[f"y{i}"], r[f"x{i}"]) for i in (1, 2, 3)) for r in rows]
    ways = Counter((f[i], f[(i + 1) % 3]) for f in faces for i in range(3))
    assert all(n == 1 and ways[b, a] == 1 for (a, b), n in ways.items())
    content = sum(np.dot(f[0], np.cross(f[1], f[2])) for f in np.array(faces)) / 6
    points, sides = len({p for f in faces for p in f}), len(ways) // 2
    assert points - sides + len(faces) == 4 and 0.5 * ball.sum() < abs(content) < ball.sum()
    assert not surfaces.cube_triangles()[0] and not surfaces.cube_triangles()[255]


def brute_affinity(aff, low, high, size):
    """Basins and joins one edge at a time."""
    shape = aff.shape[1:]
    links = {}
    for p in np.ndindex(shape):
        for k in range(3):
            q = tuple(c - (i == k) for i, c in enumerate(p))
            if q[k] >= 0:
                links[p, q] = float(aff[(k, *p)])
    root = {p: p for p in np.ndindex(shape)}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    def join(a, b):
        a, b = sorted((top(a), top(b)))
        root[b] = a

    seen = set()
    for p in np.ndindex(shape):
        own = [(-w, b if a == p else a) for (a, b), w in links.items() if p in (a, b) and w > low]
        if own:
            join(p, min(own)[1])
            seen |= {p, min(own)[1]}
    for (a, b), w in links.items():
        if w >= high:
            join(a, b)
            seen |= {a, b}
    basin = {p: top(p) for p in seen}
    number = {r: i + 1 for i, r in enumerate(sorted(set(basin.values())))}
    part, count = {n: n for n in number.values()}, {}
    for r in basin.values():
        count[number[r]] = count.get(number[r], 0) + 1
    while True:
        best = {}
        for (a, b), w in links.items():
            if a in basin and b in basin:
                u, v = sorted((part[number[basin[a]]], part[number[basin[b]]]))
                if u != v and w >= low and min(count[u], count[v]) < size:
                    best[u, v] = max(best.get((u, v), 0), w)
        if not best:
            return {p: part[number[r]] for p, r in basin.items()}
        (u, v), _ = min(best.items(), key=lambda e: (-e[1], e[0]))
        part = {k: u if x == v else x for k, x in part.items()}
        count[u] += count.pop(v)


@pytest.mark.parametrize("at_once", [1 << 20, 0])
def test_affinity_segments_equal_one_join_at_a_time(spark, at_once):
    from voxlake.operators import affinity

    aff = draw.integers(0, 40, (3, 3, 9, 8))
    rows = [(*map(int, p), *(int(aff[(k, *p)]) for k in range(3))) for p in np.ndindex(3, 9, 8)]
    df = spark.createDataFrame(rows, "z long, y long, x long, az long, ay long, ax long")
    want = brute_affinity(aff, 4, 39, 12)
    got = {(r.z, r.y, r.x): r.segment for r in affinity.segments(df, low=4, high=39, size=12, at_once=at_once).collect()}
    assert len(got) == len(rows) and {p for p, s in got.items() if s} == set(want)
    pairs = {(got[p], s) for p, s in want.items()}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs}) > 2
    large = {(r.z, r.y, r.x): r.segment for r in affinity.segments(df, low=4, high=39, size=2, minimum=6).collect()}
    sizes = {s: sum(x == s for x in large.values()) for s in set(large.values()) - {0}}
    assert sizes and min(sizes.values()) >= 6
    means = {(r.z, r.y, r.x): r.segment for r in affinity.segments(df, low=4, high=39, threshold=25).collect()}
    assert len(set(means.values())) > len(set(got.values()))


def test_absorbed_labels(spark):
    from voxlake.operators import agglomerate

    dense = np.zeros((1, 5, 12), int)
    dense[0, :, :4], dense[0, :, 4], dense[0, 1, 5:7], dense[0, :, 7:10], dense[0, 4, 11] = 3, 8, 9, 5, 6
    got = gathered(agglomerate.absorbed(volume(spark, dense, name="a"), "a", 6), dense.shape, name="a")
    assert (got[0, :, 4] == 3).all() and got[0, 1, 5:7].tolist() == [3, 5] and got[0, 4, 11] == 0 and (got[0, :, 7:10] == 5).all() and got[0, 0, 5] == 0


def test_two_passes_join_more_than_one():
    edges = {(1, 2): (0.01, 5), (2, 3): (0.2, 1), (3, 4): (0.9, 2), (0, 1): (0.8, 1), (0, 3): (0.8, 1), (1, 5): (0.9, 4), (2, 5): (0.9, 4)}
    out = matching.two_pass(edges, 0.06, 0.3)
    assert out == {2: 1, 3: 1, 4: 1, 5: 1}
    assert matching.two_pass(edges, 0.0, 0.0, keep={4, 5}) == {}
