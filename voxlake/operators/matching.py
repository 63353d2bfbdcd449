"""Matchings and orders that are sequential by nature: each runs on one bounded problem (a block pair, a block's graph)."""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np


def stable_pairs(counts: dict[tuple[int, int], int], *, minimum: int = 1000, partners: int = 1, orphan_share: float = 0.9, areas: tuple[dict, dict] | None = None) -> list[tuple[int, int]]:
    """Stable marriage of labels by overlap, each with up to `partners`, then orphans that overlap their best partner by `orphan_share`.

    Both sides prefer larger overlaps, then smaller labels.
    """
    likes: tuple[dict, dict] = (defaultdict(list), defaultdict(list))
    for (a, b), n in counts.items():
        if n >= minimum:
            likes[0][a].append((-n, b))
            likes[1][b].append((-n, a))
    for side in likes:
        for x in side.values():
            x.sort()
    rank = {b: {a: i for i, (_, a) in enumerate(x)} for b, x in likes[1].items()}
    held: dict[int, list] = defaultdict(list)
    todo = [a for a in sorted(likes[0]) for _ in range(partners)]
    asked: dict[int, int] = defaultdict(int)
    while todo:
        a = todo.pop()
        if asked[a] >= len(likes[0][a]):
            continue
        b = likes[0][a][asked[a]][1]
        asked[a] += 1
        heapq.heappush(held[b], (-rank[b][a], a))
        if len(held[b]) > partners:
            todo.append(heapq.heappop(held[b])[1])
    pairs = {(a, b) for b, xs in held.items() for _, a in xs}
    if areas:
        done = ({a for a, _ in pairs}, {b for _, b in pairs})
        for side in (0, 1):
            for x, options in sorted(likes[side].items()):
                n, best = options[0]
                if x not in done[side] and -n >= orphan_share * areas[side][x]:
                    pairs.add((x, best) if side == 0 else (best, x))
    return sorted(pairs)


def assignment(cost: np.ndarray) -> np.ndarray:
    """The column of each row in a cheapest complete assignment (rows <= columns), by shortest augmenting paths."""
    n, m = cost.shape
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, used, way = np.full(m + 1, np.inf), np.zeros(m + 1, bool), np.zeros(m + 1, int)
        while True:
            used[j0] = True
            i0 = match[j0]
            free = ~used[1:]
            now = cost[i0 - 1] - u[i0] - v[1:]
            better = free & (now < least[1:])
            least[1:][better] = now[better]
            way[1:][better] = j0
            j1 = int(np.argmin(np.where(free, least[1:], np.inf))) + 1
            delta = least[j1]
            u[match[used]] += delta
            v[used] -= delta
            least[1:][free] -= delta
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0], j0 = match[way[j0]], way[j0]
    out = np.zeros(n, int)
    for j in range(1, m + 1):
        if match[j]:
            out[match[j] - 1] = j - 1
    return out


def assign_with_opt_out(cost: np.ndarray, out_rows: np.ndarray, out_cols: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of a cheapest assignment in which every row and column may stay alone at a cost of its own."""
    n, m = cost.shape
    if not n or not m:
        return []
    big = float(np.nanmax(np.where(np.isfinite(cost), cost, 0))) + float(out_rows.sum() + out_cols.sum()) + 1
    full = np.full((n + m, n + m), big)
    full[:n, :m] = np.where(np.isfinite(cost), cost, big)
    full[np.arange(n), m + np.arange(n)] = out_rows
    full[n + np.arange(m), np.arange(m)] = out_cols
    full[n:, m:] = 0
    picked = assignment(full)
    return [(i, int(picked[i])) for i in range(n) if picked[i] < m and full[i, picked[i]] < big]


def assign_by_overlap(counts: dict[tuple[int, int], int], area_gt: dict[int, int], area_found: dict[int, int], *, share: float = 0.0, share_gt: float = 0.0) -> list[tuple[int, int]]:
    """(gt, found) pairs of least joint area; overlaps under a share of either are none."""
    gt, found = sorted(area_gt), sorted(area_found)
    cost = np.full((len(gt), len(found)), np.inf)
    for (g, f), n in counts.items():
        if n and n >= share * area_found[f] and n >= share_gt * area_gt[g]:
            cost[gt.index(g), found.index(f)] = area_gt[g] + area_found[f] - n
    eps = 1e-6
    pairs = assign_with_opt_out(cost, np.array([area_gt[g] - eps for g in gt], float), np.array([area_found[f] - eps for f in found], float))
    return [(gt[i], found[j]) for i, j in pairs]


def assign_by_distance(gt: dict[int, tuple[float, ...]], found: dict[int, tuple[float, ...]], most: float) -> list[tuple[int, int]]:
    """(gt, found) pairs of least total distance, none over `most`, at which a point rather stays alone."""
    g, f = sorted(gt), sorted(found)
    cost = np.array([[float(np.linalg.norm(np.subtract(gt[a], found[b]))) for b in f] for a in g]).reshape(len(g), len(f))
    cost[cost > most] = np.inf
    return [(g[i], f[j]) for i, j in assign_with_opt_out(cost, np.full(len(g), most), np.full(len(f), most))]


def greedy_agglomeration(edges: dict[tuple[int, int], tuple[float, int]], threshold: float, keep: set[int] = frozenset()) -> dict[int, int]:
    """Joins the cheapest edge again and again while it costs at most `threshold`; parallel edges merge to their size-weighted mean.

    Nodes of `keep` never join. Returns each joined node's survivor, the smaller of the two.
    """
    around: dict[int, dict[int, tuple[float, int]]] = defaultdict(dict)
    for (a, b), e in edges.items():
        around[a][b] = around[b][a] = e
    heap = [(w, min(a, b), max(a, b)) for (a, b), (w, _) in edges.items()]
    heapq.heapify(heap)
    into: dict[int, int] = {}
    while heap:
        w, a, b = heapq.heappop(heap)
        if w > threshold:
            break
        if a in into or b in into or around[a].get(b, (None,))[0] != w or a in keep or b in keep:
            continue
        into[b] = a
        del around[a][b]
        for c, (wb, nb) in around.pop(b).items():
            if c == a:
                continue
            del around[c][b]
            wa, na = around[a].get(c, (0.0, 0))
            joined = ((wa * na + wb * nb) / (na + nb), na + nb)
            around[a][c] = around[c][a] = joined
            heapq.heappush(heap, (joined[0], min(a, c), max(a, c)))

    def last(x: int) -> int:
        while x in into:
            x = into[x]
        return x

    return {x: last(x) for x in into}


def two_pass(edges: dict[tuple[int, int], tuple[float, int]], first: float, second: float, border: int = 0, keep: set[int] = frozenset()) -> dict[int, int]:
    """Joins up to `first`, gives what one region encloses to it, and joins what is left up to `second`. Returns each joined node's survivor."""
    into = greedy_agglomeration(edges, first, keep)

    def contracted(into: dict[int, int]) -> dict[tuple[int, int], tuple[float, int]]:
        out: dict[tuple[int, int], tuple[float, int]] = {}
        for (a, b), (w, n) in edges.items():
            a, b = sorted((into.get(a, a), into.get(b, b)))
            if a != b:
                v, m = out.get((a, b), (0.0, 0))
                out[a, b] = ((v * m + w * n) / (m + n), m + n)
        return out

    inside = inclusions(set(contracted(into)), into.get(border, border), keep)
    follow = lambda x, to: {k: to.get(v, v) for k, v in x.items()} | {k: v for k, v in to.items() if k not in x}
    into = follow(into, inside)
    return follow(into, greedy_agglomeration(contracted(into), second, keep))


def inclusions(edges: set[tuple[int, int]], border: int = 0, preserved: set[int] = frozenset()) -> dict[int, int]:
    """Nodes that every path to the border takes through one node, and that node: blocks of the graph without the border, outermost first."""
    around: dict[int, set[int]] = defaultdict(set)
    for a, b in edges:
        around[a].add(b)
        around[b].add(a)
    order, low, children = {border: 0}, {border: 0}, defaultdict(list)
    stack = [(border, None, iter(sorted(around[border])))]
    into: dict[int, int] = {}
    while stack:
        at, parent, rest = stack[-1]
        for to in rest:
            if to not in order:
                order[to] = low[to] = len(order)
                children[at].append(to)
                stack.append((to, at, iter(sorted(around[to]))))
                break
            if to != parent:
                low[at] = min(low[at], order[to])
        else:
            stack.pop()
            if stack:
                low[parent] = min(low[parent], low[at])
                if low[at] >= order[parent] and parent != border:
                    todo, inside = [at], []
                    while todo:
                        x = todo.pop()
                        inside.append(x)
                        todo += children[x]
                    if not preserved.intersection(inside):
                        into |= dict.fromkeys(inside, parent)

    def outer(x: int) -> int:
        while into[x] in into:
            x = into[x]
        return into[x]

    return {x: outer(x) for x in into}


def colouring(edges: set[tuple[int, int]], nodes: set[int]) -> dict[int, int]:
    """The smallest colour from 1 that no neighbour has, node by node in order."""
    around: dict[int, set[int]] = defaultdict(set)
    for a, b in edges:
        around[a].add(b)
        around[b].add(a)
    out: dict[int, int] = {}
    for x in sorted(nodes):
        taken = {out[y] for y in around[x] if y in out}
        out[x] = next(c for c in range(1, len(taken) + 2) if c not in taken)
    return out
