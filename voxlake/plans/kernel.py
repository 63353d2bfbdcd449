"""Queries by kernels that SQL can't express; each is tested against a brute-force version or worked cases."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..operators import matching, overlap, stencil
from ..spark import table
from .agreement import cells
from .naming import Collected, rounded
from .views import view

query = Collected()
BLOCK, KEYS = (4, 32, 32), ("z", "y", "x")


def _weights(sigma: float, reach: int) -> str:
    """The weights of a Gaussian as SQL rows (place, weight)."""
    w = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return ", ".join(f"({k}, {x:.17e})" for k, x in zip(range(-reach, reach + 1), w / w.sum(), strict=True))


def _mirrored(axis: str) -> str:
    low, high = f"{axis}0", f"{axis}1"
    return f"CASE WHEN {axis} + d < {low} THEN 2 * {low} - 1 - {axis} - d WHEN {axis} + d > {high} THEN 2 * {high} + 1 - {axis} - d ELSE {axis} + d END"


#: The whole box of a volume, 0 where it has no voxel, smoothed axis by axis with mirrored ends.
SMOOTH = f"""ends AS (SELECT MIN(z) AS z0, MAX(z) AS z1, MIN(y) AS y0, MAX(y) AS y1, MIN(x) AS x0, MAX(x) AS x1 FROM vox),
box AS (SELECT q.z, q.y, q.x, CAST(COALESCE(p, 0) AS DOUBLE) AS v FROM (SELECT z, y, x FROM ends, (SELECT unnest(range(0, 9)) AS z), (SELECT unnest(range(0, 64)) AS y), (SELECT unnest(range(0, 64)) AS x) WHERE z BETWEEN z0 AND z1 AND y BETWEEN y0 AND y1 AND x BETWEEN x0 AND x1) q
LEFT JOIN vox ON vox.z = q.z AND vox.y = q.y AND vox.x = q.x),
sz AS (SELECT t.z, t.y, t.x, SUM(w * box.v) AS v FROM (SELECT b.z, b.y, b.x, w, {_mirrored("z")} AS k FROM box b, ends, (VALUES {_weights(0.5, 2)}) AS g(d, w)) t JOIN box ON box.z = k AND box.y = t.y AND box.x = t.x GROUP BY 1, 2, 3),
sy AS (SELECT t.z, t.y, t.x, SUM(w * sz.v) AS v FROM (SELECT b.z, b.y, b.x, w, {_mirrored("y")} AS k FROM box b, ends, (VALUES {_weights(1.0, 4)}) AS g(d, w)) t JOIN sz ON sz.z = t.z AND sz.y = k AND sz.x = t.x GROUP BY 1, 2, 3),
smooth AS (SELECT t.z, t.y, t.x, SUM(w * sy.v) AS v FROM (SELECT b.z, b.y, b.x, w, {_mirrored("x")} AS k FROM box b, ends, (VALUES {_weights(1.0, 4)}) AS g(d, w)) t JOIN sy ON sy.z = t.z AND sy.y = t.y AND sy.x = k GROUP BY 1, 2, 3)"""


@query(f"WITH {SMOOTH} SELECT z, y, x, round(v, 5) AS out FROM smooth SEMI JOIN vox USING (z, y, x)", "vox")
def gaussian(spark, d):
    return rounded(stencil.over_blocks(view(spark, d, "vox"), "p", lambda a: stencil.gaussian(a, (0.5, 1.0, 1.0)), block=BLOCK, halo=(2, 4, 4)), "out", digits=5)


@query(f"""WITH {SMOOTH}, r AS (SELECT z, y, x, round(v, 6) AS v FROM smooth),
low AS (SELECT c.z, c.y, c.x, c.v, MIN(o.v) AS m FROM r c, (VALUES (-1), (0), (1)) AS k(dz), (VALUES (-1), (0), (1)) AS j(dy), (VALUES (-1), (0), (1)) AS i(dx) JOIN r o ON o.z = c.z + dz AND o.y = c.y + dy AND o.x = c.x + dx GROUP BY 1, 2, 3, 4)
SELECT z, y, x FROM low SEMI JOIN vox USING (z, y, x) WHERE v = m AND v < 128""", "vox")
def seed_places(spark, d):
    """Where the smoothed probability has its minima under the threshold."""
    return _labelled(spark, d, lambda a: stencil.find_seeds(a, sigma=(0.5, 1, 1))[0], (3, 5, 5)).where("out > 0").select(*KEYS)


@query("""WITH ends AS (SELECT MIN(z) AS z0, MAX(z) AS z1, MIN(y) AS y0, MAX(y) AS y1, MIN(x) AS x0, MAX(x) AS x1 FROM vox), f AS (SELECT z, y, x FROM vox WHERE p >= 128)
SELECT c.z, c.y, c.x, round(least(8, COALESCE(MIN(sqrt(CAST(16 * (f.z - c.z) * (f.z - c.z) + (f.y - c.y) * (f.y - c.y) + (f.x - c.x) * (f.x - c.x) AS DOUBLE))), 8)), 6) AS out
FROM vox c LEFT JOIN f ON f.z BETWEEN c.z - 2 AND c.z + 2 AND f.y BETWEEN c.y - 8 AND c.y + 8 AND f.x BETWEEN c.x - 8 AND c.x + 8 GROUP BY 1, 2, 3""", "vox")
def distance_transform(spark, d):
    """Distances in nm, cut off at what the halo can tell."""
    reach = 8.0
    kernel = lambda a: np.minimum(stencil.distance_transform(a < 128, (4.0, 1.0, 1.0)), reach)
    return rounded(stencil.over_blocks(view(spark, d, "vox"), "p", kernel, block=BLOCK, halo=(2, 8, 8)), "out")


def _labelled(spark, d, kernel, halo):
    """(block, z, y, x, out): a block's own labels, which are told apart by the block's name."""
    told = stencil.label_blocks(view(spark, d, "vox"), "p", kernel, block=(8, 32, 32), halo=halo)
    return told.where("own").select("block", *KEYS, F.col("local").alias("out"))


@query()
def watershed_segments(spark, d):
    return _labelled(spark, d, lambda a: stencil.segment(a, sigma=(0.5, 1, 1)), (3, 5, 5))


@query()
def seeds(spark, d):
    return _labelled(spark, d, lambda a: stencil.find_seeds(a, sigma=(0.5, 1, 1))[0], (3, 5, 5))


def _pieces(of: str, name: str, near: str) -> str:
    """Connected places of `of` (i, z, y, x) as `name` (i, root), in SQL."""
    return f"""{name}_step AS (SELECT c.i AS u, o.i AS v FROM {of} c JOIN {of} o ON {near}),
{name}_reach AS (SELECT i AS u, i AS v FROM {of} UNION SELECT r.u, s.v FROM {name}_reach r JOIN {name}_step s ON s.u = r.v), {name} AS (SELECT u AS i, MIN(v) AS root FROM {name}_reach GROUP BY u)"""


@query(f"""WITH RECURSIVE {SMOOTH}, bright AS (SELECT z * 10000 + y * 100 + x AS i, z, y, x FROM smooth SEMI JOIN vox USING (z, y, x) WHERE v > 170),
{_pieces("bright", "flat", "o.z = c.z AND abs(o.y - c.y) + abs(o.x - c.x) = 1")},
solid AS (SELECT bright.* FROM bright JOIN flat ON flat.i = bright.i WHERE root IN (SELECT root FROM flat GROUP BY root HAVING COUNT(*) BETWEEN 2 AND 100000)),
{_pieces("solid", "body", "abs(o.z - c.z) <= 1 AND abs(o.y - c.y) <= 1 AND abs(o.x - c.x) <= 1 AND abs(o.z - c.z) + abs(o.y - c.y) + abs(o.x - c.x) BETWEEN 1 AND 2")},
kept AS (SELECT root, CAST(row_number() OVER (ORDER BY root) AS BIGINT) AS out FROM body JOIN solid ON solid.i = body.i GROUP BY root HAVING COUNT(*) >= 4 AND MAX(z) - MIN(z) >= 1)
SELECT z, y, x, out FROM solid JOIN body ON body.i = solid.i JOIN kept ON kept.root = body.root""", "vox")
def vesicles(spark, d):
    return stencil.vesicles(view(spark, d, "vox"), "p", threshold=170)


@query("""WITH f AS (SELECT * FROM vox WHERE a <> 0), g AS (SELECT c.z, c.y, c.x, f.a, row_number() OVER (PARTITION BY c.z, c.y, c.x ORDER BY (f.z - c.z) * (f.z - c.z) + (f.y - c.y) * (f.y - c.y) + (f.x - c.x) * (f.x - c.x), f.a) AS k
FROM vox c JOIN f ON abs(f.z - c.z) <= 16 AND abs(f.y - c.y) <= 16 AND abs(f.x - c.x) <= 16 WHERE c.a = 0) SELECT z, y, x, a FROM f UNION ALL SELECT z, y, x, a FROM g WHERE k = 1""", "vox")
def thin_boundaries(spark, d):
    return stencil.thinned(view(spark, d, "vox"), "a", block=BLOCK)


@query()
def contrast_equalised(spark, d):
    return stencil.over_blocks(view(spark, d, "vox"), "p", lambda a: stencil.clahe(a).astype(float), block=(4, 64, 64), halo=(0, 0, 0), kind="long")


def _per_plane(spark, d, run, schema):
    """A kernel on the contingency of each plane, as a block pair has it."""
    vox = view(spark, d, "vox").where("a <> 0 and b <> 0")
    return vox.groupBy("z", "a", "b").agg(F.count("*").alias("n")).groupBy("z").applyInArrow(run, schema)


def _table(z, pairs) -> pa.Table:
    return pa.table({"z": pa.array([z] * len(pairs), pa.int64()), "a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})


def _counts(rows: pa.Table) -> dict:
    return {(a, b): n for a, b, n in zip(*(rows.column(c).to_pylist() for c in ("a", "b", "n")), strict=True)}


def _areas(counts: dict) -> tuple[dict, dict]:
    out: tuple[dict, dict] = ({}, {})
    for pair, n in counts.items():
        for side, x in zip(out, pair, strict=True):
            side[x] = side.get(x, 0) + n
    return out


@query()
def stable_match(spark, d):
    def run(rows: pa.Table) -> pa.Table:
        counts = _counts(rows)
        return _table(rows.column("z")[0].as_py(), matching.stable_pairs(counts, minimum=5, areas=_areas(counts)))

    return _per_plane(spark, d, run, "z long, a long, b long")


@query()
def assignment_by_overlap(spark, d):
    def run(rows: pa.Table) -> pa.Table:
        counts = _counts(rows)
        return _table(rows.column("z")[0].as_py(), matching.assign_by_overlap(counts, *_areas(counts), share=0.05))

    return _per_plane(spark, d, run, "z long, a long, b long")


@query()
def assignment_by_distance(spark, d):
    vox = view(spark, d, "vox")
    centre = lambda c: vox.where(F.col(c) != 0).groupBy("z", F.col(c).alias("label")).agg(F.avg("y").alias("y"), F.avg("x").alias("x")).withColumn("side", F.lit(c))

    def run(rows: pa.Table) -> pa.Table:
        sides: dict = {"a": {}, "b": {}}
        for r in rows.to_pylist():
            sides[r["side"]][r["label"]] = (r["y"], r["x"])
        return _table(rows.column("z")[0].as_py(), matching.assign_by_distance(sides["a"], sides["b"], 20.0))

    return centre("a").unionByName(centre("b")).groupBy("z").applyInArrow(run, "z long, a long, b long")


def _graph(spark, d):
    """Each segment's region graph: customers, an edge a row, by market segment."""
    c = table(spark, d, "customer")
    e = c.select(F.col("c_mktsegment").alias("part"), F.col("c_custkey").alias("u"), (F.col("c_custkey") - 1 - F.col("c_nationkey")).alias("v")).where("v >= 0")
    return e.withColumn("weight", (F.col("u") * 7 + F.col("v")) % 100 / 100.0)


def _nodes(part: str, found: dict, name: str) -> pa.Table:
    keys = sorted(found)
    return pa.table({"part": pa.array([part] * len(keys), pa.string()), "node": pa.array(keys, pa.int64()), name: pa.array([found[k] for k in keys], pa.int64())})


def _edges(rows: pa.Table) -> list:
    return list(zip(rows.column("u").to_pylist(), rows.column("v").to_pylist(), strict=True))


@query()
def greedy_agglomeration(spark, d):
    def run(rows: pa.Table) -> pa.Table:
        edges = {e: (w, 1) for e, w in zip(_edges(rows), rows.column("weight").to_pylist(), strict=True)}
        return _nodes(rows.column("part")[0].as_py(), matching.greedy_agglomeration(edges, 0.3), "root")

    return _graph(spark, d).groupBy("part").applyInArrow(run, "part string, node long, root long")


@query("""WITH RECURSIVE e AS (SELECT c_mktsegment AS part, c_custkey AS u, c_custkey - 1 - c_nationkey AS v FROM customer WHERE c_custkey - 1 - c_nationkey >= 0), b AS (SELECT part, u, v FROM e UNION SELECT part, v, u FROM e),
nd AS (SELECT DISTINCT part, u AS n FROM b), border AS (SELECT part, MIN(n) AS r FROM nd GROUP BY part), cut AS (SELECT part, n AS c FROM nd WHERE n NOT IN (SELECT r FROM border WHERE border.part = nd.part) UNION ALL SELECT part, -1 FROM border),
reach AS (SELECT cut.part, c, r AS n FROM cut JOIN border ON border.part = cut.part UNION SELECT reach.part, reach.c, b.v FROM reach JOIN b ON b.part = reach.part AND b.u = reach.n AND b.v <> reach.c),
inner_ AS (SELECT f.part, cut.c, f.n FROM reach f JOIN cut ON cut.part = f.part AND cut.c <> -1 AND cut.c <> f.n JOIN reach g ON g.part = f.part AND g.c = -1 AND g.n = cut.c LEFT JOIN reach r ON r.part = f.part AND r.c = cut.c AND r.n = f.n WHERE f.c = -1 AND r.n IS NULL)
SELECT part, n AS node, c AS "into" FROM inner_ i WHERE NOT EXISTS (SELECT 1 FROM inner_ o WHERE o.part = i.part AND o.n = i.c)""")
def inclusions(spark, d):
    def run(rows: pa.Table) -> pa.Table:
        edges = set(_edges(rows))
        return _nodes(rows.column("part")[0].as_py(), matching.inclusions(edges, border=min(x for e in edges for x in e)), "into")

    return _graph(spark, d).groupBy("part").applyInArrow(run, "part string, node long, into long")


@query()
def colouring(spark, d):
    def run(rows: pa.Table) -> pa.Table:
        edges = set(_edges(rows))
        return _nodes(rows.column("part")[0].as_py(), matching.colouring(edges, {x for e in edges for x in e}), "colour")

    return _graph(spark, d).groupBy("part").applyInArrow(run, "part string, node long, colour long")


@query()
def skeletons(spark, d):
    """A tree for each label of each plane block, in global places."""

    def run(rows: pa.Table) -> pa.Table:
        z, y, x = (rows.column(c).to_numpy() for c in KEYS)
        low = (z.min(), y.min(), x.min())
        mask = np.zeros([p.max() - s + 1 for p, s in zip((z, y, x), low, strict=True)], bool)
        mask[z - low[0], y - low[1], x - low[2]] = True
        nodes = stencil.skeleton(mask)
        cells_ = list(zip(*nodes, strict=True))
        return pa.table({"label": [rows.column("a")[0].as_py()] * len(nodes), "block": pa.array([rows.column("block")[0].as_py()] * len(nodes), pa.string()), "node": cells_[0], **{c: [int(p + s) for p in v] for c, v, s in zip(KEYS, cells_[1:4], low, strict=True)}, "radius": cells_[4], "parent": cells_[5]})

    vox = view(spark, d, "vox").where("a <> 0").withColumn("block", F.concat_ws("_", F.floor(F.col("y") / 16).cast("string"), F.floor(F.col("x") / 16).cast("string")))
    return vox.select("a", "block", *KEYS).groupBy("a", "block").applyInArrow(run, "label long, block string, node long, z long, y long, x long, radius double, parent long")


@query("""WITH RECURSIVE k AS (SELECT a, b, COUNT(*) AS n FROM vox WHERE a <> 0 AND b <> 0 GROUP BY a, b), p AS (SELECT a, b + 1000 AS b FROM (SELECT *, SUM(n) OVER (PARTITION BY a) AS ra, SUM(n) OVER (PARTITION BY b) AS rb FROM k) WHERE n * 100 >= ra * 20 OR n * 100 >= rb * 20),
e AS (SELECT a AS u, b AS v FROM p UNION SELECT b, a FROM p), reach AS (SELECT u AS node, u AS far FROM e UNION SELECT reach.node, e.v FROM reach JOIN e ON e.u = reach.far) SELECT node, MIN(far) AS root FROM reach GROUP BY node""", "vox")
def best_match_graph(spark, d):
    """Connected components of the matched labels of both segmentations, a's as they are and b's after them."""
    from ..operators.components import components

    pairs = overlap.overlap_match(cells(spark, d), 20)
    return components(pairs.select(F.col("a").alias("u"), (F.col("b") + 1000).alias("v")))


QUERIES, ORACLES = query.queries, query.oracles
