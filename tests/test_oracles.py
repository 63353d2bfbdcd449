"""Every query that SQL can express, against DuckDB on the smallest tables."""

import itertools
import math
import os

import duckdb
import pytest

from voxlake.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    return f"{value:.6f}" if isinstance(value, float) else str(value)


def same(df, con, sql):
    cols = sorted(df.columns)
    got = sorted(tuple(plain(x) for x in r) for r in df.select(*cols).collect())
    told = con.sql(sql)
    assert sorted(told.columns) == cols
    order = [told.columns.index(c) for c in cols]
    want = sorted(tuple(plain(r[i]) for i in order) for r in told.fetchall())
    assert got == want


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, duck, name):
    same(registry.QUERIES[name](spark, DATA), duck, registry.ORACLES[name])


def lineitem(spark, folder, rows):
    """A folder with a table of (order, line, part, supplier, quantity, tax), and DuckDB on it."""
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_tax double").coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{folder}/lineitem.parquet/*.parquet'")
    return con


@pytest.mark.parametrize("quantities", [(50,), (20, 50), (1, 20, 50)])
@pytest.mark.parametrize("name", ["rand_by_threshold", "boundary_sweep"])
def test_thresholds_without_pairs_have_no_row(spark, tmp_path, name, quantities):
    """Quantities 50, 20 and 1 are probabilities of 250, 100 and 5."""
    con = lineitem(spark, tmp_path, [(o, 4 + o % 3, 16 + o % 30, 1, float(quantities[o % len(quantities)]), 0.0) for o in range(16, 60)])
    same(registry.QUERIES[name](spark, str(tmp_path)), con, registry.ORACLES[name])


def test_orientation_does_not_hang_on_the_order_of_rows(spark, tmp_path):
    """Taxes of 7, 7 and 1 % add up to 15.0 or 15.000000000000002, the other side's to 15.0: a tie."""
    rows = []
    for order, taxes in enumerate(itertools.permutations((0.07, 0.07, 0.01))):
        rows += [(order, line, 1, 1, quantity, tax) for line, quantity, tax in zip((2, 4, 6), (5.0, 5.0, 6.0), taxes, strict=True)]
        rows += [(order, line, 1, 1, quantity, 0.05) for line, quantity in ((1, 5.0), (3, 5.0), (5, 6.0))]
    lineitem(spark, tmp_path, rows)
    got = registry.QUERIES["synapse_orientation"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == [(order, False, 31.0) for order in range(6)]


def test_orientation_of_odd_rows(spark, tmp_path):
    """Sides without lines, without values and with an unknown line."""
    rows = [(1, 2, 1, 1, None, 0.01), (2, 2, 1, 1, None, None), (2, 1, 1, 1, 3.0, 0.02), (3, None, 1, 1, 3.0, 0.02), (4, 1, 1, 1, 9.0, 0.0), (4, 2, 1, 1, 8.0, 0.0), (None, 1, 1, 1, 2.0, 0.07), (5, 3, 1, 1, None, 0.03), (5, 3, 1, 1, 4.0, None)]
    con = lineitem(spark, tmp_path, rows)
    same(registry.QUERIES["synapse_orientation"](spark, str(tmp_path)), con, registry.ORACLES["synapse_orientation"])


@pytest.mark.parametrize("name", ["triplets", "triplets_of_one_side"])
def test_triplets_deal_lines_and_ends_at_once(spark, tmp_path, name):
    """Two lines of one id (order 1, line 11 and order 2, line 1) that share a neuron count once; lines told twice, lines of no order, line or part."""
    rows = [(1, 11, 5, 1, 1.0, 0.0), (2, 1, 5, 1, 1.0, 0.0), (2, 1, 5, 1, 1.0, 0.0), (2, 1, 9, 1, 1.0, 0.0), (2, 3, 7005, 1, 1.0, 0.0), (1, 2, None, 1, 1.0, 0.0), (3, 4, 5, 1, 1.0, 0.0), (None, 4, 5, 1, 1.0, 0.0), (3, None, 5, 1, 1.0, 0.0), (4, 1, 6, 1, 1.0, 0.0), (100005, 1, 5, 1, 1.0, 0.0)]
    con = lineitem(spark, tmp_path, rows)
    priced = tmp_path / "priced"
    spark.read.parquet(f"{tmp_path}/lineitem.parquet").selectExpr("*", "0.0D AS l_extendedprice").coalesce(1).write.parquet(f"{priced}/lineitem.parquet")  # the view of points names it
    con.sql(f"CREATE OR REPLACE VIEW lineitem AS SELECT * FROM '{priced}/lineitem.parquet/*.parquet'")
    met = registry.QUERIES[name](spark, str(priced))
    same(met, con, registry.ORACLES[name])
    assert met._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2  # by the id, one for each side; so small a side is broadcast to the other


def pairs_are_one_to_one(rows, _):
    return len({(r.z, r.a) for r in rows}) == len({(r.z, r.b) for r in rows}) == len(rows) > 0


def joined(rows, _):
    """Roots aren't themselves joined, and are the smaller."""
    into = {(r.part, r.node): r.root for r in rows}
    return rows and all((p, root) not in into and root < node for (p, node), root in into.items())


def voxels_once(rows, vox, value="out", low=0, high=None):
    places = [(r.z, r.y, r.x) for r in rows]
    return set(places) == set(vox) and len(places) == len(vox) and all(r[value] >= low and (high is None or r[value] <= high) for r in rows) and len({r[value] for r in rows}) > 2


def trees(rows, vox):
    """Of each label and block one root; parents are there; nodes are voxels of the label."""
    nodes = {(r.label, r.block, r.node) for r in rows}
    roots = [(r.label, r.block) for r in rows if r.parent == -1]
    return len(nodes) == len(rows) and len(roots) == len(set(roots)) == len({n[:2] for n in nodes}) and all(r.parent == -1 or (r.label, r.block, r.parent) in nodes for r in rows) and all(vox[r.z, r.y, r.x].a == r.label for r in rows)


def apart(rows, _):
    """Neighbours of a part have other colours, and each colour from 1 up is forced by a neighbour."""
    from voxlake.plans import kernel

    colour = {(r.part, r.node): r.colour for r in rows}
    edges = [(r.part, r.u, r.v) for r in kernel._graph(SPARK[0], DENSE).collect()]
    return min(colour.values()) == 1 and all(colour[p, u] != colour[p, v] for p, u, v in edges)


def block_labels(rows, vox):
    """The voxels of a label of a block are one piece at least of what it flooded, and no place is told twice."""
    places = [(r.z, r.y, r.x) for r in rows]
    return len(places) == len(set(places)) == len(vox) and len({(r.block, r.out) for r in rows if r.out}) > 3 and len({r.block for r in rows}) > 1


def shares(rows, vox):
    """Two channels a voxel, which add up to all of 0..255."""
    total: dict = {}
    for r in rows:
        total[r.z, r.y, r.x] = total.get((r.z, r.y, r.x), 0) + r.value
    return set(total) == set(vox) and all(254 <= t <= 256 for t in total.values())


def metadata(rows, vox):
    import json

    areas = [(x["label"], x["area"]) for r in rows for x in json.loads(r.metadata)["labels"]]
    return 0 < sum(a for _, a in areas) <= len(vox) and all(a > 0 for _, a in areas)


SPARK: list = []
DENSE = "/root/testdata/sf0.01"  # has most voxels of the box
#: What the rows of a query that SQL doesn't check have to be; brute-force versions of the kernels are in test_kernels.py and test_operators.py.
HOLDS = {
    "affinity_segments": lambda rows, vox: voxels_once(rows, vox, "segment"), "affinity_segments_by_mean": lambda rows, vox: voxels_once(rows, vox, "segment"),
    "absorbed_labels": lambda rows, vox: voxels_once(rows, vox, "a"), "agglomerated_segmentation": lambda rows, vox: rows and {r.label for r in rows} == set(range(1, max(r.label for r in rows) + 1)),
    "assignment_by_distance": pairs_are_one_to_one, "assignment_by_overlap": pairs_are_one_to_one, "stable_match": lambda rows, vox: rows and all(vox for _ in rows) and len({(r.z, r.a, r.b) for r in rows}) == len(rows),
    "colouring": apart, "contrast_equalised": lambda rows, vox: voxels_once(rows, vox, high=255), "edge_clusters": lambda rows, _: {r.cluster for r in rows} == {0, 1, 2},
    "edge_probability": lambda rows, _: rows and all(0 <= r.p <= 1 for r in rows) and len({(r.u, r.v) for r in rows}) == len(rows), "global_segmentation": lambda rows, vox: voxels_once(rows, vox, "global"),
    "greedy_agglomeration": joined, "two_pass_agglomeration": joined, "mutual_agglomeration": lambda rows, _: rows and all(r.root <= r.node for r in rows) and {r.root for r in rows if r.node in {x.root for x in rows}} == {x.root for x in rows},
    "seeds": block_labels, "watershed_segments": block_labels, "segmentation_metadata": metadata, "skeletons": trees, "spine_necks": lambda rows, vox: all(vox[r.z, r.y, r.x].b == 1 and r.neck > 0 for r in rows), "u_net_channels": shares,
}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_kernel_query_holds(spark, name):
    from voxlake.plans.views import view

    SPARK[:] = [spark]
    vox = {(r.z, r.y, r.x): r for r in view(spark, DENSE, "vox").collect()}
    assert HOLDS[name](registry.QUERIES[name](spark, DENSE).collect(), vox)


@pytest.mark.parametrize("name", ["interval_join_3d", "distance_pairs", "find_datasets", "containment_join"])
def test_interval_and_distance_joins_are_hash_joins(spark, name):
    if not os.path.isdir(DATA):
        pytest.skip("no tables here")
    plan = registry.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
