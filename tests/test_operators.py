"""Worked cases: overlaps, metrics, graphs, synapses, boxes."""

import math

import pytest
from pyspark.sql import functions as F

from voxlake.functions.boxes import Box
from voxlake.operators import catalog, graphs, joins, metrics, overlap, synapses
from voxlake.operators.components import components

V = (44, 22, 14, 1024, 2048, 117)
PROBES = [
    ((1068, 22, 14, 1024, 2048, 117), False), ((44, 2070, 14, 1024, 2048, 117), False), ((44, 22, 131, 1024, 2048, 117), False),
    ((0, 22, 14, 44, 2048, 117), False), ((44, 0, 14, 1024, 22, 117), False), ((44, 22, 0, 1024, 2048, 14), False),
    ((1067, 22, 14, 1024, 2048, 117), True), ((44, 2069, 14, 1024, 2048, 117), True), ((44, 22, 130, 1024, 2048, 117), True),
    ((0, 22, 14, 45, 2048, 117), True), ((44, 0, 14, 1024, 23, 117), True), ((44, 22, 0, 1024, 2048, 15), True),
]


def boxes(spark, rows, *more):
    """Rows (id, x, y, z, w, h, d, ...)."""
    df = spark.createDataFrame(rows, ", ".join(["id long, x long, y long, z long, w long, h long, d long", *more]))
    return df.withColumns({"x1": F.col("x") + F.col("w"), "y1": F.col("y") + F.col("h"), "z1": F.col("z") + F.col("d")}).drop("w", "h", "d")


def test_boxes_overlap_strictly(spark):
    one = boxes(spark, [(0, *V)])
    others = boxes(spark, [(i, *p) for i, (p, _) in enumerate(PROBES, 1)])
    want = {i for i, (_, hit) in enumerate(PROBES, 1) if hit}
    assert {r.r_id for r in joins.range_join(one, others, tile=(256, 256, 64)).collect()} == want
    assert {r.id for r in others.where(Box.of(*V).overlaps(Box(others))).collect()} == want


def test_find_datasets_by_type_and_source(spark):
    datasets = boxes(spark, [(1, *V, "image", 7), (2, *V, "image", 8), (3, *V, "gt", 7)], "type string", "task long")
    requests = boxes(spark, [(10, *V, "image", None), (11, *V, "image", 8)], "type string", "src_task long")
    got = {tuple(r) for r in catalog.find_datasets(datasets, requests).collect()}
    assert got == {(10, 1), (10, 2), (11, 2)}


def test_pieces_of_six_slabs(spark):
    producer = boxes(spark, [(1, 2048, 2048, 256, 1024, 1024, 128)])
    slabs = [(2068, 2078, 286, 10, 964, 68), (3042, 2078, 286, 10, 964, 68), (2078, 2068, 286, 964, 10, 68), (2078, 3042, 286, 964, 10, 68), (2078, 2078, 276, 964, 964, 10), (2078, 2078, 354, 964, 964, 10)]
    readers = boxes(spark, [(0, 2048, 2048, 256, 1024, 1024, 128), *[(i, *s) for i, s in enumerate(slabs, 1)]])
    pieces = catalog.subvolumes(producer, readers)
    assert pieces.count() == 125
    per = {r.reader: r["count"] for r in catalog.links(pieces, readers).groupBy("reader").count().collect()}
    assert per == {0: 125, **dict.fromkeys(range(1, 7), 1)}


A = {(1, 1): 1, (3, 4): 2, (5, 5): 3}


def pairs(spark, a, b):
    rows = [(z, y, 9, a.get((z, y), 0), b.get((z, y), 0)) for z in range(10) for y in range(10)]
    return overlap.contingency(spark.createDataFrame(rows, "z long, y long, x long, a long, b long"))


@pytest.mark.parametrize(
    ("a", "b", "percent", "both", "want"),
    [
        ({}, {}, 50, False, set()),
        (A, {(1, 1): 3, (3, 4): 4}, 50, False, {(1, 3), (2, 4)}),
        ({(1, 1): 1, (3, 4): 2, (3, 5): 2, (3, 6): 1}, {(1, 1): 3, (3, 4): 4, (3, 5): 3, (3, 6): 4}, 49, False, {(1, 3), (1, 4), (2, 3), (2, 4)}),
        ({(1, 1): 1, (3, 4): 2, (3, 5): 2, (3, 6): 1}, {(1, 1): 3, (3, 4): 4, (3, 5): 3, (3, 6): 4}, 51, False, set()),
        ({(1, 1): 1, (3, 4): 2, (3, 5): 2, (3, 6): 2}, {(1, 1): 3, (3, 4): 4, (3, 5): 3, (3, 6): 4}, 50, False, {(1, 3), (2, 3), (2, 4)}),
        ({(1, 1): 1, (3, 4): 2, (3, 5): 2, (3, 6): 2}, {(1, 1): 3, (3, 4): 4, (3, 5): 3, (3, 6): 4}, 50, True, {(1, 3), (2, 4)}),
    ],
)
def test_overlap_match(spark, a, b, percent, both, want):
    assert {(r.a, r.b) for r in overlap.overlap_match(pairs(spark, a, b), percent, both=both).collect()} == want


def test_exclusions(spark):
    table = pairs(spark, A, {(1, 1): 3, (3, 4): 4})
    assert {(r.a, r.b) for r in overlap.excluded(table, one=spark.createDataFrame([(1,)], "a long")).collect()} == {(2, 4)}
    assert {(r.a, r.b) for r in overlap.excluded(table, two=spark.createDataFrame([(3,)], "b long")).collect()} == {(2, 4)}


def test_global_components(spark):
    nodes = spark.createDataFrame([(n,) for n in (1, 2, 11, 12, 13, 21, 22)], "node long")
    edges = spark.createDataFrame([(2, 11), (1, 21)], "u long, v long")
    got = {r.node: r["global"] for r in graphs.global_components(nodes, edges).collect()}
    assert got == {1: 1, 2: 2, 11: 2, 12: 3, 13: 4, 21: 1, 22: 5}


@pytest.mark.parametrize("at_once", [0, 1 << 20])
def test_components_of_a_chain_and_a_star(spark, at_once):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (500, 500)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long"), at_once=at_once).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 500: 500}


def cell_table(spark, rows):
    return spark.createDataFrame(rows, "a long, b long, n long")


def test_metrics_of_one_merge(spark):
    merge = cell_table(spark, [(1, 1, 2), (1, 2, 2)])
    r = metrics.split_vi(merge).first()
    assert (r.merge, r.split) == (1, 0)
    assert {x.alpha: round(x.rand, 6) for x in metrics.rand_f(merge).collect()} == {0.0: 0.5, 0.5: 0.666667, 1.0: 1.0}
    f = metrics.rand_family(merge).first()
    assert (f.pa, f.pb, f.pc, f.pd) == (2, 4, 0, 0) and math.isclose(f.rand_index, 1 / 3)


def test_metrics_of_identity(spark):
    same = cell_table(spark, [(1, 1, 2), (2, 2, 2)])
    f = metrics.rand_family(same).first()
    assert (f.rand_index, f.adjusted, f.fowlkes_mallows) == (1, 1, 1)
    assert metrics.split_vi(same).first().vi == 0


def test_merging_a_split_lowers_split_alone(spark):
    table = cell_table(spark, [(1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 3, 1)])
    r = metrics.merge_gain(table, spark.createDataFrame([(1, 2)], "a1 long, a2 long")).first()
    assert r.d_split < 0 and abs(r.d_merge) < 1e-12


def test_area_filter_is_strict(spark):
    rows = [(0, 0, i, k) for k, n in ((1, 5), (2, 10), (3, 11)) for i in range(n)]
    got = overlap.area_filter(spark.createDataFrame(rows, "z long, y long, x long, a long"), "a", 10).collect()
    assert [(r.label, r.area, r.renumbered) for r in got] == [(3, 11, 1)]


def test_star_join_connects_without_all_pairs(spark):
    one, two = spark.createDataFrame([(1, 9), (2, 9)], "a long, m long"), spark.createDataFrame([(5, 9), (6, 9)], "b long, m long")
    assert {tuple(r) for r in joins.star_join(one, two, "m", "a", "b").collect()} == {(1, 5), (1, 6), (2, 5)}


def test_top_two(spark):
    contacts = spark.createDataFrame([(1, 7, 40), (1, 8, 30), (1, 9, 20), (2, 7, 50)], "synapse long, neuron long, n long")
    assert [(r.synapse, r.neuron_1, r.neuron_2) for r in synapses.top_two(contacts, 10).collect()] == [(1, 7, 8)]


def test_duplicates_lose_to_the_larger_score(spark):
    points = spark.createDataFrame([(1, 0, 0, 0, 5.0), (2, 25, 0, 0, 3.0), (3, 1000, 0, 0, 1.0), (4, 1010, 0, 0, 1.0)], "id long, px long, py long, pz long, score double")
    assert {r.id for r in synapses.without_duplicates(points).collect()} == {1, 4}


def test_triplets(spark):
    s = spark.createDataFrame([(1, 4, 10), (2, 4, 11), (3, 12, 4)], "synapse long, neuron_1 long, neuron_2 long")
    assert {(r.s1, r.s2) for r in synapses.triplets(s).collect()} == {(1, 2), (1, 3), (2, 3)}


def test_triplets_read_each_side_once(spark, tmp_path):
    rows = [(1, 4, 10), (1, 4, 10), (2, 4, 4), (3, 12, 4), (4, None, 10), (5, None, None)]  # told twice, one neuron on both sides, none
    spark.createDataFrame(rows, "synapse long, neuron_1 long, neuron_2 long").write.parquet(str(tmp_path / "s"))
    met = synapses.triplets(spark.read.parquet(str(tmp_path / "s")))
    assert sorted(tuple(r) for r in met.collect()) == [(4, 1, 2), (4, 1, 3), (4, 2, 3), (10, 1, 4)]
    assert met._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2


def test_synapse_score(spark):
    r = synapses.score(spark.createDataFrame([(1,), (0,)], "n long"), spark.createDataFrame([(1,), (0,), (0,)], "n long")).first()
    assert (r.tp, r.double, r.merged) == (1, 0, 0) and math.isclose(r.precision, 1 / 3) and r.recall == 0.5


def test_rebase(spark):
    one = spark.createDataFrame([("p", 1, 10)], "block string, local long, one long")
    two = spark.createDataFrame([("p", 1, 99)], "block string, local long, two long")
    assert [tuple(r) for r in graphs.rebase(one, two).collect()] == [(10, 99)]


def test_joins_by_hash(spark):
    """No nested loops, even without statistics."""
    a = boxes(spark, [(1, *V)])
    plan = joins.range_join(a, a)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_rounds_join_mutual_minima(spark):
    from voxlake.operators import agglomerate

    nodes = spark.createDataFrame([(n,) for n in range(1, 7)], "node long")
    edges = spark.createDataFrame([(1, 2, 0.1, 1), (2, 3, 0.15, 1), (1, 3, 0.9, 3), (4, 5, 0.2, 1), (5, 6, 0.1, 1)], "u long, v long, weight double, size long")
    got = {r.node: r.root for r in agglomerate.rounds(nodes, edges, 0.3).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 4}


def test_rounds_of_a_chain_run_in_one_task(spark):
    """Of a chain of equal costs each round joins one edge, and yet a few tables are written; in one task and round by round the roots are the same."""
    import random

    from voxlake.operators import agglomerate
    from voxlake.spark import stored

    nodes = spark.range(60).select(F.col("id").alias("node"))
    chain = spark.createDataFrame([(i, i + 1, 0.1, 1 + i % 3) for i in range(59)], "u long, v long, weight double, size long")
    before = stored()
    assert {r.root for r in agglomerate.rounds(nodes, chain, 0.3).collect()} == {0}
    assert stored() - before <= 3
    draw = random.Random(4)
    mixed = [(draw.randrange(25), draw.randrange(25), draw.randrange(1, 9) / 8, draw.choice((1, 2, 4))) for _ in range(60)]
    mixed += [(0, 1, None, 2), (3, 40, 0.125, 1), *mixed[:5]]  # without a cost, from nodes that aren't told, and twice
    edges = spark.createDataFrame(mixed, "u long, v long, weight double, size long")
    some = nodes.where("node < 30")
    one, many = ({r.node: r.root for r in agglomerate.rounds(some, edges, 0.6, at_once=n).collect()} for n in (1 << 20, 0))
    assert one == many and len(one) == 30 and 3 < len(set(one.values())) < 30


def test_blocks_merge_where_they_overlap(spark):
    from voxlake.operators import agglomerate

    rows = [("a", 0, 0, x, 1 if x < 5 else 2) for x in range(10)] + [("b", 0, 0, x, 7 if x < 9 else 8) for x in range(8, 14)]
    got = {(r.block, r.local): r["global"] for r in agglomerate.merged_blocks(spark.createDataFrame(rows, "block string, z long, y long, x long, local long")).collect()}
    assert got["a", 2] == got["b", 7] == got["b", 8] and got["a", 1] != got["a", 2]


def test_aggregate_classifier_pads_each_part(spark):
    import numpy as np

    from voxlake.operators import classify
    from voxlake.operators.stencil import grey_dilation

    wide = classify.Classifier(lambda a, x, y, z: {"m": grey_dilation(a, (0, 2, 2))}, ["m"], (0, 2, 2))
    both = classify.Aggregate([(classify.identity("i"), {}), (wide, {"m": "most"})])
    assert both.pad == (0, 2, 2) and both.classes == ["i", "most"]
    dense = np.random.default_rng(2).integers(0, 255, (2, 12, 13))
    df = spark.createDataFrame([(*map(int, p), int(v)) for p, v in np.ndenumerate(dense)], "z long, y long, x long, v long")
    got = {"i": np.zeros(dense.shape), "most": np.zeros(dense.shape)}
    for r in classify.classified(df, "v", both, block=(1, 5, 5)).collect():
        got[r.channel][r.z, r.y, r.x] = r.value
    assert (got["i"] == dense).all() and (got["most"] == grey_dilation(dense, (0, 2, 2))).all()


def test_propagation_keeps_known_labels(spark):
    from voxlake.operators import classify

    edges = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0)], "u long, v long, affinity double")
    got = {r.node: r.score for r in classify.propagated(edges, spark.createDataFrame([(1, 1), (3, 0)], "node long, score int"), rounds=3).collect()}
    assert got == {1: 1.0, 2: 0.5, 3: 0.0}


def test_stored_tables_can_be_released(spark):
    from voxlake import spark as session

    df = session.store(spark.range(5))
    assert df.count() == 5 and session.release(spark) >= 1 and session.release(spark) == 0


def test_label_propagation_until_it_is_still(spark):
    from voxlake.operators import classify

    edges = spark.createDataFrame([(k, k + 1, 1.0) for k in range(8)] + [(20, 21, 1.0)], "u long, v long, affinity double")
    known = spark.createDataFrame([(0, 0.0), (8, 1.0)], "node long, score double")
    got = {r.node: r.score for r in classify.propagated(edges, known).collect()}
    assert set(got) == set(range(9)) and all(abs(got[k] - k / 8) < 0.01 for k in got)
    assert {r.node for r in classify.propagated(edges, known, rounds=2).collect()} == {0, 1, 2, 6, 7, 8}
