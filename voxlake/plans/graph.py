"""Queries on graphs: global labels, contraction, region adjacency, paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graphs, joins, overlap, rag
from ..spark import table
from .naming import Collected, rounded
from .views import view

query = Collected()
NODES = "nodes AS (SELECT c_custkey AS node FROM customer)"
CLOSED = """both_ AS (SELECT u, v FROM {e} UNION SELECT v, u FROM {e}),
reach AS (SELECT node AS a, node AS b FROM nodes UNION SELECT reach.a, both_.v FROM reach JOIN both_ ON reach.b = both_.u),
root AS (SELECT a AS node, MIN(b) AS root FROM reach GROUP BY a)"""


def nodes(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("node"))


@query("WITH RECURSIVE " + NODES + ", " + CLOSED.format(e="edge") + " SELECT node, CAST(dense_rank() OVER (ORDER BY root) AS BIGINT) AS global FROM root", "edge")
def connected_components(spark, d):
    return graphs.global_components(nodes(spark, d), view(spark, d, "edge"))


@query("WITH RECURSIVE " + NODES + """, ends AS (SELECT u, v FROM edge UNION SELECT v, u FROM edge), busy AS (SELECT u FROM ends GROUP BY u HAVING COUNT(*) > 2),
kept AS (SELECT u, v FROM edge WHERE u NOT IN (SELECT u FROM busy) AND v NOT IN (SELECT u FROM busy)), """ + CLOSED.format(e="kept") + " SELECT node, CAST(dense_rank() OVER (ORDER BY root) AS BIGINT) AS global FROM root", "edge")
def max_connections_filter(spark, d):
    return graphs.global_components(nodes(spark, d), view(spark, d, "edge"), max_connections=2)


MAPPING = "map AS (SELECT DISTINCT a AS label, 100 + a * a % 17 AS global FROM vox WHERE a BETWEEN 1 AND 9)"


def mapping(spark, d):
    return view(spark, d, "vox").where("a between 1 and 9").select(F.col("a").alias("label"), (F.col("a") * F.col("a") % 17 + 100).alias("global")).distinct()


@query(f"WITH {MAPPING} SELECT z, y, x, COALESCE(global, 0) AS global FROM vox LEFT JOIN map ON vox.a = map.label", "vox")
def relabel_lut(spark, d):
    vox = view(spark, d, "vox").withColumnRenamed("a", "label")
    return joins.relabel(vox, mapping(spark, d), "label", "global").select("z", "y", "x", "global")


@query(f"WITH {MAPPING} SELECT z, y, x, COALESCE(global, a + 1000) AS global FROM vox LEFT JOIN map ON vox.a = map.label", "vox")
def relabel_fallback(spark, d):
    vox = view(spark, d, "vox").withColumnRenamed("a", "label")
    return joins.relabel(vox, mapping(spark, d), "label", "global", otherwise=F.col("label") + 1000).select("z", "y", "x", "global")


@query("""WITH l AS (SELECT l_suppkey AS m, l_orderkey AS a, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey) AS i FROM (SELECT DISTINCT l_suppkey, l_orderkey FROM lineitem)),
r AS (SELECT l_suppkey AS m, l_partkey AS b, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_partkey) AS j FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem))
SELECT DISTINCT a, b FROM l JOIN r ON l.m = r.m WHERE i = 1 OR j = 1""")
def star_join_pairs(spark, d):
    li = table(spark, d, "lineitem")
    return joins.star_join(li.select(F.col("l_suppkey").alias("m"), F.col("l_orderkey").alias("a")), li.select(F.col("l_suppkey").alias("m"), F.col("l_partkey").alias("b")), "m", "a", "b")


@query("SELECT DISTINCT a AS label FROM vox WHERE a <> 0 INTERSECT SELECT DISTINCT b FROM vox WHERE b <> 0", "vox")
def identical_labels(spark, d):
    vox = view(spark, d, "vox")
    return vox.where("a != 0").select(F.col("a").alias("label")).intersect(vox.where("b != 0").select(F.col("b").alias("label")))


@query("SELECT one, two FROM (SELECT c_nationkey AS one, c_custkey % 97 AS two, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment, c_custkey) AS k FROM customer) WHERE k = 1")
def rebase_labels(spark, d):
    c = table(spark, d, "customer")
    one = c.select(F.col("c_mktsegment").alias("block"), F.col("c_custkey").alias("local"), F.col("c_nationkey").alias("one"))
    two = c.select(F.col("c_mktsegment").alias("block"), F.col("c_custkey").alias("local"), (F.col("c_custkey") % 97).alias("two"))
    return graphs.rebase(one, two)


WEIGHTED = "w AS (SELECT least(u, v) AS u, greatest(u, v) AS v, 1 + u % 5 AS size, (u * 7 + v) % 100 / 100.0E0 AS weight, u % 11 = 0 AS preserve, v % 13 = 0 AS false_edge FROM edge)"


def weighted(spark, d):
    e = view(spark, d, "edge")
    return e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), (F.col("u") % 5 + 1).alias("size"), ((F.col("u") * 7 + F.col("v")) % 100 / 100.0).alias("weight"), (F.col("u") % 11 == 0).alias("preserve"), (F.col("v") % 13 == 0).alias("false_edge"))


FLAT = "WITH RECURSIVE " + NODES + ", " + WEIGHTED + ", k AS (SELECT u, v FROM w WHERE weight <= 0.4 AND NOT preserve AND NOT false_edge), " + CLOSED.format(e="k")


@query(FLAT + " SELECT node, root FROM root", "edge")
def flat_agglomeration(spark, d):
    return graphs.flat_agglomeration(nodes(spark, d), weighted(spark, d), 0.4)


@query(FLAT + """, m AS (SELECT p.root AS a, q.root AS b, w.* FROM w JOIN root p ON p.node = w.u JOIN root q ON q.node = w.v)
SELECT least(a, b) AS u, greatest(a, b) AS v, CAST(SUM(size) AS BIGINT) AS size, round(MIN(weight), 6) AS weight, bool_or(preserve) AS preserve, bool_and(false_edge) AS false_edge FROM m WHERE a <> b GROUP BY 1, 2""", "edge")
def rag_contract(spark, d):
    roots = graphs.flat_agglomeration(nodes(spark, d), weighted(spark, d), 0.4)
    return rounded(graphs.contract(nodes(spark, d).withColumn("size", F.lit(1)), weighted(spark, d), roots)[1], "weight")


@query("WITH RECURSIVE aff AS (SELECT u, v, 0.5 + (u * 7 + v) % 50 / 100.0E0 AS w FROM edge), both_ AS (SELECT u, v, w FROM aff WHERE w >= 0.5 UNION SELECT v, u, w FROM aff WHERE w >= 0.5), p AS (SELECT c_custkey AS source, c_custkey AS node, CAST(1.0 AS DOUBLE) AS affinity, 0 AS n FROM customer WHERE c_mktsegment = 'BUILDING' UNION SELECT p.source, both_.v, p.affinity * both_.w, p.n + 1 FROM p JOIN both_ ON p.node = both_.u WHERE p.n < 3 AND p.affinity * both_.w >= 0.5) SELECT source, node, round(MAX(affinity), 6) AS affinity FROM p GROUP BY source, node", "edge")
def affinity_paths(spark, d):
    e = view(spark, d, "edge").select("u", "v", ((F.col("u") * 7 + F.col("v")) % 50 / 100.0 + 0.5).alias("affinity"))
    seeds = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("node"))
    return rounded(graphs.affinity(e, seeds, threshold=0.5, depth=3), "affinity")


@query("WITH RECURSIVE both_ AS (SELECT u, v FROM edge UNION SELECT v, u FROM edge), p AS (SELECT c_custkey AS node, CAST(0 AS BIGINT) AS distance, 0 AS n FROM customer WHERE c_mktsegment = 'BUILDING' UNION SELECT both_.v, p.distance + 1 + both_.v % 7, p.n + 1 FROM p JOIN both_ ON p.node = both_.u WHERE p.n < 5) SELECT node, CAST(MIN(distance) AS BIGINT) AS distance FROM p GROUP BY node", "edge")
def shortest_path_area(spark, d):
    cost = nodes(spark, d).withColumn("area", F.col("node") % 7 + 1)
    return graphs.shortest_paths(view(spark, d, "edge"), cost, table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("node")), depth=5)


STEPS = "(VALUES (1,0,0),(-1,0,0),(0,1,0),(0,-1,0),(0,0,1),(0,0,-1)) AS s(dz, dy, dx)"
TOUCH = f"touch AS (SELECT DISTINCT c.z, c.y, c.x, c.a AS node, o.a AS other, c.p / 255.0E0 AS value FROM vox c, {STEPS} JOIN vox o ON o.z = c.z + dz AND o.y = c.y + dy AND o.x = c.x + dx WHERE c.a <> 0 AND o.a <> 0 AND c.a <> o.a)".replace(f"vox c, {STEPS} JOIN vox o ON", f"vox c CROSS JOIN {STEPS} JOIN vox o ON")
EDGES = TOUCH + ", re AS (SELECT least(node, other) AS u, greatest(node, other) AS v, CAST(COUNT(*) AS BIGINT) AS size FROM touch GROUP BY 1, 2)"
RNODES = EDGES + ", rn AS (SELECT a AS node, CAST(COUNT(*) AS BIGINT) AS size FROM vox WHERE a <> 0 GROUP BY a)"


def touch(spark, d):
    vox = view(spark, d, "vox")
    return rag.contacts(vox.withColumn("value", F.col("p") / 255.0), "a", "value")


@query(f"WITH {EDGES} SELECT u, v, size FROM re", "vox")
def rag_edges(spark, d):
    return rag.edges(touch(spark, d))


@query(f"WITH {RNODES} SELECT rn.node, rn.size, COALESCE(k.n, 0) AS boundary_size FROM rn LEFT JOIN (SELECT node, CAST(COUNT(*) AS BIGINT) AS n FROM touch GROUP BY node) k ON rn.node = k.node", "vox")
def rag_nodes(spark, d):
    return rag.nodes(view(spark, d, "vox"), "a", touch(spark, d))


@query(f"""WITH {TOUCH}, m AS (SELECT least(node, other) AS u, greatest(node, other) AS v, AVG(value) AS a, AVG(value * value) AS b, AVG(value * value * value) AS c, AVG(value * value * value * value) AS d FROM touch GROUP BY 1, 2)
SELECT u, v, round(a, 6) AS mean, round(b - a * a, 6) AS var, round(c - 3 * a * b + 2 * a * a * a, 6) AS third, round(d - 4 * a * c + 6 * a * a * b - 3 * a * a * a * a, 6) AS fourth FROM m""", "vox")
def edge_moments(spark, d):
    sums = touch(spark, d).groupBy(F.least("node", "other").alias("u"), F.greatest("node", "other").alias("v")).agg(*rag.moment_sums(F.col("value")))
    return rounded(sums.select("u", "v", *rag.moments()), "mean", "var", "third", "fourth")


@query(f"""WITH {TOUCH}, h AS (SELECT least(node, other) AS u, greatest(node, other) AS v, CAST(least(floor(value * 25), 24) AS INTEGER) AS bin, COUNT(*) AS n FROM touch GROUP BY 1, 2, 3),
c AS (SELECT *, SUM(n) OVER (PARTITION BY u, v ORDER BY bin) AS upto, SUM(n) OVER (PARTITION BY u, v) AS total FROM h),
f AS (SELECT *, row_number() OVER (PARTITION BY u, v, q ORDER BY bin) AS k FROM c, (VALUES (0.1E0), (0.3E0), (0.5E0), (0.7E0), (0.9E0)) AS x(q) WHERE upto >= total * q)
SELECT u, v, q, round((bin + (q * total - (upto - n)) / n) / 25, 6) AS value FROM f WHERE k = 1""", "vox")
def edge_percentiles(spark, d):
    keyed = touch(spark, d).select(F.least("node", "other").alias("u"), F.greatest("node", "other").alias("v"), "value")
    return rounded(rag.percentiles(rag.histogram(keyed, ["u", "v"], F.col("value")), ["u", "v"]), "value")


@query(f"""WITH {EDGES}, b AS (SELECT u AS node, size FROM re UNION ALL SELECT v, size FROM re), k AS (SELECT node, size, row_number() OVER (PARTITION BY node ORDER BY size DESC) AS i, SUM(size) OVER (PARTITION BY node) AS total FROM b)
SELECT node, round(MAX(size) / CAST(MAX(total) AS DOUBLE), 6) AS of_all, round(COALESCE(MAX(CASE WHEN i = 2 THEN size END), 0) / CAST(MAX(size) AS DOUBLE), 6) AS second FROM k GROUP BY node""", "vox")
def inclusiveness(spark, d):
    return rounded(rag.inclusiveness(rag.edges(touch(spark, d))), "of_all", "second")


@query(f"WITH {RNODES} SELECT re.u, re.v, least(p.size, q.size) AS small, greatest(p.size, q.size) AS large, re.size, abs(p.size - q.size) AS difference FROM re JOIN rn p ON p.node = re.u JOIN rn q ON q.node = re.v", "vox")
def edge_node_features(spark, d):
    t = touch(spark, d)
    return rag.edge_features(rag.edges(t), rag.nodes(view(spark, d, "vox"), "a", t))


@query(f"WITH {TOUCH} SELECT node, MAX(other) AS other FROM touch WHERE other > node GROUP BY node", "vox")
def largest_neighbour(spark, d):
    return rag.largest_neighbour(touch(spark, d))


@query("SELECT a AS node, CASE WHEN AVG(CASE WHEN p > 170 THEN 1.0E0 ELSE 0 END) > 0.33 THEN 2 WHEN AVG(CASE WHEN p > 85 THEN 1.0E0 ELSE 0 END) > 0.5 THEN 1 ELSE 0 END AS type, round(AVG(p), 6) AS mean FROM vox WHERE a <> 0 GROUP BY a", "vox")
def majority_type(spark, d):
    share = lambda t: F.avg((F.col("p") > t).cast("double"))
    kind = F.when(share(170) > 0.33, 2).when(share(85) > 0.5, 1).otherwise(0).alias("type")
    return rounded(view(spark, d, "vox").where("a != 0").groupBy(F.col("a").alias("node")).agg(kind, F.avg("p").alias("mean")), "mean")


@query("SELECT b AS label, root, CAST(COUNT(*) AS BIGINT) AS n FROM (SELECT vox.b, k.root FROM vox JOIN (SELECT a, MIN(b) AS root FROM vox WHERE a <> 0 AND b <> 0 GROUP BY a) k ON vox.a = k.a WHERE vox.b <> 0) GROUP BY 1, 2", "vox")
def first_overlap(spark, d):
    table_ = overlap.contingency(view(spark, d, "vox"))
    roots = table_.groupBy("a").agg(F.min("b").alias("root"))
    return table_.join(roots, "a").groupBy(F.col("b").alias("label"), "root").agg(F.sum("n").alias("n"))


QUERIES, ORACLES = query.queries, query.oracles
