"""Queries on joined regions, classifiers, and the pipeline from probabilities to a global segmentation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import agglomerate, classify, rag, stencil
from .graph import EDGES, RNODES, touch, weighted
from .graph import nodes as customers
from .naming import Collected, rounded
from .synapse import network
from .views import view

query = Collected()


@query()
def mutual_agglomeration(spark, d):
    return agglomerate.rounds(customers(spark, d), weighted(spark, d), 0.4)


@query("SELECT z, y, x, CASE WHEN COUNT(*) OVER (PARTITION BY a) < 1950 THEN 0 ELSE a END AS a FROM vox", "vox")
def without_small(spark, d):
    return agglomerate.without_small(view(spark, d, "vox").select("z", "y", "x", "a"), "a", 1950)


@query("WITH k AS (SELECT DISTINCT id AS synapse, n AS label FROM (SELECT id, n1 AS n FROM point UNION ALL SELECT id, 100000 + n2 % 7000 FROM point) WHERE n <> 0) SELECT DISTINCT l.label AS u, r.label AS v FROM k l JOIN k r ON l.synapse = r.synapse AND l.label < r.label", "point")
def kept_apart(spark, d):
    n = network(spark, d)
    return agglomerate.kept_apart(n.select("synapse", F.col("neuron_1").alias("label")).unionByName(n.select("synapse", F.col("neuron_2").alias("label"))))


@query("SELECT least(u, v) AS u, greatest(u, v) AS v, round((u * 7 + v) % 100 / 100.0E0, 6) AS weight FROM edge ORDER BY abs((u * 7 + v) % 100 / 100.0E0 - 0.5), least(u, v), greatest(u, v) LIMIT 50", "edge")
def most_uncertain_edges(spark, d):
    return rounded(agglomerate.by_uncertainty(weighted(spark, d), 50).select("u", "v", "weight"), "weight")


@query(f"WITH {RNODES} SELECT re.u, re.v, re.size AS weight, least(p.size, q.size) AS smaller FROM re JOIN rn p ON p.node = re.u JOIN rn q ON q.node = re.v ORDER BY smaller DESC, re.u, re.v LIMIT 20", "vox")
def largest_impact_edges(spark, d):
    t = touch(spark, d)
    return agglomerate.by_impact(rag.edges(t).withColumnRenamed("size", "weight"), rag.nodes(view(spark, d, "vox"), "a", t), 20)


@query("WITH e AS (SELECT MIN(z) AS z0, MAX(z) AS z1, MIN(y) AS y0, MAX(y) AS y1, MIN(x) AS x0, MAX(x) AS x1 FROM vox) SELECT a * 100 + z AS label, CAST(COUNT(*) AS BIGINT) AS area FROM vox, e WHERE a <> 0 GROUP BY 1 HAVING NOT bool_or(y IN (y0, y1) OR x IN (x0, x1) OR z IN (z0, z1)) AND COUNT(*) >= 3", "vox")
def orphan_bodies(spark, d):
    return agglomerate.orphans(view(spark, d, "vox").withColumn("a", F.when(F.col("a") != 0, F.col("a") * 100 + F.col("z")).otherwise(0)), "a", 3)


@query("""WITH k AS (SELECT a AS label, z, COUNT(*) AS n FROM vox WHERE a <> 0 GROUP BY 1, 2), s AS (SELECT c.a AS label, c.z, COUNT(*) AS n FROM vox c JOIN vox p ON p.z = c.z - 1 AND p.y = c.y AND p.x = c.x AND p.a = c.a WHERE c.a <> 0 GROUP BY 1, 2),
c AS (SELECT k.label, k.z, CASE WHEN COALESCE(s.n, 0) < 250 AND row_number() OVER (PARTITION BY k.label ORDER BY k.z) > 1 THEN 1 ELSE 0 END AS cut FROM k LEFT JOIN s ON k.label = s.label AND k.z = s.z)
SELECT label, z, CAST(SUM(cut) OVER (PARTITION BY label ORDER BY z) AS BIGINT) AS piece FROM c""", "vox")
def unsegment_contacts(spark, d):
    return agglomerate.unsegmented(view(spark, d, "vox"), "a", 250)


STEPS = "(VALUES (1,0,0),(-1,0,0),(0,1,0),(0,-1,0),(0,0,1),(0,0,-1)) AS s(dz, dy, dx)"


@query(f"""WITH t AS (SELECT DISTINCT c.z, c.y, c.x, least(c.a, o.a) AS u, greatest(c.a, o.a) AS v, c.p FROM vox c CROSS JOIN {STEPS} JOIN vox o ON o.z = c.z + dz AND o.y = c.y + dy AND o.x = c.x + dx WHERE c.a <> 0 AND o.a <> 0 AND c.a <> o.a)
SELECT u, v, z, y, x FROM (SELECT *, row_number() OVER (PARTITION BY u, v ORDER BY p, z, y, x) AS k FROM t) WHERE k = 1""", "vox")
def edge_locations(spark, d):
    vox = view(spark, d, "vox").where("a <> 0")
    around = F.explode(F.array(*[F.struct(*[F.lit(s).alias(c) for c, s in zip("zyx", step, strict=True)]) for step in stencil.AXIS_STEPS])).alias("d")
    sent = vox.select(*[(F.col(c)).alias(c) for c in "zyx"], F.col("a").alias("other"), around).select(*[(F.col(c) + F.col(f"d.{c}")).alias(c) for c in "zyx"], "other").distinct()
    met = vox.join(sent, ["z", "y", "x"]).where("a <> other")
    return agglomerate.best_locations(met.select(F.col("a").alias("node"), "other", F.col("p").alias("value"), "z", "y", "x"))


@query("SELECT z, y, x, 'image' AS channel, p AS value FROM vox UNION ALL SELECT z, y, x, 'inverse', 255 - p FROM vox", "vox")
def classified_channels(spark, d):
    both = classify.Aggregate([(classify.identity("x"), {"x": "image"}), (classify.Classifier(lambda image, x, y, z: {"x": 255 - image}, ["x"], (0, 2, 2)), {"x": "inverse"})])
    return classify.classified(view(spark, d, "vox"), "p", both, block=(4, 32, 32))


def _features(spark, d) -> DataFrame:
    t = touch(spark, d)
    sums = t.groupBy(F.least("node", "other").alias("u"), F.greatest("node", "other").alias("v")).agg(*rag.moment_sums(F.col("value")))
    told = sums.select("u", "v", F.col("m0").alias("size"), *rag.moments()).withColumn("constant", F.lit(1.0))
    return told.withColumn("label", ((F.col("u") + F.col("v")) % 3 == 0).cast("int"))


@query(f"""WITH {EDGES}, f AS (SELECT 'size' AS feature, CAST(size AS DOUBLE) AS v FROM re UNION ALL SELECT 'constant', 1.0 FROM re) SELECT feature, round(var_pop(v), 6) AS variance, var_pop(v) <= 1e-9 AS useless FROM f GROUP BY feature""", "vox")
def useless_features(spark, d):
    return rounded(classify.useless_features(_features(spark, d), ["size", "constant"]), "variance")


@query()
def edge_probability(spark, d):
    from ..spark import store

    f = store(_features(spark, d))
    names = ["size", "mean", "var", "third", "fourth"]
    return classify.edge_probability(classify.edge_classifier(f, names), f).select("u", "v", "p")


@query()
def edge_clusters(spark, d):
    from ..spark import store

    return classify.clustered(store(_features(spark, d)), ["size", "mean", "var"], 3).select("u", "v", "cluster")


@query("""WITH w AS (SELECT least(u, v) AS u, greatest(u, v) AS v, 1 - (u * 7 + v) % 100 / 100.0E0 AS f FROM edge), b AS (SELECT u, v, f FROM w WHERE f > 0 UNION ALL SELECT v, u, f FROM w WHERE f > 0),
k AS (SELECT c_custkey AS node, CASE WHEN c_custkey % 20 = 0 THEN 1.0E0 ELSE 0.0E0 END AS s FROM customer WHERE c_custkey % 10 = 0),
r1 AS (SELECT * FROM k UNION ALL SELECT b.u, SUM(f * s) / SUM(f) FROM b JOIN k ON k.node = b.v WHERE b.u % 10 <> 0 GROUP BY 1), r2 AS (SELECT * FROM k UNION ALL SELECT b.u, SUM(f * s) / SUM(f) FROM b JOIN r1 ON r1.node = b.v WHERE b.u % 10 <> 0 GROUP BY 1),
r3 AS (SELECT * FROM k UNION ALL SELECT b.u, SUM(f * s) / SUM(f) FROM b JOIN r2 ON r2.node = b.v WHERE b.u % 10 <> 0 GROUP BY 1) SELECT node, round(s + 1e-9, 6) AS score FROM r3""", "edge")
def propagated_labels(spark, d):
    e = weighted(spark, d).select("u", "v", (1 - F.col("weight")).alias("affinity")).where("affinity > 0")
    known = customers(spark, d).where("node % 10 = 0").select("node", (F.col("node") % 20 == 0).cast("int").alias("score"))
    told = classify.propagated(e, known, rounds=3)
    return rounded(told.withColumn("score", F.col("score") + 1e-9), "score")  # many scores lie halfway between two roundings


@query("""WITH e AS (SELECT c.z, c.y, c.x, bool_or(o.a <> c.a) AS ea, bool_or(o.b <> c.b) AS eb FROM vox c JOIN vox o ON o.z = c.z AND abs(o.y - c.y) + abs(o.x - c.x) = 1 GROUP BY 1, 2, 3),
n AS (SELECT c.z, c.y, c.x, c.ea, c.eb, bool_or(o.ea) AS na, bool_or(o.eb) AS nb FROM e c JOIN e o ON o.z = c.z AND o.y BETWEEN c.y - 1 AND c.y + 1 AND o.x BETWEEN c.x - 1 AND c.x + 1 GROUP BY 1, 2, 3, 4, 5)
SELECT round(SUM(CASE WHEN ea AND nb THEN 1 ELSE 0 END) / CAST(SUM(CASE WHEN ea THEN 1 ELSE 0 END) AS DOUBLE), 6) AS precision, round(SUM(CASE WHEN eb AND na THEN 1 ELSE 0 END) / CAST(SUM(CASE WHEN eb THEN 1 ELSE 0 END) AS DOUBLE), 6) AS recall FROM n""", "vox")
def boundary_agreement(spark, d):
    """Boundaries within one voxel of the other's, both ways."""
    from ..operators import voxels

    vox = view(spark, d, "vox")
    flat = F.explode(F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a, b in ((0, 1), (0, -1), (1, 0), (-1, 0))])).alias("s")
    sent = vox.select("z", "y", "x", F.col("a").alias("oa"), F.col("b").alias("ob"), flat).select("z", (F.col("y") + F.col("s.dy")).alias("y"), (F.col("x") + F.col("s.dx")).alias("x"), "oa", "ob")
    edge = vox.join(sent, ["z", "y", "x"]).groupBy("z", "y", "x").agg(F.bool_or(F.col("oa") != F.col("a")).cast("int").alias("ea"), F.bool_or(F.col("ob") != F.col("b")).cast("int").alias("eb"))
    near = {c: voxels.neighbour_extremes(edge, c, reach=(0, 1, 1), cross=False).select("z", "y", "x", F.col("high").alias(f"n{c}")) for c in ("ea", "eb")}
    all_ = edge.join(near["ea"], ["z", "y", "x"]).join(near["eb"], ["z", "y", "x"])
    share = lambda e, n: F.try_divide(F.sum(F.col(e) * F.col(n)), F.sum(e))
    return rounded(all_.agg(share("ea", "neb").alias("precision"), share("eb", "nea").alias("recall")), "precision", "recall")


@query()
def global_segmentation(spark, d):
    """From probabilities to global labels: blocks segmented with their halos, joined where they overlap, renumbered, and told for each voxel."""
    from ..spark import store

    kernel = lambda a: stencil.segment(a, sigma=(0.5, 1, 1))
    local = store(stencil.label_blocks(view(spark, d, "vox"), "p", kernel, block=(8, 32, 32), halo=(0, 4, 4)))
    mapping = agglomerate.merged_blocks(local)
    return local.where("own").join(mapping, ["block", "local"], "left").select("z", "y", "x", F.coalesce("global", F.lit(0)).alias("global"))


QUERIES, ORACLES = query.queries, query.oracles
