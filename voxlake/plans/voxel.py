"""Queries on voxels: scans, overlays, combinations, neighbourhoods that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins, voxels
from ..spark import table
from .naming import Collected, rounded
from .views import view

query = Collected()
STEPS = "(VALUES (0,0,0),(1,0,0),(-1,0,0),(0,1,0),(0,-1,0),(0,0,1),(0,0,-1)) AS s(dz, dy, dx)"


@query("SELECT z - 2 AS z, y - 10 AS y, x - 5 AS x, p, CASE WHEN a <> 0 THEN a + 100 ELSE a END AS a FROM vox WHERE x >= 5 AND x < 45 AND y >= 10 AND y < 60 AND z >= 2 AND z < 6", "vox")
def scan_box(spark, d):
    return voxels.scan(view(spark, d, "vox").select("z", "y", "x", "p", "a"), (5, 10, 2, 40, 50, 4), local=True, label="a", offset=100)


@query("SELECT z, y, x, p < 100 AS below, p > 150 AS above, a IN (1, 3, 5) AS among, 255 - p AS inverted FROM vox", "vox")
def thresholds(spark, d):
    p, a = F.col("p"), F.col("a")
    return view(spark, d, "vox").select("z", "y", "x", voxels.threshold(p, at=100).alias("below"), voxels.threshold(p, at=150, higher=True).alias("above"), voxels.threshold(a, classes=[1, 3, 5]).alias("among"), (255 - p).alias("inverted"))


def layers(spark, d):
    vox = view(spark, d, "vox")
    return [vox.select("z", "y", "x", F.col(e).alias("v")) for e in ("p", "a")] + [vox.where("b <> 0").select("z", "y", "x", F.col("b").alias("v"))]


UNION = "u AS (SELECT z, y, x, p AS v FROM vox UNION ALL SELECT z, y, x, a FROM vox UNION ALL SELECT z, y, x, b FROM vox WHERE b <> 0)"


@query(f"WITH {UNION} SELECT z, y, x, CAST(SUM(v) AS BIGINT) AS v FROM u GROUP BY 1, 2, 3", "vox")
def voxel_sum(spark, d):
    return voxels.combined(layers(spark, d), "v", "sum")


@query(f"WITH {UNION} SELECT z, y, x, CAST(floor(SUM(v) / COUNT(*)) AS BIGINT) AS v FROM u GROUP BY 1, 2, 3", "vox")
def voxel_mean(spark, d):
    return voxels.combined(layers(spark, d), "v", "mean")


@query(f"WITH {UNION} SELECT z, y, x, CAST(median(v) AS DOUBLE) AS v FROM u GROUP BY 1, 2, 3", "vox")
def voxel_median(spark, d):
    return voxels.combined(layers(spark, d), "v", "median")


@query(f"WITH {UNION} SELECT z, y, x, CAST(product(v) AS DOUBLE) AS v FROM u GROUP BY 1, 2, 3", "vox")
def voxel_product(spark, d):
    return voxels.combined(layers(spark, d), "v", "product")


@query(f"WITH {UNION} SELECT z, y, x, 255 - MAX(v) AS low, 255 - MIN(v) AS high FROM u GROUP BY 1, 2, 3", "vox")
def merge_predictions(spark, d):
    low = voxels.merged_predictions(layers(spark, d), "v", "min", inverted=True).withColumnRenamed("v", "low")
    return low.join(voxels.merged_predictions(layers(spark, d), "v", "max", inverted=True).withColumnRenamed("v", "high"), ["z", "y", "x"])


@query("SELECT f.z, f.y, f.x, COALESCE(c.p, -1) AS coarse FROM vox f LEFT JOIN vox c ON c.z = CAST(floor(f.z / 2) AS BIGINT) AND c.y = CAST(floor(f.y / 4) AS BIGINT) AND c.x = CAST(floor(f.x / 4) AS BIGINT)", "vox")
def nearest_upsample(spark, d):
    vox = view(spark, d, "vox")
    coarse = vox.select("z", "y", "x", F.col("p").alias("coarse"))
    return joins.nearest_upsample(vox.select("z", "y", "x"), coarse, {"z": 2, "y": 4, "x": 4}, "coarse").withColumn("coarse", F.coalesce("coarse", F.lit(-1)))


@query("""SELECT z, r AS "row", c AS "column", CAST(CASE WHEN z < 7 THEN COALESCE(p, 255) ELSE 255 END AS BIGINT) AS p FROM (SELECT unnest(range(0, 9)) AS z), (SELECT unnest(range(0, 64)) AS r), (SELECT unnest(range(0, 64)) AS c) LEFT JOIN (SELECT z AS vz, y, x, p FROM vox) ON vz = z AND y = r AND x = c""", "vox")
def missing_tiles(spark, d):
    tiles = view(spark, d, "vox").select("z", F.col("y").alias("row"), F.col("x").alias("column"), "p")
    return voxels.filled_tiles((0, 0, 0, 4096, 4096, 9), (64, 64), tiles, 7, "p")


@query("SELECT z, y, x, CASE WHEN b <> 0 THEN b + (SELECT MAX(a) FROM vox) WHEN a <> 0 THEN a ELSE NULL END AS v FROM vox WHERE a <> 0 OR b <> 0", "vox")
def overlay_later_wins(spark, d):
    vox = view(spark, d, "vox")
    most = vox.agg(F.max("a").alias("most"))
    one = vox.where("a <> 0").select("z", "y", "x", F.col("a").alias("v"))
    two = vox.where("b <> 0").crossJoin(F.broadcast(most)).select("z", "y", "x", (F.col("b") + F.col("most")).alias("v"))  # one row
    return joins.overlay(one, two, keys=["z", "y", "x"], value="v")


@query("SELECT z, y, x, CASE WHEN p > 200 AND b <> 0 THEN b WHEN a IN (2, 5) THEN 0 ELSE a END AS a FROM vox", "vox")
def repair_overlay(spark, d):
    vox = view(spark, d, "vox")
    fix = vox.where("p > 200").select("z", "y", "x", F.col("b").alias("a"))
    return voxels.repaired(vox, "a", [2, 5], fix)


AROUND = f"n AS (SELECT c.z, c.y, c.x, MIN(o.a) AS low, MAX(o.a) AS high, c.a FROM vox c CROSS JOIN {STEPS} JOIN vox o ON o.z = c.z + dz AND o.y = c.y + dy AND o.x = c.x + dx GROUP BY c.z, c.y, c.x, c.a)"


@query(f"WITH {AROUND} SELECT z, y, x, CASE WHEN low = high THEN a ELSE 0 END AS a FROM n", "vox")
def erode_labels(spark, d):
    return voxels.eroded(view(spark, d, "vox"), "a")


@query("SELECT c.z, c.y, c.x, MAX(o.p) AS p FROM vox c JOIN (SELECT z + dz AS z, y + dy AS y, x + dx AS x, p FROM vox, (SELECT unnest([-1, 0, 1]) AS dz), (SELECT unnest([-2, -1, 0, 1, 2]) AS dy), (SELECT unnest([-2, -1, 0, 1, 2]) AS dx)) o ON o.z = c.z AND o.y = c.y AND o.x = c.x GROUP BY 1, 2, 3", "vox")
def dilate_box(spark, d):
    return voxels.dilated(view(spark, d, "vox"), "p", (1, 2, 2))


@query("SELECT z, y, x, CAST(floor((least(greatest(CAST(p AS DOUBLE), 57.15E0), 179.07E0) - 57.15E0) * 255 / (179.07E0 - 57.15E0)) AS BIGINT) AS p FROM vox", "vox")
def rescale_range(spark, d):
    return view(spark, d, "vox").select("z", "y", "x", voxels.stretched(F.col("p"), 57.15, 179.07).alias("p"))


@query("""WITH k AS (SELECT p, row_number() OVER (ORDER BY p) - 1 AS i, row_number() OVER (ORDER BY p DESC) - 1 AS j, COUNT(*) OVER () AS n FROM vox),
e AS (SELECT MIN(CASE WHEN i = CAST(floor(n * 0.05E0) AS BIGINT) THEN p END) AS low, MIN(CASE WHEN j = CAST(floor(n * 0.05E0) AS BIGINT) THEN p END) AS high FROM k)
SELECT z, y, x, CAST(floor((least(greatest(p, low), high) - low) * 255.0E0 / greatest(high - low, 1)) AS BIGINT) AS p FROM vox, e""", "vox")
def rescale_saturate(spark, d):
    return voxels.saturated(view(spark, d, "vox"), "p", 0.1)


@query("""WITH v AS (SELECT p, SUM(COUNT(*)) OVER (ORDER BY p) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS s FROM vox GROUP BY p),
t AS (SELECT q, SUM(COUNT(*)) OVER (ORDER BY q) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS s FROM (SELECT CAST(floor(p / 2) AS BIGINT) + 30 AS q FROM vox WHERE a <> 0) GROUP BY q),
l AS (SELECT v.p, MIN(q) AS q FROM v JOIN t ON t.s >= v.s GROUP BY v.p) SELECT z, y, x, q AS p FROM vox JOIN l ON vox.p = l.p""", "vox")
def match_histogram(spark, d):
    vox = view(spark, d, "vox")
    return voxels.matched_histogram(vox, "p", vox.where("a <> 0").select((F.floor(F.col("p") / 2) + 30).alias("p")))


PIECES = """both_ AS (SELECT c.i, o.i AS j FROM k c JOIN k o ON o.a = c.a AND ({near})), reach AS (SELECT i, i AS j FROM k UNION SELECT reach.i, both_.j FROM reach JOIN both_ ON reach.j = both_.i)"""
LOCAL = "k AS (SELECT z, y, x, a, (z * 64 + y) * 64 + x AS i FROM vox WHERE a <> 0 AND p > 90)"


@query("WITH RECURSIVE " + LOCAL + ", " + PIECES.format(near="o.z = c.z AND abs(o.y - c.y) + abs(o.x - c.x) = 1") + " SELECT z, y, x, MIN(j) AS root FROM k JOIN reach ON reach.i = k.i GROUP BY 1, 2, 3", "vox")
def plane_pieces(spark, d):
    told = voxels.plane_components(view(spark, d, "vox").where("p > 90"), "a")
    return told.select("z", "y", "x", ((F.col("root.z") * 64 + F.col("root.y")) * 64 + F.col("root.x")).alias("root"))


@query("WITH RECURSIVE " + LOCAL + ", " + PIECES.format(near="abs(o.z - c.z) + abs(o.y - c.y) + abs(o.x - c.x) = 1") + " SELECT z, y, x, MIN(j) AS root FROM k JOIN reach ON reach.i = k.i GROUP BY 1, 2, 3", "vox")
def volume_pieces(spark, d):
    told = voxels.volume_components(view(spark, d, "vox").where("p > 90"), "a")
    return told.select("z", "y", "x", ((F.col("root.z") * 64 + F.col("root.y")) * 64 + F.col("root.x")).alias("root"))


@query("SELECT a AS label, CAST(COUNT(*) AS BIGINT) AS n, round(AVG(z), 6) AS cz, round(AVG(y), 6) AS cy, round(AVG(x), 6) AS cx, CAST(SUM(p) AS BIGINT) AS weight, MIN(x) AS x0, MAX(x) + 1 AS x1 FROM vox WHERE a <> 0 GROUP BY a", "vox")
def label_extents(spark, d):
    told = view(spark, d, "vox").where("a <> 0").groupBy(F.col("a").alias("label")).agg(F.count("*").alias("n"), *[F.avg(c).alias(f"c{c}") for c in "zyx"], F.sum("p").alias("weight"), F.min("x").alias("x0"), (F.max("x") + 1).alias("x1"))
    return rounded(told, "cz", "cy", "cx")


@query("SELECT z, n, CAST(SUM(n) OVER (ORDER BY z) - n AS BIGINT) AS before FROM (SELECT z, COUNT(DISTINCT a) AS n FROM vox WHERE a <> 0 GROUP BY z)", "vox")
def plane_offsets(spark, d):
    from pyspark.sql.window import Window

    per = view(spark, d, "vox").where("a <> 0").groupBy("z").agg(F.count_distinct("a").alias("n"))  # a row a plane
    return per.select("z", "n", (F.sum("n").over(Window.orderBy("z")) - F.col("n")).alias("before"))


@query("SELECT CAST(l_linenumber AS BIGINT) AS z, CAST(COUNT(*) AS BIGINT) AS n, round(SUM(l_extendedprice * (1 - l_discount)), 2) AS total FROM lineitem GROUP BY 1")
def plane_totals(spark, d):
    li = table(spark, d, "lineitem")
    return rounded(li.groupBy(F.col("l_linenumber").cast("long").alias("z")).agg(F.count("*").alias("n"), F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("total")), "total", digits=2)


@query("SELECT q.z, q.y, q.x, CAST(COALESCE(CASE WHEN b <> 0 THEN b ELSE a END, 0) AS BIGINT) AS v FROM (SELECT z, y, x FROM (SELECT unnest(range(0, 9)) AS z), (SELECT unnest(range(0, 70)) AS y), (SELECT unnest(range(0, 70)) AS x)) q LEFT JOIN vox ON vox.z = q.z AND vox.y = q.y AND vox.x = q.x", "vox")
def planned_scan(spark, d):
    vox = view(spark, d, "vox")
    one, two = vox.select("z", "y", "x", F.col("a").alias("v")), vox.where("b <> 0").select("z", "y", "x", F.col("b").alias("v"))
    return voxels.planned((0, 0, 0, 70, 70, 9), [one, two], "v")


@query("SELECT f.z, f.y, f.x, f.p < 150 AND COALESCE(c.a, 0) <> 0 AS inside FROM vox f LEFT JOIN vox c ON c.z = CAST(floor(f.z / 2) AS BIGINT) AND c.y = CAST(floor(f.y / 2) AS BIGINT) AND c.x = CAST(floor(f.x / 2) AS BIGINT)", "vox")
def border_mask(spark, d):
    vox = view(spark, d, "vox")
    mask = vox.select("z", "y", "x", F.col("a").alias("mask"))
    met = joins.nearest_upsample(vox.select("z", "y", "x", "p"), mask, {"z": 2, "y": 2, "x": 2}, "mask")
    return met.select("z", "y", "x", (voxels.threshold(F.col("p"), at=150) & (F.coalesce("mask", F.lit(0)) != 0)).alias("inside"))


QUERIES, ORACLES = query.queries, query.oracles
