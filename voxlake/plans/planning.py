"""Queries on boxes: scans, interval joins, pieces, dependencies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.boxes import Box
from ..operators import catalog, joins
from ..spark import table
from .naming import Collected
from .views import view

query = Collected()
PROBE = (200, 300, 20, 400, 350, 90)
OVER = "l.x < r.x1 AND r.x < l.x1 AND l.y < r.y1 AND r.y < l.y1 AND l.z < r.z1 AND r.z < l.z1"


@query("""SELECT id, x + 3 >= 200 AND x + 3 < 600 AND y + 3 >= 300 AND y + 3 < 650 AND z + 3 >= 20 AND z + 3 < 110 AS contains, x < 600 AND 200 < x1 AND y < 650 AND 300 < y1 AND z < 110 AND 20 < z1 AS overlaps,
greatest(x, 200) AS ix, least(x1, 600) - greatest(x, 200) AS iw, least(x, 200) AS ux, greatest(x1, 600) - least(x, 200) AS uw, greatest(z, 20) AS iz, greatest(z1, 110) - least(z, 20) AS ud FROM block""", "block")
def volume_predicates(spark, d):
    blocks = view(spark, d, "block")
    one, two = Box.of(*PROBE), Box(blocks)
    inner, outer = two.intersection(one), two.union(one)
    return blocks.select("id", one.contains(*[F.col(c) + 3 for c in "xyz"]).alias("contains"), two.overlaps(one).alias("overlaps"), inner["x"].alias("ix"), inner["w"].alias("iw"), outer["x"].alias("ux"), outer["w"].alias("uw"), inner["z"].alias("iz"), outer["d"].alias("ud"))


@query(f"SELECT l.id AS id1, r.id AS id2, (least(l.x1, r.x1) - greatest(l.x, r.x)) * (least(l.y1, r.y1) - greatest(l.y, r.y)) * (least(l.z1, r.z1) - greatest(l.z, r.z)) AS volume FROM block l JOIN block r ON l.id < r.id AND {OVER}", "block")
def interval_join_3d(spark, d):
    met = joins.range_join(view(spark, d, "block"), view(spark, d, "block")).where("l_id < r_id")
    i = Box(met, "l_").intersection(Box(met, "r_"))
    return met.select(F.col("l_id").alias("id1"), F.col("r_id").alias("id2"), (i["w"] * i["h"] * i["d"]).alias("volume"))


@query("WITH big AS (SELECT id, x, y, z, x1 + 24 AS x1, y1 + 24 AS y1, z1 + 12 AS z1 FROM block) SELECT l.id AS outside, r.id AS inside FROM big l JOIN block r ON l.id <> r.id AND l.x <= r.x AND r.x1 <= l.x1 AND l.y <= r.y AND r.y1 <= l.y1 AND l.z <= r.z AND r.z1 <= l.z1", "block")
def containment_join(spark, d):
    blocks = view(spark, d, "block")
    big = blocks.withColumns({"x1": F.col("x1") + 24, "y1": F.col("y1") + 24, "z1": F.col("z1") + 12})
    return catalog.contained(big, blocks)


TYPED = """WITH ds AS (SELECT id, x, y, z, x1, y1, z1, CASE WHEN d % 2 = 0 THEN 'image' ELSE 'segmentation' END AS type, w AS task FROM block),
rq AS (SELECT id, x, y, z, x1, y1, z1, CASE WHEN d % 2 = 0 THEN 'image' ELSE 'segmentation' END AS type, CASE WHEN h % 3 = 0 THEN CAST(NULL AS BIGINT) ELSE h END AS src FROM block)"""


def _typed(spark, d):
    blocks = view(spark, d, "block")
    kind = F.when(F.col("d") % 2 == 0, "image").otherwise("segmentation").alias("type")
    datasets = blocks.select("id", *catalog.BOX, kind, F.col("w").alias("task"))
    requests = blocks.select("id", *catalog.BOX, kind, F.when(F.col("h") % 3 != 0, F.col("h")).alias("src_task"))
    return datasets, requests


@query(TYPED + f" SELECT l.id AS request, r.id AS dataset FROM rq l JOIN ds r ON l.type = r.type AND (l.src IS NULL OR l.src = r.task) AND {OVER}", "block")
def find_datasets(spark, d):
    datasets, requests = _typed(spark, d)
    return catalog.find_datasets(datasets, requests)


@query(TYPED + f", dep AS (SELECT l.id AS plan, r.id AS dataset FROM rq l JOIN ds r ON l.type = r.type AND (l.src IS NULL OR l.src = r.task) AND {OVER}) SELECT DISTINCT p.task, s.task AS needs FROM dep JOIN ds s ON s.id = dep.dataset JOIN ds p ON p.id = dep.plan", "block")
def dependency_chain(spark, d):
    datasets, requests = _typed(spark, d)
    dependents = catalog.find_datasets(datasets, requests).withColumnRenamed("request", "plan")
    tasks = datasets.select(F.col("task").alias("id")).distinct()
    return catalog.dependencies(tasks, datasets, dependents, datasets.select("id", "task"))


def _cuts(axis: str) -> str:
    a = axis
    return f"""c{a} AS (SELECT producer, c FROM (SELECT l.id AS producer, l.{a} AS lo, l.{a}1 AS hi, unnest([l.{a}, l.{a}1, r.{a}, r.{a}1]) AS c FROM block l JOIN block r ON {OVER}) WHERE c >= lo AND c <= hi GROUP BY 1, 2),
p{a} AS (SELECT producer, c AS lo, lead(c) OVER (PARTITION BY producer ORDER BY c) AS hi FROM c{a})"""


@query("WITH " + ", ".join(_cuts(a) for a in "xyz") + " SELECT px.producer, px.lo AS x, py.lo AS y, pz.lo AS z, px.hi AS x1, py.hi AS y1, pz.hi AS z1 FROM px JOIN py ON px.producer = py.producer JOIN pz ON px.producer = pz.producer WHERE px.hi IS NOT NULL AND py.hi IS NOT NULL AND pz.hi IS NOT NULL", "block")
def subvolume_pieces(spark, d):
    blocks = view(spark, d, "block")
    return catalog.subvolumes(blocks, blocks)


@query("WITH g AS (SELECT id, unnest(range(CAST(floor(x / 64) AS BIGINT), CAST(floor((x1 - 1) / 64) AS BIGINT) + 1)) AS tile_column, y, y1, z, z1 FROM block), h AS (SELECT id, tile_column, unnest(range(CAST(floor(y / 64) AS BIGINT), CAST(floor((y1 - 1) / 64) AS BIGINT) + 1)) AS tile_row, z, z1 FROM g) SELECT DISTINCT tile_column AS column, tile_row AS row, tile_z AS z, '/tiles/' || tile_z || '/' || tile_row || '_' || tile_column || '.png' AS location FROM (SELECT tile_column, tile_row, unnest(range(z, z1)) AS tile_z FROM h)", "block")
def tile_index(spark, d):
    from ..sources import documents

    return documents.tile_index(catalog.tile_grid(view(spark, d, "block"), (64, 64, 1)), "/tiles/{z}/{row}_{column}.png")


@query("""SELECT id, CASE WHEN x > 0 THEN x + 2 ELSE x END AS x, CASE WHEN x1 < 1008 THEN x1 - 2 ELSE x1 END AS x1, CASE WHEN z > 0 THEN z + 2 ELSE z END AS z, CASE WHEN z1 < 204 THEN z1 - 2 ELSE z1 END AS z1 FROM block""", "block")
def padding_trim(spark, d):
    blocks = view(spark, d, "block")
    kept = Box(blocks).trimmed(4, Box.of(0, 0, 0, 1008, 1008, 204))
    return blocks.select("id", *[kept[c].alias(c) for c in ("x", "x1", "z", "z1")])


@query("SELECT COALESCE(l.id, -1) AS left_id, COALESCE(r.id, -1) AS right_id, COALESCE(l.y, r.y) AS y, COALESCE(l.z, r.z) AS z, COALESCE(l.face, r.face) AS face FROM (SELECT MIN(id) AS id, y, z, x1 AS face FROM block GROUP BY y, z, x1) l FULL OUTER JOIN (SELECT MIN(id) AS id, y, z, x AS face FROM block GROUP BY y, z, x) r ON l.y = r.y AND l.z = r.z AND l.face = r.face", "block")
def face_match(spark, d):
    blocks = view(spark, d, "block")
    side = lambda face, name: blocks.groupBy("y", "z", F.col(face).alias("face")).agg(F.min("id").alias(name))
    return joins.face_match(side("x1", "left_id"), side("x", "right_id"), ["y", "z", "face"]).select(F.coalesce("left_id", F.lit(-1)).alias("left_id"), F.coalesce("right_id", F.lit(-1)).alias("right_id"), "y", "z", "face")


@query("""SELECT n_name AS dataset_name, CAST(COUNT(*) AS BIGINT) AS n, MIN(c_custkey) AS first_id, CAST(SUM(CASE WHEN r_name = 'ASIA' THEN 1 ELSE 0 END) AS BIGINT) AS asian FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name""")
def catalog_lookup(spark, d):
    customer, nation, region = (table(spark, d, t) for t in ("customer", "nation", "region"))
    met = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return met.groupBy(F.col("n_name").alias("dataset_name")).agg(F.count("*").alias("n"), F.min("c_custkey").alias("first_id"), F.sum((F.col("r_name") == "ASIA").cast("long")).alias("asian"))


QUERIES, ORACLES = query.queries, query.oracles
