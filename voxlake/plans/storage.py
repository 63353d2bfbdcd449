"""Queries on what is written and read again: volumes, plans, planes, documents, tables; and on sets of rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.boxes import Box
from ..operators import classify, graphs
from ..sources import blocks, documents, tiff, tiles
from ..spark import place, store, table
from . import scalar
from .graph import nodes as customers
from .graph import weighted
from .naming import Collected, rounded
from .synapse import network
from .views import view

query = Collected()
KEYS, BLOCK = ("z", "y", "x"), (4, 32, 32)


def volume(spark, d, *values: str) -> str:
    """A folder of chunks with a dataset for each of the named columns."""
    path = place(spark)
    for value in values:
        blocks.write_chunks(view(spark, d, "vox"), path, dataset=value, value=value, block=BLOCK)
    return path


@query("SELECT z, y, x, a AS value FROM vox WHERE a <> 0", "vox")
def volume_round_trip(spark, d):
    return blocks.read_chunks(spark, volume(spark, d, "a"), dataset="a").where("value <> 0")


@query("SELECT z, y, x, b AS value FROM vox WHERE b <> 0", "vox")
def one_of_two_datasets(spark, d):
    return blocks.read_chunks(spark, volume(spark, d, "a", "b"), dataset="b").where("value <> 0")


@query("SELECT z, y, x, p AS value FROM vox WHERE p <> 0 AND x >= 5 AND x < 45 AND y >= 10 AND y < 60 AND z >= 2 AND z < 6", "vox")
def exported_box(spark, d):
    """A box of a volume, written as a volume of its own."""
    inside = blocks.read_chunks(spark, volume(spark, d, "p"), dataset="p", box=(5, 10, 2, 40, 50, 4))
    path = place(spark)
    blocks.write_chunks(inside, path, dataset="box", value="value", block=(2, 16, 16), dtype="uint8")
    return blocks.read_chunks(spark, path, dataset="box").where("value <> 0")


@query("SELECT 'a' AS dataset, CAST(0 AS BIGINT) AS voxels UNION ALL SELECT 'b', CAST(COUNT(*) AS BIGINT) FROM vox WHERE b <> 0", "vox")
def deleted_dataset(spark, d):
    path = volume(spark, d, "a", "b")
    blocks.delete_dataset(spark, path, "a")
    count = lambda n: blocks.read_chunks(spark, path, dataset=n).where("value <> 0").agg(F.lit(n).alias("dataset"), F.count("*").alias("voxels"))
    return count("a").unionByName(count("b"))


@query("SELECT z, y, x, a + 1000 AS value FROM vox WHERE a <> 0", "vox")
def stitched_volume(spark, d):
    """Two halves that overlap by 16 voxels, each with labels of its own, as one volume of global ones."""
    vox = view(spark, d, "vox")
    ends = vox.agg(*[f(c) for c in "xyz" for f in (F.min, F.max)]).first()
    whole = [(ends[2 * i], ends[2 * i + 1] + 1) for i in range(3)]
    halves = None
    for name, low, high, shift in (("one", whole[0][0], 40, 7), ("two", 24, whole[0][1], 300)):
        box = {f"box_{c}{n}": F.lit(int(v)) for c, (a, b) in zip("xyz", [(low, high), *whole[1:]], strict=True) for n, v in (("", a), ("1", b))}
        half = vox.where((F.col("x") >= low) & (F.col("x") < high)).select(F.lit(name).alias("block"), *[v.alias(k) for k, v in box.items()], *KEYS, (F.col("a") + shift).alias("local"))
        halves = half if halves is None else halves.unionByName(half)
    mapping = halves.where((F.col("local") != 7) & (F.col("local") != 300)).select("block", "local", (F.col("local") - F.when(F.col("block") == "one", 7).otherwise(300) + 1000).alias("global")).distinct()
    path = place(spark)
    blocks.write_stitched(halves, mapping, path, dataset="all", pad=16, whole=(*[int(a) for a, _ in whole], *[int(b - a) for a, b in whole]), chunk=BLOCK)
    return blocks.read_chunks(spark, path, dataset="all").where("value <> 0")


@query("SELECT q.z, q.y, q.x, COALESCE(vox.a, 0) AS value FROM (SELECT z, y, x FROM (SELECT unnest(range(4, 10)) AS z), (SELECT unnest(range(10, 60)) AS y), (SELECT unnest(range(20, 80)) AS x)) q LEFT JOIN vox ON vox.z = (q.z - 1) // 2 AND vox.y = (q.y - 2) // 4 AND vox.x = (q.x - 3) // 4", "vox")
def repaired_region(spark, d):
    coarse = view(spark, d, "vox").select(*KEYS, F.col("a").alias("value"))
    return blocks.repair_scan(coarse, (20, 10, 4, 60, 50, 6), (3, 2, 1), (4, 4, 2))


@query("SELECT q.z, q.y, q.x, COALESCE(vox.p, 0) AS value FROM (SELECT z, y, x FROM (SELECT unnest(range(1, 5)) AS z), (SELECT unnest(range(0, 50)) AS y), (SELECT unnest(range(0, 60)) AS x)) q LEFT JOIN vox ON vox.z = q.z AND vox.y = q.y // 2 AND vox.x = q.x // 2", "vox")
def precomputed_probabilities(spark, d):
    return classify.precomputed(view(spark, d, "vox").select(*KEYS, F.col("p").alias("value")), (0, 0, 1, 60, 50, 4), 1)


@query("SELECT z, y, x, a + 256 * p AS value FROM vox WHERE a + 256 * p <> 0", "vox")
def png_round_trip(spark, d):
    """Planes as PNG tiles of three channels, and back."""
    written = store(blocks.png_planes(view(spark, d, "vox").select(*KEYS, (F.col("a") + 256 * F.col("p")).alias("v")), "v", tile=(32, 32)))
    return tiles.png_voxels(written).where("value <> 0")


@query("SELECT z, y, x, p AS value FROM vox WHERE p <> 0", "vox")
def tiff_round_trip(spark, d):
    """A TIFF for each plane, and back."""
    return tiff.tiff_voxels(store(tiff.tiff_planes(view(spark, d, "vox"), "p"))).where("value <> 0")


@query("SELECT z, CAST(COUNT(*) AS BIGINT) AS tiles FROM (SELECT DISTINCT z, y // 32 AS r, x // 32 AS c FROM vox) GROUP BY z", "vox")
def plane_tiles(spark, d):
    """How many tiles each plane is written as."""
    named = blocks.png_planes(view(spark, d, "vox"), "a", tile=(32, 32)).select(F.regexp_extract("name", r"_(\d+)\.png$", 1).cast("long").alias("z"))
    return named.groupBy("z").agg(F.count("*").alias("tiles"))


DATASETS = "ds AS (SELECT x, y, z, x1, y1, z1, 'ds' || (id % 3) AS dataset_name, 'uint8' AS datatype, id % 3 AS dataset_id, '/data/' || id || '.tif' AS path FROM block)"


def dataset_blocks(spark, d):
    b = view(spark, d, "block")
    number = F.col("id") % 3
    return b.select("x", "y", "z", "x1", "y1", "z1", F.concat(F.lit("ds"), number.cast("string")).alias("dataset_name"), F.lit("uint8").alias("datatype"), number.alias("dataset_id"), F.concat(F.lit("/data/"), F.col("id").cast("string"), F.lit(".tif")).alias("path"))


@query(f"""WITH {DATASETS}, dims AS (SELECT dataset_name AS n, MAX(z1) - MIN(z) AS depth, MAX(y1) - MIN(y) AS height, MAX(x1) - MIN(x) AS width FROM ds GROUP BY 1)
SELECT dataset_name, datatype, depth, height, width, x, y, z, x1 - x AS w, path FROM ds JOIN dims ON n = dataset_name""", "block")
def storage_plans(spark, d):
    """Storage plans as JSON files, read again a row a block."""
    path = place(spark)
    blocks.storage_plan(dataset_blocks(spark, d)).write.text(path)
    told = blocks.read_plans(spark, path, lines=True)
    return told.select("dataset_name", "datatype", *[F.col("dimensions")[i].alias(n) for i, n in enumerate(("depth", "height", "width"))], *[F.col(f"volume.{c}").alias(c) for c in "xyz"], F.col("volume.width").alias("w"), "path")


@query(f"WITH {DATASETS} SELECT dataset_name, 100 + dataset_id AS loading_plan_id, CAST(COUNT(*) AS BIGINT) AS blocks, MIN(path) AS path, '/data/' || dataset_name || '.done' AS waits FROM ds GROUP BY dataset_name, dataset_id", "block")
def loading_plans(spark, d):
    """Loading plans made of storage plans, as JSON files, read again."""
    path = place(spark)
    plans = blocks.storage_plan(dataset_blocks(spark, d))
    number = F.get_json_object("plan", "$.dataset_id").cast("long")
    done = F.array(F.concat(F.lit("/data/"), F.get_json_object("plan", "$.dataset_name"), F.lit(".done")))
    blocks.loading_plans(plans, number + 100, done).write.text(path)
    read = spark.read.json(path).select("dataset_name", "loading_plan_id", F.col("dataset_done_files")[0].alias("waits"), F.explode("blocks").alias("b"))
    return read.groupBy("dataset_name", "loading_plan_id", "waits").agg(F.count("*").alias("blocks"), F.min("b.path").alias("path"))


@query("SELECT path FROM (SELECT '/plans/' || o_custkey || '/' || o_orderpriority || '_' || o_orderkey || '.plan' AS path FROM orders) WHERE split_part(path, '/', -1) LIKE '1-URGENT%'")
def found_plans(spark, d):
    paths = table(spark, d, "orders").select(F.concat(F.lit("/plans/"), F.col("o_custkey").cast("string"), F.lit("/"), F.col("o_orderpriority"), F.lit("_"), F.col("o_orderkey").cast("string"), F.lit(".plan")).alias("path"))
    return blocks.find_plans(paths, "1-URGENT")


@query("SELECT 'orders.parquet' AS name, CAST(COUNT(*) AS BIGINT) AS n FROM orders")
def found_files(spark, d):
    """Files of a folder by name, and what they hold."""
    files = blocks.find_files(spark, d, "orders*.parquet")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name")).distinct().crossJoin(table(spark, d, "orders").agg(F.count("*").alias("n")))  # one row each


SYNAPSES = "SELECT id, n1 AS neuron_1, 100000 + n2 % 7000 AS neuron_2, round(score, 2) AS score, px AS x, py AS y, pz AS z FROM point"


def synapses(spark, d):
    p = view(spark, d, "point")
    return p.select("id", F.col("n1").alias("neuron_1"), (F.col("n2") % 7000 + 100000).alias("neuron_2"), F.round("score", 2).alias("score"), F.col("px").alias("x"), F.col("py").alias("y"), F.col("pz").alias("z"))


@query(f"SELECT neuron_1, neuron_2, score, x, y, z FROM ({SYNAPSES})", "point")
def synapse_documents(spark, d):
    """A JSON document for each block of 4,000 places, written as text and read again."""
    path = place(spark)
    documents.synapse_document(synapses(spark, d), by=[F.floor(F.col("x") / 4000), F.floor(F.col("y") / 4000), F.col("z")]).write.text(path)
    return documents.synapse_rows(spark.read.schema(documents.SYNAPSES).json(path))


@query("WITH c AS (SELECT z, a, b, COUNT(*) AS n FROM vox WHERE a <> 0 AND b <> 0 GROUP BY 1, 2, 3) SELECT z, a, b, n FROM c", "vox")
def connection_documents(spark, d):
    """A JSON document of connections for each plane, read again."""
    vox = view(spark, d, "vox").where("a <> 0 and b <> 0")
    pairs = vox.groupBy("z", "a", "b").agg(F.count("*").alias("n"))
    area = lambda c: vox.groupBy("z", F.col(c).alias("label")).agg(F.count("*").alias("area"))
    path = place(spark)
    documents.connection_document(pairs, area("a"), area("b"), by=["z"]).select(F.struct("z", "document").alias("d")).select(F.to_json("d").alias("value")).write.text(path)
    read = spark.read.schema("z long, document string").json(path).select("z", F.from_json("document", "connections array<array<long>>, counts array<long>").alias("d"))
    rows = read.select("z", F.explode(F.arrays_zip(F.col("d.connections").alias("c"), F.col("d.counts").alias("n"))).alias("r"))
    return rows.select("z", F.col("r.c")[0].alias("a"), F.col("r.c")[1].alias("b"), F.col("r.n").alias("n"))


@query("SELECT least(u, v) AS u, greatest(u, v) AS v, 1 + u % 5 AS size, round((u * 7 + v) % 100 / 100.0E0, 6) AS weight FROM edge", "edge")
def graph_documents(spark, d):
    """Region graphs as JSON, one for every 64 nodes, read again."""
    part = F.floor(F.col("node") / 64)
    n = customers(spark, d).select("node", F.lit(1).cast("long").alias("size"))
    e = weighted(spark, d).select("u", "v", "size", "weight")
    document = documents.rag_document(n.withColumn("part", part), e.withColumn("part", F.floor(F.col("u") / 64)), by=["part"])
    return rounded(documents.rag_tables(store(document))[1], "weight")


@query(scalar.ORACLES["task_times"])
def timing_csv(spark, d):
    """Run times of tasks as CSV, and back."""
    told, path = scalar.QUERIES["task_times"](spark, d), place(spark)
    how = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    told.write.options(**how).csv(path)
    return spark.read.schema(told.schema).options(**how).csv(path)


@query(SYNAPSES, "point")
def copied_table(spark, d):
    """A table written, its folder copied, and the copy read."""
    one, two = place(spark), place(spark)
    rows = synapses(spark, d)
    rows.write.parquet(one)
    blocks.copy_path(spark, one, two)
    return spark.read.schema(rows.schema).parquet(two)


# Sets of rows


@query("SELECT a AS u, b AS v FROM vox WHERE a <> 0 AND b <> 0 UNION SELECT b, a FROM vox WHERE a <> 0 AND b <> 0 UNION SELECT a, a FROM vox WHERE a <> 0", "vox")
def connections_both_ways(spark, d):
    vox = view(spark, d, "vox")
    return graphs.both_ways(vox.where("a <> 0 and b <> 0").select(F.col("a").alias("u"), F.col("b").alias("v")), vox.where("a <> 0").select(F.col("a").alias("node")))


@query("WITH gone AS (SELECT id FROM point WHERE score < 20000 UNION SELECT id FROM point WHERE pz > 5) SELECT id, n1, n2 FROM point WHERE id NOT IN (SELECT id FROM gone)", "point")
def rows_left(spark, d):
    """Synapses without those that one of two filters removes."""
    p = view(spark, d, "point")
    gone = p.where("score < 20000").select("id").union(p.where("pz > 5").select("id")).distinct()
    return p.join(gone, "id", "left_anti").select("id", "n1", "n2")


@query("SELECT DISTINCT CAST(p // 10 AS BIGINT) AS threshold FROM vox WHERE p % 10 = 0 EXCEPT SELECT DISTINCT CAST(a AS BIGINT) FROM vox", "vox")
def missing_thresholds(spark, d):
    vox = view(spark, d, "vox")
    return vox.where("p % 10 = 0").select(F.floor(F.col("p") / 10).alias("threshold")).distinct().exceptAll(vox.select("a").distinct())


@query("SELECT DISTINCT a * 1000 + b AS pair, a, b FROM vox", "vox")
def encoded_pairs(spark, d):
    return view(spark, d, "vox").select((F.col("a") * 1000 + F.col("b")).alias("pair"), "a", "b").distinct()


@query("""WITH n AS (SELECT id, x, y, z, x1, y1, z1, unnest([x, x + 4, x1]) AS cx FROM block), xs AS (SELECT id, cx AS low, lead(cx) OVER (PARTITION BY id ORDER BY cx) AS high FROM n),
m AS (SELECT id, unnest([y, y + 4, y1]) AS cy FROM block), ys AS (SELECT id, cy AS low, lead(cy) OVER (PARTITION BY id ORDER BY cy) AS high FROM m)
SELECT xs.id, xs.low AS x, xs.high AS x1, ys.low AS y, ys.high AS y1 FROM xs JOIN ys ON xs.id = ys.id WHERE xs.high IS NOT NULL AND ys.high IS NOT NULL""", "block")
def cut_products(spark, d):
    """The pieces into which a box falls by its cuts on two axes."""
    b = view(spark, d, "block")
    cuts = lambda c: F.array(F.struct(F.col(c).alias("low"), (F.col(c) + 4).alias("high")), F.struct((F.col(c) + 4).alias("low"), F.col(f"{c}1").alias("high")))
    told = b.select("id", F.explode(cuts("x")).alias("i"), "y", "y1").select("id", "i", F.explode(cuts("y")).alias("j"))
    return told.select("id", F.col("i.low").alias("x"), F.col("i.high").alias("x1"), F.col("j.low").alias("y"), F.col("j.high").alias("y1"))


@query("SELECT 1 AS side, n1 AS neuron, CAST(COUNT(*) AS BIGINT) AS n FROM point GROUP BY n1 UNION ALL SELECT 2, 100000 + n2 % 7000, CAST(COUNT(*) AS BIGINT) FROM point GROUP BY 2", "point")
def columns_of_blocks(spark, d):
    """Both sides' columns one after the other."""
    n = network(spark, d)
    side = lambda k: n.select(F.lit(k).alias("side"), F.col(f"neuron_{k}").alias("neuron"))
    return side(1).unionByName(side(2)).groupBy("side", "neuron").agg(F.count("*").alias("n"))


@query("WITH e AS (SELECT MAX(x1) AS w, MAX(y1) AS h, MAX(z1) AS d FROM block) SELECT i, j, k FROM e, (SELECT unnest(range(0, 40)) AS i), (SELECT unnest(range(0, 40)) AS j), (SELECT unnest(range(0, 40)) AS k) WHERE i * 256 < w AND j * 256 < h AND k * 64 < d", "block")
def grid_of_blocks(spark, d):
    """All blocks of 256 x 256 x 64 that cover the boxes' extent."""
    ends = view(spark, d, "block").agg(*[F.max(f"{c}1").alias(c) for c in "xyz"])
    for name, axis, size in (("i", "x", 256), ("j", "y", 256), ("k", "z", 64)):
        ends = ends.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(axis) - 1) / size))))
    return ends.select("i", "j", "k")


@query("WITH m AS (SELECT DISTINCT a AS node, a % 4 AS root FROM vox WHERE a <> 0), k AS (SELECT m.root AS label, b, COUNT(*) AS n FROM vox JOIN m ON vox.a = m.node WHERE b <> 0 GROUP BY 1, 2) SELECT label, b AS assigned, n FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, b) AS i FROM k) WHERE i = 1", "vox")
def assignment_after_merges(spark, d):
    """Best matches of labels after merges, from the counts before them."""
    counts = view(spark, d, "vox").where("a <> 0 and b <> 0").groupBy(F.col("a").alias("label"), "b").agg(F.count("*").alias("n"))
    merged = counts.select(F.col("label").alias("node"), (F.col("label") % 4).alias("root")).distinct()
    return graphs.assigned_after(counts.withColumnRenamed("b", "other"), merged).withColumnRenamed("other", "assigned")


LABELS = "m AS (SELECT DISTINCT a AS node, CASE WHEN a % 3 = 0 THEN a % 2 + 1 ELSE a END AS one FROM vox WHERE a <> 0), h AS (SELECT node, one, CASE WHEN one % 5 = 0 THEN 5 ELSE one END AS two FROM m)"


def _history(spark, d):
    first = view(spark, d, "vox").where("a <> 0").select(F.col("a").alias("node")).distinct()
    one = first.withColumn("root", F.when(F.col("node") % 3 == 0, F.col("node") % 2 + 1).otherwise(F.col("node")))
    two = one.select(F.col("root").alias("node")).distinct().withColumn("root", F.when(F.col("node") % 5 == 0, 5).otherwise(F.col("node")))
    return first, [one, two]


@query(f"WITH {LABELS} SELECT node, two AS label FROM h", "vox")
def reassigned_labels(spark, d):
    first, steps = _history(spark, d)
    return graphs.reassigned(first, steps)


@query(f"WITH {LABELS} SELECT two AS label, node FROM h WHERE two <> node", "vox")
def label_history(spark, d):
    first, steps = _history(spark, d)
    return graphs.history(first, steps)


@query(f"WITH {LABELS} SELECT node, CASE WHEN two IN (1, 2) THEN one + 1000 * CAST(node <> one AS INTEGER) ELSE two END AS label FROM h", "vox")
def split_labels(spark, d):
    """Labels 1 and 2 taken apart again: what the first step joined to them gets labels of its own."""
    first, steps = _history(spark, d)
    told = graphs.reassigned(first, steps)
    apart = first.join(steps[0], "node").where("root in (1, 2)").select("node", (F.col("root") + 1000 * (F.col("node") != F.col("root")).cast("long")).alias("piece"))
    return graphs.split(told, apart)


QUERIES, ORACLES = query.queries, query.oracles
