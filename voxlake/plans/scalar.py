"""Queries on scalar functions, documents and task times."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars
from ..sources import documents
from ..spark import table
from ..streaming import events
from .naming import Collected, rounded
from .views import view

query = Collected()


@query("""SELECT id, '/root/' || x || '/' || y || '/' || z || '/image_' || lpad(CAST(x AS VARCHAR), 9, '0') || '-' || lpad(CAST(x1 AS VARCHAR), 9, '0') || '_' || lpad(CAST(y AS VARCHAR), 9, '0') || '-' || lpad(CAST(y1 AS VARCHAR), 9, '0') || '_' || lpad(CAST(z AS VARCHAR), 9, '0') || '-' || lpad(CAST(z1 AS VARCHAR), 9, '0') || '_' || id || '.storage.done' AS done FROM block""", "block")
def plan_paths(spark, d):
    b = view(spark, d, "block")
    path = scalars.plan_path("/root", F.lit("image"), {c: F.col(c) for c in ("x", "y", "z", "x1", "y1", "z1")}, F.col("id"))
    return b.select("id", scalars.with_suffix(path, ".plan", ".done").alias("done"))


@query("SELECT id, x % 256 * 65536 + y % 256 * 256 + z AS packed, x % 256 AS r, y % 256 AS g, z AS b FROM block", "block")
def rgb_pack(spark, d):
    packed = view(spark, d, "block").select("id", scalars.rgb_pack(F.col("x") % 256, F.col("y") % 256, F.col("z")).alias("packed"))
    r, g, b = scalars.rgb_unpack(F.col("packed"))
    return packed.select("id", "packed", r.alias("r"), g.alias("g"), b.alias("b"))


MORTON = " + ".join(f"((({c} >> {i}) & 1) << {3 * i + k})" for i in range(10) for k, c in enumerate("xyz"))


@query(f"SELECT id, CAST({MORTON} AS BIGINT) AS morton, CAST((x + y) * (x + y + 1) / 2 AS BIGINT) + y AS pair FROM block", "block")
def morton(spark, d):
    b = view(spark, d, "block")
    return b.select("id", scalars.morton(F.col("x"), F.col("y"), F.col("z"), 10).alias("morton"), scalars.pairing(F.col("x"), F.col("y")).alias("pair"))


@query("SELECT id, (CAST(('0x' || substr(m, 1, 2)) AS BIGINT) + 255 * CAST(('0x' || substr(m, 3, 2)) AS BIGINT)) % 7 AS shard FROM (SELECT id, md5(x || ',' || y || ',' || z) AS m FROM block)", "block")
def md5_shard(spark, d):
    return view(spark, d, "block").select("id", scalars.path_shard(F.col("x"), F.col("y"), F.col("z"), 7).alias("shard"))


@query("SELECT z, y, x, CAST(floor(least(greatest((p - 20) / 200.0E0, 0), 1) * 255 + 0.5) AS INTEGER) AS q, 255 - CAST(floor(least(greatest((p - 20) / 200.0E0, 0), 1) * 255 + 0.5) AS INTEGER) AS inverted, round(p * 2.0E0 + 100, 6) AS bytes, round(p * ln(2.0E0), 6) AS nats FROM vox", "vox")
def quantised(spark, d):
    p = F.col("p").cast("double")
    told = view(spark, d, "vox").select("z", "y", "x", scalars.quantised(p, low=20, high=220).alias("q"), scalars.quantised(p, low=20, high=220, inverted=True).alias("inverted"), scalars.memory_model(p, (100, 300), (200, 500)).alias("bytes"), scalars.bits_to_nats(p).alias("nats"))
    return rounded(told, "bytes", "nats")


@query("""SELECT CAST(c_acctbal AS VARCHAR) AS acctbal, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nationkey, '' AS segment FROM customer
UNION ALL SELECT CAST(s_acctbal AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR), '' FROM supplier UNION ALL SELECT '', '', '', c_mktsegment FROM customer""")
def json_union_csv(spark, d):
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    part = lambda df, p: df.select(F.col(f"{p}_name").alias("name"), F.col(f"{p}_nationkey").alias("nationkey"), F.col(f"{p}_acctbal").alias("acctbal"), F.lit(1).alias("hidden"))
    return documents.united([part(c, "c"), part(s, "s"), c.select(F.col("c_mktsegment").alias("segment"))], excluded=("hidden",))


@query("""WITH s AS (SELECT user_id, MAX(ts) AS t FROM events WHERE event_type = 'signup' GROUP BY 1), e AS (SELECT s.user_id, s.t, MIN(ts) AS e FROM events JOIN s ON events.user_id = s.user_id AND ts > t WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT user_id, t AS start, e AS "end", CAST(epoch_us(e) - epoch_us(t) AS BIGINT) AS micros FROM e""")
def task_times(spark, d):
    return events.task_times(table(spark, d, "events"), "user_id", "signup", "purchase")


@query("SELECT date_trunc('hour', ts) AS start, event_type, CAST(COUNT(*) AS BIGINT) AS n, round(SUM(value), 4) AS total FROM events GROUP BY 1, 2")
def windowed_events(spark, d):
    return rounded(events.windowed(table(spark, d, "events")), "total", digits=4)


@query("""WITH m AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, SUM(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM m)
SELECT user_id, MIN(ts) AS start, MAX(ts) + INTERVAL 30 MINUTE AS "end", CAST(COUNT(*) AS BIGINT) AS n FROM s GROUP BY user_id, k""")
def event_sessions(spark, d):
    return events.sessions(table(spark, d, "events"))


@query("""SELECT o_orderpriority AS dataset_name, CAST(COUNT(*) AS BIGINT) AS blocks, MIN(x) AS x, MAX(x1) AS x1 FROM block JOIN orders ON id = o_orderkey GROUP BY 1""", "block")
def pipeline_index(spark, d):
    b = view(spark, d, "block").join(table(spark, d, "orders"), F.col("id") == F.col("o_orderkey")).withColumn("path", F.col("id").cast("string")).withColumnRenamed("o_orderpriority", "dataset_name")
    index = documents.pipeline_index(b)
    return index.select("dataset_name", F.size("blocks").cast("long").alias("blocks"), F.array_min(F.transform("blocks", lambda s: s["x"])).alias("x"), F.array_max(F.transform("blocks", lambda s: s["x1"])).alias("x1"))


@query("SELECT a AS label, CAST(COUNT(*) * 2 AS BIGINT) AS triangles FROM (SELECT c.a FROM vox c CROSS JOIN (VALUES (1,0,0),(-1,0,0),(0,1,0),(0,-1,0),(0,0,1),(0,0,-1)) AS s(dz, dy, dx) LEFT JOIN vox o ON o.z = c.z + dz AND o.y = c.y + dy AND o.x = c.x + dx AND o.a = c.a WHERE c.a <> 0 AND o.a IS NULL) GROUP BY a", "vox")
def surface_triangles(spark, d):
    return documents.surface(view(spark, d, "vox"), "a").groupBy("label").agg(F.count("*").alias("triangles"))


@query("SELECT id, x + y + z AS total, w * h * d AS volume FROM block", "block")
def volume_json(spark, d):
    """Boxes to JSON and back."""
    text = view(spark, d, "block").select("id", F.to_json(F.struct("x", "y", "z", F.col("w").alias("width"), F.col("h").alias("height"), F.col("d").alias("depth"))).alias("volume"))
    back = text.select("id", F.from_json("volume", "x long, y long, z long, width long, height long, depth long").alias("v"))
    return back.select("id", F.expr("v.x + v.y + v.z").alias("total"), F.expr("v.width * v.height * v.depth").alias("volume"))


HISTORY = """SELECT s.user_id, COUNT(*) AS runs, MAX(s.event_id) AS last_id, COALESCE(MAX(p.top), '') AS top FROM {events} s JOIN {events} e ON s.user_id = e.user_id AND e.event_type = 'purchase' AND e.ts > s.ts
LEFT OUTER JOIN (SELECT user_id, MAX(props) AS top FROM {events} WHERE event_type LIKE '%view' GROUP BY user_id) p ON p.user_id = s.user_id WHERE s.event_type = 'signup' GROUP BY s.user_id"""


@query(HISTORY.format(events="events"))
def task_history(spark, d):
    return spark.sql(HISTORY, events=table(spark, d, "events"))


@query("SELECT p_type AS class, CAST(COUNT(*) AS BIGINT) AS n, round(SUM(l_quantity), 4) AS seconds FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def runtime_totals(spark, d):
    li, part = table(spark, d, "lineitem"), table(spark, d, "part")
    task = part.select("p_partkey", scalars.task_class(F.concat(F.lit("ns."), F.col("p_type"), F.lit("_"), F.col("p_brand"))).alias("class"))
    told = li.join(task, F.col("l_partkey") == F.col("p_partkey")).groupBy("class").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("seconds"))
    return rounded(told, "seconds", digits=4)


@query("SELECT v FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, COUNT(*) OVER () AS n FROM (SELECT DISTINCT o_custkey AS v FROM orders)) WHERE n < 200 OR i % CAST(floor(n / 100) AS BIGINT) = 0")
def stratified_sample(spark, d):
    """Every so many of the distinct values, so that about 100 stay: a sampling operator."""
    from ..operators.overlap import dense_rank

    ranked = dense_rank(table(spark, d, "orders").select(F.col("o_custkey").alias("v")), "v", "i")
    n = ranked.agg(F.count("*").alias("n"))
    return ranked.crossJoin(F.broadcast(n)).where((F.col("n") < 200) | ((F.col("i") - 1) % F.greatest(F.floor(F.col("n") / 100), F.lit(1)) == 0)).select("v")  # one row


@query("SELECT l_suppkey AS k, MIN(v - before) AS least FROM (SELECT l_suppkey, v, lag(v) OVER (PARTITION BY l_suppkey ORDER BY v) AS before FROM (SELECT DISTINCT l_suppkey, l_partkey AS v FROM lineitem)) WHERE before IS NOT NULL GROUP BY 1")
def smallest_difference(spark, d):
    from pyspark.sql.window import Window

    own = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_partkey").alias("v")).distinct()
    return own.withColumn("step", F.col("v") - F.lag("v").over(Window.partitionBy("k").orderBy("v"))).where("step is not null").groupBy("k").agg(F.min("step").alias("least"))


@query("SELECT id, round(((1008 - x1) * (1008 - x1) + (1008 - y1) * (1008 - y1) + (204 - z1) * (204 - z1)) / (1008.0E0 * 1008 * 2 + 204 * 204), 6) AS priority FROM block", "block")
def far_corner_priority(spark, d):
    far = lambda c, n: (F.lit(n) - F.col(c)) * (F.lit(n) - F.col(c))
    told = view(spark, d, "block").select("id", ((far("x1", 1008) + far("y1", 1008) + far("z1", 204)) / (1008.0 * 1008 * 2 + 204 * 204)).alias("priority"))
    return rounded(told, "priority")


QUERIES, ORACLES = query.queries, query.oracles
