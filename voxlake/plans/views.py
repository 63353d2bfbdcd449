"""The test tables seen as volumes: the same text runs in Spark and in DuckDB.

vox    one row a voxel: two segmentations a and b (0 is background) and a probability p of 0 to 255
block  3-D boxes, one an order
edge   a sparse graph over customers
point  scored points with two neurons each, one a (order, line number)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..spark import table

VOX = """SELECT z, y, x, a, p, CASE WHEN (x * 7 + y * 3 + z) % 10 < 8 THEN CASE WHEN a = 0 THEN 0 ELSE 1 + a % 7 END ELSE b0 END AS b
FROM (SELECT z, y, x, p, (x + y * 2 + z) % 6 AS b0,
             CAST(floor(x / 8) + floor(y / 16) * 8 + floor(z / 4) * 3 AS BIGINT) % 13 AS a
      FROM (SELECT CAST(l_linenumber AS BIGINT) AS z, l_partkey % 64 AS y, l_orderkey % 64 AS x, CAST(MAX(l_quantity * 5) AS BIGINT) % 256 AS p
            FROM {lineitem} GROUP BY 1, 2, 3) g) h"""

BLOCK = """SELECT id, x, y, z, w, h, d, x + w AS x1, y + h AS y1, z + d AS z1
FROM (SELECT o_orderkey AS id, o_orderkey * 7919 % 1000 AS x, o_custkey * 10477 % 1000 AS y, o_orderkey % 50 * 4 AS z,
             8 + o_orderkey % 9 AS w, 8 + o_custkey % 9 AS h, 4 + o_orderkey % 5 AS d FROM {orders}) o"""

EDGE = """SELECT c_custkey AS u, c_custkey - 1 - c_nationkey AS v FROM {customer} WHERE c_mktsegment <> 'BUILDING' AND c_custkey > c_nationkey"""

POINT = """SELECT l_orderkey * 10 + l_linenumber AS id, (l_orderkey * 31 + MIN(l_partkey) * 17) % 29989 AS px, (l_orderkey * 977 + l_linenumber * 7) % 29959 AS py,
       CAST(l_linenumber AS BIGINT) AS pz, MAX(l_extendedprice) AS score, l_orderkey AS n1, MIN(l_partkey) AS n2
FROM {lineitem} GROUP BY l_orderkey, l_linenumber"""

VIEWS = {"vox": (VOX, "lineitem"), "block": (BLOCK, "orders"), "edge": (EDGE, "customer"), "point": (POINT, "lineitem")}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql, source = VIEWS[name]
    return spark.sql(sql, **{source: table(spark, sf_dir, source)})


def oracle(sql: str, *names: str) -> str:
    """`sql` for DuckDB over the views it names."""
    ctes = [f"{n} AS ({VIEWS[n][0].format(**{VIEWS[n][1]: VIEWS[n][1]})})" for n in names]
    head = "WITH RECURSIVE " if "RECURSIVE" in sql else "WITH "
    body = sql.replace("WITH RECURSIVE", "WITH", 1).strip()
    if body.startswith("WITH "):
        return head + ",\n".join(ctes) + ",\n" + body[5:]
    return head + ",\n".join(ctes) + "\n" + body
