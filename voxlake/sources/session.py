"""A proofreading session as a folder: its tables, what was decided, and the volume that follows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graphs import reassigned

TABLES = {"voxels": "z long, y long, x long, label long", "nodes": "node long, size long", "edges": "u long, v long, size long, weight double", "decisions": "step long, node long, root long"}


def save_session(path: str, **tables: DataFrame) -> None:
    """Writes the session's tables (any of TABLES); one that is there already is replaced."""
    for name, df in tables.items():
        df.select(*[c.split()[0] for c in TABLES[name].split(", ")]).write.mode("overwrite").parquet(f"{path}/{name}")


def open_session(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{path}/{name}")


def decide(path: str, step: int, joins: DataFrame) -> None:
    """Adds a step's joins (node, root) to the decisions."""
    joins.select(F.lit(step).cast("long").alias("step"), "node", "root").write.mode("append").parquet(f"{path}/decisions")


def export_session(spark: SparkSession, path: str) -> DataFrame:
    """(z, y, x, label) after all decisions, in the order of their steps."""
    voxels, decisions = (open_session(spark, path, n) for n in ("voxels", "decisions"))
    steps = [r["step"] for r in decisions.select("step").distinct().orderBy("step").collect()]  # a number a step of a person's work
    told = reassigned(voxels.select(F.col("label").alias("node")).distinct(), [decisions.where(F.col("step") == s).select("node", "root") for s in steps])
    return voxels.join(told.select(F.col("node").alias("label"), F.col("label").alias("to")), "label").select("z", "y", "x", F.col("to").alias("label"))
