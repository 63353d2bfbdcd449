"""Session helpers: reading tables, the folder that driver and executors share, cutting lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def reachable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, whatever the working folder. Harmless where it is installed."""
    home, env = str(Path(__file__).resolve().parent.parent), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, home])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Where it names none, a temporary folder if driver and executors are one process, else an error."""
    there = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not there:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        there = tempfile.mkdtemp(prefix="voxlake-")
        spark.sparkContext.setCheckpointDir(there)
    return there


_stored: list[str] = []


def place(spark: SparkSession) -> str:
    """A new path in the shared folder, which `release` deletes with the stored tables."""
    path = f"{shared_dir(spark)}/voxlake-{uuid.uuid4().hex}"
    _stored.append(path)
    return path


def store(df: DataFrame, **options: str) -> DataFrame:
    """`df`, written as Parquet (with the writer's `options`) to the shared folder and read again: cuts the lineage, and survives a lost executor."""
    spark = df.sparkSession
    path = place(spark)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored() -> int:
    """How many tables `store` has written in this process and not released."""
    return len(_stored)


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Deletes the tables that `store` has written in this process, from the `since`-th on but for the last `keep`.

    Call it when no result that reads them is needed any more.
    """
    conf, n = spark._jsc.hadoopConfiguration(), 0
    paths = _stored[since : len(_stored) - keep]
    _stored[since : len(_stored) - keep] = []
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n
