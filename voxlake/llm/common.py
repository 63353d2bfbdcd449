"""What the operators of this package share on the Spark side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spark import reachable, release, store, stored
from ..spark import table as read

__all__ = ["crc_fold", "fit_logistic", "free", "in_fold", "labelled_sample", "read", "release", "small_batches", "store", "stored", "table"]

#: Rows in a batch that the Parquet reader or Arrow holds: bounds what a JVM or a Python worker has of long texts at once.
BATCH_ROWS = 256
SET = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")


def small_batches(spark: SparkSession) -> None:
    """Batches of BATCH_ROWS texts in the session, instead of 10,000 in Arrow and 4,096 in the Parquet reader, and workers that find this package."""
    reachable(spark)
    for name in SET:
        spark.conf.set(name, str(BATCH_ROWS))


_own: dict[int, tuple] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table in a session of its own, with the settings of `spark`: what the operators set for their plans doesn't reach the caller's."""
    key, parent = id(spark._jsparkSession), spark._jsparkSession
    if key not in _own or _own[key][0] is not parent or _own[key][1].sparkContext is not spark.sparkContext:
        _own[key] = parent, SparkSession(spark.sparkContext, parent.cloneSession())
    own = _own[key][1]
    for k, v in spark.conf.getAll.items():
        if k not in SET and own.conf.get(k, None) != v and own.conf.isModifiable(k):
            own.conf.set(k, v)
    return read(own, sf_dir, name)


def free(names: list[str], wish: str) -> str:
    """A column name that isn't among `names` in any case."""
    taken = {n.lower() for n in names}
    while wish.lower() in taken:
        wish += "_"
    return wish


def crc_fold(key: str | Column, folds: int) -> Column:
    """crc32 of the key as text, modulo `folds`; null for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string").cast("binary")) % folds


def in_fold(key: str | Column, folds: int, fold: int) -> Column:
    """Whether the key is in the fold; false for a null key."""
    return F.coalesce(crc_fold(key, folds) == fold, F.lit(False))


def labelled_sample(labels: DataFrame, label: str, *, folds: int, held_out: int, bound: int, seed: int = 7) -> dict[int, int]:
    """At most `bound` labelled ids outside the held-out fold, and their labels.

    The sample is the `bound` smallest seeded hashes, so it is the same in any partitioning. Rows with a
    null id or label don't count; of several labels of one id, the largest does.
    """
    from pyspark.sql.types import LongType

    rows = (
        labels.select(F.col("doc_id").cast(LongType()).alias("id"), F.col(label).cast("int").alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isNotNull() & ~in_fold("id", folds, held_out))
        .groupBy("id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64(F.col("id"), F.lit(seed)), "id").limit(bound).collect()
    )
    return {r["id"]: r["y"] for r in rows}


def fit_logistic(x, y, l2: float = 1e-3, rounds: int = 50):
    """Weights (the last is the intercept) of a logistic regression by Newton steps; zeros if a class is missing."""
    import numpy as np

    x = np.column_stack([x, np.ones(len(x))]) if len(x) else np.zeros((0, 1))
    w = np.zeros(x.shape[1])
    if len(set(np.asarray(y).tolist())) < 2:
        return w
    ridge = np.eye(len(w)) * l2 * len(x)
    ridge[-1, -1] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + ridge, x.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w
