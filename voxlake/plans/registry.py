"""All queries of the library and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import agreement, assembly, graph, kernel, planning, rest, scalar, segmentation, storage, synapse, voxel

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
for module in (agreement, planning, graph, synapse, voxel, scalar, assembly, kernel, storage, segmentation, rest):
    QUERIES |= module.QUERIES
    ORACLES |= module.ORACLES


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlap join of two segmentations, their contingency, and variation of information."""
    return QUERIES["vi_split"](spark, sf_dir)
