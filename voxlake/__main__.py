"""python -m voxlake: export a box of a volume, or write storage plans, with the session that `spark-submit` or the environment gives."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .sources import blocks


def export_box(spark: SparkSession, args: argparse.Namespace) -> None:
    """Voxels of one dataset in a box, as a volume of its own."""
    inside = blocks.read_chunks(spark, args.volume, dataset=args.dataset, box=tuple(args.box))
    blocks.write_chunks(inside, args.target, dataset=args.name or args.dataset, value="value", block=tuple(args.chunk), dtype=args.dtype)


def storage_plans(spark: SparkSession, args: argparse.Namespace) -> None:
    """A storage plan for each dataset of a volume's chunks, one JSON document a line."""
    chunks = spark.read.schema(blocks.CHUNK).parquet(args.volume)
    named = chunks.select("x", "y", "z", "x1", "y1", "z1", F.col("dataset").alias("dataset_name"), F.col("dtype").alias("datatype"), F.col("dataset").alias("dataset_id"), F.concat(F.lit(args.volume + "/dataset="), "dataset").alias("path"))
    blocks.storage_plan(named).write.text(args.target)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="python -m voxlake", description=__doc__)
    parts = top.add_subparsers(required=True)
    box = parts.add_parser("export-box", description=export_box.__doc__)
    box.add_argument("volume"), box.add_argument("target")
    box.add_argument("--dataset", required=True), box.add_argument("--name")
    box.add_argument("--box", nargs=6, type=int, metavar=("X", "Y", "Z", "WIDTH", "HEIGHT", "DEPTH"), required=True)
    box.add_argument("--chunk", nargs=3, type=int, metavar=("Z", "Y", "X"), default=(64, 512, 512))
    box.add_argument("--dtype", choices=list(blocks.DTYPES), default="uint32")
    box.set_defaults(run=export_box)
    plan = parts.add_parser("storage-plan", description=storage_plans.__doc__)
    plan.add_argument("volume"), plan.add_argument("target")
    plan.set_defaults(run=storage_plans)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(SparkSession.builder.appName("voxlake").getOrCreate(), args)


if __name__ == "__main__":
    main()
