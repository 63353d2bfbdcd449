"""Region adjacency: which labels touch, with mergeable features of their contacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BINS, QUANTILES = 25, (0.1, 0.3, 0.5, 0.7, 0.9)
STEPS = ((1, 0, 0), (0, 1, 0), (0, 0, 1))


def contacts(voxels: DataFrame, label: str, value: str) -> DataFrame:
    """(node, other, value): of each voxel that isn't background, once for each label among its six neighbours but its own.

    A voxel is sent to its own place and its six neighbours' places, and meets them in a hash join; a third of the pairs
    would do (one step an axis), which is what is joined: each touching pair is then told from both sides.
    """
    own = voxels.where(F.col(label) != 0).select("z", "y", "x", F.col(label).alias("node"), F.col(value).cast("double").alias("value"))
    shifts = F.explode(F.array(*[F.struct(*[F.lit(s).alias(c) for c, s in zip("zyx", step, strict=True)]) for step in STEPS])).alias("d")
    sent = own.select("z", "y", "x", "node", "value", shifts).select(
        (F.col("z") + F.col("d.z")).alias("z"), (F.col("y") + F.col("d.y")).alias("y"), (F.col("x") + F.col("d.x")).alias("x"),
        F.col("node").alias("before"), F.col("value").alias("value_before"), F.struct("z", "y", "x").alias("from"),
    )
    met = own.join(sent, ["z", "y", "x"]).where("node != before")
    sides = F.explode(F.array(F.struct(F.col("node").alias("node"), F.col("before").alias("other"), F.struct("z", "y", "x").alias("at"), F.col("value").alias("value")), F.struct(F.col("before").alias("node"), F.col("node").alias("other"), F.col("from").alias("at"), F.col("value_before").alias("value")))).alias("s")
    return met.select(sides).select("s.*").distinct().select("node", "other", "value")


def edges(touch: DataFrame) -> DataFrame:
    """(u, v, size): incidences of voxel and neighbouring label, told from both sides."""
    return touch.groupBy(F.least("node", "other").alias("u"), F.greatest("node", "other").alias("v")).agg(F.count("*").alias("size"))


def nodes(voxels: DataFrame, label: str, touch: DataFrame) -> DataFrame:
    """(node, size, boundary_size)."""
    size = voxels.where(F.col(label) != 0).groupBy(F.col(label).alias("node")).agg(F.count("*").alias("size"))
    return size.join(touch.groupBy("node").agg(F.count("*").alias("boundary_size")), "node", "left").select("node", "size", F.coalesce("boundary_size", F.lit(0)).alias("boundary_size"))


def moment_sums(value: Column) -> list[Column]:
    """Sums that merge by addition: count, and of powers 1 to 4."""
    return [F.count(value).alias("m0"), *[F.sum(F.pow(value, F.lit(k))).alias(f"m{k}") for k in (1, 2, 3, 4)]]


def moments() -> list[Column]:
    """mean, and central moments 2 to 4, which aren't standardised, from `moment_sums`."""
    e = [F.col(f"m{k}") / F.col("m0") for k in (1, 2, 3, 4)]
    m = e[0]
    return [m.alias("mean"), (e[1] - m * m).alias("var"), (e[2] - 3 * m * e[1] + 2 * m * m * m).alias("third"), (e[3] - 4 * m * e[2] + 6 * m * m * e[1] - 3 * m * m * m * m).alias("fourth")]


def histogram(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """(keys, bin, n) of values of 0 to 1 in 25 bins, the last closed."""
    return df.groupBy(*keys, F.least(F.floor(value * BINS), F.lit(BINS - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def percentiles(bins: DataFrame, keys: list[str], quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """(keys, q, value): where the cumulated histogram first reaches q of the count, linear within the bin."""
    w = Window.partitionBy(*keys).orderBy("bin")  # 25 rows a key
    run = bins.withColumn("upto", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
    asked = run.withColumn("q", F.explode(F.array(*[F.lit(q) for q in quantiles]))).where(F.col("upto") >= F.col("total") * F.col("q"))
    first = asked.groupBy(*keys, "q").agg(F.min_by(F.struct("bin", "n", "upto", "total"), "bin").alias("f"))
    return first.select(*keys, "q", ((F.col("f.bin") + (F.col("q") * F.col("f.total") - (F.col("f.upto") - F.col("f.n"))) / F.col("f.n")) / BINS).alias("value"))


def inclusiveness(edge: DataFrame) -> DataFrame:
    """(node, of_all, second): the largest edge's share of a node's edges, and the second largest over the largest."""
    both = edge.select(F.col("u").alias("node"), "size").unionByName(edge.select(F.col("v").alias("node"), "size"))
    told = both.groupBy("node").agg(F.sum("size").alias("total"), F.max("size").alias("most"), F.count("*").alias("n"))
    tied = both.join(told.select("node", "most"), "node")
    second = tied.groupBy("node").agg(F.sum((F.col("size") == F.col("most")).cast("int")).alias("ties"), F.max(F.when(F.col("size") < F.col("most"), F.col("size"))).alias("next"))
    two = F.when(F.col("ties") > 1, F.col("most")).otherwise(F.coalesce("next", F.lit(0)))
    return told.join(second, "node").select("node", (F.col("most") / F.col("total")).alias("of_all"), (two / F.col("most")).alias("second"))


def edge_features(edge: DataFrame, node: DataFrame) -> DataFrame:
    """(u, v, small, large, size, difference): the features of an edge's two nodes by size, its own size, and their difference."""
    one, two = node.select(F.col("node").alias("u"), F.col("size").alias("size_u")), node.select(F.col("node").alias("v"), F.col("size").alias("size_v"))
    return edge.join(one, "u").join(two, "v").select("u", "v", F.least("size_u", "size_v").alias("small"), F.greatest("size_u", "size_v").alias("large"), "size", F.abs(F.col("size_u") - F.col("size_v")).alias("difference"))


def largest_neighbour(touch: DataFrame) -> DataFrame:
    """(node, other): each label with the largest label that it touches, if that is larger."""
    return touch.where("other > node").groupBy("node").agg(F.max("other").alias("other"))
