"""Agreement of two clusterings, all from their contingency table (a, b, n)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .overlap import with_marginals


def xlog2x(x: Column) -> Column:
    """x log2 x, 0 at 0."""
    return F.when(x > 0, x * F.log2(F.when(x > 0, x))).otherwise(F.lit(0.0))


def sums(table: DataFrame) -> DataFrame:
    """One row: n, and the sums of squares and of n log2 n of cells, rows (a) and columns (b)."""
    n = F.col("n").cast("double")
    cells = table.agg(F.sum(n).alias("n"), F.sum(n * n).alias("c2"), F.sum(xlog2x(n)).alias("cl"))
    sides = []
    for key, name in (("a", "r"), ("b", "s")):
        side = table.groupBy(key).agg(F.sum("n").cast("double").alias("m"))
        sides.append(side.agg(F.sum(F.col("m") * F.col("m")).alias(f"{name}2"), F.sum(xlog2x(F.col("m"))).alias(f"{name}l")))
    return cells.crossJoin(sides[0]).crossJoin(sides[1])  # one row each


def split_vi(table: DataFrame) -> DataFrame:
    """Conditional entropies in bits: merge = H(b|a), what a wrongly joins; split = H(a|b); and their sum."""
    s = sums(table)
    merge, split = (F.col("rl") - F.col("cl")) / F.col("n"), (F.col("sl") - F.col("cl")) / F.col("n")
    return s.select(merge.alias("merge"), split.alias("split"), (merge + split).alias("vi"))


def rand_f(table: DataFrame, alphas: tuple[float, ...] = (0.0, 0.5, 1.0)) -> DataFrame:
    """sum p^2 / (alpha sum gt^2 + (1 - alpha) sum pred^2) with a as prediction and b as ground truth: split, F, merge."""
    s = sums(table)
    alpha = F.explode(F.array(*[F.lit(x) for x in alphas]))
    return s.select("*", alpha.alias("alpha")).select("alpha", (F.col("c2") / (F.col("alpha") * F.col("s2") + (1 - F.col("alpha")) * F.col("r2"))).alias("rand"))


def f_info(table: DataFrame, alphas: tuple[float, ...] = (0.0, 0.5, 1.0)) -> DataFrame:
    """Mutual information over ((1 - alpha) H(gt) + alpha H(pred)); null without entropy."""
    s, n = sums(table), F.col("n")
    h = {k: F.log2(n) - F.col(c) / n for k, c in (("pred", "rl"), ("gt", "sl"), ("both", "cl"))}
    alpha = F.explode(F.array(*[F.lit(x) for x in alphas]))
    weight = (1 - F.col("alpha")) * F.col("gt") + F.col("alpha") * F.col("pred")
    return s.select(*[v.alias(k) for k, v in h.items()], alpha.alias("alpha")).select("alpha", F.try_divide(F.col("gt") + F.col("pred") - F.col("both"), weight).alias("f_info"))


def rand_family(table: DataFrame) -> DataFrame:
    """Pair counts a, b, c, d, the Rand index, its adjusted form and Fowlkes-Mallows."""
    s, n = sums(table), F.col("n")
    a, b, c = (F.col("c2") - n) / 2, (F.col("r2") - F.col("c2")) / 2, (F.col("s2") - F.col("c2")) / 2
    d = (F.col("c2") + n * n - F.col("r2") - F.col("s2")) / 2
    s = s.select(n.alias("n"), a.alias("pa"), b.alias("pb"), c.alias("pc"), d.alias("pd"))
    a, b, c, d = (F.col(x) for x in ("pa", "pb", "pc", "pd"))
    nk = a + b + c + d
    chance = (a + b) * (a + c) + (c + d) * (b + d)
    return s.select("pa", "pb", "pc", "pd", F.try_divide(a + d, nk).alias("rand_index"), F.try_divide(nk * (a + d) - chance, nk * nk - chance).alias("adjusted"), F.try_divide(a, F.sqrt((a + b) * (a + c))).alias("fowlkes_mallows"))


def adapted_rand(table: DataFrame) -> DataFrame:
    """Error, precision and recall with ground truth a (label 0 left out) and prediction b, whose 0 counts as single voxels, over all voxels."""
    n = table.agg(F.sum("n").cast("double").alias("n"))
    kept = table.where("a != 0")
    rows = kept.groupBy("a").agg(F.sum("n").cast("double").alias("m")).agg(F.sum(F.col("m") * F.col("m")).alias("sum_a"))
    cols = kept.where("b != 0").groupBy("b").agg(F.sum("n").cast("double").alias("m")).agg(F.coalesce(F.sum(F.col("m") * F.col("m")), F.lit(0.0)).alias("sum_b"))
    x = F.col("n").cast("double")
    both = kept.agg(F.coalesce(F.sum(F.when(F.col("b") != 0, x * x)), F.lit(0.0)).alias("sum_ab"), F.coalesce(F.sum(F.when(F.col("b") == 0, x)), F.lit(0.0)).alias("single"))
    all_ = n.crossJoin(rows).crossJoin(cols).crossJoin(both)
    extra = F.col("single") / F.col("n")
    told = all_.select(((F.col("sum_ab") + extra) / (F.col("sum_b") + extra)).alias("precision"), ((F.col("sum_ab") + extra) / F.col("sum_a")).alias("recall"))
    return told.select((1 - 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).alias("error"), "precision", "recall")


def edit_distance(table: DataFrame, minimum: int = 1000) -> DataFrame:
    """Splits and merges to mend: cells of more than `minimum` voxels beyond the first of each b and a; a label without any counts -1."""
    def beyond(key: str) -> DataFrame:
        per = table.where(F.col(key) != 0).groupBy(key).agg(F.sum((F.col("n") > minimum).cast("long")).alias("m"))
        return per.agg(F.coalesce(F.sum(F.col("m") - 1), F.lit(0)).cast("long").alias(f"by_{key}"))

    return beyond("b").crossJoin(beyond("a")).select(F.col("by_b").alias("splits"), F.col("by_a").alias("merges"))


def per_object(table: DataFrame) -> DataFrame:
    """Of each a: area, its largest overlap, and the entropy in bits of the b inside."""
    m = with_marginals(table)
    p = F.col("n") / F.col("row_n")
    return m.groupBy("a").agg(F.max("row_n").alias("area"), F.max("n").alias("overlap_area"), F.sum(-xlog2x(p)).alias("entropy"))


def worst(table: DataFrame) -> DataFrame:
    """Each a's share of H(b|a), by size of the share."""
    total = table.agg(F.sum("n").alias("total"))
    told = per_object(table).crossJoin(F.broadcast(total))
    return told.select("a", "area", (F.col("entropy") * F.col("area") / F.col("total")).alias("part"))


def top_overlaps(table: DataFrame, k: int = 4) -> DataFrame:
    """The k largest overlaps of each a: rank, b, and the fractions of a and b that they are."""
    from pyspark.sql.window import Window

    ranked = with_marginals(table).withColumn("rank", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("n"), "b"))).where(F.col("rank") <= k)
    return ranked.select("a", "rank", "b", (F.col("n") / F.col("row_n")).alias("of_a"), (F.col("n") / F.col("col_n")).alias("of_b"))


def merge_gain(table: DataFrame, pairs: DataFrame) -> DataFrame:
    """How merge and split change, in bits, if the segments a1 and a2 of each pair were one."""
    n = table.agg(F.sum("n").cast("double").alias("total"))
    rows = table.groupBy("a").agg(F.sum("n").cast("double").alias("m"))
    one = pairs.join(table.select(F.col("a").alias("a1"), "b", F.col("n").alias("n1")), "a1")
    met = one.join(table.select(F.col("a").alias("a2"), "b", F.col("n").alias("n2")), ["a2", "b"])
    joint = lambda x, y: xlog2x(x + y) - xlog2x(x) - xlog2x(y)
    cells = met.groupBy("a1", "a2").agg(F.sum(joint(F.col("n1").cast("double"), F.col("n2").cast("double"))).alias("dc"))
    told = pairs.join(cells, ["a1", "a2"], "left").join(rows.select(F.col("a").alias("a1"), F.col("m").alias("m1")), "a1").join(rows.select(F.col("a").alias("a2"), F.col("m").alias("m2")), "a2").crossJoin(F.broadcast(n))
    dc = F.coalesce("dc", F.lit(0.0))
    return told.select("a1", "a2", ((joint(F.col("m1"), F.col("m2")) - dc) / F.col("total")).alias("d_merge"), (-dc / F.col("total")).alias("d_split"))


def voi_change(one: Column, two: Column, total: Column) -> Column:
    """Entropy that is lost when sets of these sizes become one, in bits."""
    return (xlog2x((one + two) / total) - xlog2x(one / total) - xlog2x(two / total)).cast("double")


def merged_rows(table: DataFrame, mapping: DataFrame) -> DataFrame:
    """The contingency after joining segments by `mapping` (a, to): rows of one target are summed."""
    moved = table.join(mapping, "a", "left").select(F.coalesce("to", "a").alias("a"), "b", "n")
    return moved.groupBy("a", "b").agg(F.sum("n").alias("n"))


def pooled(tables: list[DataFrame]) -> DataFrame:
    """One contingency of several blocks' ones: metrics of the whole come from sums of pairs, not from means of metrics."""
    all_ = tables[0]
    for t in tables[1:]:
        all_ = all_.unionByName(t)
    return all_.groupBy("a", "b").agg(F.sum("n").alias("n"))


def accepted(gains: DataFrame, ratio: float) -> DataFrame:
    """Merges that lower the sum and the split part, and the merge part too or by less than `ratio` of the split's gain (a1, a2, d_merge, d_split)."""
    fine = (F.col("d_merge") < 0) | (F.try_divide(-F.col("d_merge"), F.col("d_split")) < ratio)
    return gains.where((F.col("d_merge") + F.col("d_split") < 0) & (F.col("d_split") < 0) & fine)
