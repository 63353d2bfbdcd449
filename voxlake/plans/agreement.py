"""Queries on two segmentations a and b of the volume: overlaps, matches, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics, overlap
from .naming import Collected, rounded
from .views import view

query = Collected()
C = "WITH c AS (SELECT a, b, CAST(COUNT(*) AS BIGINT) AS n FROM vox WHERE a <> 0 AND b <> 0 GROUP BY a, b)"
R = C + ", r AS (SELECT a, CAST(SUM(n) AS BIGINT) AS m FROM c GROUP BY a), s AS (SELECT b, CAST(SUM(n) AS BIGINT) AS m FROM c GROUP BY b), t AS (SELECT CAST(SUM(n) AS DOUBLE) AS n FROM c)"


def cells(spark, d, **how):
    return overlap.contingency(view(spark, d, "vox"), **how)


@query(C + " SELECT a, b, n FROM c", "vox")
def contingency(spark, d):
    return cells(spark, d)


@query(C + """, k AS (SELECT a, b, n, CASE WHEN a IN (3) OR b IN (2) THEN 0 ELSE n END AS m FROM c)
SELECT a, b, n, round(m / (SELECT CAST(SUM(m) AS DOUBLE) FROM k), 6) AS p FROM k""", "vox")
def contingency_norm(spark, d):
    return rounded(overlap.normalised(cells(spark, d), ignore_a=[3], ignore_b=[2]), "p")


@query("SELECT a AS label, CAST(COUNT(*) AS BIGINT) AS area FROM vox WHERE a <> 0 GROUP BY a", "vox")
def areas(spark, d):
    return overlap.areas(view(spark, d, "vox"), "a")


@query("WITH s AS (SELECT a AS label, CAST(COUNT(*) AS BIGINT) AS area FROM vox WHERE a <> 0 GROUP BY a HAVING COUNT(*) > 1950) SELECT label, area, CAST(row_number() OVER (ORDER BY label) AS BIGINT) AS renumbered FROM s", "vox")
def area_filter(spark, d):
    return overlap.area_filter(view(spark, d, "vox"), "a", 1950).select("label", "area", "renumbered")


@query("SELECT l_partkey AS label, CAST(dense_rank() OVER (ORDER BY l_partkey) AS BIGINT) AS renumbered FROM (SELECT DISTINCT l_partkey FROM lineitem)")
def dense_relabel(spark, d):
    from ..spark import table

    return overlap.dense_rank(table(spark, d, "lineitem").withColumnRenamed("l_partkey", "label"), "label", "renumbered")


@query(R + " SELECT c.a, c.b, c.n FROM c JOIN r ON c.a = r.a JOIN s ON c.b = s.b WHERE c.n * 100 >= r.m * 50 OR c.n * 100 >= s.m * 50", "vox")
def overlap_match_or(spark, d):
    return overlap.overlap_match(cells(spark, d))


@query(R + " SELECT c.a, c.b, c.n FROM c JOIN r ON c.a = r.a JOIN s ON c.b = s.b WHERE c.n * 100 >= r.m * 10 AND c.n * 100 >= s.m * 10", "vox")
def overlap_match_and(spark, d):
    return overlap.overlap_match(cells(spark, d), 10, both=True)


@query(C + " SELECT a, b, n FROM c WHERE a <> 4 AND b <> 3 AND NOT (a = 5 AND b = 1)", "vox")
def exclusions(spark, d):
    one, two = spark.createDataFrame([(4,)], "a long"), spark.createDataFrame([(3,)], "b long")
    return overlap.excluded(cells(spark, d), one, two, spark.createDataFrame([(5, 1)], "a long, b long"))


@query(C + " SELECT a, b, n FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY n DESC, b DESC) AS k FROM c) WHERE k = 1", "vox")
def best_match(spark, d):
    return overlap.best(cells(spark, d), "a", "b")


@query(R + " SELECT a, b, n, round(n / m, 6) AS share, n * 2 >= m AS matched FROM (SELECT c.*, r.m, row_number() OVER (PARTITION BY c.a ORDER BY n DESC, b) AS k FROM c JOIN r ON c.a = r.a) WHERE k = 1", "vox")
def ground_truth_match(spark, d):
    return rounded(overlap.ground_truth_match(cells(spark, d)), "share")


H = R + """, h AS (SELECT (SELECT SUM(m * log2(m)) FROM r) AS rl, (SELECT SUM(m * log2(m)) FROM s) AS sl, (SELECT SUM(n * log2(n)) FROM c) AS cl, t.n,
  (SELECT CAST(SUM(m * m) AS DOUBLE) FROM r) AS r2, (SELECT CAST(SUM(m * m) AS DOUBLE) FROM s) AS s2, (SELECT CAST(SUM(n * n) AS DOUBLE) FROM c) AS c2 FROM t)"""


@query(H + " SELECT round((rl - cl) / n, 6) AS merge, round((sl - cl) / n, 6) AS split, round((rl + sl - 2 * cl) / n, 6) AS vi FROM h", "vox")
def vi_split(spark, d):
    return rounded(metrics.split_vi(cells(spark, d)), "merge", "split", "vi")


ALPHAS = "(VALUES (CAST(0.0 AS DOUBLE)), (CAST(0.5 AS DOUBLE)), (CAST(1.0 AS DOUBLE))) AS x(alpha)"


@query(H + f" SELECT alpha, round(c2 / (alpha * s2 + (1 - alpha) * r2), 6) AS rand FROM h, {ALPHAS}", "vox")
def rand_f(spark, d):
    return rounded(metrics.rand_f(cells(spark, d)), "rand")


@query(H + f" SELECT alpha, round((log2(n) + (cl - rl - sl) / n) / ((1 - alpha) * (log2(n) - sl / n) + alpha * (log2(n) - rl / n)), 6) AS f_info FROM h, {ALPHAS}", "vox")
def f_info(spark, d):
    return rounded(metrics.f_info(cells(spark, d)), "f_info")


@query(H + """, p AS (SELECT (c2 - n) / 2 AS pa, (r2 - c2) / 2 AS pb, (s2 - c2) / 2 AS pc, (c2 + n * n - r2 - s2) / 2 AS pd FROM h),
q AS (SELECT *, pa + pb + pc + pd AS nk, (pa + pb) * (pa + pc) + (pc + pd) * (pb + pd) AS x FROM p)
SELECT pa, pb, pc, pd, round((pa + pd) / nk, 6) AS rand_index, round((nk * (pa + pd) - x) / (nk * nk - x), 6) AS adjusted, round(pa / sqrt((pa + pb) * (pa + pc)), 6) AS fowlkes_mallows FROM q""", "vox")
def rand_family(spark, d):
    return rounded(metrics.rand_family(cells(spark, d)), "rand_index", "adjusted", "fowlkes_mallows")


@query("""WITH c AS (SELECT a, b, CAST(COUNT(*) AS DOUBLE) AS n FROM vox GROUP BY a, b), t AS (SELECT SUM(n) AS n FROM c),
e AS (SELECT COALESCE(SUM(c.n), 0) / MAX(t.n) AS x FROM t LEFT JOIN c ON a <> 0 AND b = 0),
sa AS (SELECT SUM(m * m) AS v FROM (SELECT SUM(n) AS m FROM c WHERE a <> 0 GROUP BY a)), sb AS (SELECT SUM(m * m) AS v FROM (SELECT SUM(n) AS m FROM c WHERE a <> 0 AND b <> 0 GROUP BY b)),
ab AS (SELECT SUM(n * n) AS v FROM c WHERE a <> 0 AND b <> 0), p AS (SELECT (ab.v + x) / (sb.v + x) AS p, (ab.v + x) / sa.v AS r FROM ab, sa, sb, e)
SELECT round(1 - 2 * p * r / (p + r), 6) AS error, round(p, 6) AS precision, round(r, 6) AS recall FROM p""", "vox")
def adapted_rand(spark, d):
    return rounded(metrics.adapted_rand(cells(spark, d, keep_zero=True)), "error", "precision", "recall")


@query(C + """ SELECT (SELECT CAST(SUM(k - 1) AS BIGINT) FROM (SELECT SUM(CASE WHEN n > 100 THEN 1 ELSE 0 END) AS k FROM c GROUP BY b)) AS splits,
(SELECT CAST(SUM(k - 1) AS BIGINT) FROM (SELECT SUM(CASE WHEN n > 100 THEN 1 ELSE 0 END) AS k FROM c GROUP BY a)) AS merges""", "vox")
def edit_distance(spark, d):
    return metrics.edit_distance(cells(spark, d), 100)


E = R + ", e AS (SELECT c.a, MAX(r.m) AS area, MAX(c.n) AS overlap_area, SUM(-(c.n / CAST(r.m AS DOUBLE)) * log2(c.n / CAST(r.m AS DOUBLE))) AS entropy FROM c JOIN r ON c.a = r.a GROUP BY c.a)"


@query(E + " SELECT a, area, overlap_area, round(entropy, 6) AS entropy FROM e", "vox")
def per_object_entropy(spark, d):
    return rounded(metrics.per_object(cells(spark, d)), "entropy")


@query(E + " SELECT a, area, round(entropy * area / t.n, 6) AS part FROM e, t", "vox")
def worst_segments(spark, d):
    return rounded(metrics.worst(cells(spark, d)), "part")


@query(R + " SELECT a, rank, b, round(n / m, 6) AS of_a, round(n / k, 6) AS of_b FROM (SELECT c.a, c.b, c.n, r.m, s.m AS k, CAST(row_number() OVER (PARTITION BY c.a ORDER BY c.n DESC, c.b) AS INTEGER) AS rank FROM c JOIN r ON c.a = r.a JOIN s ON c.b = s.b) WHERE rank <= 4", "vox")
def top_overlaps(spark, d):
    return rounded(metrics.top_overlaps(cells(spark, d)), "of_a", "of_b")


G = "CASE WHEN {0} > 0 THEN {0} * log2({0}) ELSE 0 END"


@query(R + """, pairs AS (SELECT x.a AS a1, y.a AS a2, CAST(x.m AS DOUBLE) AS m1, CAST(y.m AS DOUBLE) AS m2 FROM r x JOIN r y ON x.a < y.a),
dc AS (SELECT p.a1, p.a2, SUM((u.n + v.n) * log2(u.n + v.n) - u.n * log2(u.n) - v.n * log2(v.n)) AS g FROM pairs p JOIN c u ON u.a = p.a1 JOIN c v ON v.a = p.a2 AND v.b = u.b GROUP BY p.a1, p.a2)
SELECT p.a1, p.a2, round(((m1 + m2) * log2(m1 + m2) - m1 * log2(m1) - m2 * log2(m2) - COALESCE(g, 0)) / t.n, 6) AS d_merge, round(-COALESCE(g, 0) / t.n, 6) AS d_split
FROM pairs p LEFT JOIN dc ON p.a1 = dc.a1 AND p.a2 = dc.a2, t""", "vox")
def merge_gain(spark, d):
    table = cells(spark, d)
    one = table.select(F.col("a").alias("a1")).distinct()
    pairs = one.join(one.select(F.col("a1").alias("a2")), F.col("a1") < F.col("a2"))  # label pairs of one volume
    return rounded(metrics.merge_gain(table, pairs), "d_merge", "d_split")


@query(R + """ SELECT c.a, c.b, round(((c.n + r.m) / t.n) * log2((c.n + r.m) / t.n) - (c.n / t.n) * log2(c.n / t.n) - (r.m / t.n) * log2(r.m / t.n), 6) AS change FROM c JOIN r ON c.a = r.a, t""", "vox")
def voi_change(spark, d):
    m = overlap.with_marginals(cells(spark, d))
    total = m.agg(F.sum("n").cast("double").alias("total"))
    return rounded(m.crossJoin(F.broadcast(total)).select("a", "b", metrics.voi_change(F.col("n"), F.col("row_n"), F.col("total")).alias("change")), "change")


@query("""SELECT CAST(SUM(CASE WHEN a <> 0 AND b <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS tp, round(SUM(CASE WHEN a <> 0 AND b <> 0 THEN 1 ELSE 0 END) / CAST(SUM(CASE WHEN a <> 0 THEN 1 ELSE 0 END) AS DOUBLE), 6) AS precision,
round(SUM(CASE WHEN a <> 0 AND b <> 0 THEN 1 ELSE 0 END) / CAST(SUM(CASE WHEN b <> 0 THEN 1 ELSE 0 END) AS DOUBLE), 6) AS recall FROM vox""", "vox")
def pixel_wise(spark, d):
    n = lambda c: F.sum(c.cast("long"))
    both, a, b = n((F.col("a") != 0) & (F.col("b") != 0)), n(F.col("a") != 0), n(F.col("b") != 0)
    return rounded(view(spark, d, "vox").agg(both.alias("tp"), F.try_divide(both, a).alias("precision"), F.try_divide(both, b).alias("recall")), "precision", "recall")


@query("""WITH c AS (SELECT z % 2 AS part, a, b, COUNT(*) AS n FROM vox WHERE a <> 0 AND b <> 0 GROUP BY 1, 2, 3), r AS (SELECT part, a, SUM(n) AS m FROM c GROUP BY 1, 2), s AS (SELECT part, b, SUM(n) AS m FROM c GROUP BY 1, 2),
x AS (SELECT part, SUM(n) AS n, SUM(n * log2(n)) AS cl FROM c GROUP BY 1), y AS (SELECT part, SUM(m * log2(m)) AS rl FROM r GROUP BY 1), w AS (SELECT part, SUM(m * log2(m)) AS sl FROM s GROUP BY 1),
v AS (SELECT (rl - cl) / n AS merge, (sl - cl) / n AS split FROM x JOIN y USING (part) JOIN w USING (part))
SELECT round(AVG(merge), 6) AS merge, round(stddev_pop(merge) / sqrt(COUNT(*)), 6) AS merge_sem, round(AVG(split), 6) AS split, round(median(split), 6) AS split_median FROM v""", "vox")
def vi_over_samples(spark, d):
    vox, parts = view(spark, d, "vox"), None
    for k in (0, 1):
        one = metrics.split_vi(overlap.contingency(vox.where(F.col("z") % 2 == k)))
        parts = one if parts is None else parts.unionByName(one)
    return rounded(parts.agg(F.avg("merge").alias("merge"), (F.stddev_pop("merge") / F.sqrt(F.count("*"))).alias("merge_sem"), F.avg("split").alias("split"), F.median("split").alias("split_median")), "merge", "merge_sem", "split", "split_median")


GAINS = R + """, pairs AS (SELECT x.a AS a1, y.a AS a2, CAST(x.m AS DOUBLE) AS m1, CAST(y.m AS DOUBLE) AS m2 FROM r x JOIN r y ON x.a < y.a),
dc AS (SELECT p.a1, p.a2, SUM((u.n + v.n) * log2(u.n + v.n) - u.n * log2(u.n) - v.n * log2(v.n)) AS g FROM pairs p JOIN c u ON u.a = p.a1 JOIN c v ON v.a = p.a2 AND v.b = u.b GROUP BY p.a1, p.a2),
gain AS (SELECT p.a1, p.a2, ((m1 + m2) * log2(m1 + m2) - m1 * log2(m1) - m2 * log2(m2) - COALESCE(g, 0)) / t.n AS dm, -COALESCE(g, 0) / t.n AS ds FROM pairs p LEFT JOIN dc ON p.a1 = dc.a1 AND p.a2 = dc.a2, t)"""


@query(GAINS + " SELECT a1, a2, round(dm, 6) AS d_merge, round(ds, 6) AS d_split FROM gain WHERE dm + ds < -1e-9 AND ds < 0 AND (dm < 0 OR -dm / ds < 0.9)", "vox")
def accepted_merges(spark, d):
    table = cells(spark, d)
    one = table.select(F.col("a").alias("a1")).distinct()
    gains = metrics.merge_gain(table, one.join(one.select(F.col("a1").alias("a2")), F.col("a1") < F.col("a2")))  # label pairs of one volume
    return rounded(metrics.accepted(gains, 0.9).where(F.col("d_merge") + F.col("d_split") < -1e-9), "d_merge", "d_split")


@query("""WITH c AS (SELECT a, b, COUNT(*) AS n FROM vox GROUP BY 1, 2), r AS (SELECT a, SUM(n) AS m FROM c GROUP BY 1), s AS (SELECT b, SUM(n) AS m FROM c GROUP BY 1), t AS (SELECT CAST(SUM(n) AS DOUBLE) AS n FROM c)
SELECT round(((SELECT SUM(m * ln(m)) FROM r) - (SELECT SUM(n * ln(n)) FROM c)) / t.n, 6) AS merge, round(((SELECT SUM(m * ln(m)) FROM s) - (SELECT SUM(n * ln(n)) FROM c)) / t.n, 6) AS split FROM t""", "vox")
def vi_nats_with_background(spark, d):
    from ..functions.scalars import bits_to_nats

    told = metrics.split_vi(cells(spark, d, keep_zero=True))
    return rounded(told.select(bits_to_nats(F.col("merge")).alias("merge"), bits_to_nats(F.col("split")).alias("split")), "merge", "split")


@query("""WITH l AS (SELECT z, y, x, 'a' AS k, a AS v FROM vox UNION ALL SELECT z, y, x, 'b', b FROM vox UNION ALL SELECT z, y, x, 'p', CAST(floor(p / 64) AS BIGINT) + 1 FROM vox),
c AS (SELECT o.k AS one, q.k AS two, o.v AS a, q.v AS b, COUNT(*) AS n FROM l o JOIN l q ON o.z = q.z AND o.y = q.y AND o.x = q.x AND o.k < q.k WHERE o.v <> 0 AND q.v <> 0 GROUP BY 1, 2, 3, 4),
r AS (SELECT one, two, SUM(m * log2(m)) AS h FROM (SELECT one, two, a, SUM(n) AS m FROM c GROUP BY 1, 2, 3) GROUP BY 1, 2), s AS (SELECT one, two, SUM(m * log2(m)) AS h FROM (SELECT one, two, b, SUM(n) AS m FROM c GROUP BY 1, 2, 3) GROUP BY 1, 2)
SELECT c.one, c.two, round((MAX(r.h) + MAX(s.h) - 2 * SUM(n * log2(n))) / SUM(n), 6) AS vi FROM c JOIN r ON r.one = c.one AND r.two = c.two JOIN s ON s.one = c.one AND s.two = c.two GROUP BY 1, 2""", "vox")
def vi_matrix(spark, d):
    vox = view(spark, d, "vox").withColumn("p", F.floor(F.col("p") / 64) + 1)
    out = None
    for one, two in (("a", "b"), ("a", "p"), ("b", "p")):
        row = metrics.split_vi(overlap.contingency(vox, one, two)).select(F.lit(one).alias("one"), F.lit(two).alias("two"), "vi")
        out = row if out is None else out.unionByName(row)
    return rounded(out, "vi")


@query("""WITH c AS (SELECT t, CASE WHEN p < t THEN a ELSE 0 END AS a, b, COUNT(*) AS n FROM vox, (SELECT unnest([64, 128, 192]) AS t) GROUP BY 1, 2, 3), k AS (SELECT * FROM c WHERE a <> 0 AND b <> 0),
s AS (SELECT t, SUM(m * m) AS v FROM (SELECT t, a, SUM(n) AS m FROM k GROUP BY 1, 2) GROUP BY 1), g AS (SELECT t, SUM(m * m) AS v FROM (SELECT t, b, SUM(n) AS m FROM k GROUP BY 1, 2) GROUP BY 1)
SELECT k.t AS threshold, round(SUM(n * n) / (0.5E0 * MAX(g.v) + 0.5E0 * MAX(s.v)), 6) AS rand FROM k JOIN s ON k.t = s.t JOIN g ON k.t = g.t GROUP BY 1""", "vox")
def rand_by_threshold(spark, d):
    """A threshold that leaves no labelled pair has no row."""
    out = None
    for t in (64, 128, 192):
        cut = view(spark, d, "vox").withColumn("a", F.when(F.col("p") < t, F.col("a")).otherwise(0))
        row = metrics.rand_f(overlap.contingency(cut), (0.5,)).select(F.lit(t).alias("threshold"), "rand")
        out = row if out is None else out.unionByName(row)
    return rounded(out.where("rand is not null"), "rand")


@query("SELECT CASE WHEN a <= 4 THEN 1 ELSE a END AS a, b, CAST(COUNT(*) AS BIGINT) AS n FROM vox WHERE a <> 0 AND b <> 0 GROUP BY 1, 2", "vox")
def merged_contingency(spark, d):
    table = cells(spark, d)
    mapping = table.where("a <= 4").select("a", F.lit(1).cast("long").alias("to")).distinct()
    return metrics.merged_rows(table, mapping)


@query("SELECT a, b, CAST(COUNT(*) AS BIGINT) AS n FROM vox WHERE a <> 0 AND b <> 0 GROUP BY a, b", "vox")
def pooled_contingency(spark, d):
    vox = view(spark, d, "vox")
    return metrics.pooled([overlap.contingency(vox.where(F.col("z") % 2 == k)) for k in (0, 1)])


@query("SELECT DISTINCT u.a AS a, v.a AS b FROM vox u JOIN vox v ON v.z = u.z + 1 AND v.y = u.y AND v.x = u.x WHERE u.z = 3 AND u.b = v.b AND u.a <> 0 AND v.a <> 0 AND u.b <> 0", "vox")
def cut_pairs(spark, d):
    """Labels on either side of a cut between planes that a second segmentation holds together."""
    vox = view(spark, d, "vox").where("a <> 0 and b <> 0")
    below = vox.where("z = 4").select("y", "x", F.col("a").alias("other"), "b")
    return vox.where("z = 3").select("y", "x", "a", "b").join(below, ["y", "x", "b"]).select("a", F.col("other").alias("b")).distinct()


QUERIES, ORACLES = query.queries, query.oracles
