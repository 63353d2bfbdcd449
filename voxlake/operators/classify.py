"""Pixel classifiers over padded blocks, and learned edge probabilities."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Classify = Callable[[np.ndarray, int, int, int], dict[str, np.ndarray]]


@dataclass
class Classifier:
    """`run(image, x, y, z)` gives an image of 0..255 for each class; `pad` (z, y, x) is what it needs around a block."""

    run: Classify
    classes: Sequence[str]
    pad: tuple[int, int, int] = (0, 0, 0)


def identity(name: str) -> Classifier:
    return Classifier(lambda image, x, y, z: {name: image}, [name])


@dataclass
class Aggregate:
    """Classifiers run together, each at its own pad, with classes renamed; of equal names the last counts."""

    parts: Sequence[tuple[Classifier, dict[str, str]]]
    classes: Sequence[str] = field(init=False)
    pad: tuple[int, int, int] = field(init=False)

    def __post_init__(self):
        self.classes = list(dict.fromkeys(names.get(c, c) for part, names in self.parts for c in part.classes))
        self.pad = tuple(max(part.pad[i] for part, _ in self.parts) for i in range(3))

    def run(self, image: np.ndarray, x: int, y: int, z: int) -> dict[str, np.ndarray]:
        out = {}
        for part, names in self.parts:
            spare = [a - b for a, b in zip(self.pad, part.pad, strict=True)]
            inner = image[tuple(slice(s, n - s) for s, n in zip(spare, image.shape, strict=True))]
            for name, found in part.run(inner, x, y, z).items():
                out[names.get(name, name)] = found
        return out


def classified(voxels: DataFrame, value: str, classifier: Classifier | Aggregate, *, block: tuple[int, int, int]) -> DataFrame:
    """(z, y, x, channel, value): the classifier on blocks mirrored at the volume's ends where nothing is around them; a block's own voxels come out.

    A classifier gives its image without the pad, or whole (then the pad is cut off).
    """
    df = voxels.select("z", "y", "x", F.col(value).cast("double").alias("v"))
    for c, b, h in zip("zyx", block, classifier.pad, strict=True):
        df = df.withColumn(f"b{c}", F.explode(F.sequence(F.floor((F.col(c) - h) / b), F.floor((F.col(c) + h) / b))))

    def run(rows: pa.Table) -> pa.Table:
        z, y, x, v = (rows.column(n).to_numpy() for n in ("z", "y", "x", "v"))
        start = [int(rows.column(f"b{c}")[0].as_py()) * b for c, b in zip("zyx", block, strict=True)]
        low = [s - h for s, h in zip(start, classifier.pad, strict=True)]
        dense = np.zeros([b + 2 * h for b, h in zip(block, classifier.pad, strict=True)])
        places = [p - s for p, s in zip((z, y, x), low, strict=True)]
        dense[tuple(places)] = v
        there = [(int(p.min()), int(p.max()) + 1) for p in places]
        dense = np.pad(dense[tuple(slice(*t) for t in there)], [(a, n - b) for (a, b), n in zip(there, dense.shape, strict=True)], mode="symmetric")
        own = np.ones(len(z), bool)
        for p, s, b in zip((z, y, x), start, block, strict=True):
            own &= (p >= s) & (p < s + b)
        z, y, x = z[own], y[own], x[own]
        parts = []
        for name, image in classifier.run(dense, start[2], start[1], start[0]).items():
            off = [(n - b) // 2 for n, b in zip(image.shape, block, strict=True)]
            cells = image[z - start[0] + off[0], y - start[1] + off[1], x - start[2] + off[2]]
            parts.append(pa.table({"z": z, "y": y, "x": x, "channel": pa.array([name] * len(z), pa.string()), "value": np.clip(cells, 0, 255).astype(np.int64)}))
        return pa.concat_tables(parts)

    return df.groupBy("bz", "by", "bx").applyInArrow(run, "z long, y long, x long, channel string, value long")


def precomputed(volume: DataFrame, box: tuple[int, int, int, int, int, int], resolution: int) -> DataFrame:
    """(z, y, x, value) of a box from a volume kept at 1 / 2 ** resolution in y and x."""
    from ..sources.blocks import repair_scan

    return repair_scan(volume, box, (0, 0, 0), (1 << resolution, 1 << resolution, 1))


def edge_classifier(features: DataFrame, names: Sequence[str], label: str = "label", *, kind: str = "forest", seed: int = 1):
    """A fitted MLlib pipeline that gives `probability` for rows of the named features; kind: forest, boosting, svm or logistic."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    model = {
        "forest": lambda: RandomForestClassifier(numTrees=50, seed=seed, labelCol=label, featuresCol="vector"), "boosting": lambda: GBTClassifier(seed=seed, labelCol=label, featuresCol="vector"),
        "svm": lambda: LinearSVC(labelCol=label, featuresCol="vector"), "logistic": lambda: LogisticRegression(labelCol=label, featuresCol="vector"),
    }[kind]()
    return Pipeline(stages=[VectorAssembler(inputCols=list(names), outputCol="vector", handleInvalid="keep"), model]).fit(features)


def edge_probability(model, features: DataFrame) -> DataFrame:
    """`features` with the probability of label 1."""
    from pyspark.ml.functions import vector_to_array

    return model.transform(features).withColumn("p", vector_to_array("probability")[1]).drop("vector", "rawPrediction", "probability", "prediction")


def bandwidths(features: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row: the standard deviation of each named feature."""
    return features.agg(*[F.stddev_pop(F.col(n).cast("double")).alias(n) for n in names])


def similarity(pairs: DataFrame, names: Sequence[str], widths: DataFrame) -> DataFrame:
    """`pairs` (u_<name> and v_<name> of each feature) with affinity, exp of minus half their distance in bandwidths."""
    from ..functions.scalars import scaled_distance

    told = pairs.crossJoin(F.broadcast(widths.select(*[F.col(n).alias(f"w_{n}") for n in names])))  # one row
    d = scaled_distance(*[[F.col(f"{p}_{n}").cast("double") for n in names] for p in ("u", "v")], [F.col(f"w_{n}") for n in names])
    return told.withColumn("affinity", F.exp(-d / 2)).drop(*[f"w_{n}" for n in names])


def useless_features(features: DataFrame, names: Sequence[str], least: float = 1e-9) -> DataFrame:
    """(feature, variance, useless) of each named feature."""
    one = features.agg(*[F.var_pop(F.col(n).cast("double")).alias(n) for n in names])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("variance")) for n in names])).alias("f")
    return one.select(pairs).select("f.feature", "f.variance", (F.col("f.variance") <= least).alias("useless"))


def propagated(edges: DataFrame, known: DataFrame, *, rounds: int | None = None, still: float = 1e-4) -> DataFrame:
    """(node, score) after label propagation: unlabelled nodes take the affinity-weighted mean of their neighbours, round by round; labelled ones keep theirs.

    It ends after `rounds`, or without them when a round has moved no score by more than `still`, and reached no new node.
    """
    from itertools import count

    from ..spark import store

    both = store(edges.select("u", "v", "affinity").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"), "affinity")))
    held = store(known.select("node", F.col("score").cast("double").alias("score")))
    score = held
    for _ in count() if rounds is None else range(rounds):
        met = both.join(score.select(F.col("node").alias("v"), "score"), "v").groupBy(F.col("u").alias("node")).agg((F.sum(F.col("affinity") * F.col("score")) / F.sum("affinity")).alias("score"))
        now = store(met.join(held.select("node"), "node", "left_anti").unionByName(held))
        moved = now.join(score.withColumnRenamed("score", "before"), "node", "left").where(F.col("before").isNull() | (F.abs(F.col("score") - F.col("before")) > still))
        score = now
        if rounds is None and not moved.take(1):
            break
    return score


def clustered(features: DataFrame, names: Sequence[str], k: int, *, seed: int = 1) -> DataFrame:
    """`features` with `cluster` by k-means."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    ready = VectorAssembler(inputCols=list(names), outputCol="vector").transform(features)
    return KMeans(k=k, seed=seed, featuresCol="vector", predictionCol="cluster").fit(ready).transform(ready).drop("vector")
