"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad; its features are its own (length, case, digits, symbols, repeated words, ...) and
those of the lines before and after. Training gives each line its document's label and maximises the chain's conditional
likelihood on a bounded sample of labelled documents; then lines that would surely be of the other kind among lines like themselves change theirs, as long as most of a
document's text keeps its label, and the field is fitted again, so that it learns from chains whose lines differ. A document's quality is the mean of its lines' forward-backward marginals,
weighted by their lengths, then calibrated on the same sample.

With two states a chain's messages are one log-ratio a line, so forward and backward passes run over all
documents of a batch at once, line by line. The passes over the documents are narrow.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fit_logistic, in_fold, labelled_sample, small_batches
from .kernels import chunks, runs, span_hashes, text_bytes, word_ranges
from .mixing import SPACE

#: Labelled documents that the chain is fitted on, at most, and lines of a training chain (longer documents give several chains).
SAMPLE, CHAIN = 6000, 40
#: Lines that it is fitted on, at most, 52 bytes each: of a longer document the sample has only this many divided by SAMPLE, evenly spread chains of it.
SAMPLE_LINES = 1 << 19
FOLDS, HELD_OUT = 3, 1
ROUNDS, RATE, L2 = 120, 0.1, 1e-3
#: Log-odds from which a line of the training sample changes its document's label.
SURE = 3.0

#: Each byte's kind.
UPPER, LOWER_CASE, DIGIT, SYMBOL, OTHER = range(5)
KIND = np.full(256, OTHER, np.uint8)
KIND[0x21:0x7F] = SYMBOL
KIND[0x30:0x3A] = DIGIT
KIND[0x41:0x5B] = UPPER
KIND[0x61:0x7B] = LOWER_CASE
PLAIN = np.zeros(256, bool)
PLAIN[list(b".,;:'\"()-?")] = True
CLOSING = np.zeros(256, bool)
CLOSING[list(b".?")] = True

FEATURES = 13


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lengths, bounds of each text's lines) of all lines that aren't empty."""
    starts, ends = runs(data != 0x0A, offsets)
    bounds, n = word_ranges(starts, offsets), len(starts)
    if not n:
        return np.zeros((0, FEATURES)), np.zeros(0, np.int64), bounds
    length = ends - starts

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(mask) + 1, np.int32)
        np.cumsum(mask, dtype=np.int32, out=total[1:])
        return total[ends] - total[starts]

    kind = KIND[data]
    upper, small, digit, symbol = (share(kind == k) for k in (UPPER, LOWER_CASE, DIGIT, SYMBOL))
    odd = share((kind == SYMBOL) & ~PLAIN[data])
    ws, we = runs(~SPACE[data], offsets)
    line = np.searchsorted(starts, ws, side="right") - 1
    words = np.bincount(line, minlength=n)
    hashes = span_hashes(data, ws, we)
    again = np.zeros(len(ws), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    order = np.lexsort((hashes, line))
    kinds = np.ones(len(ws), bool)
    kinds[1:] = (hashes[order][1:] != hashes[order][:-1]) | (line[order][1:] != line[order][:-1])
    distinct = np.bincount(line[order][kinds], minlength=n)
    whole = span_hashes(data, starts, ends)
    same = np.zeros(n, bool)
    same[1:] = whole[1:] == whole[:-1]
    same[bounds[:-1][bounds[:-1] < n]] = False
    some = np.maximum(words, 1)
    out = np.column_stack([
        np.log1p(length), np.log1p(words), upper / (upper + small + 1), upper / length, digit / length, symbol / length, odd / length,
        np.minimum(length / some, 40), np.bincount(line, we - ws <= 3, minlength=n) / some, np.bincount(line, again, minlength=n) / some,
        distinct / some, CLOSING[data[ends - 1]], same,
    ])
    return out, length, bounds


def around(own: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each line's features with those of the lines before and after (zeros at a text's ends)."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    first, last = bounds[:-1][bounds[:-1] < bounds[1:]], bounds[1:][bounds[:-1] < bounds[1:]] - 1
    before[first] = 0
    after[last] = 0
    return np.hstack([own, before, after])


class Chains:
    """Chains side by side: line t of all chains that have one. The longest come first."""

    def __init__(self, bounds: np.ndarray):
        size = np.diff(bounds)
        self.order = np.argsort(-size, kind="stable")
        begin, size = bounds[:-1][self.order], size[self.order]
        alive = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
        self.steps = [begin[:n] + t for t, n in enumerate(alive)]

    def messages(self, u: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward log-ratios (with the line's own potential) and backward ones, good to bad; a[i, j] is for i before j."""
        f, b = u.copy(), np.zeros_like(u)
        for earlier, now in zip(self.steps, self.steps[1:], strict=False):
            r = f[earlier[: len(now)]]
            f[now] += np.logaddexp(r + a[1, 1], a[0, 1]) - np.logaddexp(r + a[1, 0], a[0, 0])
        for now, later in zip(self.steps[-2::-1], self.steps[:0:-1], strict=False):
            v = u[later] + b[later]
            b[now[: len(later)]] = np.logaddexp(v + a[1, 1], a[1, 0]) - np.logaddexp(v + a[0, 1], a[0, 0])
        return f, b

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.steps) < 2:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return (np.concatenate([e[: len(n)] for e, n in zip(self.steps, self.steps[1:], strict=False)]), np.concatenate(self.steps[1:]))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class LineField:
    """mean and scale of features, weights of a line's potential, transitions, calibration."""

    def __init__(self, own: np.ndarray, bounds: np.ndarray, label: np.ndarray):
        """Fitted by Adam on the conditional likelihood of chains whose lines all have their document's label."""
        self.mean, self.scale = (own.mean(0), own.std(0) + 1e-6) if len(own) else (np.zeros(FEATURES), np.ones(FEATURES))
        self.weights, self.bias, self.a, self.calibration = np.zeros(3 * FEATURES), 0.0, np.zeros((2, 2)), np.array([1.0, 0.0])
        if len(set(label.tolist())) < 2:
            self.bias = 0.0 if not len(label) else (4.0 if label[0] else -4.0)
            return
        x, y = self.design(own, bounds), np.repeat(label, np.diff(bounds)).astype(float)
        cuts = np.unique(np.concatenate([bounds, *[np.arange(s, e, CHAIN) for s, e in zip(bounds, bounds[1:], strict=False)]]))
        self.optimise(x, y, Chains(cuts))
        alone = x[:, :FEATURES] @ self.weights.reshape(3, FEATURES).sum(0) + self.bias  # among lines like itself: neighbours and chain would hold it to its document
        other = self.others(alone, own[:, 0], bounds, label)
        if other.any():
            self.optimise(x, np.where(other, 1 - y, y), Chains(cuts))
        raw = self.aggregate(own, own[:, 0], bounds, logged=True)
        self.calibration = fit_logistic(raw[:, None], label > 0)

    def optimise(self, x: np.ndarray, y: np.ndarray, chains: Chains) -> None:
        """Weights and transitions by Adam, for lines' labels y."""
        first, second = chains.pairs()
        gold = np.bincount((2 * y[first] + y[second]).astype(int), minlength=4).reshape(2, 2) / len(x)
        theta = np.zeros(x.shape[1] + 5)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, ROUNDS + 1):
            u, a = x @ theta[:-5] + theta[-5], theta[-4:].reshape(2, 2)
            f, b = chains.messages(u, a)
            p = sigmoid(f + b)
            tail = u[second] + b[second]
            joint = np.stack([np.full(len(first), a[0, 0]), a[0, 1] + tail, f[first] + a[1, 0], f[first] + a[1, 1] + tail])
            joint = np.exp(joint - joint.max(0)) if len(first) else joint
            joint = (joint / joint.sum(0)).sum(1).reshape(2, 2) / len(x) if len(first) else np.zeros((2, 2))
            up = np.concatenate([x.T @ (y - p) / len(x), [(y - p).mean()], (gold - joint).ravel()]) - L2 * theta
            m, v = 0.9 * m + 0.1 * up, 0.99 * v + 0.01 * up * up
            theta = theta + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.weights, self.bias, self.a = theta[:-5], theta[-5], theta[-4:].reshape(2, 2)

    @staticmethod
    def others(odds: np.ndarray, length: np.ndarray, bounds: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Lines that are of the other kind than their document with odds of SURE, in documents most of whose text (length in logs) keeps its label."""
        of = np.repeat(np.arange(len(label)), np.diff(bounds))
        other = np.where(label[of] > 0, odds < -SURE, odds > SURE)
        size = np.expm1(length)
        share = np.bincount(of, size * other, len(label)) / np.maximum(np.bincount(of, size, len(label)), 1e-9)
        return other & (share < 0.5)[of]

    def design(self, own: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return around((own - self.mean) / self.scale, bounds)

    def marginals(self, own: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Log-odds that each line is good."""
        f, b = Chains(bounds).messages(self.design(own, bounds) @ self.weights + self.bias, self.a)
        return f + b

    def aggregate(self, own: np.ndarray, length: np.ndarray, bounds: np.ndarray, logged: bool = False) -> np.ndarray:
        """Log-odds of each text's length-weighted mean of its lines' probabilities; of a text without lines -12."""
        length = np.expm1(length) if logged else length
        total = lambda w: np.diff(np.concatenate([[0.0], np.cumsum(w)])[bounds])
        odds = np.clip(self.marginals(own, bounds), -30, 30)
        good, bad = total(length / (1 + np.exp(-odds))), total(length / (1 + np.exp(odds)))
        with np.errstate(divide="ignore", invalid="ignore"):
            out = np.log(np.maximum(good, 1e-12)) - np.log(np.maximum(bad, 1e-12))
        return np.where(np.diff(bounds) > 0, np.clip(out, -12, 12), -12)

    def score(self, column: pa.Array) -> np.ndarray:
        """Of each text; 0 for one without lines."""
        data, offsets = text_bytes(column)
        out = np.zeros(len(offsets) - 1)
        for i, j in chunks(offsets):
            own, length, bounds = lines(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            score = sigmoid(self.aggregate(own, length, bounds) * self.calibration[0] + self.calibration[1])
            out[i:j] = np.where(np.diff(bounds) > 0, score, 0)
        return out


def _spread(own: np.ndarray, most: int) -> np.ndarray:
    """All lines, or `most` evenly spread runs of CHAIN of them."""
    if len(own) <= most * CHAIN:
        return own
    begin = np.linspace(0, len(own) - CHAIN, most).astype(np.int64)
    return own[(begin[:, None] + np.arange(CHAIN)).ravel()]


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> LineField:
    """Fitted on the lines of at most `sample` labelled documents outside the held-out fold; of a document with many lines on some of its chains."""
    spark = docs.sparkSession
    small_batches(spark)
    known = labelled_sample(labels, "quality", folds=FOLDS, held_out=HELD_OUT, bound=sample)
    ids = spark.createDataFrame(list(known.items()), "doc_id long, y int")
    most = max(1, SAMPLE_LINES // (sample * CHAIN))

    def tell(batches):
        for b in batches:
            data, offsets = text_bytes(b.column(0))
            cells = []
            for i, j in chunks(offsets):
                own, _, bounds = lines(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                cells += [_spread(own[s:e], most).astype(np.float32).tobytes() for s, e in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(cells, pa.binary())], names=["doc_id", "y", "own"])

    told = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id").select("text", "doc_id", "y").mapInArrow(tell, "doc_id long, y int, own binary")
    told = told.groupBy("doc_id").agg(F.max(F.struct("y", "own")).alias("x")).select("x.y", "x.own").toArrow()  # one row for each id, whatever number of rows has it
    rows = sorted(zip(told.column("y").to_pylist(), told.column("own").to_pylist(), strict=True))  # whatever the partitioning
    rows = [(y, np.frombuffer(x, np.float32).reshape(-1, FEATURES)) for y, x in rows if x]
    bounds = np.concatenate([[0], np.cumsum([len(x) for _, x in rows], dtype=np.int64)]).astype(np.int64)
    own = np.concatenate([x for _, x in rows]).astype(float) if rows else np.zeros((0, FEATURES))
    return LineField(own, bounds, np.array([y for y, _ in rows], np.int64))


def with_score(docs: DataFrame, field: LineField, column: str = "score") -> DataFrame:
    """`docs` with the quality of `text` (null: an empty text) as `column`, which replaces one of that name; all other columns stay."""
    small_batches(docs.sparkSession)
    docs = docs.drop(column)
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sent.value.score(b.column(b.schema.get_field_index("text"))))], names=[*b.schema.names, column])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def report(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Texts without lines (null, empty, line ends alone) score 0. Repeated rows have equal scores. A null doc_id isn't held
    out and isn't learned from; without labels of both classes all texts with lines get one score. Other columns
    of either table are ignored; no documents give no rows.
    """
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels, **how))
    return scored.select("doc_id", in_fold("doc_id", FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
