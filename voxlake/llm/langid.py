"""Language identification by error-correcting output codes.

Every language has a codeword of bits; for each bit a binary naive Bayes classifier over letter n-grams tells
the languages with a 1 from those with a 0. Up to `EXHAUSTIVE` languages get all distinct splits, more of them
seeded codewords of 10 log2(languages) bits. Decoding adds an exponential loss of each bit's margin against
a codeword's bit, weighted by how well the bit separates its languages; the least loss wins, and a runner-up that is
close flags the text as ambiguous.

Learning is one narrow pass over all learnable documents that sums n-grams by language into 2 ** 15 slots; what is
shuffled, collected and broadcast is bounded by languages x slots.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_fold, small_batches
from .kernels import LOWER, chunks, text_bytes

SLOT_BITS = 15
FOLDS, HELD_OUT = 4, 2
EXHAUSTIVE = 6
SMOOTHING = 0.5
#: Of the probability, by which the winner has to lead for a text not to be ambiguous.
LEAD = 0.2
UNDETERMINED = "und"

#: Bytes of n-grams: a-z and all beyond ASCII; the others are 0x20.
LETTER = np.full(256, 0x20, np.uint8)
LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
LETTER[0x80:] = np.arange(0x80, 0x100)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each letter the slots of its bigram and trigram (with what follows it, and also with what precedes); letters' places."""
    n = len(data)
    padded = np.full(n + 2, 0x20, np.uint32)
    padded[1:-1] = LETTER[LOWER[data]]
    at, before, after = padded[1:-1], padded[:-2].copy(), padded[2:].copy()
    before[offsets[:-1][offsets[:-1] < n]] = 0x20
    after[offsets[1:][offsets[1:] > 0] - 1] = 0x20
    place = np.flatnonzero(at != 0x20)
    two = at[place] << np.uint32(8) | after[place]
    three = two | (before[place] << np.uint32(16))
    slot = lambda x, salt: ((x + np.uint32(salt)) * np.uint32(2654435761)) >> np.uint32(32 - SLOT_BITS)
    return np.concatenate([slot(two, 1 << 24), slot(three, 0)]).reshape(2, -1), place


def codewords(n: int, seed: int = 3) -> np.ndarray:
    """n codewords of +1 and -1 as rows."""
    if n < 2:
        return np.ones((n, 1))
    if n <= EXHAUSTIVE:
        bits = np.arange(1, 1 << (n - 1))
        return np.vstack([np.full(len(bits), 1.0), *[np.where(bits >> i & 1, -1.0, 1.0) for i in range(n - 1)]])
    width, best, reach = int(np.ceil(10 * np.log2(n))), None, -1
    draw = np.random.default_rng(seed)
    for _ in range(50):
        code = np.where(draw.random((n, width)) < 0.5, -1.0, 1.0)
        code[0, np.abs(code.sum(0)) == n] *= -1
        apart = ((code[:, None] != code[None]).sum(2) + width * np.eye(n)).min()
        if apart > reach:
            best, reach = code, apart
    return best


class Decoder:
    """From each language's counts by slot."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages))
        share = (counts + SMOOTHING) / (counts + SMOOTHING).sum(1, keepdims=True) if len(languages) else counts
        weights, reach, trust = [], [], []
        for bit in self.code.T:
            ones, zeros = share[bit > 0], share[bit < 0]
            if not len(ones) or not len(zeros):
                weights.append(np.zeros(counts.shape[1]))
            else:
                weights.append(np.log(ones.mean(0)) - np.log(zeros.mean(0)))
            margin = bit * (share @ weights[-1]) if len(languages) else np.zeros(0)
            reach.append(max(float(np.abs(margin).mean()), 1e-9) if len(margin) else 1.0)
            trust.append(max(float(margin.min()) / reach[-1], 0.05) if len(margin) else 1.0)
        #: Weights of a slot for all bits, scaled so that a language's own text has a margin near 1.
        self.weights = (np.array(weights).T / np.array(reach)).astype(np.float32) if weights else np.zeros((counts.shape[1], 0), np.float32)
        self.trust = np.array(trust)

    def margins(self, column: pa.Array) -> np.ndarray:
        """Mean margin of each bit for each text."""
        data, offsets = text_bytes(column)
        out = np.zeros((len(offsets) - 1, self.weights.shape[1]))
        for i, j in chunks(offsets, 1 << 20):
            at = offsets[i : j + 1] - offsets[i]
            slots, place = grams(data[offsets[i] : offsets[j]], at)
            bounds = np.searchsorted(place, at)
            for t in range(j - i):
                a, b = bounds[t], bounds[t + 1]
                if a < b:
                    seen = np.bincount(slots[:, a:b].ravel(), minlength=1 << SLOT_BITS) if b - a > 4096 else None
                    total = seen @ self.weights if seen is not None else self.weights[slots[:, a:b].ravel()].sum(0, dtype=np.float64)
                    out[i + t] = total / (2 * (b - a))
        return out

    def decode(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, runner-up's score and ambiguity of each text."""
        texts, n = column, len(column)
        if not self.languages:
            return [UNDETERMINED] * n, np.zeros(n), np.zeros(n), np.ones(n, bool)
        margin = np.clip(self.margins(column), -3, 3)
        loss = (np.exp(-2 * margin[:, None, :] * self.code[None]) * self.trust).sum(2) / self.trust.sum()
        odds = np.exp(-4 * (loss - loss.min(1, keepdims=True)))
        odds /= odds.sum(1, keepdims=True)
        order = np.argsort(-odds, axis=1, kind="stable")
        first = odds[np.arange(n), order[:, 0]]
        second = odds[np.arange(n), order[:, 1]] if odds.shape[1] > 1 else np.zeros(n)
        best = [self.languages[k] for k in order[:, 0]]
        data, offsets = text_bytes(texts)
        ascii_letter = np.concatenate([[0], np.cumsum((LOWER[data] >= 0x61) & (LOWER[data] <= 0x7A))])
        for t in np.flatnonzero(ascii_letter[offsets[1:]] == ascii_letter[offsets[:-1]]):
            if not any(c.isalpha() for c in texts[int(t)].as_py() or ""):
                best[t], first[t], second[t] = UNDETERMINED, 0.0, 0.0
        return best, first, second, first - second < LEAD


def fit(docs: DataFrame) -> Decoder:
    """A decoder of the languages of all documents outside the held-out fold that have text and language."""
    small_batches(docs.sparkSession)
    learn = docs.select("text", F.col("lang").cast("string").alias("lang")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~in_fold("doc_id", FOLDS, HELD_OUT)
    )

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            langs = np.array(b.column(1).to_pylist(), object)
            data, offsets = text_bytes(b.column(0))
            for i, j in chunks(offsets):
                slots, place = grams(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                text = np.searchsorted(offsets[i : j + 1] - offsets[i], place, side="right") - 1
                for lang in dict.fromkeys(langs[i:j]):
                    mine = (langs[i:j] == lang)[text]
                    n = np.bincount(slots[:, mine].ravel(), minlength=1 << SLOT_BITS)
                    total[lang] = total.get(lang, 0) + n
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "slot", "n"])
            if not len(at):
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([0], pa.int32()), pa.array([0], pa.int64())], names=["lang", "slot", "n"])

    found = learn.mapInArrow(count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    names = found.column("lang").to_pylist()
    languages = sorted(set(names))
    counts = np.zeros((len(languages), 1 << SLOT_BITS))
    row = {x: i for i, x in enumerate(languages)}
    counts[[row[x] for x in names], found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return Decoder(languages, counts)


def with_language(docs: DataFrame, decoder: Decoder) -> DataFrame:
    """`docs` with lang_pred, score, runner_up (its score) and ambiguous, which replace columns of these names; all others stay."""
    small_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "score", "runner_up", "ambiguous")
    sent = docs.sparkSession.sparkContext.broadcast(decoder)
    new = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("runner_up", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]

    def run(batches):
        for b in batches:
            out = sent.value.decode(b.column(b.schema.get_field_index("text")))
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(x) for x in out)], names=[*b.schema.names, *(f.name for f in new)])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *new]))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, ambiguous.

    Of languages with equal odds the first by name is predicted, and the text is ambiguous. `und` with score 0 if the text is null or has no letter, or if there was nothing to learn from. Repeated rows have
    equal results. A null doc_id isn't held out and isn't learned from. Other columns are ignored; no documents give no rows.
    """
    told = with_language(docs.select("doc_id", "text"), fit(docs))
    return told.select("doc_id", in_fold("doc_id", FOLDS, HELD_OUT).alias("held_out"), "lang_pred", "score", "ambiguous")
