"""Toxicity by class-conditional Kneser-Ney models of the spelling and the sequence of words.

Letters: two models of order 5 over the letters of a word, one of toxic and one of ordinary texts, back off to one distribution that both
share: Kneser-Ney continuation counts of the letter grams of all documents, labelled or not. Letters are code points in 12 bits, so a
gram is a long; the table of grams and the counts of what precedes them grow with the corpus, stay in Spark, and are joined with
the grams that labelled texts have.

Words: two models of word pairs, so that an expression of ordinary words tells too. They back off to the class's continuation counts of words, and these
to the word's spelling under the letters' shared distribution.

A text's evidence is the difference of the two log-likelihoods, of letters and of words, divided by its length, over the whole text and
over its most telling words; a logistic regression on labelled rows that the models haven't seen
turns it into a score.

Passes over the documents: letter grams, word pairs of the labelled rows, evidence of the calibration rows, scores. Each is narrow; only counts by
gram are shuffled, after a task has left out those that it sent shortly before. The models go to the tasks with at most `EVENTS` letter grams
and `EVENTS` word pairs, 12 bytes each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import fit_logistic, in_fold, labelled_sample, small_batches, store
from .kernels import LOWER, chunks, mix, runs, span_hashes, text_bytes, word_ranges

ORDER, BITS, DISCOUNT = 5, 12, 0.75
#: Labelled rows that the two models and the calibration are fitted on, at most.
SAMPLE = 30_000
#: Letter grams, and word pairs, of the labelled rows that the models keep, at most: the frequent ones, as many as fit with all of equal frequency.
EVENTS = 1 << 21
FOLDS, HELD_OUT = 5, 0

MASK = [(1 << (BITS * n)) - 1 for n in range(ORDER + 1)]
#: Of `seen`, how many of the latest grams a task remembers.
RECENT = 1 << 20


def _letters() -> np.ndarray:
    """The class of code points up to 0x7FF: 0 between words, letters in lower case as themselves, one class for digits."""
    table = np.arange(0x800, dtype=np.int64)
    for c in range(0x80, 0x800):
        low = chr(c).lower()
        table[c] = ord(low) if len(low) == 1 and ord(low) < 0x800 else c
    table[:0x80] = 0
    table[0x61:0x7B] = np.arange(0x61, 0x7B)
    table[0x30:0x3A] = 0x30
    return table


LETTER = _letters()
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True


def letters_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each code point, 12 bits (those from 0x800 on share 2,048 classes by a hash), and the byte where it begins."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    point = data[lead].astype(np.int64)
    wide = np.flatnonzero(point >= 0xC0)
    if len(wide):
        padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int64) & 0x3F
        at, first = lead[wide], point[wide]
        two = (first & 0x1F) << 6 | padded[at + 1]
        three = (first & 0x0F) << 12 | padded[at + 1] << 6 | padded[at + 2]
        four = (first & 0x07) << 18 | padded[at + 1] << 12 | padded[at + 2] << 6 | padded[at + 3]
        point[wide] = np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))
    out = LETTER[np.minimum(point, 0x7FF)]
    high = point >= 0x800
    if high.any():
        out[high] = 0x800 + ((point[high] * 2654435761 & 0xFFFFFFFF) >> 21)
    return out, lead


def events(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each letter its gram (the letter in the low bits, the four before it in its word above); starts and ends of words in letters; texts' offsets in letters."""
    data = LOWER[data]
    letters, lead = letters_of(data)
    at = np.searchsorted(lead, offsets)
    word = letters > 0
    starts, ends = runs(word, at)
    place = np.arange(len(letters), dtype=np.int32)
    begin = np.zeros(len(letters), np.int32)
    begin[starts] = place[starts]
    since = place - np.maximum.accumulate(begin)
    codes = letters.copy()
    for j in range(1, ORDER):
        codes[j:] |= np.where(since[j:] >= j, letters[:-j], 0) << (BITS * j)
    return np.where(word, codes, 0), starts, ends, at


class Spoken:
    """The words of texts end to end: hashes of each and of the one before it in its text (0 for the first), bounds of each text's words, and the distinct words, by letter."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = LOWER[data]
        starts, ends = runs(WORD[data], offsets)
        self.words, self.bounds = span_hashes(data, starts, ends).view(np.int64), word_ranges(starts, offsets)
        self.before = np.zeros(len(starts), np.int64)
        self.before[1:] = self.words[:-1]
        self.before[self.bounds[:-1][self.bounds[:-1] < len(starts)]] = 0
        _, first, self.kind = np.unique(self.words, return_index=True, return_inverse=True)
        size = ends[first] - starts[first]
        shift = np.concatenate([[0], np.cumsum(size + 1)]).astype(np.int64)
        letters = np.full(shift[-1], 0x20, np.uint8)
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        letters[np.repeat(shift[:-1], size) + inside] = data[np.repeat(starts[first], size) + inside]
        codes, begin, end, _ = events(letters, np.array([0, len(letters)]))
        #: Grams of the distinct words' letters, and of which word each is.
        self.codes, self.of = codes[codes > 0], np.repeat(np.arange(len(begin)), end - begin)
        self.size = end - begin

    def summed(self, of_letters: np.ndarray) -> np.ndarray:
        """For each word the sum of its letters' values."""
        return np.bincount(self.of, of_letters, len(self.size))[self.kind]


def pair_key(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(before.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + words.view(np.uint64)).view(np.int64)


class Lookup:
    """Values of distinct longs: an open hash table, made where it is first asked."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values, self.table = keys[order], values[order].astype(np.float32), None

    def __getstate__(self):
        return self.__dict__ | {"table": None}

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.width)).astype(np.int64)

    def _build(self) -> None:
        self.width = max(4, int(2 * len(self.keys)).bit_length())
        size = 1 << self.width
        self.table, self.steps = np.full(size, -1, np.int32), 0
        todo, at = np.arange(len(self.keys), dtype=np.int32), self._slots(self.keys)
        while len(todo):
            free = self.table[at] < 0
            self.table[at[free]] = todo[free]
            lost = self.table[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & (size - 1)
            self.steps += 1

    def get(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of x (0 for what has none), and which have one."""
        if self.table is None:
            self._build()
        out, found = np.zeros(len(x), np.float32), np.zeros(len(x), bool)
        live, at = np.arange(len(x)), self._slots(x)
        for _ in range(self.steps):
            place = self.table[at]
            some = place >= 0
            live, at, place = live[some], at[some], place[some]
            good = self.keys[place] == x[live]
            out[live[good]], found[live[good]] = self.values[place[good]], True
            live, at = live[~good], (at[~good] + 1) & (len(self.table) - 1)
            if not len(live):
                break
        return out, found


class Letters:
    """Log-likelihood ratios (toxic to ordinary) of letters: of known grams, else of their history's weight of backing off."""

    def __init__(self, codes: np.ndarray, ratio: np.ndarray, low: np.ndarray, history: np.ndarray, weight: np.ndarray, kinds: int):
        self.ratio, self.weight = Lookup(codes, ratio), Lookup(history, weight)
        self.low: Lookup | None = Lookup(codes, low)
        self.least = float(np.log(1 / max(kinds, 1)))

    def ratios(self, codes: np.ndarray) -> np.ndarray:
        out, found = self.ratio.get(codes)
        rest = np.flatnonzero(~found)
        out[rest] = self.weight.get(codes[rest] >> BITS)[0]
        return out

    def spelled(self, codes: np.ndarray) -> np.ndarray:
        """Log-probabilities of letters under the shared distribution; of grams that no labelled text has, an even one."""
        out, found = self.low.get(codes)
        return np.where(found, out, self.least)


class Words:
    """Log-likelihood ratios of words after the word before: of known pairs, else of the history's weight and the word."""

    def __init__(self, pairs: np.ndarray, ratio: np.ndarray, history: np.ndarray, weight: np.ndarray, words: np.ndarray, single: np.ndarray, unseen: float):
        self.pairs, self.weight, self.single, self.unseen = Lookup(pairs, ratio), Lookup(history, weight), Lookup(words, single), unseen

    def ratios(self, before: np.ndarray, words: np.ndarray) -> np.ndarray:
        out, found = self.pairs.get(pair_key(before, words))
        rest = np.flatnonzero(~found)
        single, known = self.single.get(words[rest])
        out[rest] = self.weight.get(before[rest])[0] + np.where(known, single, self.unseen)
        return out


FEATURES = 8


class Toxicity:
    def __init__(self, letters: Letters, words: Words, weights: np.ndarray):
        self.letters, self.words, self.weights = letters, words, weights

    def evidence(self, column: pa.Array) -> np.ndarray:
        """A row for each text, of letters and then of words: mean ratio (of a letter; of a word), sum over the root of the words, the one and the three most telling words."""
        data, offsets = text_bytes(column)
        out = np.zeros((len(offsets) - 1, FEATURES))
        for i, j in chunks(offsets):
            said = Spoken(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            spelled, letters = said.summed(self.letters.ratios(said.codes)), said.size[said.kind]
            pairs = self.words.ratios(said.before, said.words).astype(np.float64)
            for t in range(j - i):
                own = slice(said.bounds[t], said.bounds[t + 1])
                x, y = spelled[own], pairs[own]
                if len(x):
                    out[i + t] = 100 * x.sum() / letters[own].sum(), x.sum() / np.sqrt(len(x)), x.max(), _top(x), 10 * y.sum() / len(y), y.sum() / np.sqrt(len(y)), y.max(), _top(y)
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.evidence(column) @ self.weights[:-1] + self.weights[-1], -40, 40)))


def _top(x: np.ndarray) -> float:
    return float((np.partition(x, len(x) - 3)[-3:] if len(x) > 3 else x).mean())


def smoothed(n: Column, total: Column, kinds: Column, low: Column) -> Column:
    """Kneser-Ney: the discounted share, and what the discounts left over by the lower order; the lower order where nothing was seen."""
    return F.when(total > 0, (F.greatest(n - DISCOUNT, F.lit(0.0)) + DISCOUNT * kinds * low) / total).otherwise(low)


def weight_of(total: Column, kinds: Column) -> Column:
    """The log of what a history gives to its lower order; 0 where nothing was seen."""
    return F.when(total > 0, F.log(DISCOUNT * kinds / total)).otherwise(0.0)


def continuations(grams: DataFrame, n: int) -> DataFrame:
    """(g, c, total, kinds) of the grams of n letters that end the distinct `gram`s of n + 1: how many letters precede them, and the sums of that by history."""
    counted = grams.select(F.col("gram").bitwiseAND(F.lit(MASK[n])).alias("g")).groupBy("g").agg(F.count("*").alias("c"))
    same = Window.partitionBy(F.shiftright("g", BITS))
    return counted.select("g", "c", F.sum("c").over(same).alias("total"), F.count("*").over(same).alias("kinds"))


def shared_backoff(grams: DataFrame, asked: DataFrame) -> tuple[DataFrame, int]:
    """`asked` (gram, ...) with low, the shared probability of its last letter after the three before it, from the distinct `gram`s of all documents; and how many letters there are."""
    tables, level = {}, grams.select("gram")
    for n in range(ORDER - 1, 0, -1):
        tables[n] = store(continuations(level, n)) if n > 1 else continuations(level, n).collect()  # 2 ** BITS letters
        level = tables[n].select(F.col("g").alias("gram")) if n > 1 else None
    single = tables[1]
    kinds = len(single)
    spark = asked.sparkSession
    first = spark.createDataFrame([(r["g"], (max(r["c"] - DISCOUNT, 0) + DISCOUNT * r["kinds"] / kinds) / r["total"]) for r in single], "g1 long, low double")
    out = asked.withColumn("g1", F.col("gram").bitwiseAND(F.lit(MASK[1]))).join(F.broadcast(first), "g1").drop("g1")
    for n in range(2, ORDER):
        told = tables[n].select(F.col("g").alias("gn"), "c", "total", "kinds")
        out = out.withColumn("gn", F.col("gram").bitwiseAND(F.lit(MASK[n]))).join(told, "gn")
        out = out.withColumn("low", smoothed(F.col("c"), F.col("total"), F.col("kinds"), F.col("low"))).drop("gn", "c", "total", "kinds")
    return out, kinds


def by_class(df: DataFrame, history: Column) -> DataFrame:
    """`df` (toxic, ordinary) with the totals and kinds of each class by history."""
    same = Window.partitionBy(history)
    cells = {}
    for c in ("toxic", "ordinary"):
        cells |= {f"{c}_total": F.sum(c).over(same), f"{c}_kinds": F.sum((F.col(c) > 0).cast("long")).over(same)}
    return df.withColumns(cells)


def ratio(toxic: Column, ordinary: Column, low: tuple[Column, Column]) -> Column:
    cells = [smoothed(n, F.col(f"{c}_total"), F.col(f"{c}_kinds"), x) for c, n, x in zip(("toxic", "ordinary"), (toxic, ordinary), low, strict=True)]
    return F.log(cells[0]) - F.log(cells[1])


def frequent(df: DataFrame, most: int) -> DataFrame:
    """The rows (toxic, ordinary) of the largest counts, all rows of a count or none, at most `most` rows."""
    n = F.col("toxic") + F.col("ordinary")
    kept, least = 0, 1
    sizes = df.groupBy(F.least(n, F.lit(1000)).alias("n")).agg(F.count("*").alias("rows")).collect()
    for r in sorted(sizes, key=lambda r: -r["n"]):
        kept += r["rows"]
        least = r["n"] if kept <= most else least
        if kept > most:
            least = r["n"] + 1
            break
    return df.where(n >= least)


def _longs(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy() for n in names]


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, most: int = EVENTS) -> Toxicity:
    """Models and calibration. Without calibration rows of both classes every text has one score, the share of toxic labels; 1 in 3 without any."""
    spark = docs.sparkSession
    small_batches(spark)
    known = labelled_sample(labels, "toxic", folds=FOLDS, held_out=HELD_OUT, bound=sample)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    shared = spark.sparkContext.broadcast(known)

    def grams(batches):
        recent = np.zeros(RECENT, np.int64)
        for b in batches:
            data, offsets = text_bytes(b.column(1))
            label = np.array([shared.value.get(x, -1) if f != FOLDS - 1 else -1 for x, f in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)])
            for i, j in chunks(offsets):
                said = Spoken(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                slot = (said.codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)
                fresh = np.unique(said.codes[recent[slot] != said.codes])
                recent[slot] = said.codes
                none = np.zeros(len(fresh), np.int64)
                yield rows(fresh, none, none)
                label_of = np.repeat(label[i:j], np.diff(said.bounds))
                for y in (0, 1):
                    times = np.bincount(said.kind[label_of == y], minlength=len(said.size))[said.of]
                    if times.any():
                        kinds, where = np.unique(said.codes[times > 0], return_inverse=True)
                        n = np.bincount(where, times[times > 0]).astype(np.int64)
                        yield rows(kinds, n * y, n * (1 - y))

    rows = lambda c, t, o: pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(t, pa.int64()), pa.array(o, pa.int64())], names=["gram", "toxic", "ordinary"])
    seen = store(docs.withColumn("fold", fold).mapInArrow(grams, "gram long, toxic long, ordinary long").groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")))
    labelled, kinds = shared_backoff(seen, by_class(seen.where("toxic + ordinary > 0"), F.shiftright("gram", BITS)))
    weight = weight_of(F.col("toxic_total"), F.col("toxic_kinds")) - weight_of(F.col("ordinary_total"), F.col("ordinary_kinds"))
    labelled = store(labelled.select("gram", "toxic", "ordinary", ratio(F.col("toxic"), F.col("ordinary"), (F.col("low"), F.col("low"))).alias("ratio"), F.log("low").alias("low"), weight.alias("weight")))
    kept = frequent(labelled, most)
    history = kept.groupBy(F.shiftright("gram", BITS).alias("history")).agg(F.first("weight").alias("weight")).toArrow()  # at most `most` rows, as what follows
    letters = Letters(*_longs(kept.select("gram", "ratio", "low").toArrow(), "gram", "ratio", "low"), *_longs(history, "history", "weight"), kinds)

    sample_rows = spark.createDataFrame(list(known.items()), "doc_id long, y int")
    told = docs.join(F.broadcast(sample_rows), "doc_id").select("text", "y", in_fold("doc_id", FOLDS, FOLDS - 1).alias("apart"))
    words = _words(told.where(~F.col("apart")).select("text", "y"), letters, most)
    letters.low = None  # only the words needed it

    sent = spark.sparkContext.broadcast(Toxicity(letters, words, np.zeros(FEATURES + 1)))
    names = [f"x{k}" for k in range(FEATURES)]

    def weigh(batches):
        for b in batches:
            e = sent.value.evidence(b.column(0))
            yield pa.RecordBatch.from_arrays([b.column(1), *(pa.array(e[:, k].copy()) for k in range(FEATURES))], names=["y", *names])

    # One row for each document of the sample, whatever number of rows has its id, in one order whatever the partitioning.
    apart = docs.join(F.broadcast(sample_rows.where(in_fold("doc_id", FOLDS, FOLDS - 1))), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("y").alias("y"))
    table = apart.select("text", "y").mapInArrow(weigh, "y int, " + ", ".join(f"{n} double" for n in names)).toArrow().sort_by([(n, "ascending") for n in ["y", *names]])
    told = np.column_stack(_longs(table, "y", *names)) if len(table) else np.zeros((0, FEATURES + 1))
    weights = fit_logistic(told[:, 1:], told[:, 0] > 0)
    if not weights.any():
        toxic = sum(known.values())
        weights = np.array([0.0] * FEATURES + [np.log((toxic + 1) / (len(known) - toxic + 2))])
    return Toxicity(letters, words, weights)


def _words(sample: DataFrame, letters: Letters, most: int) -> Words:
    """From (text, y) of the labelled sample."""
    sent = sample.sparkSession.sparkContext.broadcast(letters)

    def count(batches):
        for b in batches:
            data, offsets = text_bytes(b.column(0))
            label = b.column(1).to_numpy()
            for i, j in chunks(offsets):
                said = Spoken(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                if not len(said.words):
                    continue
                back = said.summed(sent.value.spelled(said.codes))
                y = np.repeat(label[i:j], np.diff(said.bounds))
                _, first, where = np.unique(pair_key(said.before, said.words), return_index=True, return_inverse=True)
                cells = [said.before[first], said.words[first], np.exp(np.maximum(back[first], -600)), np.bincount(where, y == 1).astype(np.int64), np.bincount(where, y == 0).astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cells], names=["before", "word", "back", "toxic", "ordinary"])

    counted = sample.mapInArrow(count, "before long, word long, back double, toxic long, ordinary long")
    pairs = store(counted.groupBy("before", "word").agg(F.max("back").alias("back"), F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")))
    follow = [F.sum((F.col(c) > 0).cast("long")).alias(c) for c in ("toxic", "ordinary")]
    single = store(pairs.groupBy("word").agg(F.max("back").alias("back"), *follow))
    totals = single.agg(*[f for c in ("toxic", "ordinary") for f in (F.sum(c).alias(f"{c}_total"), F.sum((F.col(c) > 0).cast("long")).alias(f"{c}_kinds"))]).first()
    all_ = {k: float(v or 0) for k, v in totals.asDict().items()}
    at = lambda c: smoothed(F.col(c), F.lit(all_[f"{c}_total"]), F.lit(all_[f"{c}_kinds"]), F.col("back"))
    single = single.select("word", "toxic", "ordinary", at("toxic").alias("p_toxic"), at("ordinary").alias("p_ordinary"))
    low = single.select("word", "p_toxic", "p_ordinary")
    weighed = by_class(pairs.select("before", "word", "toxic", "ordinary"), F.col("before")).join(low, "word")
    weight = weight_of(F.col("toxic_total"), F.col("toxic_kinds")) - weight_of(F.col("ordinary_total"), F.col("ordinary_kinds"))
    told = store(weighed.select("before", "word", "toxic", "ordinary", ratio(F.col("toxic"), F.col("ordinary"), (F.col("p_toxic"), F.col("p_ordinary"))).alias("ratio"), weight.alias("weight")))
    kept = frequent(told, most)
    history = _longs(kept.groupBy("before").agg(F.first("weight").alias("weight")).toArrow(), "before", "weight")
    before, word, value = _longs(kept.select("before", "word", "ratio").toArrow(), "before", "word", "ratio")
    alone = _longs(frequent(single, most).select("word", (F.log("p_toxic") - F.log("p_ordinary")).alias("ratio")).toArrow(), "word", "ratio")
    left = [np.log(DISCOUNT * all_[f"{c}_kinds"] / all_[f"{c}_total"]) if all_[f"{c}_total"] else 0.0 for c in ("toxic", "ordinary")]
    return Words(pair_key(before, word), value, *history, *alone, float(left[0] - left[1]))


def with_score(docs: DataFrame, toxicity: Toxicity, column: str = "score") -> DataFrame:
    """`docs` with the score of `text` (null: an empty text) as `column`, which replaces one of that name; all other columns stay."""
    small_batches(docs.sparkSession)
    docs = docs.drop(column)
    sent = docs.sparkSession.sparkContext.broadcast(toxicity)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sent.value.score(b.column(b.schema.get_field_index("text"))), pa.float64())], names=[*b.schema.names, column])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def report(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Empty and null texts have the score of no evidence. Repeated rows have equal scores. A null doc_id isn't held out
    and isn't learned from. Other columns of either table are ignored; no documents give no rows.
    """
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels, **how))
    return scored.select("doc_id", in_fold("doc_id", FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
