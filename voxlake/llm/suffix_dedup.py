"""Repeated passages by a sparse suffix array.

1. Of each `WORDS - K + 1` consecutive K-grams of a text the smallest hash is an anchor: a passage of `WORDS` words that two texts
   share has an anchor at the same place of it in both. Texts of the same words are one class, of which one stands for all.
2. Anchors whose K-gram only one class has lead nowhere and go. A class's other anchors are suffixes: the words from the
   anchor on, and those before it backwards, as far as a passage around the anchor can reach.
   Equal suffixes of one class, as a word that is repeated over and over makes them, are one with several places.
3. The suffixes are sorted over the whole corpus, by (gram, right, left), in ranges of equal size: one that a third of all texts
   have falls into as many ranges as it needs. Each is compared with its next neighbours, and with the next of another class on either
   side however many of its own come first (up to `OVERLAP`), and the match extended right and left; from `WORDS` words on it is a repeat. Neighbours over a range's edge are compared apart. A second order, (gram, left, right),
   finds the neighbours of suffixes that agree more to the left.
4. Where many passages overlap in part, the neighbours of either order may share less than others do. So windows of `WORDS` words around the
   anchors are counted by hash, and those that another class has and no match covers are repeats too. The first and the last window of a match are
   looked up in the same way: suffixes have 24 bits of a word's hash, and a match that runs one word too far by chance is cut.
5. Matches are merged by class, then told for each of its documents; texts of a class with several documents repeat whole.

What is shuffled: 16 bytes an anchor; twice the texts with surviving anchors; the surviving suffixes; 24 bytes a window around one. Nothing meets in pairs but
sorted neighbours, so a large group costs as its size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, store
from .kernels import BASE, gram_hashes, minimisers, mix, sliding
from .winnow import merged, words_of

WORDS, K = 50, 8
#: Sorted neighbours that a suffix is compared with on each side.
NEIGHBOURS = 3
#: Suffixes that are compared at once, and those of them that come again with the next ones.
AT_ONCE, OVERLAP = 4096, 512
#: Suffixes that the driver sees of each range to choose the ranges, instead of 100.
SAMPLED = 20
#: Bytes of a word's hash in a suffix.
WIDE = 3

SUFFIX = "gram long, sright binary, sleft binary, class long, pos array<int>"


def class_of(words: np.ndarray) -> int:
    """A hash of the whole word sequence."""
    powers = np.multiply.accumulate(np.full(len(words), BASE)) if len(words) else words
    return int(mix(np.array([(words * powers).sum(dtype=np.uint64) + np.uint64(len(words))], np.uint64)).view(np.int64)[0])


def _anchors(words: np.ndarray, size: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors and their grams; none in a text of fewer than `size` words."""
    if len(words) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = gram_hashes(words, k)
    at = minimisers(grams, size - k + 1)
    return at, grams[at].view(np.int64)


def _windows(words: np.ndarray, grams: np.ndarray, spans: list, size: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and hashes of the windows of `size` words whose anchor is in `grams`, whether none of the spans covers them, and whether one begins or ends with them."""
    own, low = gram_hashes(words, k), np.uint64((1 << 20) - 1)
    keys = (own & ~low) | (low - (np.arange(len(own), dtype=np.uint64) & low))
    at, g = _anchors(words, size, k)
    start = np.flatnonzero(np.isin(sliding(keys, size - k + 1, np.minimum), keys[at[np.isin(g, grams)]]))
    begin, end = (np.array([-1, *(x[c] for x in spans)], np.int64) for c in "se")
    edge = np.isin(start, begin) | np.isin(start + size, end)
    return start, gram_hashes(words, size)[start].view(np.int64), end[np.searchsorted(begin, start, side="right") - 1] < start + size, edge


def _confirmed(spans: list, sure: list, size: int) -> list[tuple[int, int]]:
    """The spans without a word at an end whose window no other text has, and the windows that no span covers."""
    starts = {x["s"] for x in sure}
    out = [(x["s"], x["s"] + size) for x in sure if x["open"]]
    for x in spans:
        s, e = x["s"] + (x["s"] not in starts), x["e"] - (x["e"] - size not in starts)
        if e - s >= size:
            out.append((s, e))
    return out


def _spans(ranges: list[list[tuple[int, int]]]) -> pa.ListArray:
    """A list of merged (s, e) for each list of ranges."""
    flat = [merged(x) for x in ranges]
    at = np.cumsum([0, *(len(x) // 2 for x in flat)])
    both = np.array([v for x in flat for v in x], np.int32).reshape(-1, 2)
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays([pa.array(both[:, c].copy()) for c in (0, 1)], names=["s", "e"]))


def _packed(words: np.ndarray) -> bytes:
    return words.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :WIDE].tobytes()


class _Rows:
    """Suffixes in sorted order: fixed-width words to the right and left, with how many are real."""

    def __init__(self, gram, right, left, cls, pos, size: int, k: int):
        self.gram, self.cls, self.pos, n = gram, cls, pos, len(gram)
        self.sides = []
        for cells, width in ((right, size), (left, size - k)):
            length = np.array([len(x) // WIDE for x in cells], np.int64)
            flat = np.frombuffer(b"".join(x.ljust(width * WIDE, b"\0") for x in cells), np.uint8).reshape(n, width, WIDE)
            self.sides.append((flat, length))

    def common(self, i: np.ndarray, j: np.ndarray, side: int) -> np.ndarray:
        """Equal words of rows i and j."""
        flat, length = self.sides[side]
        if not flat.shape[1]:
            return np.zeros(len(i), np.int64)
        differ = (flat[i] != flat[j]).any(2)
        first = np.where(differ.any(1), differ.argmax(1), flat.shape[1])
        return np.minimum(first, np.minimum(length[i], length[j]))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Near rows of one gram and two classes: up to NEIGHBOURS apart, and the rows on either side of a run of one class with all of the run."""
        n = len(self.gram)
        every = np.arange(n)
        cut = np.flatnonzero((self.cls[1:] != self.cls[:-1]) | (self.gram[1:] != self.gram[:-1])) + 1
        begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [n]])
        run = np.repeat(np.arange(len(begin)), end - begin)
        one = [every[:-d] for d in range(1, min(NEIGHBOURS, n - 1) + 1)] + [every, every]
        two = [every[d:] for d in range(1, min(NEIGHBOURS, n - 1) + 1)] + [begin[run] - 1, end[run]]
        i, j = np.concatenate(one), np.concatenate(two)
        inside = (j >= 0) & (j < n)
        i, j = i[inside], j[inside]
        good = (self.gram[i] == self.gram[j]) & (self.cls[i] != self.cls[j])
        return i[good], j[good]

    def matches(self, size: int) -> list[list[int]]:
        """class, start, end of what every row shares, `size` words or more, with a near one of another class."""
        n = len(self.gram)
        reach, hit = np.zeros((2, n), np.int64), np.zeros(n, bool)
        if n > 1:
            i, j = self.pairs()
            for k in range(0, len(i), AT_ONCE):
                a, b = i[k : k + AT_ONCE], j[k : k + AT_ONCE]
                right, left = self.common(a, b, 0), self.common(a, b, 1)
                good = right + left >= size
                for row in (a[good], b[good]):
                    hit[row] = True
                    np.maximum.at(reach[0], row, right[good])
                    np.maximum.at(reach[1], row, left[good])
        out: list[list[int]] = [[], [], []]
        for x in np.flatnonzero(hit).tolist():
            flat = merged([(p - int(reach[1, x]), p + int(reach[0, x])) for p in self.pos[x]])
            for s, e in zip(flat[::2], flat[1::2], strict=True):
                for column, value in zip(out, (int(self.cls[x]), s, e), strict=True):
                    column.append(value)
        return out


def _columns(batch, names) -> list:
    pick = {n: batch.column(batch.schema.get_field_index(n)) for n in names}
    return [pick["gram"].to_numpy(), pick["sright"].to_pylist(), pick["sleft"].to_pylist(), pick["class"].to_numpy(), pick["pos"].to_pylist()]


def _join(a: list, b: list) -> list:
    return [[*x, *y] if isinstance(x, list) else np.concatenate([x, y]) for x, y in zip(a, b, strict=True)]


def _part(rows: list, sl: slice) -> list:
    return [x[sl] for x in rows]


def compared(suffixes: DataFrame, order: list[str], size: int, k: int) -> DataFrame:
    """(class, s, e) of matches between near suffixes in the given order over the whole corpus."""
    spark = suffixes.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.execution.rangeExchange.sampleSizePerPartition", str(SAMPLED))
    names = ["gram", "sright", "sleft", "class", "pos"]
    schema = "class long, s int, e int, part int, nth int, gram long, sright binary, sleft binary, pos array<int>"

    def out(cls, s, e):
        m = len(cls)
        void = [pa.nulls(m, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(s, pa.int32()), pa.array(e, pa.int32()), *void], names=["class", "s", "e", "part", "nth", "gram", "sright", "sleft", "pos"])

    def run(batches):
        from pyspark import TaskContext

        part, held, head = TaskContext.get().partitionId(), None, None
        for b in batches:
            if not b.num_rows:
                continue
            rows = _columns(b, names)
            if head is None or len(head[0]) < NEIGHBOURS:
                head = _part(rows if head is None else _join(head, rows), slice(0, NEIGHBOURS))
            held = rows if held is None else _join(held, rows)
            while len(held[0]) >= AT_ONCE + OVERLAP:
                yield out(*_Rows(*_part(held, slice(0, AT_ONCE + OVERLAP)), size, k).matches(size))
                held = _part(held, slice(AT_ONCE, None))
        if held is not None:
            yield out(*_Rows(*held, size, k).matches(size))
            carry = _part(held, slice(max(0, len(held[0]) - NEIGHBOURS), None))
        if head is not None:
            edge = _join(head, carry)
            m, nth = len(edge[0]), [*range(len(head[0])), *range(1 << 20, (1 << 20) + len(carry[0]))]
            void = pa.nulls(m, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(edge[3], pa.int64()), void, void, pa.array([part] * m, pa.int32()), pa.array(nth, pa.int32()), pa.array(edge[0], pa.int64()), pa.array(edge[1], pa.binary()), pa.array(edge[2], pa.binary()), pa.array(edge[4], pa.list_(pa.int32()))],
                names=["class", "s", "e", "part", "nth", "gram", "sright", "sleft", "pos"],
            )

    sorted_ = suffixes.repartitionByRange(n, *order, "class").sortWithinPartitions(*order, "class").select(*names)
    told = store(sorted_.mapInArrow(run, schema))
    edges = told.where("part is not null").orderBy("part", "nth").toArrow()  # a few rows for each range
    found = told.where("part is null").select("class", "s", "e")
    if len(edges) > 1:
        rows = _columns(edges.combine_chunks().to_batches()[0], names)
        cls, s, e = _Rows(*rows, size, k).matches(size)
        more = spark.createDataFrame(list(zip(cls, s, e, strict=True)), "class long, s int, e int")
        found = found.unionByName(more)
    return found


def repeats(docs: DataFrame, *, words: int = WORDS, k: int = K) -> DataFrame:
    """One row for each document with repeated passages: doc_id, class (smallest doc_id of the same words), n_words, n_repeated, spans.

    spans are merged ranges of words (struct s, e) that the text shares, `words` or more at a time, with a text of another
    doc_id. Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. Null, empty and shorter texts, and
    texts that repeat only within themselves, have no row. Rows of one doc_id and equal text are one. Words that only rows
    without a doc_id have are not searched; where others have them too, such rows count as one more document. Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def anchors(batches):
        for b in batches:
            ids, cls, size, grams, owner = [], [], [], [], []
            for i, w in zip(b.column(0).to_pylist(), words_of(b.column(1)), strict=True):
                c = class_of(w)
                at, g = _anchors(w, words, k)
                g = np.unique(g)
                ids.append(i), cls.append(c), size.append(len(w)), grams.append(g), owner.append(np.full(len(g), c, np.int64))
            m, rest = len(ids), np.concatenate([np.zeros(0, np.int64), *grams])
            void = lambda n: pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.array(ids, pa.int64()), void(len(rest))]), pa.array(np.concatenate([np.array(cls, np.int64), *owner])), pa.concat_arrays([pa.array(size, pa.int64()), void(len(rest))]), pa.concat_arrays([void(m), pa.array(rest)])],
                names=["doc_id", "class", "n_words", "gram"],
            )

    seen = store(docs.mapInArrow(anchors, "doc_id long, class long, n_words long, gram long"))
    members = seen.where("gram is null").select("doc_id", "class", "n_words").distinct()
    classes = store(members.where(F.col("n_words") >= words).groupBy("class").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"), F.first("n_words").alias("n_words")))
    shared = seen.where("gram is not null").groupBy("gram").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a != b").select("gram")
    mine = seen.where("gram is not null").select("gram", "class").join(shared, "gram").distinct().groupBy("class").agg(F.collect_list("gram").alias("grams"))
    asked = store(mine.join(classes, "class").where("least is not null").select("class", "least", "grams"))

    def suffixes(batches):
        for b in batches:
            rows = [[], [], [], [], []]
            for w, c, grams in zip(words_of(b.column(0)), b.column(1).to_pylist(), b.column(2), strict=True):
                if class_of(w) != c:
                    continue
                at, g = _anchors(w, words, k)
                keep = np.isin(g, grams.values.to_numpy())
                places: dict[tuple, list[int]] = {}
                for p, gram in zip(at[keep].tolist(), g[keep].tolist(), strict=True):
                    places.setdefault((gram, _packed(w[p : p + words]), _packed(w[max(0, p - words + k) : p][::-1])), []).append(p)
                for suffix, found in places.items():
                    for row, x in zip(rows, (*suffix, c, found), strict=True):
                        row.append(x)
                if len(rows[0]) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, TYPES, strict=True)], names=["gram", "sright", "sleft", "class", "pos"])
                    rows = [[], [], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, TYPES, strict=True)], names=["gram", "sright", "sleft", "class", "pos"])

    texts = docs.join(asked.hint("shuffle_hash"), docs["doc_id"] == asked["least"]).select("text", "class", "grams")
    suffix = store(texts.mapInArrow(suffixes, SUFFIX))
    found = compared(suffix, ["gram", "sright", "sleft"], words, k).unionByName(compared(suffix, ["gram", "sleft", "sright"], words, k))

    def merge(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _spans([[(x["s"], x["e"]) for x in row] for row in b.column(1).to_pylist()])], names=["class", "spans"])

    shape = "class long, spans array<struct<s:int,e:int>>"
    partly = store(found.groupBy("class").agg(F.collect_set(F.struct("s", "e")).alias("collected")).mapInArrow(merge, shape))

    def windows(batches):
        for b in batches:
            rows, n = [], 0
            for w, c, grams, spans in zip(words_of(b.column(0)), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist(), strict=True):
                if class_of(w) != c:
                    continue
                start, key, open_, edge = _windows(w, grams.values.to_numpy(), spans or [], words, k)
                rows.append((key, np.full(len(key), c), start, open_, edge))
                n += len(key)
                if n > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*rows, strict=True)], names=["key", "class", "s", "open", "edge"])
                    rows, n = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*rows, strict=True)], names=["key", "class", "s", "open", "edge"])

    left = asked.join(partly, "class", "left")
    again = docs.join(left.hint("shuffle_hash"), docs["doc_id"] == left["least"]).select("text", "class", "grams", "spans")
    seen_windows = store(again.mapInArrow(windows, "key long, class long, s long, open boolean, edge boolean"))
    told = F.col("open") | F.col("edge")
    both = seen_windows.groupBy("key").agg(F.min("class").alias("a"), F.max("class").alias("b"), F.max(told).alias("some")).where("a != b and some").select("key")
    sure = seen_windows.where(told).join(both, "key").groupBy("class").agg(F.collect_list(F.struct("s", "open")).alias("sure"))

    def confirm(batches):
        for b in batches:
            ranges = [_confirmed(spans or [], sure, words) for spans, sure in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), _spans(ranges)], names=["class", "spans"])

    # A class without a sure window has no repeat.
    partly = sure.join(partly, "class", "left").select("class", "spans", "sure").mapInArrow(confirm, shape).where(F.size("spans") > 0)
    whole = F.array(F.struct(F.lit(0).alias("s"), F.col("n_words").cast("int").alias("e")))
    spans = classes.join(partly, "class", "left").select("class", "least", F.when(F.col("n") > 1, whole).otherwise(F.col("spans")).alias("spans")).where("spans is not null")
    spans = store(spans)
    rows = members.join(spans, "class").select("doc_id", F.col("least").alias("class"), "n_words", "spans")
    n = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + (x["e"] - x["s"]).cast("long"))
    return rows.select("doc_id", "class", "n_words", n.alias("n_repeated"), "spans")


TYPES = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.int32()))


def report(docs: DataFrame, **how) -> DataFrame:
    """doc_id, class_id, n_words, n_repeated and spans as start:end, ..., of documents with repeated passages."""
    text = F.concat_ws(",", F.transform("spans", lambda x: F.concat_ws(":", x["s"].cast("string"), x["e"].cast("string"))))
    return repeats(docs, **how).select("doc_id", F.col("class").alias("class_id"), "n_words", "n_repeated", text.alias("spans"))
