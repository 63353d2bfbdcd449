"""Benchmark decontamination by winnowing.

Every document and every benchmark item is cut into words; of each `span - k + 1` consecutive k-grams
the smallest hash is kept. A run of `span` words that a document shares with an item therefore shares a
kept fingerprint at the same place. Where kept fingerprints meet, the hit is extended to the windows of `span` words around
it, which are told by their hash; a longer match is the union of its windows. So a fingerprint that many items have costs one
look-up, not one comparison for each of them. Items shorter than `span` are one window of their own length.

Scale: a benchmark of at most `block_words` words goes to the tasks as sorted hashes, some 20 bytes a word, and the pass over the documents is narrow. A
larger one stays a table: the documents' fingerprints that pass a bitmap of `FILTER_BITS` bits meet the benchmark's in a join, then the
windows around those that match do. What is broadcast is 2 ** FILTER_BITS bits whatever the benchmark's size, and the
plan has the same number of steps.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free, small_batches, store
from .kernels import LOWER, chunks, gram_hashes, minimisers, runs, span_hashes, text_bytes, word_ranges

K, SPAN = 5, 10
#: Words (two characters each at least) of a benchmark that goes to the tasks whole, at most.
BLOCK_WORDS = 1 << 21
FILTER_BITS = 26

#: Bytes of words: digits, a-z after lower-casing, and all beyond ASCII.
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True


def words_of(column: pa.Array):
    """For each text its word hashes."""
    data, offsets = text_bytes(column)
    for i, j in chunks(offsets):
        part, at = LOWER[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]
        starts, ends = runs(WORD[part], at)
        hashes, bounds = span_hashes(part, starts, ends), word_ranges(starts, at)
        for t in range(j - i):
            yield hashes[bounds[t] : bounds[t + 1]]


def windows_of(words: np.ndarray, span: int) -> tuple[int, np.ndarray]:
    """The length of an item's windows and their hashes."""
    m = min(span, len(words))
    return m, gram_hashes(words, m) if m else np.zeros(0, np.uint64)


def prints_of(words: np.ndarray, k: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the kept k-grams of a text of `span` words or more."""
    if len(words) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = gram_hashes(words, k)
    at = minimisers(grams, span - k + 1)
    return at, grams[at]


def found_in(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values of x are among the sorted keys, and where."""
    if not len(keys):
        return np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return keys[at] == x, at


def around(at: np.ndarray, n: int, k: int, span: int) -> np.ndarray:
    """Starts of the windows that contain a k-gram at one of the places."""
    starts = np.unique(at[:, None] - np.arange(span - k + 1))
    return starts[(starts >= 0) & (starts <= n - span)]


class Block:
    """Fingerprints and windows of a benchmark; windows are known by length."""

    def __init__(self, ids: list[str], texts: list[str], k: int, span: int):
        self.k, self.span, self.ids = k, span, np.array(ids, object)
        prints, by_length = [np.zeros(0, np.uint64)], {}
        for n, words in enumerate(words_of(pa.array(texts, pa.large_string()))):
            prints.append(prints_of(words, k, span)[1])
            m, keys = windows_of(words, span)
            if m:
                keys = np.unique(keys)
                by_length.setdefault(m, []).append((keys, np.full(len(keys), n, np.int32)))
        self.prints, self.windows = np.unique(np.concatenate(prints)), {}
        for m, parts in by_length.items():
            keys, items = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(keys, kind="stable")
            kinds, start = np.unique(keys[order], return_index=True)
            self.windows[m] = kinds, np.append(start, len(keys)), items[order]

    def hits(self, words: np.ndarray) -> tuple[list[int], list[str]]:
        """Word ranges of the document inside occurring windows (start, end, start, end, ...), and the ids of the items concerned."""
        found, items = [], []
        for m, (keys, start, owner) in self.windows.items():
            if len(words) < m:
                continue
            if m == self.span:
                at, prints = prints_of(words, self.k, m)
                starts = around(at[found_in(self.prints, prints)[0]], len(words), self.k, m)
                if not len(starts):
                    continue
            else:
                starts = np.arange(len(words) - m + 1)
            good, place = found_in(keys, gram_hashes(words, m)[starts])
            if good.any():
                found += [(s, s + m) for s in starts[good].tolist()]
                items += [owner[start[x] : start[x + 1]] for x in np.unique(place[good])]
        return merged(found), sorted(set(self.ids[np.unique(np.concatenate(items))])) if items else []


def merged(ranges: list[tuple[int, int]]) -> list[int]:
    """The union of the ranges as a flat list: start, end, start, end, ..."""
    out: list[int] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, k: int = K, span: int = SPAN, block_words: int = BLOCK_WORDS) -> DataFrame:
    """`docs` with n_words, hits (word ranges as start, end, start, end, ...), n_hit and items (sorted item ids).

    A null or empty text has no words and no hits; a benchmark without rows hits nothing, and its rows without id or text have no windows. Rows of the same id
    are told apart: each input row gives one output row. A column of `docs` that has the name of an added one
    is replaced; all others are kept as they are. Equal item ids count once.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop("n_words", "hits", "n_hit", "items")
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where("item is not null and text is not null")
    if (items.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0) > block_words:
        return _joined(docs, items, k, span)
    rows = items.collect()  # at most block_words words
    shared = spark.sparkContext.broadcast(Block([r["item"] for r in rows], [r["text"] for r in rows], k, span))

    def run(batches):
        for batch in batches:
            n_words, hits, ids = [], [], []
            for words in words_of(batch.column(batch.schema.get_field_index("text"))):
                found, more = shared.value.hits(words)
                n_words.append(len(words)), hits.append(found), ids.append(more)
            yield _with_hits(batch, list(batch.schema.names), n_words, hits, ids)

    return docs.mapInArrow(run, _schema(docs))


def _schema(docs: DataFrame) -> T.StructType:
    return T.StructType([*docs.schema.fields, *T._parse_datatype_string("n_words long, hits array<int>, n_hit long, items array<string>").fields])


def _with_hits(batch: pa.RecordBatch, names: list[str], n_words: list, hits: list, items: list) -> pa.RecordBatch:
    new = [pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array([sum(x[1::2]) - sum(x[::2]) for x in hits], pa.int64()), pa.array(items, pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), *new], names=[*names, "n_words", "hits", "n_hit", "items"])


def _bitmap(keys: DataFrame) -> np.ndarray:
    """2 ** FILTER_BITS bits, of which those of the keys' high bits are set."""
    place = F.shiftrightunsigned("key", 64 - FILTER_BITS)
    bits = keys.groupBy(F.shiftrightunsigned(place, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(key, %d) & 63 as int))" % (64 - FILTER_BITS))).alias("bits"))
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    told = bits.toArrow()  # 2 ** (FILTER_BITS - 6) rows at most
    out[told.column("word").to_numpy()] = told.column("bits").to_numpy().view(np.uint64)
    return out


def _joined(docs: DataFrame, items: DataFrame, k: int, span: int) -> DataFrame:
    """As `decontaminate`, by joins."""
    spark, names = docs.sparkSession, docs.columns
    one, two, told = (free(names, n) for n in ("text_key1", "text_key2", "text_found"))
    keys = [F.xxhash64("text").alias("key1"), F.hash("text").alias("key2")]

    def rows(*columns):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["item", "m", "key", "kind"])

    def cut(batches):
        for b in batches:
            for item, words in zip(b.column(0).to_pylist(), words_of(b.column(1)), strict=True):
                m, keys = windows_of(words, span)
                keys = np.unique(keys)
                prints = np.unique(prints_of(words, k, span)[1]) if m == span else keys
                kind = np.repeat([0, 1], [len(keys), len(prints)])
                yield rows(pa.array([item] * len(kind), pa.string()), np.full(len(kind), m), np.concatenate([keys, prints]).view(np.int64), kind)

    bench = store(items.select("item", "text").mapInArrow(cut, "item string, m long, key long, kind long").distinct())
    windows = bench.where("kind = 0").select("item", "m", "key")
    prints = store(bench.where("kind = 1").select("m", "key").distinct())
    lengths = [r["m"] for r in prints.select("m").distinct().collect()]  # span at most
    bits = spark.sparkContext.broadcast(_bitmap(prints))

    def fingerprints(batches):
        for b in batches:
            for a, c, words in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), words_of(b.column(2)), strict=True):
                for m in lengths:
                    at, keys = prints_of(words, k, span) if m == span else (np.arange(max(0, len(words) - m + 1)), gram_hashes(words, m))
                    place = keys >> np.uint64(64 - FILTER_BITS)
                    good = (bits.value[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
                    if good.any():
                        n = int(good.sum())
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(n, a), np.full(n, c, np.int32), np.full(n, m), keys[good].view(np.int64), at[good])], names=["key1", "key2", "m", "key", "at"])

    texts = docs.select(*keys, "text").where("text is not null")
    seen = store(texts.mapInArrow(fingerprints, "key1 long, key2 int, m long, key long, at long").join(prints, ["m", "key"], "left_semi").select("key1", "key2", "m", "at").distinct())
    places = seen.groupBy("key1", "key2").agg(F.collect_list(F.struct("m", "at")).alias("places"))

    def extend(batches):
        for b in batches:
            for a, c, words, places in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), words_of(b.column(2)), b.column(3).to_pylist(), strict=True):
                for m in {x["m"] for x in places}:
                    at = np.array([x["at"] for x in places if x["m"] == m])
                    starts = around(at, len(words), k, span) if m == span else at
                    n = len(starts)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(n, a), np.full(n, c, np.int32), np.full(n, m), gram_hashes(words, m)[starts].view(np.int64), starts)], names=["key1", "key2", "m", "key", "at"])

    hit = texts.join(places, ["key1", "key2"]).dropDuplicates(["key1", "key2"]).select("key1", "key2", "text", "places")
    asked = store(hit.mapInArrow(extend, "key1 long, key2 int, m long, key long, at long"))
    met = store(asked.join(windows.select("m", "key").distinct(), ["m", "key"], "left_semi"))
    ids = met.select("key1", "key2", "m", "key").distinct().join(windows, ["m", "key"]).groupBy("key1", "key2").agg(F.sort_array(F.collect_set("item")).alias("items"))
    where = met.groupBy("key1", "key2").agg(F.collect_list(F.struct("at", "m")).alias("where"))
    result = store(where.join(ids, ["key1", "key2"]).select(F.col("key1").alias(one), F.col("key2").alias(two), F.struct("where", "items").alias(told)))
    keyed = docs.withColumns({one: F.xxhash64("text"), two: F.hash("text")})
    marked = keyed.join(result, [one, two], "left").select(*names, told)

    def tell(batches):
        for b in batches:
            found = b.column(len(names)).to_pylist()
            n_words = [len(w) for w in words_of(b.column(names.index("text")))]
            hits = [merged([(y["at"], y["at"] + y["m"]) for y in x["where"]]) if x else [] for x in found]
            yield _with_hits(b, names, n_words, hits, [x["items"] if x else [] for x in found])

    return marked.mapInArrow(tell, _schema(docs))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated, and the hit ranges as text."""
    return decontaminate(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


#: Windows of 10 consecutive words (or a shorter item whole), as the report counts them.
ORACLE = """
WITH ben AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
win AS (
  SELECT DISTINCT item, least(10, len(w)) AS m, list_slice(w, i, i + least(10, len(w)) - 1) AS g
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM ben WHERE len(w) > 0)),
doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM documents),
grams AS (
  SELECT r, m, i, list_slice(w, i, i + m - 1) AS g
  FROM (SELECT r, w, m, unnest(range(1, CAST(len(w) - m + 2 AS BIGINT))) AS i FROM doc, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
hit AS (SELECT r, i, win.m, item FROM grams JOIN win ON grams.m = win.m AND grams.g = win.g),
cover AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + m)) AS j FROM hit) GROUP BY r),
ids AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(cover.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(ids.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(cover.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN cover USING (r) LEFT JOIN ids USING (r)
"""
