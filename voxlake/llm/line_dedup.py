"""Cross-site boilerplate lines by distinct-site spread.

1. Every line's hash with its site, summed in the task and then by (line, site), so that a line that a third of all rows have
   is a few rows a task. Lines of one site end here.
2. A HyperLogLog sketch of the sites of each line, merged by aggregation. An estimate clearly above or below the
   threshold decides; lines near it get an exact distinct count.
3. Boilerplate lines leave all documents but the first that has them (smallest doc_id), where their first occurrence stays, so
   that the corpus keeps one copy of what it repeats.

Step 3 looks lines up in the boilerplate table. If that has at most `BROADCAST_LINES` lines it goes to the tasks and
the documents aren't shuffled; else the texts' lines meet it in a join by hash, and each text is joined with the
list of its own boilerplate lines. Texts are known by hash there, so rows that lack an id, or share one, are no group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free, small_batches, store
from .kernels import chunks, runs, span_hashes, text_bytes, word_ranges

#: Sites that a line has to be on. Twice a sketch's 99.9 % error around it is near.
SITES, SKETCH_BITS, NEAR = 8, 12, 0.12

#: Lines that are looked up by broadcast, at most: 16 bytes each.
BROADCAST_LINES = 1 << 20


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes (without the bytes up to 0x20 around them) of all lines that aren't blank; bounds of each text's lines."""
    starts, ends = runs(data != 0x0A, offsets)
    marks = np.flatnonzero(data > 0x20)
    lo, hi = np.searchsorted(marks, starts), np.searchsorted(marks, ends)
    full = lo < hi
    starts, ends, lo, hi = starts[full], ends[full], lo[full], hi[full]
    return starts, ends, span_hashes(data, marks[lo] if len(lo) else lo, marks[hi - 1] + 1 if len(hi) else hi), word_ranges(starts, offsets)


def sightings(docs: DataFrame) -> DataFrame:
    """(line, site, first): lines by site as each task saw them, with the smallest doc_id."""
    small_batches(docs.sparkSession)
    docs = docs.select("text", F.col("source").cast("string").alias("site"), F.col("doc_id").cast("long").alias("doc_id"))

    def run(batches):
        for b in batches:
            data, offsets = text_bytes(b.column(0))
            kinds = b.column(1).dictionary_encode()
            site = kinds.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            names = [*kinds.dictionary.to_pylist(), None]
            ids = b.column(2).fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
            for i, j in chunks(offsets):
                _, _, hashes, bounds = line_spans(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                each = np.diff(bounds)
                s, d = np.repeat(site[i:j], each), np.repeat(ids[i:j], each)
                order = np.lexsort((d, s, hashes))
                h, s, d = hashes[order], s[order], d[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
                at = np.flatnonzero(new)
                yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array([names[k] for k in s[at]], pa.string()), pa.array(d[at])], names=["line", "site", "first"])

    return docs.mapInArrow(run, "line long, site string, first long")


def spread(docs: DataFrame, *, sites: int = SITES) -> DataFrame:
    """(line, first) of lines on at least `sites` distinct sites; `first` is the smallest doc_id that has them. A null source is no site."""
    by_site = sightings(docs).groupBy("line", "site").agg(F.min("first").alias("first"))
    by_site = store(by_site)
    several = by_site.groupBy("line").agg(F.min("site").alias("a"), F.max("site").alias("b"), F.min("first").alias("first")).where("a != b").select("line", "first")
    sketches = (
        by_site.where("site is not null").join(several.select("line"), "line", "left_semi")
        .groupBy("line").agg(F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sketch"))
        .select("line", F.hll_sketch_estimate("sketch").alias("about"))
    )
    told = store(sketches.join(several, "line").where(F.col("about") >= sites * (1 - NEAR)))
    clear = told.where(F.col("about") > sites * (1 + NEAR)).select("line", "first")
    near = told.where(F.col("about") <= sites * (1 + NEAR)).select("line", "first")
    exact = by_site.join(near, "line", "left_semi").groupBy("line").agg(F.countDistinct("site").alias("n")).where(F.col("n") >= sites)
    return store(clear.unionByName(near.join(exact, "line", "left_semi")))


def _cut(text: bytes, starts: list[int]) -> bytes:
    """The text without the lines that begin at `starts`, and without their line ends."""
    gone, at, kept = set(starts), 0, []
    for line in text.split(b"\n"):
        if at not in gone:
            kept.append(line)
        at += len(line) + 1
    return b"\n".join(kept)


def _without(batch: pa.RecordBatch, names: list[str], lookup) -> tuple[list[pa.Array], list[pa.Array]]:
    """The columns of `batch` with boilerplate lines cut, and n_lines and n_removed; lookup(i) gives sorted hashes and firsts for row i."""
    column = batch.column(names.index("text"))
    data, offsets = text_bytes(column)
    ids = batch.column(names.index("doc_id")).to_pylist()
    texts, n_lines, n_removed = column.to_pylist(), [], []
    for i, j in chunks(offsets):
        at = offsets[i : j + 1] - offsets[i]
        part = data[offsets[i] : offsets[j]]
        starts, _, hashes, bounds = line_spans(part, at)
        hashes = hashes.view(np.int64)
        for t in range(j - i):
            own = hashes[bounds[t] : bounds[t + 1]]
            lines, firsts = lookup(i + t)
            n_lines.append(len(own))
            n_removed.append(0)
            if not len(own) or not len(lines):
                continue
            place = np.minimum(np.searchsorted(lines, own), len(lines) - 1)
            found = lines[place] == own
            if not found.any():
                continue
            if ids[i + t] is not None:
                once = np.zeros(len(own), bool)
                once[np.unique(own, return_index=True)[1]] = True
                found &= ~(once & (firsts[place] == ids[i + t]))
            if found.any():
                n_removed[-1] = int(found.sum())
                text = part[at[t] : at[t + 1]].tobytes()
                texts[i + t] = _cut(text, (starts[bounds[t] : bounds[t + 1]][found] - at[t]).tolist()).decode()
    new = {"text": pa.array(texts, column.type)}
    columns = [new.get(n, c) for n, c in zip(names, batch.columns, strict=True)]
    return columns, [pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())]


def removed(docs: DataFrame, lines: DataFrame, *, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """`docs` without the lines of `lines` (line, first), as `dedup` says, with n_lines and n_removed."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop("n_lines", "n_removed")
    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])
    names = docs.columns
    if lines.count() <= broadcast_lines:
        table = lines.toArrow()
        line, first = (table.column(k).to_numpy() for k in ("line", "first"))
        order = np.argsort(line)
        sent = spark.sparkContext.broadcast((line[order], first[order]))

        def run(batches):
            for b in batches:
                columns, new = _without(b, names, lambda _: sent.value)
                yield pa.RecordBatch.from_arrays([*columns, *new], names=schema.names)

        return docs.mapInArrow(run, schema)

    def seen(batches):
        for b in batches:
            data, offsets = text_bytes(b.column(2))
            for i, j in chunks(offsets):
                _, _, hashes, bounds = line_spans(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                of = pa.array(np.repeat(np.arange(j - i), np.diff(bounds)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i).take(of), b.column(1).slice(i, j - i).take(of), pa.array(hashes.view(np.int64))], names=["key1", "key2", "line"])

    told_name, one, two = (free(names, n) for n in ("marks", "text_key1", "text_key2"))
    keys = {one: F.xxhash64("text"), two: F.hash("text")}
    per_text = docs.select(F.xxhash64("text").alias("key1"), F.hash("text").alias("key2"), "text").mapInArrow(seen, "key1 long, key2 int, line long").distinct()
    marks = per_text.join(lines, "line").groupBy("key1", "key2").agg(F.sort_array(F.collect_list(F.struct("line", "first"))).alias(told_name))
    marks = marks.select(F.col("key1").alias(one), F.col("key2").alias(two), told_name)
    marked = docs.withColumns(keys).join(marks.hint("shuffle_hash"), [one, two], "left").select(*names, told_name)

    def run_marked(batches):
        for b in batches:
            told = [x or [] for x in b.column(len(names)).to_pylist()]
            pick = lambda i: (np.array([x["line"] for x in told[i]], np.int64), np.array([x["first"] for x in told[i]], np.int64))  # noqa: B023, E731
            columns, new = _without(b.select(names), names, pick)
            yield pa.RecordBatch.from_arrays([*columns, *new], names=schema.names)

    return marked.mapInArrow(run_marked, schema)


def dedup(docs: DataFrame, *, sites: int = SITES, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """`docs` with boilerplate lines cut from `text`, and n_lines (lines that aren't blank) and n_removed.

    A line is what stands between line feeds; blanks around it don't count and blank lines always stay. It is boilerplate
    if documents of at least `sites` (2 or more) distinct sources have it; a null source is no site. The document of the smallest doc_id
    that has it keeps its first occurrence; rows of one doc_id are one document, and a null doc_id is never the smallest. Null texts stay null, with no lines;
    texts may become empty, and no row is dropped. All other columns stay; n_lines and n_removed replace columns of these names.
    """
    return removed(docs, spread(docs, sites=sites), broadcast_lines=broadcast_lines)


def report(docs: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, and text_sha256 of what is left (null for a null text)."""
    return dedup(docs.select("doc_id", "text", "source"), **how).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


ORACLE = """
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
line AS (
  SELECT r, doc_id, source, i, l, regexp_replace(regexp_replace(l, '^[\\x00-\\x20]+', ''), '[\\x00-\\x20]+$', '') AS k
  FROM (SELECT r, doc_id, source, unnest(ls) AS l, unnest(range(1, len(ls) + 1)) AS i FROM doc WHERE text IS NOT NULL)),
boiler AS (SELECT k, min(doc_id) AS f FROM line WHERE k <> '' GROUP BY k HAVING count(DISTINCT source) >= 8),
told AS (
  SELECT r, i, l, line.k AS k,
         boiler.k IS NULL OR (doc_id IS NOT DISTINCT FROM f AND row_number() OVER (PARTITION BY r, line.k ORDER BY i) = 1) AS stays
  FROM line LEFT JOIN boiler ON line.k = boiler.k),
per AS (
  SELECT r, count(*) FILTER (WHERE k <> '') AS n, count(*) FILTER (WHERE NOT stays) AS gone, string_agg(l, chr(10) ORDER BY i) FILTER (WHERE stays) AS t
  FROM told GROUP BY r)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_lines, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       CASE WHEN text IS NULL THEN NULL ELSE sha256(coalesce(t, '')) END AS text_sha256
FROM doc LEFT JOIN per USING (r)
"""
