"""SimHash near-duplicates, found with BK-trees.

1. One narrow pass gives each text a 64-bit fingerprint; only (doc_id, fingerprint) goes on, and equal
   fingerprints become one.
2. Fingerprints within `radius` bits agree in one of radius + 1 blocks of bits at least, so each goes to radius + 1
   shards, named by block and value. A shard of over `shard` fingerprints is cut again by blocks of its
   remaining bits, and so on: what has to meet still meets, and as the bits run out a shard is bounded by 2 to
   the power of those left. No shard grows with the corpus, however large a group of near copies is.
3. In each shard a BK-tree (children by integer Hamming distance to their parent) is built and asked in one go;
   a query follows only the edges within the radius. A shard sends the links that join two of its sets,
   fewer than it has members, so a large group doesn't turn into all its pairs.
4. Connected components over the links, then the smallest doc_id of each.

The trees go to the tasks that ask them with the shuffle of the shards. Broadcasting all trees would hold
every fingerprint of the corpus on every executor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import components
from .common import small_batches, store
from .kernels import LOWER, chunks, runs, text_bytes, word_ranges, xxh64
from .mixing import SPACE

SHINGLE, RADIUS, SHARD = 3, 2, 256
#: Shingles that are hashed and counted at once.
STEP = 1 << 18
EACH_BYTE = np.uint64(0x0101010101010101)


def fingerprints(column: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The SimHash of each text's word shingles (A-Z lower-cased, joined by one space; repeats count), as uint64."""
    data, offsets = text_bytes(column)
    out = np.zeros(len(offsets) - 1, np.uint64)
    for i, j in chunks(offsets):
        part, at = LOWER[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]
        word = ~SPACE[part]
        starts, ends = runs(word, at)
        bounds = word_ranges(starts, at)
        keep = word.copy()
        keep[ends[ends < len(part)]] = True  # the byte after a word: a separator, or the next text's first
        part[~word] = 0x20
        place = np.cumsum(keep) - 1
        packed, starts, ends = part[keep], place[starts] if len(starts) else starts, place[ends - 1] + 1 if len(ends) else ends
        words = np.diff(bounds)
        size = np.minimum(shingle, words)
        count = np.where(words > 0, words - size + 1, 0)
        text = np.repeat(np.arange(j - i), count)
        first = bounds[:-1][text] + np.arange(len(text)) - (np.cumsum(count) - count)[text]
        s, e = starts[first], ends[first + size[text] - 1]
        ones = np.zeros((j - i, 64), np.int64)
        for x in range(0, len(text), STEP):  # so that one very long text needs no more memory
            sl = slice(x, x + STEP)
            h, of = xxh64(packed, s[sl], e[sl], 42), text[sl]
            begin = np.flatnonzero((first[sl] - bounds[:-1][of]) % 255 == 0)  # sums of at most 255 fit into a byte
            begin = begin if len(begin) and begin[0] == 0 else np.concatenate([[0], begin])
            for bit in range(8):
                sums = np.add.reduceat((h >> np.uint64(bit)) & EACH_BYTE, begin).view(np.uint8).reshape(-1, 8)
                np.add.at(ones, (of[begin][:, None], 8 * np.arange(8) + bit), sums)
        out[i:j] = np.packbits(ones * 2 > count[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint's 64 bits as a signed long; a null text is an empty one, of fingerprint 0."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fingerprints(b.column(1), shingle).view(np.int64))], names=["doc_id", "fp"])

    return docs.mapInArrow(run, T.StructType([docs.schema["doc_id"], T.StructField("fp", T.LongType())]))


class BKTree:
    """A node is [fingerprint, {Hamming distance: child}]."""

    def __init__(self):
        self.root = None

    def within(self, fp: int, radius: int) -> list[int]:
        """Members at most `radius` bits from fp. By the triangle inequality they are under the edges followed."""
        found, todo = [], [self.root] if self.root else []
        while todo:
            at, children = todo.pop()
            d = (at ^ fp).bit_count()
            if d <= radius:
                found.append(at)
            if children:
                todo += [c for k, c in children.items() if d - radius <= k <= d + radius]
        return found

    def add(self, fp: int) -> None:
        if self.root is None:
            self.root = [fp, {}]
            return
        node = self.root
        while d := (node[0] ^ fp).bit_count():
            if d not in node[1]:
                node[1][d] = [fp, {}]
                return
            node = node[1][d]


def shard_links(fps: list[int], radius: int) -> list[tuple[int, int]]:
    """Links within the radius that span every set of linked members."""
    tree, sets, out = BKTree(), {fp: fp for fp in fps}, []

    def top(x: int) -> int:
        while sets[x] != x:
            sets[x] = x = sets[sets[x]]
        return x

    for fp in fps:
        for other in tree.within(fp, radius):
            a, b = top(fp), top(other)
            if a != b:
                sets[a] = b
                out.append((fp, other))
        tree.add(fp)
    return out


def _blocks(bits: tuple[int, ...], radius: int) -> list[tuple[int, ...]]:
    """The bits dealt into radius + 1 blocks, fewer if there are fewer bits."""
    n = min(radius + 1, len(bits))
    return [bits[i * len(bits) // n : (i + 1) * len(bits) // n] for i in range(n)]


def _asked(batches, radius: int):
    """Links from rows sorted by (shard, value); shards may run over batches."""
    key, members, links = None, [], []
    for b in batches:
        shard, value, fp = (b.column(i).to_numpy() for i in range(3))
        new = np.flatnonzero((np.diff(shard) != 0) | (np.diff(value) != 0)) + 1
        for s, e in zip([0, *new], [*new, len(fp)], strict=True):
            if s == e:
                continue
            if (shard[s], value[s]) != key:
                if len(members) > 1:
                    links += shard_links(members, radius)
                key, members = (shard[s], value[s]), []
            members += fp[s:e].view(np.uint64).tolist()
        if links:
            yield _batch(links)
            links = []
    if len(members) > 1:
        yield _batch(shard_links(members, radius))


def _batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    flat = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(flat[:, 0].copy()), pa.array(flat[:, 1].copy())], names=["u", "v"])


def links(prints: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links (u, v) of at most `radius` bits between the distinct longs `fp` of `prints` that connect all that are within it."""
    paths, rows, level, out = {0: tuple(range(64))}, prints.select("fp", F.lit(0).alias("path"), F.lit(0).cast("long").alias("fixed")), 0, None
    while True:
        deal, following = [], {}
        for path, bits in paths.items():
            for block in _blocks(bits, radius):
                mask = sum(1 << b for b in block)
                mask -= (mask >> 63) << 64
                to = len(following)
                deal.append((path, to, mask))
                following[to] = tuple(b for b in bits if b not in set(block))
        by_path = {p: F.array(*[F.struct(F.lit(t).alias("t"), F.lit(m).cast("long").alias("m")) for q, t, m in deal if q == p]) for p in paths}
        choice = by_path[0]
        for p in [p for p in paths if p]:
            choice = F.when(F.col("path") == p, by_path[p]).otherwise(choice)
        rows = rows.select("fp", "fixed", F.explode(choice).alias("x")).select(
            "fp", F.col("x.t").alias("path"), (F.col("fixed").bitwiseOR(F.col("x.m").bitwiseAND(F.col("fp")))).alias("fixed")
        )
        level += 1
        paths = {p: bits for p, bits in following.items() if bits}
        large = rows.groupBy("path", "fixed").agg(F.count("*").alias("n")).where(F.col("n") > shard).select("path", "fixed")
        large = store(large) if paths else None
        on = ["path", "fixed"]
        more = large is not None and bool(large.take(1))
        asked = rows.join(large, on, "left_anti") if more else rows
        asked = asked.select("path", "fixed", "fp").repartition("path", "fixed").sortWithinPartitions("path", "fixed")
        found = asked.mapInArrow(lambda batches: _asked(batches, radius), "u long, v long")
        out = found if out is None else out.unionByName(found)
        if not more:
            return out
        rows = store(rows.join(large, on, "left_semi").select("fp", "path", "fixed"))


def groups(docs: DataFrame, *, shingle: int = SHINGLE, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """One row per document: doc_id, fp, component_id (the smallest doc_id that links lead to).

    Fingerprints of at most `radius` differing bits link; texts without words have fingerprint 0 and link like any
    others. Repeated rows stay repeated, with equal values. A null doc_id links as others do but is nobody's component_id unless all are null.
    Other columns are ignored; no documents give no rows.
    """
    prints = store(with_fingerprint(docs, shingle))
    reps = store(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(reps, radius, shard), at_once=0)
    rooted = reps.join(roots, reps["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    joined = rooted.where("root != fp").join(ids, "root").select("fp", "component_id")
    own = rooted.where("root = fp").join(ids, "root").select("fp", "component_id")
    of = store(joined.unionByName(own))
    return prints.join(of, "fp").select("doc_id", "fp", "component_id")


def report(docs: DataFrame, **how) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    return groups(docs, **how).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
