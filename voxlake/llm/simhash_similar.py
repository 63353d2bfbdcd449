"""SimHash near-duplicates at a similarity that is too low for blocks of fingerprint bits.

Texts whose five-word shingles have a Jaccard similarity of 0.8 differ in about 12 of 64 SimHash bits, and up to 18; any block of bits
that all such pairs share is a few bits long. So here shards come from the content: each text goes to `BANDS` shards, named by
`ROWS` min-hashes of its shingles, of which two texts of similarity 0.8 share one with probability 0.998. In a shard a BK-tree over
fingerprints (children by integer Hamming distance to their parent, members of a small subtree scanned at once) gives the members within `RADIUS`; a pair of
these of which `LOOSE` of `HASHES` min-hashes agree is a candidate, and the Jaccard similarity of its shingle sets, counted from the texts, decides.

Texts of the same words are one class. Candidates are asked twice:

1. Those that span each shard (blocks of `SHARD` of a larger one), so that members of a group get one root at a cost of its size. Their texts are joined to them.
2. In shards that still have several roots, all that have different ones. The shingle sets of these shards' members come to the task, which
   compares them there and sends the links that join two of its sets, fewer than it has members: pairs that are refused leave no row.
   A shard of over `SHARD` classes is cut into blocks that are compared each with every other, but for blocks of one root.

Texts that share much but aren't similar have no root in common; the comparisons of their shingle sets grow as the square of their number, what is shuffled
as the number of their blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import components
from .common import small_batches, store
from .kernels import LOWER, chunks, gram_hashes, mix, runs, span_hashes, text_bytes, word_ranges
from .mixing import SPACE
from .suffix_dedup import class_of

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS, HASHES = 16, 5, 128
RADIUS, SHARD = 24, 4096
#: Agreements of a candidate: at similarity 0.8 there are 104, with a standard error of 4.4.
LOOSE = 86

_draw = np.random.default_rng(11)
FLIP = _draw.integers(0, 1 << 63, HASHES, dtype=np.uint64)
TIMES = _draw.integers(0, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
#: Members of a subtree that are scanned at once.
LEAF = 64
#: Ids that are looked up by broadcast, at most: some 50 bytes each in an executor.
BROADCAST_IDS = 1 << 20
#: Shingles for which a text counts as one more member of its shard, so that a block's sets stay within some 64 MB.
HEAVY = 2048
#: Equal halves of two bytes, by the bytes' exclusive or.
HALVES = np.array([(x < 16) + (x % 16 == 0) for x in range(256)], np.int16)


def sketches(column: pa.Array, shingle: int = SHINGLE) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Class, number of shingles, fingerprint, signature (HASHES x 4 bits) and band keys of each text."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    cls, some, fps = [], np.zeros(n, np.int64), np.zeros(n, np.uint64)
    sign, keys = np.zeros((n, HASHES // 2), np.uint8), np.zeros((n, BANDS), np.uint64)
    for i, j in chunks(offsets):
        part, at = LOWER[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]
        starts, ends = runs(~SPACE[part], at)
        hashes, bounds = span_hashes(part, starts, ends), word_ranges(starts, at)
        own = [hashes[bounds[t] : bounds[t + 1]] for t in range(j - i)]
        cls += [class_of(w) for w in own]
        full = [t for t in range(j - i) if len(own[t])]
        if not full:
            continue
        grams = [gram_hashes(own[t], min(shingle, len(own[t]))) for t in full]
        flat, begin = np.concatenate(grams), np.cumsum([0, *map(len, grams)])[:-1]
        rows = np.array(full) + i
        some[rows] = [len(g) for g in grams]
        for t, g in zip(rows, grams, strict=True):
            fps[t] = _majority(g)
        least = np.stack([np.minimum.reduceat((flat ^ f) * m, begin) for f, m in zip(FLIP, TIMES, strict=True)], axis=1)
        four = ((least >> np.uint64(9)) & np.uint64(15)).astype(np.uint8)
        sign[rows] = four[:, ::2] << 4 | four[:, 1::2]
        for b in range(BANDS):
            key = np.full(len(rows), b + 1, np.uint64)
            for r in range(ROWS):
                key = mix(key ^ least[:, b * ROWS + r])
            keys[rows, b] = key
    return cls, some, fps, sign, keys


def _majority(grams: np.ndarray, step: int = 1 << 14) -> np.uint64:
    counts = np.zeros(64, np.int64)
    for s in range(0, len(grams), step):
        counts += np.unpackbits(grams[s : s + step].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return np.packbits(counts * 2 > len(grams)).view(">u8")[0].astype(np.uint64)


class BKTree:
    """A node has a parent fingerprint and a subtree for each Hamming distance to it; a subtree of at most LEAF members, or of equal fingerprints, is a leaf."""

    def __init__(self, fps: np.ndarray, members: np.ndarray | None = None, equal: bool = False):
        self.members = np.arange(len(fps)) if members is None else members
        self.fps, self.children = fps[self.members], {}
        if equal or len(self.members) <= LEAF:
            return
        self.parent = self.fps[0]
        edge = np.bitwise_count(self.fps ^ self.parent)
        self.children = {int(d): BKTree(fps, self.members[edge == d], d == 0) for d in np.unique(edge)}

    def within(self, fp: np.uint64, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Members at most `radius` bits from fp, and their distances. By the triangle inequality they are under the edges followed."""
        found, todo = [], [self]
        while todo:
            node = todo.pop()
            if node.children:
                d = int(np.bitwise_count(fp ^ node.parent))
                todo += [c for k, c in node.children.items() if d - radius <= k <= d + radius]
            else:
                away = np.bitwise_count(node.fps ^ fp).astype(np.int16)
                good = away <= radius
                found.append((node.members[good], away[good]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int16))


def alike(x: np.ndarray, others: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which of the shingle sets (sorted, distinct) have the Jaccard similarity to x."""
    size = np.array([len(y) for y in others])
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(x, flat), len(x) - 1)
    both = np.add.reduceat((x[at] == flat).astype(np.int64), np.cumsum(size) - size)
    return both >= similarity * (len(x) + size - both) - 1e-9


def shard_links(cls: np.ndarray, fps: np.ndarray, sign: np.ndarray, radius: int) -> np.ndarray:
    """Pairs of a shard that may be similar and span every set of such ones."""
    tree, sets, out = BKTree(fps), np.arange(len(cls)), [np.zeros((0, 2), np.int64)]
    for x in range(1, len(cls)):
        near, away = tree.within(fps[x], radius)
        near, away = near[near < x], away[near < x]
        near = near[np.argsort(away, kind="stable")]
        while len(near := near[sets[near] != sets[x]]):
            block = near[:256]
            agree = HALVES[sign[block] ^ sign[x]].sum(1)
            best = block[agree.argmax()]
            if agree.max() >= LOOSE:
                out.append(np.array([[cls[x], cls[best]]]))
                sets[sets == sets[best]] = sets[x]
            else:
                near = near[256:]
    return np.concatenate(out)


def exact_links(cls: np.ndarray, fps: np.ndarray, sign: np.ndarray, roots: np.ndarray, side: np.ndarray, shingles: list[np.ndarray], radius: int, similarity: float) -> np.ndarray:
    """Similar pairs of a shard that join its roots: every pair of different roots is asked, unless links join it already.

    Members of one side aren't asked among themselves, but for side -1.
    """
    tree, size, out = BKTree(fps), np.array([len(x) for x in shingles]), [np.zeros((0, 2), np.int64)]
    sets = np.unique(roots, return_inverse=True)[1]
    for x in range(1, len(cls)):
        near, _ = tree.within(fps[x], radius)
        near = near[near < x]
        near = near[(sets[near] != sets[x]) & ((side[near] != side[x]) | (side[x] < 0))]
        near = near[np.minimum(size[near], size[x]) >= similarity * np.maximum(size[near], size[x]) - 1e-9]
        agree = HALVES[sign[near] ^ sign[x]].sum(1) if len(near) else np.zeros(0, np.int64)
        near = near[agree >= LOOSE][np.argsort(-agree[agree >= LOOSE], kind="stable")]
        while len(near := near[sets[near] != sets[x]]):
            block, near = near[:64], near[64:]
            for y in block[alike(shingles[x], [shingles[y] for y in block], similarity)]:
                if sets[y] != sets[x]:
                    out.append(np.array([[cls[x], cls[y]]]))
                    sets[sets == sets[y]] = sets[x]
    return np.concatenate(out)


def _asked(batches, radius: int, similarity: float | None):
    """Links from rows (key, class, fp, sign[, root, side, shingles]) sorted by key; shards may run over batches, and have about 2 x SHARD members at most."""
    carry = None

    def done(rows):
        key, cut = rows[0], np.flatnonzero(np.diff(rows[0])) + 1
        pairs = [np.zeros((0, 2), np.int64)]
        for s, e in zip([0, *cut], [*cut, len(key)], strict=True):
            kinds, at = np.unique(rows[1][s:e], return_index=True)
            if len(kinds) < 2:
                continue
            at = at + s
            fps, sign = rows[2][at], np.frombuffer(b"".join(rows[3][at]), np.uint8).reshape(len(at), -1)
            if similarity is None:
                pairs.append(shard_links(kinds, fps, sign, radius))
            else:
                pairs.append(exact_links(kinds, fps, sign, rows[4][at], rows[5][at], [np.frombuffer(x, np.uint64) for x in rows[6][at]], radius, similarity))
        flat = np.sort(np.concatenate(pairs), axis=1)
        for i in range(0, max(1, len(flat)), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(flat[i : i + (1 << 16), c].copy()) for c in (0, 1)], names=["u", "v"])

    def cells(c):
        if not pa.types.is_binary(c.type):
            return c.to_numpy()
        out = np.empty(len(c), object)
        out[:] = c.to_pylist()
        return out

    for b in batches:
        if not b.num_rows:
            continue
        rows = [cells(c) for c in b.columns]
        rows[2] = rows[2].view(np.uint64)
        rows = rows if carry is None else [np.concatenate([x, y]) for x, y in zip(carry, rows, strict=True)]
        last = int(np.searchsorted(rows[0], rows[0][-1], side="left")) if rows[0][0] <= rows[0][-1] else 0
        if last:
            yield from done([x[:last] for x in rows])
        carry = [x[last:] for x in rows]
    if carry is not None:
        yield from done(carry)


def _ask(rows: DataFrame, columns: list[str], radius: int, similarity: float | None) -> DataFrame:
    rows = rows.select("key", "class", "fp", "sign", *columns).repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(lambda b: _asked(b, radius, similarity), "u long, v long").distinct()


def _weight() -> Column:
    return F.sum(1 + F.floor(F.col("words") / HEAVY))


def spanning(sketched: DataFrame, *, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Pairs (u, v) of `sketched` (class, fp, sign, bands) that span each shard, or each block of a large one."""
    keyed = sketched.select("class", F.explode("bands").alias("key"))
    sizes = store(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    block = F.when(F.col("n") > shard, F.xxhash64("key", F.pmod(F.xxhash64("key", "class"), F.ceil(F.col("n") / shard)))).otherwise(F.col("key"))
    shared = keyed.join(sizes, "key").select(block.alias("key"), "class")  # few of all bands are shared: their sketches come afterwards
    return _ask(shared.join(sketched.select("class", "fp", "sign"), "class"), [], radius, None)


def remaining(sketched: DataFrame, roots: DataFrame, docs: DataFrame, *, shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Similar pairs (u, v) that join all different roots that similar pairs sharing a band join.

    Shards of one root have none. A large shard is cut into blocks, a root of over `shard` members into blocks of its own, and
    each block is compared with itself and every other, but for blocks of one root.
    """
    rooted = sketched.select("class", "bands", "words").join(roots, sketched["class"] == roots["node"], "left")
    rooted = store(rooted.select("class", "words", F.coalesce("root", "class").alias("root"), "bands"))
    narrow = rooted.select(F.explode("bands").alias("key"), "class", "words", "root")
    sizes = store(narrow.groupBy("key").agg(_weight().alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key", "n"))
    large = store(sizes.where(F.col("n") > shard).select("key"))
    tasks = narrow.join(sizes.where(F.col("n") <= shard), "key", "left_semi").select("key", "class", "root", F.lit(-1).alias("side"))
    if large.take(1):
        big = store(narrow.join(large, "key"))
        of = store(big.groupBy("key", "root").agg(_weight().alias("g")))
        heavy = store(of.where(F.col("g") > shard).select("key", F.col("root").alias("head"), F.ceil(F.col("g") / shard).alias("blocks")))
        light = store(of.where(F.col("g") <= shard).groupBy("key").agg(F.ceil(F.sum("g") / shard).alias("rest")))
        cut = big.join(heavy, (big["key"] == heavy["key"]) & (big["root"] == heavy["head"]), "left").select(big["key"], "class", "root", "head", "blocks").join(light, "key", "left")
        cut = cut.select("key", "class", "root", "head", F.pmod(F.xxhash64("class"), F.coalesce("blocks", "rest")).alias("block"))
        numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).alias("block")
        names = heavy.select("key", "head", numbers("blocks")).unionByName(light.select("key", F.lit(None).cast("long").alias("head"), numbers("rest")))
        names = store(names.withColumn("name", F.xxhash64("key", F.coalesce("head", F.lit(0)), F.col("head").isNull(), "block")).select("key", "head", "name"))
        other = names.select(*[F.col(c).alias(f"{c}2") for c in names.columns])
        met = names.join(other, (names["key"] == other["key2"]) & (names["name"] <= other["name2"])).where("head is null or head2 is null or head != head2")
        met = met.withColumn("task", F.xxhash64("key", "name", "name2"))
        side = lambda c, n: met.where("name < name2").select("key", F.col(c).alias("name"), "task", F.lit(n).alias("side"))
        entries = store(met.where("name = name2").select("key", "name", "task", F.lit(-1).alias("side")).unionByName(side("name", 0)).unionByName(side("name2", 1)))
        cut = cut.withColumn("name", F.xxhash64("key", F.coalesce("head", F.lit(0)), F.col("head").isNull(), "block")).select("key", "name", "class", "root")
        dealt = cut.join(entries, ["key", "name"])
        tasks = tasks.unionByName(dealt.select(F.col("task").alias("key"), "class", "root", "side"))
    tasks = store(tasks)
    asked = tasks.select("class").distinct()
    texts = store(_texts(docs, sketched, asked).mapInArrow(lambda batches: _sets(batches, shingle), "class long, shingles binary"))
    full = sketched.select("class", "fp", "sign").join(texts, "class")
    return _ask(tasks.join(full, "class"), ["root", "side", "shingles"], radius, similarity)


def _sets(batches, shingle: int):
    for b in batches:
        for i in range(0, b.num_rows, 32):
            part = b.slice(i, 32)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x.tobytes() for _, x in _shingled(part.column(1), shingle)], pa.binary())], names=["class", "shingles"])


def _shingled(column: pa.Array, shingle: int) -> list[tuple[int, np.ndarray]]:
    """Class and distinct shingle hashes of each text."""
    data, offsets = text_bytes(column)
    out = []
    for i, j in chunks(offsets):
        part, at = LOWER[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]
        starts, ends = runs(~SPACE[part], at)
        hashes, bounds = span_hashes(part, starts, ends), word_ranges(starts, at)
        own = [hashes[bounds[t] : bounds[t + 1]] for t in range(j - i)]
        out += [(class_of(w), np.unique(gram_hashes(w, min(shingle, len(w))))) for w in own]
    return out


def _small(ids: DataFrame) -> DataFrame:
    """A stored table of ids, to broadcast if it has at most BROADCAST_IDS rows; else it meets whole texts in a shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("shuffle_hash")


def _texts(docs: DataFrame, classes: DataFrame, asked: DataFrame) -> DataFrame:
    """(class, text) of each class in `asked`, from the document of its smallest doc_id."""
    ids = store(classes.select("class", "least").join(asked, "class", "left_semi").select("least").distinct())
    texts = docs.select("doc_id", "text").join(_small(ids), docs["doc_id"].eqNullSafe(ids["least"]), "left_semi").select("text")

    def told(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in _shingled(b.column(0), 1)], pa.int64()), b.column(0)], names=["class", "text"])

    return texts.mapInArrow(told, "class long, text string").join(asked, "class", "left_semi").dropDuplicates(["class"])


def similar(pairs: DataFrame, docs: DataFrame, classes: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (u, v) of classes whose shingle sets have the Jaccard similarity, which is counted from the texts in `docs`."""
    asked = pairs.select(F.col("u").alias("class")).unionByName(pairs.select(F.col("v").alias("class"))).distinct()
    texts = store(_texts(docs, classes, asked))

    def run(batches):
        for b in batches:
            good = []
            for (_, x), (_, y) in zip(_shingled(b.column(2), shingle), _shingled(b.column(3), shingle), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(good)), b.column(1).filter(pa.array(good))], names=["u", "v"])

    one, two = (texts.select(F.col("class").alias(c), F.col("text").alias(f"text_{c}")) for c in "uv")
    return store(pairs.join(one, "u").join(two, "v").select("u", "v", "text_u", "text_v").mapInArrow(run, "u long, v long"))


def sketch_table(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, class, words (number of shingles), fp, sign, bands) of each document; a null text is an empty one."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")

    def run(batches):
        for b in batches:
            cls, some, fps, sign, keys = sketches(b.column(1), shingle)
            bands = pa.ListArray.from_arrays(pa.array(np.arange(0, len(cls) * BANDS + 1, BANDS), pa.int32()), pa.array(keys.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cls, pa.int64()), pa.array(some), pa.array(fps.view(np.int64)), pa.array([x.tobytes() for x in sign], pa.binary()), bands], names=["doc_id", "class", "words", "fp", "sign", "bands"])

    fields = T._parse_datatype_string("class long, words long, fp long, sign binary, bands array<long>").fields
    return docs.mapInArrow(run, T.StructType([docs.schema["doc_id"], *fields]))


def groups(docs: DataFrame, *, shingle: int = SHINGLE, similarity: float = SIMILARITY, shard: int = SHARD) -> DataFrame:
    """(doc_id, component_id): the smallest doc_id that links of similar texts lead to. Texts without words are one class, similar to no other."""
    seen = store(sketch_table(docs, shingle))
    classes = store(seen.groupBy("class").agg(F.min("doc_id").alias("least"), F.first("words").alias("words"), F.first("fp").alias("fp"), F.first("sign").alias("sign"), F.first("bands").alias("bands")))
    some = classes.where("words > 0")
    links = similar(store(spanning(some, shard=shard)), docs, classes, shingle, similarity)
    roots = store(components(links, at_once=0))
    rest = store(remaining(some, roots, docs, shingle=shingle, similarity=similarity, shard=shard))
    if rest.take(1):
        roots = components(links.unionByName(rest), at_once=0)
    rooted = classes.select("class", "least").join(roots, classes["class"] == roots["node"], "left").select("class", "least", F.coalesce("root", "class").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = store(rooted.join(ids, "root").select("class", "component_id"))
    return seen.select("doc_id", "class").join(of, "class").select("doc_id", "component_id")


def representatives(docs: DataFrame, **how) -> DataFrame:
    """The documents of `docs` whose doc_id is the smallest of their group, whole rows.

    Rows of one doc_id are one document: they stay or go together. A null doc_id stays only if no document of its group has an id.
    """
    told = groups(docs, **how)
    gone = store(told.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct())
    return docs.join(_small(gone), docs["doc_id"].eqNullSafe(gone["doc_id"]), "left_anti")
