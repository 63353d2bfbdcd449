"""Mixing sources to target weights by subset-sum budget fitting.

1. Sizes: words of each document, one narrow pass; only (doc_id, source, size) goes on.
2. Targets: sources by code point (null last) weigh 3, 1, 2, 3, 1, 2, ...; together they get `share` of all
   words, none over `most` times its own. What a source can't take is shared again by weight.
3. A source takes each document as often as its target holds its whole size. For the rest of the budget the
   documents are counted by exact length; every length gives its even share, longest lengths fill up while the
   gap is wide, and a bounded knapsack over bitsets of reachable sums closes the gap, in units of several words first where it is wider than `REACH`.
4. Of each length the asked number of documents is selected in the order of a seeded hash.

Scale: a group of equal lengths, which may hold a third of all rows, is cut by bits of the hash: of its `BUCKETS` cells those before the one in which its
quota runs out are taken whole, those after it not at all, and that one is cut again by the next bits until it has at most `RANKED` rows to rank. So
what is ranked is bounded however large the group, and each level reads a part in `BUCKETS` of the rows before it. Rows of equal id are told apart by a number that the task gives them: they are equal, so
it doesn't matter which of them are taken. Quotas meet the rows by broadcast if there are at most `BROADCAST_QUOTAS`, else salted. A source's plan sees its histogram of lengths (at most sqrt(2 x words) distinct ones), never rows.
The driver holds one number per source.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small_batches, store
from .kernels import chunks, runs, text_bytes, word_ranges

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
SEED = 20

#: Groups of one source and length of over RANKED documents are cut into BUCKETS cells (2 ** BITS), again and again.
RANKED, BITS = 256, 7
BUCKETS = 1 << BITS
#: Quotas that are broadcast, at most, some 100 bytes each, and the parts into which the rows of one are dealt beyond that.
BROADCAST_QUOTAS, SALTS = 1 << 17, 32
NAMES = ["source", "size", "n", "quota", "repeats", "source_size", "target"]

#: Sums up to this are fitted exactly by the knapsack.
REACH = 1 << 16

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def n_words(column: pa.Array) -> np.ndarray:
    """Words ([^\\x20\\x09-\\x0D]+) of each text."""
    data, offsets = text_bytes(column)
    out = [np.zeros(0, np.int64)]
    for i, j in chunks(offsets):
        at = offsets[i : j + 1] - offsets[i]
        out.append(np.diff(word_ranges(runs(~SPACE[data[offsets[i] : offsets[j]]], at)[0], at)))
    return np.concatenate(out)


def with_size(docs: DataFrame, column: str = "size") -> DataFrame:
    """`docs` with the number of words of `text` (0 for null) as `column`, which replaces one of that name."""
    small_batches(docs.sparkSession)
    docs = docs.drop(column)

    def run(batches):
        for b in batches:
            sizes = pa.array(n_words(b.column(b.schema.get_field_index("text"))), pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, sizes], names=[*b.schema.names, column])

    return docs.mapInArrow(run, docs.select("*", F.lit(0).cast("long").alias(column)).schema)


def targets(sizes: dict[str | None, int], share: float = SHARE, most: float = MOST) -> dict[str | None, float]:
    """Each source's target in words.

    Sources in code point order, null last, weigh 3, 1, 2, repeating. A source whose part would pass `most` times
    its size stops there, and the others share the excess by weight, until none is above. Sources without words get 0.
    """
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(order)}
    budget, out, open_ = share * sum(sizes.values()), {}, list(order)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if budget * weight[s] / total >= most * sizes[s]]
        if not over:
            out |= {s: budget * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = most * sizes[s]
        budget -= sum(out[s] for s in over)
        open_ = [s for s in open_ if s not in set(over)]
        budget = max(budget, 0.0)
    return out


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take, so that their words come as near to `budget` from below as found.

    Zero lengths are never taken. Exact whenever the gap that the even shares leave is at most REACH; of a wider one
    no document is left that would still fit.
    """
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    counts = np.where(lengths > 0, counts, 0)
    whole = int((lengths * counts).sum())
    if budget >= whole:
        return counts
    take = np.array([int(c) * int(budget) // whole for c in counts], np.int64) if whole else counts * 0
    order = np.argsort(-lengths, kind="stable")
    best = take
    for reserve in (REACH // 2, 0, None):
        got = _closed(lengths, counts, budget, take if reserve is None else _filled(lengths, counts, budget, take, order, REACH, reserve), order)
        best = max(best, got, key=lambda t: int((t * lengths).sum()))
        if int((best * lengths).sum()) == int(budget):
            break
    return best


def _filled(lengths: np.ndarray, counts: np.ndarray, budget: int, take: np.ndarray, order: np.ndarray, enough: int, reserve: int) -> np.ndarray:
    """`take` with the longest that leave `reserve` words, until the gap is at most `enough`."""
    take, gap = take.copy(), int(budget) - int((take * lengths).sum())
    for i in order:
        if gap <= enough:
            break
        more = min(int(counts[i] - take[i]), (gap - reserve) // max(1, int(lengths[i])))
        if more > 0:
            take[i] += more
            gap -= more * int(lengths[i])
    return take


def _closed(lengths: np.ndarray, counts: np.ndarray, budget: int, take: np.ndarray, order: np.ndarray) -> np.ndarray:
    """`take` with the gap closed by the knapsack: a wide one in units first, lengths rounded up so that no sum is over it."""
    gap = int(budget) - int((take * lengths).sum())
    if gap > REACH:
        unit = -(-gap // REACH)
        take = take + _closest(-(-lengths // unit), counts - take, order, gap // unit)
        take = _filled(lengths, counts, budget, take, order, REACH, 0)
        gap = int(budget) - int((take * lengths).sum())
    return take + _closest(lengths, counts - take, order, min(gap, REACH)) if gap > 0 else take


def _closest(lengths: np.ndarray, counts: np.ndarray, order: np.ndarray, reach: int) -> np.ndarray:
    """How many of each length make the largest sum up to `reach`."""
    take = counts * 0
    free = [(i, k) for i in order if 0 < lengths[i] <= reach for k in powers_of(min(int(counts[i]), reach // int(lengths[i])))]
    full, sums, kept = (1 << (reach + 1)) - 1, 1, []
    for i, k in free:
        kept.append(sums)
        sums |= (sums << (k * int(lengths[i]))) & full
        if sums >> reach & 1:
            break
    at = sums.bit_length() - 1
    for (i, k), before in zip(free[len(kept) - 1 :: -1] if kept else [], kept[::-1], strict=False):
        if not before >> at & 1:
            take[i] += k
            at -= k * int(lengths[i])
    return take


def powers_of(n: int) -> list[int]:
    """Parts 1, 2, 4, ... and a rest, of which every number up to n is a sum."""
    out, k = [], 1
    while n > 0:
        out.append(min(k, n))
        n -= out[-1]
        k *= 2
    return out


def mix(docs: DataFrame, *, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    `taken` is the words the mix takes of the document, repeats counted: its size times 0 up to `most`. A null or empty
    text has size 0 and is taken 0 times; a null source is a source of its own; equal rows may be taken differently,
    but the same number of them in every run. No documents give no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    sized = store(
        with_size(docs.select("doc_id", "source", "text")).select(
            "doc_id", "source", "size",
            F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(seed)).alias("h"), F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)).alias("own"),
        )
    )
    per_length = store(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    totals = {r["source"]: int(r["words"]) for r in per_length.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words")).collect()}
    aim = targets(totals, share, most)
    sent = spark.sparkContext.broadcast({s: (t, float(aim[s]), int(aim[s] // t) if t else 0, int(aim[s] % t) if t else 0) for s, t in totals.items()})

    def fitted(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("size")
        source_size, target, repeats, rest = sent.value[rows.column("source")[0].as_py()]
        sizes, n = rows.column("size").to_numpy(), rows.column("n").to_numpy()
        same = lambda x, kind: pa.array([x] * len(n), kind)
        return pa.table([rows.column("source"), rows.column("size"), rows.column("n"), pa.array(fit(sizes, n, rest)), same(repeats, pa.int64()), same(source_size, pa.int64()), same(target, pa.float64())], names=NAMES)

    quotas = store(per_length.groupBy("source").applyInArrow(fitted, "source string, size long, n long, quota long, repeats long, source_size long, target double"))
    rows = store(met(sized, quotas, ["source", "size"], [n for n in NAMES if n not in ("source", "size")]))
    out = lambda df, extra: df.select("doc_id", "source", "size", "source_size", "target", ((F.col("repeats") + extra) * F.col("size")).alias("taken"))
    result = out(rows.where("quota = 0 or quota = n"), F.when(F.col("quota") > 0, 1).otherwise(0))
    for part, extra in chosen(rows.where("quota > 0 and quota < n")):
        result = result.unionByName(out(part, extra))
    return result


def met(rows: DataFrame, told: DataFrame, on: list[str], names: list[str]) -> DataFrame:
    """`rows` with the named columns of `told`, a stored table with one row for each (source, size), nulls equal."""
    if told.count() <= BROADCAST_QUOTAS:
        told, more = F.broadcast(told), []
    else:
        told, more = told.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("shuffle_merge"), ["salt"]
        rows = rows.withColumn("salt", F.pmod("own", F.lit(SALTS)).cast("int"))
    keep = [c for c in rows.columns if c not in names and c not in more]
    return rows.join(told, [rows[n].eqNullSafe(told[n]) for n in [*on, *more]]).select(*[rows[c] for c in keep], *[told[n] for n in names])


def chosen(rows: DataFrame) -> list[tuple[DataFrame, Column]]:
    """Parts of `rows` (with h, own, n and quota by source and size) and what is added to their repeats: 1 for the `quota` rows of the smallest h in each group."""
    key, parts, shift = ["source", "size"], [], 64 - BITS
    large = rows.where(F.col("n") > RANKED)
    ranked = rows.where(F.col("n") <= RANKED)
    while large.take(1):
        large = large.withColumn("bucket", F.shiftrightunsigned("h", shift).bitwiseAND(F.lit(BUCKETS - 1)))
        cells = large.groupBy(*key, "bucket").agg(F.count("*").alias("m"), F.first("quota").alias("rest"), (F.min("h") == F.max("h")).alias("equal"))
        before = F.coalesce(F.sum("m").over(Window.partitionBy(*key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        cells = cells.withColumn("left", F.col("rest") - before).where("left > 0 and left <= m")  # where the quota runs out: one cell a group
        cells = store(cells.select(*key, F.col("bucket").alias("cross"), "m", "left", "equal"))
        cut = store(met(large, cells, key, ["cross", "m", "left", "equal"]))
        inside = (F.col("bucket") == F.col("cross")) & (F.col("left") < F.col("m"))
        parts.append((cut.where(~inside), F.when(F.col("bucket") <= F.col("cross"), 1).otherwise(0)))
        fresh = F.when(F.col("equal"), F.col("own")).otherwise(F.col("h"))
        again = cut.where(inside).withColumns({"n": F.col("m"), "quota": F.col("left"), "h": fresh}).select(*rows.columns)
        ranked = ranked.unionByName(again.where(F.col("n") <= RANKED))
        large, shift = again.where(F.col("n") > RANKED), max(0, shift - BITS)
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("h", "doc_id", "own"))
    parts.append((ranked.withColumn("rank", rank), F.when(F.col("rank") <= F.col("quota"), 1).otherwise(0)))
    return parts
