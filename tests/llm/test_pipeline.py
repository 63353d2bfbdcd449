"""The pipeline's stages, each on what its predecessor kept."""

import os
import random
import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
def test_stages(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    schema, kept = [(f.name, f.dataType) for f in docs.schema], {r.doc_id for r in docs.collect()}
    for name, stage in pipeline.STAGES:
        docs = pipeline.store(stage(spark, docs, DATA))
        now = {r.doc_id for r in docs.collect()}
        assert now <= kept and now, name
        if name != pipeline.STAGES[-1][0]:
            assert [(f.name, f.dataType) for f in docs.schema] == schema
        if name == "quality":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
            wrong = sum((i in now) != bool(q) for i, q in labels.items())
            assert wrong <= 0.03 * len(labels)
        if name == "benchmark":
            bench = {w for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect() for w in windows(r.text)}
            assert not any(bench & set(windows(r.text)) for r in docs.collect())
        kept = now
    direct = pipeline.run(spark, DATA)
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, docs.collect()))


def windows(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    return [tuple(ws[i : i + 10]) for i in range(len(ws) - 9)]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
def test_queries_equal_sql(spark):
    import duckdb

    from voxlake.llm import queries

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    for name, sql in queries.ORACLES.items():
        df, told = queries.QUERIES[name](spark, DATA), con.sql(sql)
        cols = sorted(df.columns)
        assert sorted(told.columns) == cols
        assert sorted(map(str, map(tuple, df.select(*cols).collect()))) == sorted(map(str, told.project(", ".join(cols)).fetchall()))


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(None, "no id at all but words", "en", None, None), (901, None, None, None, None), (902, "", "en", "s1", 0), (903, " \n\t", None, "s2", 3), (904, "same row twice here now", "en", "s1", 22), (904, "same row twice here now", "en", "s1", 22), (905, " ".join(f"w{k % 977}" for k in range(30_000)), "en", "s3", 9)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Small tables with all that the stages look for, and a folder to read labels and benchmark from."""
    draw, at = random.Random(17), str(tmp_path_factory.mktemp("tables"))
    words = ["".join(draw.choice("bcdfglmnprst") + draw.choice("aeiou") for _ in range(draw.randint(1, 4))) for _ in range(300)]
    items = [(f"b{k}", " ".join(draw.choices(words, k=14))) for k in range(6)] + [("short", "dunafi lomeri"), ("none", ""), (None, "x y z"), ("null", None)]
    rows, labels = [], []
    for i in range(200):
        text = "\n".join(" ".join(draw.choices(words, k=draw.randint(8, 20))).capitalize() + "." for _ in range(draw.randint(2, 6)))
        if i % 5 == 1:
            text += "\nAll rights reserved by nobody"
        if i % 11 == 2:
            text += "\nand " + items[i % 6][1] + " then"
        if i % 9 == 3:
            text = "\n".join("#### " + "!!! $$$ " * 9 for _ in range(5))
        if i % 10 == 7 and i > 20:
            old = rows[i - 10][1].split(" ")
            old[len(old) // 2] = "changed"
            text = " ".join(old)
        rows.append((i, text, "en", f"s{i % 12}", len(text)))
        labels.append((i, int("####" not in text), 0))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{at}/benchmark.parquet")
    return rows, items, at


def stage(spark, name, rows, at):
    import corpus_pipeline as pipeline

    df = spark.createDataFrame(rows, COLUMNS).withColumns({n: F.lit("clash") for n in ("score", "size", "class", "hits", "n_removed", "n_hit", "bucket")})
    out = dict(pipeline.STAGES)[name](spark, df, at)
    assert out.columns == ([c.split()[0] for c in COLUMNS.split(", ")] if name != "mixture" else ["doc_id", "source", "size", "source_size", "target", "taken"])
    return [tuple(r) for r in out.collect()]


def ordered(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("name", ["quality", "lines", "near_duplicates", "benchmark", "mixture"])
def test_stage_of_nothing(spark, tables, name):
    assert stage(spark, name, [], tables[2]) == []


def test_quality_stage(spark, tables):
    rows, _, at = tables
    kept = stage(spark, "quality", rows + ODD, at)
    assert set(kept) <= set(rows + ODD) and len(set(kept)) <= len(kept)
    gone = {r[0] for r in rows + ODD} - {r[0] for r in kept}
    bad = {i for i, t, *_ in rows if "####" in t}
    assert {901, 902} <= gone and bad <= gone and len(gone - bad - {r[0] for r in ODD}) <= 2 and len(bad) > 15
    assert sum(r[0] == 904 for r in kept) in (0, 2)


def test_line_stage_equals_brute_force(spark, tables):
    from test_llm import lines_plain

    rows = tables[0] + ODD
    want = [(i, t, *r[2:4], len(t) if n else r[4]) for r, (i, t, _, n) in zip(rows, lines_plain(rows, 8), strict=True)]
    got = stage(spark, "lines", rows, tables[2])
    assert ordered(got) == ordered(want) and sum(a != b for a, b in zip(rows, want)) > 30


def test_near_duplicate_stage_equals_brute_force(spark, tables):
    from test_llm import brute_groups, shingles

    rows = tables[0] + ODD
    texts = [t or "" for _, t, *_ in rows]
    root = brute_groups(texts)
    empty = [k for k, t in enumerate(texts) if not shingles(t)]
    groups: dict = {}
    for k, r in enumerate(root):
        groups.setdefault("empty" if k in empty else r, []).append(k)
    gone = set()
    for members in groups.values():
        least = min((rows[k][0] for k in members if rows[k][0] is not None), default=None)
        gone |= {rows[k][0] for k in members if rows[k][0] != least}
    want = [r for r in rows if r[0] not in gone]
    got = stage(spark, "near_duplicates", rows, tables[2])
    assert ordered(got) == ordered(want) and len(want) < len(rows) - 15


def test_benchmark_stage_equals_brute_force(spark, tables):
    from test_llm import hits_plain

    rows, items, at = tables
    odd = [*ODD, (950, "so dunafi lomeri here", None, None, None), (951, "lomeri dunafi", "en", "s", 0)]
    want = [r for r in rows + odd if not hits_plain(r[1], [(i, t) for i, t in items if i is not None])[1]]
    got = stage(spark, "benchmark", rows + odd, at)
    assert ordered(got) == ordered(want) and 950 not in {r[0] for r in got} and len(want) < len(rows + odd) - 10


def test_mixture_stage(spark, tables):
    rows = tables[0] + ODD
    got = stage(spark, "mixture", rows, tables[2])
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    total: dict = {}
    for _, t, _, s, _ in rows:
        total[s] = total.get(s, 0) + size(t)
    order = [*sorted(s for s in total if s is not None), None]
    weight, budget, target, open_ = dict(zip(order, [3, 1, 2] * 9)), 1.5 * sum(total.values()), {}, list(order)
    while over := [s for s in open_ if budget * weight[s] / sum(weight[x] for x in open_) > 2 * total[s]]:
        target |= {s: 2 * total[s] for s in over}
        budget -= sum(2 * total[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    target |= {s: budget * weight[s] / sum(weight[x] for x in open_) for s in open_}
    assert ordered((r[0], r[1], r[2]) for r in got) == ordered((i, s, size(t)) for i, t, _, s, _ in rows)
    for s in total:
        mine = [r for r in got if r[1] == s]
        assert all(r[3] == total[s] and abs(r[4] - target[s]) < 1e-6 and 0 <= r[5] <= 2 * r[2] for r in mine)
        least = min((r[2] for r in mine if r[2] and r[5] < 2 * r[2]), default=0)
        assert 0 <= target[s] - sum(r[5] for r in mine) + 1e-6 and target[s] - sum(r[5] for r in mine) <= max(least, 1) + 1e-6
    assert sum(r[5] for r in stage(spark, "mixture", rows, tables[2])) == sum(r[5] for r in got)
