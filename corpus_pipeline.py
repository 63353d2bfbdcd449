"""The training-corpus pipeline: quality, boilerplate lines, near-duplicates, benchmark leaks, mixture.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the
columns of `documents`, and only these: columns beside them are dropped, whatever their names. The last returns the mixture's plan.

Rows count one by one: repeated rows stay or go together, but for the near-duplicates and the mixture, which say what they do. No documents give no rows, in any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm import line_dedup, mixing, quality_crf, simhash_similar, winnow
from voxlake.llm.common import read, release, store, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Near-duplicates: shingles of five words, and the Jaccard similarity from which texts are one group.
SHINGLE, SIMILARITY = 5, 0.8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field holds for good. The field learns from the labels of `documents`, outside its held-out fold.

    Null and empty texts, and those of line ends alone, score 0 and go; a score of exactly 0.5 stays. A null doc_id isn't learned from, but scored.
    Where labels of one class only are left, texts with lines all stay (good ones) or all go (bad ones); without any, they stay.
    """
    field = quality_crf.fit(docs, read(docs.sparkSession, sf_dir, "labels"))
    return quality_crf.with_score(docs.select(*COLUMNS), field).where("score >= 0.5").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without cross-site boilerplate lines; n_chars follows the text where lines are cut, and stays as it is elsewhere.

    No document goes: null texts stay null, and a text of boilerplate alone becomes empty. A null source is no site, a null doc_id is never the first
    that has a line, and rows of one doc_id are one document.
    """
    cut = line_dedup.dedup(docs.select(*COLUMNS))
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the smallest doc_id.

    Null texts, empty ones and those without words are equal, and one group. Texts of fewer than five words are alike if all their words are. Rows of one doc_id stay or go
    together, equal to one another or not; a null doc_id stays only in a group where no row has an id.
    """
    return simhash_similar.representatives(docs.select(*COLUMNS), shingle=SHINGLE, similarity=SIMILARITY)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item, nor all words of a shorter one.

    Null and empty texts have no words and stay, whatever their id. Items without id, text or words have no windows.
    """
    return winnow.decontaminate(docs.select(*COLUMNS), read(docs.sparkSession, sf_dir, "benchmark")).where("n_hit = 0").select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mixture takes: one row for each row, also for those of which it takes none.

    Null and empty texts have size 0 and are taken 0 times; a null source is a source of its own, after all others. Of equal rows, as many are taken in
    every run, whichever they are.
    """
    return mixing.mix(docs.select(*COLUMNS)).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("mixture", mixture)]

#: The first stage is a learned model, which SQL can't express; the stages are tested against brute-force versions (tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other. What a stage has written besides its result is deleted when the result is."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        since = stored()
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = store(docs)
            release(spark, since, keep=1)
    return docs
