"""A corpus pipeline of five stages: from documents to a deduplicated, clean and balanced mix.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns a
DataFrame; it is written as Parquet and read again as the next stage's docs. All but the last return
the columns of documents; the last adds size, target, taken and copies, for the documents it takes.

Cases: an empty table gives an empty result; null texts go in the first stage (no words), null ids
and sources stay; repeated rows are one document after the third stage; other columns are carried,
also such that are named like the operators' own (the last stage replaces size, target, taken and
copies).

Scratch tables of a stage are dropped when the next one begins (its predecessor is written by then)
or run() has written it; run() also drops what is no longer read of the stages' own tables.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, jaccard_join, line_dedup, mixing, quality_rules
from tidemark.llm.common import drop_path, mark, read_table, release, scratch_dir


def _stage(f):
    """A stage that first drops the scratch tables of earlier ones: all but those that its docs still read."""

    @functools.wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        own = _LEFT.setdefault(spark.sparkContext.applicationId, set())
        now = mark(spark)
        if own & now:
            release(spark, now - own, docs)
        own.clear()
        before = mark(spark)
        out = f(spark, docs, sf_dir)
        own.update(mark(spark) - before)
        return out

    return run_stage


#: The scratch tables of the last stage, by application.
_LEFT: dict[str, set[str]] = {}


@_stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


@_stage
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Chunks of lines that repeat an earlier one go; documents of which nothing is left, too."""
    return line_dedup.clean(docs)


@_stage
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard_join.one_of_each(docs)


@_stage
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


@_stage
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix does not take go; the others say how many copies it takes."""
    return mixing.taken_documents(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
]

#: SQL has no form of the quality posterior, the chunk boundaries or the cube method.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = read_table(spark, sf_dir, "documents")
    base = f"{scratch_dir(spark)}/tidemark/pipeline-{uuid.uuid4().hex}"
    there = mark(spark)
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{k}")
        release(spark, there)
        if k:
            drop_path(spark, f"{base}/{k - 1}")
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
