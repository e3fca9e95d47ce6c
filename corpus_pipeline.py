"""Corpus pipeline: quality filter, line dedup, near-dedup, benchmark
decontamination and mixing, each stage written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of `documents`.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, line_dedup, minhash_dedup, mixing, quality
from tidemark.llm.common import discard, saved, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; a null text is scored as
    an empty one, rows that repeat are judged each."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that repeat an earlier line, n_chars brought
    up to date; a document that loses all its lines that hold a word goes."""
    out = line_dedup.keep_first_lines(docs)
    out = out.where("n_dropped = 0 or text rlike '[0-9A-Za-z\\\\x{80}-\\\\x{10ffff}]'")
    chars = F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", chars).select(*docs.columns)


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; null and empty texts are
    in no group and stay, of rows that repeat one stays."""
    return minhash_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none,
    rows that share an id with one that does go with it."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their place in a mixture in which a source weighs
    the square root of its number of documents; a null source is a source, rows
    that repeat have a place each."""
    return mixing.mix(docs)


def _after(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, begun by deleting what earlier stages kept for themselves:
    their results are written by then, and only those are read."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, but=docs)
        return stage(spark, docs, sf_dir)
    return run


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_filter),
    ("line_dedup", _after(line_filter)),
    ("minhash_near_dedup", _after(near_duplicate_filter)),
    ("benchmark_decontamination", _after(decontamination)),
    ("source_mixing", _after(mixture)),
]

# The classifier and the hashed searches have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to `documents`, one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
