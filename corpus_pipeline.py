"""Documents to a training corpus: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.batches import bounded_batches
from newsloom.llm.decontaminate import without_leaks
from newsloom.llm.lines import without_repeated_lines
from newsloom.llm.mixing import mix
from newsloom.llm.quality import keep_good
from newsloom.llm.shingle_sets import keep_first_similar
from newsloom.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the host-level quality rules keep."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document or line has; those with no line left go.

    Every line with a word counts: short ones are compared as they are, long ones also with near copies. n_chars follows the text.
    """
    bounded_batches(spark)
    cut = without_repeated_lines(docs, exact_words=1)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id.

    Near are texts whose five-word shingles have a Jaccard similarity of 0.8 or more. Texts within three SimHash bits are
    found by the vantage-point tree; such pairs may be some 10 bits apart, with a tail that no radius cuts off
    cheaply, so an exact set join finds the others. All links are verified.
    """
    bounded_batches(spark)
    return keep_first_similar(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of `benchmark`."""
    bounded_batches(spark)
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fill the token budgets of domain, language and source, one row per epoch of use."""
    return mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]
#: Similar texts, windows against items and connected groups have no SQL form; tests/llm holds brute-force forms.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
