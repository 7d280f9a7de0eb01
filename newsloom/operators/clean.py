"""Cleaning of collected entries into article rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.barrier import with_computed
from newsloom.functions.text import MIN_TITLE_CHARS, collapsed_word_count, normalise
from newsloom.operators.dedup import unique_urls
from newsloom.operators.language import detect_language
from newsloom.schema import CLEAN_ARTICLES

TEXT_COLUMNS = ("title", "summary", "author", "full_text")


def align(df: DataFrame, schema=CLEAN_ARTICLES) -> DataFrame:
    """The columns of `schema`, in order; absent ones are NULL."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def has_text(full_text: str = "full_text", summary: str = "summary") -> Column:
    return F.col(full_text).isNotNull() | F.col(summary).isNotNull()


def titled(title: str = "title") -> Column:
    return F.coalesce(F.length(title) >= MIN_TITLE_CHARS, F.lit(False))


def normalise_columns(df: DataFrame, columns=TEXT_COLUMNS) -> DataFrame:
    """Text columns with entities decoded and white space collapsed; empty becomes NULL."""
    present = {c: F.col(c) for c in columns if c in df.columns}
    plain = with_computed(df, **present)
    return plain.withColumns({c: normalise(F.col(c)) for c in present})


def clean_articles(entries: DataFrame, profiles: DataFrame, order: list[str]) -> DataFrame:
    """Article rows (plus the order columns) from enriched entries.

    The first row of a URL counts even if it is dropped later: its twins go with it. So URLs are
    settled first, on untouched rows, and only survivors have their text worked on.
    """
    first = unique_urls(entries, order)
    kept = normalise_columns(first).where(has_text() & titled())
    # Held per row: the texts were decoded in Python, which must not happen once per use.
    kept = with_computed(kept, _text=F.coalesce("full_text", "summary")).withColumn("word_count", collapsed_word_count(F.col("_text")))
    spoken = detect_language(kept, profiles, "url", "_text", "language")
    extra = [f for f in kept.schema.fields if f.name in order and f.name not in CLEAN_ARTICLES.fieldNames()]
    return align(spoken.withColumn("is_clean", F.lit(True)), T.StructType(extra + CLEAN_ARTICLES.fields))


def cleaning_counters(entries: DataFrame, order: list[str]) -> DataFrame:
    """rows_in, duplicate_urls, no_text, short_title, rows_out of a cleaning run."""
    first = normalise_columns(unique_urls(entries, order))
    reasons = first.select(
        F.when(~has_text(), "no_text").when(~titled(), "short_title").otherwise("kept").alias("reason")
    )
    total = entries.agg(F.count("*").alias("n")).scalar()
    out = reasons.agg(
        F.count("*").alias("first_rows"), F.count_if(F.col("reason") == "no_text").alias("no_text"),
        F.count_if(F.col("reason") == "short_title").alias("short_title"),
        F.count_if(F.col("reason") == "kept").alias("rows_out"),
    ).withColumn("rows_in", total)
    return out.select(
        "rows_in", (F.col("rows_in") - F.col("first_rows")).alias("duplicate_urls"),
        "no_text", "short_title", "rows_out",
    )
