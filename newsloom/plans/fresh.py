"""Reports on feed entries that are not stored yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.urls import url_key, without_query
from newsloom.operators.joins import without_stored_prefix

ENTRIES_PER_FEED = 8
SHOWN_PER_FEED = 2
COMMANDS = 8


def first_entries(entries: DataFrame, n: int) -> DataFrame:
    """The first `n` entries of every source, in feed order (cut before the shuffle)."""
    order = Window.partitionBy("source_id").orderBy("position", "url")
    return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def fresh_entries(entries: DataFrame, articles: DataFrame, n: int = ENTRIES_PER_FEED) -> DataFrame:
    """Of the first `n` entries per source, those whose URL without its query is not the beginning
    of any stored URL, ignoring case."""
    sample = first_entries(entries, n).withColumn("url", without_query(F.col("url"))).where(
        "url <> '' AND title <> ''"
    )
    keyed = sample.withColumn("_key", url_key(F.col("url")))
    stored = articles.select(url_key(F.col("url")).alias("_key"))
    return without_stored_prefix(keyed, stored, "_key").drop("_key", "rank")


def fresh_report(entries: DataFrame, articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Up to two fresh entries per source, and the first eight of those overall."""
    shown = first_entries(fresh_entries(entries, articles), SHOWN_PER_FEED)
    return shown, shown.orderBy("source_id", "rank").limit(COMMANDS)


def latest_per_feed(entries: DataFrame, n: int = SHOWN_PER_FEED, title_chars: int = 65) -> DataFrame:
    return first_entries(entries, n).select(
        "source_id", "rank", F.left("title", F.lit(title_chars)).alias("title"), "url"
    )
