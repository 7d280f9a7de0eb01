"""Entries joined with the text of their pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.page_text import with_page_text
from newsloom.functions.text import FULL_TEXT_CHARS, choose_text
from newsloom.functions.urls import in_domains


def page_scan(entries: DataFrame, pages: DataFrame) -> DataFrame:
    """Entries with the landed page of their URL; NULL where none has landed."""
    return entries.join(pages.select("url", "html"), "url", "left")


def enrich(entries: DataFrame, pages: DataFrame, extracted: DataFrame | None = None) -> DataFrame:
    """Entries with full_text, author and published_at.

    `pages`: `(url, html)`, one row per URL. `extracted` optionally holds what another extractor
    made of a page: `(url, text, author, published_at)`; it is not used for sites that need
    rendering, and its text only when at least 200 characters long or longer than ours. Author and
    date of the feed win over it. Only pages that an entry asks for are read for their text, once each.
    """
    wanted = pages.select("url", "html").join(entries.select("url").distinct(), "url", "left_semi")
    text = with_page_text(wanted, "html", "_page").drop("html")
    joined = entries.join(text, "url", "left")
    if extracted is None:
        joined = joined.withColumns({
            "_first": F.lit(""), "_author": F.lit(None).cast("string"), "_date": F.lit(None).cast("timestamp"),
        })
    else:
        usable = extracted.where(~in_domains(F.col("url"))).select(
            "url", F.col("text").alias("_first"), F.col("author").alias("_author"),
            F.col("published_at").alias("_date"),
        )
        joined = joined.join(usable, "url", "left")
    full_text = F.substring(choose_text(F.col("_first"), F.col("_page")), 1, FULL_TEXT_CHARS)
    return joined.withColumns({
        "full_text": F.nullif(full_text, F.lit("")),
        "author": F.coalesce(F.nullif("author", F.lit("")), F.nullif("_author", F.lit("")), "author"),
        "published_at": F.coalesce("published", "_date"),
    }).drop("published", "_first", "_page", "_author", "_date")
