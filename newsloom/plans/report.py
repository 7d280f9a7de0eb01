"""The analytics report and the ad-hoc queries around it.

Ties in an ordering are broken by a last key, so results are the same every time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REPORT_DAYS = 30
TOP = 10


def _rounded_mean(total: Column, count: Column) -> Column:
    return F.round(total / count).cast("int")


def overall_stats(articles: DataFrame) -> DataFrame:
    return articles.agg(
        F.count("*").alias("total_articles"),
        F.countDistinct("source_id").alias("active_sources"),
        F.count_if("is_clean").alias("clean_articles"),
        F.round(F.avg("word_count")).cast("int").alias("avg_word_count"),
        F.to_date(F.min("published_at")).alias("earliest_article"),
        F.to_date(F.max("published_at")).alias("latest_article"),
        F.max("scraped_at").alias("last_scraped_at"),
    )


def articles_per_source(articles: DataFrame, sources: DataFrame) -> DataFrame:
    """Counts per source name and category; sources without articles show zero.

    Articles are summed per source id before the join, so the join sees one row per source however
    unevenly articles are spread.
    """
    per_id = articles.where("source_id IS NOT NULL").groupBy(F.col("source_id").alias("id")).agg(
        F.count("id").alias("n"), F.sum("word_count").alias("words"), F.count("word_count").alias("counted"),
        F.max("scraped_at").alias("scraped"),
    )
    return (
        sources.select("id", "name", "category").join(per_id, "id", "left")
        .groupBy(F.col("name").alias("source"), "category")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("article_count"),
            _rounded_mean(F.sum("words"), F.nullif(F.sum("counted"), F.lit(0))).alias("avg_words"),
            F.to_date(F.max("scraped")).alias("last_scraped"),
        )
        .orderBy(F.desc("article_count"), "source", "category")
    )


def sources_with_articles(articles: DataFrame, sources: DataFrame) -> DataFrame:
    """Every source with every one of its articles, or with NULL when it has none."""
    mine = articles.where("source_id IS NOT NULL").select("source_id", F.col("id").alias("article_id"))
    return sources.select(F.col("id").alias("source_id"), "name").join(mine, "source_id", "left")


def articles_per_day(articles: DataFrame, days: int | None = REPORT_DAYS) -> DataFrame:
    """Articles per publication day, newest first; the newest `days` days."""
    daily = (
        articles.where("published_at IS NOT NULL").groupBy(F.to_date("published_at").alias("date"))
        .agg(F.count("*").alias("articles")).orderBy(F.desc("date"))
    )
    return daily if days is None else daily.limit(days)


def articles_since(articles: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Articles per day over the last `days` days before `as_of`."""
    recent = articles.where(F.col("published_at") >= as_of - F.make_dt_interval(F.lit(days)))
    return articles_per_day(recent, None)


def top_authors(articles: DataFrame, n: int = TOP) -> DataFrame:
    return (
        articles.where("author IS NOT NULL AND author <> ''").groupBy("author")
        .agg(F.count("*").alias("articles")).orderBy(F.desc("articles"), "author").limit(n)
    )


def language_counts(articles: DataFrame) -> DataFrame:
    return articles.groupBy("language").agg(F.count("*").alias("articles"))


def language_breakdown(articles: DataFrame) -> DataFrame:
    """Counts and percentage per language; the window runs over one row per language."""
    total = F.sum("articles").over(Window.partitionBy())
    share = F.round(F.col("articles") * F.lit(100.0) / total, 1)
    return language_counts(articles).withColumn("pct", share).orderBy(F.desc("articles"), "language")


def run_history(runs: DataFrame, limit: int | None = TOP) -> DataFrame:
    rows = runs.select(
        "id", "started_at", "finished_at", "articles_found", "articles_inserted", "articles_skipped",
        "errors", "status",
    ).orderBy(F.desc("started_at"), F.desc("id"))
    return rows if limit is None else rows.limit(limit)


def report(articles: DataFrame, sources: DataFrame, runs: DataFrame) -> dict[str, DataFrame]:
    """The six sections, by title."""
    return {
        "Overall Stats": overall_stats(articles),
        "Articles per Source": articles_per_source(articles, sources),
        "Articles per Day": articles_per_day(articles),
        "Top Authors": top_authors(articles),
        "Language Breakdown": language_breakdown(articles),
        "Pipeline Run History": run_history(runs),
    }


def articles_of_source(articles: DataFrame, sources: DataFrame, name: str, limit: int = TOP) -> DataFrame:
    """Newest articles of the source with this name."""
    named = sources.where(F.col("name") == name).select(F.col("id").alias("source_id"))
    return (
        articles.join(named, "source_id")
        .select("id", "title", "word_count", "published_at")
        .orderBy(F.desc_nulls_last("published_at"), "id").limit(limit)
    )


def search_titles(articles: DataFrame, text: str, limit: int | None = TOP) -> DataFrame:
    """Articles with `text` in the title, upper and lower case alike."""
    hits = articles.where(F.contains(F.lower("title"), F.lit(text.lower()))).select(
        "id", "title", "url", "published_at"
    )
    return hits if limit is None else hits.orderBy("id").limit(limit)


def latest_scraped(articles: DataFrame, limit: int = TOP) -> DataFrame:
    return articles.select("id", "title", "word_count", "language", "scraped_at").orderBy(
        F.desc("scraped_at"), "id"
    ).limit(limit)


def _has_embedding(articles: DataFrame) -> Column:
    return F.col("has_embedding") if "has_embedding" in articles.columns else F.col("content_embedding").isNotNull()


def last_articles(articles: DataFrame, limit: int = TOP, url_chars: int = 60) -> DataFrame:
    """Newest ids with their duplicate flags."""
    return articles.select(
        "id", "is_duplicate", "duplicate_of_id", "similarity_score",
        _has_embedding(articles).alias("has_embedding"),
        F.left("url", F.lit(url_chars)).alias("url"),
    ).orderBy(F.desc("id")).limit(limit)


def duplicates(articles: DataFrame, url_chars: int = 65) -> DataFrame:
    return articles.where("is_duplicate").select(
        "id", "is_duplicate", "duplicate_of_id", "similarity_score", F.left("url", F.lit(url_chars)).alias("url")
    ).orderBy(F.desc("id"))


def table_counts(articles: DataFrame) -> DataFrame:
    """total, with_embedding, without_embedding, duplicates, in one pass."""
    has = _has_embedding(articles)
    return articles.agg(
        F.count("*").alias("total"), F.count_if(has).alias("with_embedding"),
        F.count_if(~has).alias("without_embedding"), F.count_if("is_duplicate").alias("duplicates"),
    )


def source_counts(sources: DataFrame) -> DataFrame:
    return sources.agg(F.count_if("is_active").alias("active"), F.count("*").alias("total"))
