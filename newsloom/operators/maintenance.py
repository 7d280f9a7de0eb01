"""Table maintenance as functions from tables to tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.features import content_text, feature_set
from newsloom.functions.urls import url_key
from newsloom.operators.dedup import UNTITLED, keep_first
from newsloom.operators.ids import assign_ids

DEFAULT_CATEGORY = "General"
DEFAULT_LANGUAGE = "en"


def upsert_sources(sources: DataFrame, seeds: DataFrame, now: Column) -> DataFrame:
    """Seeds update name and category of the source with their URL, or become new sources.

    `seeds`: `(name, url, category)`; of seeds with one URL, ignoring case, the last counts. Ids and
    flags of known sources stay.
    """
    placed = seeds.withColumn("_place", F.monotonically_increasing_id())
    last = placed.groupBy(url_key(F.col("url")).alias("_key")).agg(
        F.max_by(F.struct("name", "url", "category"), "_place").alias("_seed"))
    new = last.select("_seed.*").select(
        url_key(F.col("url")).alias("_key"), F.col("name").alias("_name"), F.col("url").alias("_url"),
        F.col("category").alias("_category"),
    )
    old = sources.withColumn("_key", url_key(F.col("url")))
    known = old.join(new, "_key", "left").select(
        "id", F.coalesce("_name", "name").alias("name"), "url",
        F.coalesce("_category", "category").alias("category"),
        "is_active", "created_at", "last_fetched_at",
    )
    added = new.join(old.select("_key"), "_key", "left_anti").select(
        F.col("_name").alias("name"), F.col("_url").alias("url"), F.col("_category").alias("category")
    )
    return known.unionByName(insert_sources(sources, added, now))


def insert_sources(sources: DataFrame, added: DataFrame, now: Column) -> DataFrame:
    """Rows for new sources `(name, url, category)`: defaults filled, ids after the stored ones.

    Sources whose URL, ignoring case, is stored or comes earlier among the new ones (by URL, then
    name) are left out.
    """
    fresh = keep_first(added, url_key(F.col("url")), ["url", "name", "category"]).withColumn("_key", url_key(F.col("url")))
    added = fresh.join(sources.select(url_key(F.col("url")).alias("_key")), "_key", "left_anti").drop("_key")
    last = sources.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last")).scalar()
    return assign_ids(added, ["url"], last).select(
        F.col("id").cast("int").alias("id"), "name", "url",
        F.coalesce("category", F.lit(DEFAULT_CATEGORY)).alias("category"),
        F.lit(True).alias("is_active"), now.cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("last_fetched_at"),
    )


def find_source(sources: DataFrame, wanted: str) -> DataFrame:
    """Sources with this numeric id, or with this text in their name."""
    if wanted.isdigit():
        return sources.where(F.col("id") == int(wanted))
    return sources.where(F.contains(F.lower("name"), F.lit(wanted.lower())))


def toggle_source(sources: DataFrame, active: bool, source_id: int | None = None,
                  name: str | None = None) -> DataFrame:
    hit = (F.col("id") == source_id) if source_id is not None else (F.col("name") == name)
    return sources.withColumn("is_active", F.when(hit, F.lit(active)).otherwise(F.col("is_active")))


def has_source(sources: DataFrame, source_id: int) -> bool:
    return not sources.where(F.col("id") == source_id).isEmpty()


def delete_source(sources: DataFrame, articles: DataFrame, source_id: int) -> tuple[DataFrame, DataFrame]:
    """Both tables without the source; its articles stay, without a source."""
    kept = sources.where(F.col("id") != source_id)
    return kept, articles.withColumn("source_id", F.nullif("source_id", F.lit(source_id)))


def delete_article(articles: DataFrame, article_id: int) -> DataFrame:
    """Table without the article; rows flagged as its duplicates lose the reference."""
    return articles.where(F.col("id") != article_id).withColumn(
        "duplicate_of_id", F.nullif("duplicate_of_id", F.lit(article_id))
    )


def mark_fetched(sources: DataFrame, entries: DataFrame, now: Column) -> DataFrame:
    """Sources with at least one entry get a new fetch time; the others keep theirs."""
    seen = entries.select(F.col("source_id").alias("id"), F.lit(True).alias("_seen")).distinct()
    return sources.join(seen, "id", "left").select(
        *[c for c in sources.columns if c != "last_fetched_at"],
        F.when(F.col("_seen"), now).otherwise(F.col("last_fetched_at")).alias("last_fetched_at"),
    )


def run_status(found: Column, failed: Column) -> Column:
    return F.when(failed, "failed").when(found == 0, "partial").otherwise("success")


def run_row(run_id: int, counters: DataFrame, started_at: Column, finished_at: Column,
            failed: bool = False, damaged: int = 0) -> DataFrame:
    """The row of one finished run from `insert_counters`. A run that found nothing is 'partial';
    errors are a failure of the run and its `damaged` feed documents."""
    return counters.select(
        F.lit(run_id).cast("bigint").alias("id"),
        started_at.cast("timestamp").alias("started_at"), finished_at.cast("timestamp").alias("finished_at"),
        F.col("found").alias("articles_found"), F.col("inserted").alias("articles_inserted"),
        F.col("skipped").alias("articles_skipped"),
        F.lit(int(failed) + damaged).cast("bigint").alias("errors"),
        run_status(F.col("found"), F.lit(failed)).alias("status"),
    )


def with_defaults(articles: DataFrame, now: Column) -> DataFrame:
    """Column defaults of the article table."""
    return articles.withColumns({
        "title": F.coalesce("title", F.lit(UNTITLED)),
        "language": F.coalesce("language", F.lit(DEFAULT_LANGUAGE)),
        "is_clean": F.coalesce("is_clean", F.lit(False)),
        "scraped_at": F.coalesce("scraped_at", now.cast("timestamp")),
        "is_duplicate": F.coalesce("is_duplicate", F.lit(False)),
    })


def evolve(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """`df` in the given schema: missing columns are added, with a default where one is given; columns
    that the schema does not know come last."""
    empty = df.sparkSession.createDataFrame([], schema)
    known = {f.name for f in schema.fields}
    missing = [f for f in schema.fields if f.name not in df.columns]
    ordered = [c for c in df.columns if c in known] + [c for c in df.columns if c not in known]
    wide = empty.unionByName(df.select(*[F.col(f"`{c}`") for c in ordered]), allowMissingColumns=True)
    fills = {f.name: F.lit(defaults[f.name]).cast(f.dataType) for f in missing if f.name in (defaults or {})}
    return wide.withColumns(fills) if fills else wide


def backfill_content(articles: DataFrame) -> DataFrame:
    """Content vectors where there is text and no vector yet."""
    wanted = F.col("content_embedding").isNull() & F.col("full_text").isNotNull()
    return articles.withColumn(
        "content_embedding",
        F.when(wanted, feature_set(content_text(F.col("full_text")))).otherwise(F.col("content_embedding")),
    )


def backfill_counters(articles: DataFrame) -> DataFrame:
    """embedded, skipped, total of what `backfill_content` would do."""
    wanted = articles.where("content_embedding IS NULL AND full_text IS NOT NULL")
    usable = feature_set(content_text(F.col("full_text"))).isNotNull()
    return wanted.agg(
        F.count_if(usable).alias("embedded"), F.count_if(~usable).alias("skipped"), F.count("*").alias("total")
    )


def backfill_sources(sources: DataFrame, vectors: DataFrame) -> DataFrame:
    """Source vectors `(id, vector)` filled in where missing."""
    fresh = vectors.select("id", F.col("vector").alias("_vector"))
    return sources.join(fresh, "id", "left").withColumn(
        "source_embedding", F.coalesce("source_embedding", "_vector")
    ).drop("_vector")
