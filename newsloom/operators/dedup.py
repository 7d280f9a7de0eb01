"""Deduplication: by URL, by content, by general text, and the insert that combines them.

A stored row is a candidate for every later row whether or not it was flagged itself, so the
matches of a batch do not depend on each other and the whole batch is one join against earlier
rows. Flagged rows are stored, not skipped, and count both as inserted and as skipped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.features import content_text, feature_set, general_text, trimmed
from newsloom.functions.urls import url_key
from newsloom.operators.bits import Bits
from newsloom.operators.ids import assign_ids
from newsloom.operators.joins import skew_safe_join
from newsloom.operators.nearest import KnownSets, best_of, known_sets, nearest_earlier_sets, nearest_known_sets
from newsloom.schema import ARTICLES
from newsloom.session import stage

# Fixed values.
THRESHOLD = 0.92
MIN_QUERY_CHARS = 50
UNTITLED = "(untitled)"


def keep_first(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """The first row of every key, in the given order.

    Spark cuts the groups inside each input task before the shuffle (WindowGroupLimit), so a key
    held by a third of all rows reaches its reducer as one row per task.
    """
    first = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def unique_urls(batch: DataFrame, order: list[str]) -> DataFrame:
    """First row per URL, upper and lower case being different."""
    return keep_first(batch, F.col("url"), order)


def new_urls(batch: DataFrame, stored: DataFrame, order: list[str]) -> DataFrame:
    """Rows whose URL, ignoring case, is neither stored nor earlier in the batch."""
    first = keep_first(batch, url_key(F.col("url")), order).withColumn("_key", url_key(F.col("url")))
    known = stored.select(url_key(F.col("url")).alias("_key"))
    return first.join(known, "_key", "left_anti").drop("_key")


def with_vectors(rows: DataFrame, category: str | None = None) -> DataFrame:
    """Rows with the feature sets of their general and content text."""
    kind = F.col(category) if category else None
    return rows.withColumns({
        "embedding": feature_set(general_text(F.col("title"), F.col("summary"), F.col("full_text"), kind)),
        "content_embedding": feature_set(content_text(F.col("full_text"))),
    })


def long_enough(text: Column) -> Column:
    return F.coalesce(F.length(trimmed(text)) >= MIN_QUERY_CHARS, F.lit(False))


def _matches(stored: DataFrame, asking: DataFrame, vector: str, threshold: float, known: KnownSets | None) -> DataFrame:
    """Nearest earlier row of asking rows `(id, features, asks)`: in the batch itself, or stored.

    Stored rows are looked up through `known`; without it, it is made of all of them.
    """
    within = nearest_earlier_sets(asking, threshold)
    if (stored if known is None else known.keys).isEmpty():
        return within
    if known is None:
        known = known_sets(stored.select("id", F.col(vector).alias("features")), threshold)
    return best_of(within, nearest_known_sets(asking.where("asks").select("id", "features"), known, threshold))


def content_matches(stored: DataFrame, batch: DataFrame, threshold: float = THRESHOLD,
                    known: KnownSets | None = None) -> DataFrame:
    """Nearest earlier article by content for every batch row with at least 50 characters of text.

    Both frames have `id` (stored ids below batch ids) and `content_embedding`; the batch also has
    `full_text`, or `asks` which says whether that is long enough. A candidate needs any content at all.
    """
    asks = F.col("asks") if "asks" in batch.columns else long_enough(F.col("full_text"))
    asking = batch.select("id", F.col("content_embedding").alias("features"), asks.alias("asks"))
    return _matches(stored, asking, "content_embedding", threshold, known)


def general_matches(stored: DataFrame, batch: DataFrame, matched: DataFrame,
                    threshold: float = THRESHOLD, known: KnownSets | None = None) -> DataFrame:
    """Nearest earlier article by general text for batch rows not in `matched`."""
    open_ids = stage(batch.select("id").join(matched.select("id"), "id", "left_anti"), "open-ids")
    # Matched rows that ask by chance are left out of the answer.
    asking = batch.select("id", F.col("embedding").alias("features"), Bits(open_ids, "id").maybe("id").alias("asks"))
    found = _matches(stored, asking, "embedding", threshold, known)
    return found.join(matched.select("id").distinct(), "id", "left_anti")


def duplicate_matches(stored: DataFrame, batch: DataFrame, threshold: float = THRESHOLD,
                      general: bool = True, known: dict[str, KnownSets] | None = None) -> DataFrame:
    """`(id, duplicate_of_id, similarity_score, general_similarity)` of the rows of a stored batch that repeat an earlier one.

    A match by general text is recorded with the threshold as its score; the true value is kept in
    `general_similarity`.
    """
    known = known or {}
    content = stage(content_matches(stored, batch, threshold, known.get("content")), "content-matches")
    found = content.select(
        "id", F.col("match_id").alias("duplicate_of_id"), F.col("similarity").alias("similarity_score"),
        F.lit(None).cast("double").alias("general_similarity"))
    if not general:
        return found
    other = general_matches(stored, batch, content, threshold, known.get("general"))
    return stage(found.unionByName(other.select(
        "id", F.col("match_id").alias("duplicate_of_id"), F.lit(threshold).alias("similarity_score"),
        F.col("similarity").alias("general_similarity"))), "matches")


def with_flags(batch: DataFrame, matches: DataFrame) -> DataFrame:
    """Batch rows with is_duplicate and the columns of their `matches`."""
    return batch.join(matches, "id", "left").select(
        *batch.columns, F.col("duplicate_of_id").isNotNull().alias("is_duplicate"), "duplicate_of_id", "similarity_score",
        "general_similarity")


def flag_duplicates(stored: DataFrame, batch: DataFrame, threshold: float = THRESHOLD,
                    general: bool = True, known: dict[str, KnownSets] | None = None) -> DataFrame:
    """Rows of a stored batch with is_duplicate, duplicate_of_id, similarity_score and general_similarity."""
    return with_flags(batch, duplicate_matches(stored, batch, threshold, general, known))


@dataclass
class Inserted:
    """New rows in table form, and one row of counters."""

    rows: DataFrame
    counters: DataFrame


def dedup_insert(stored: DataFrame, batch: DataFrame, order: list[str], threshold: float = THRESHOLD,
                 use_vectors: bool = True, general: bool = True, category: str | None = None,
                 scraped_at: Column | None = None, known: dict[str, KnownSets] | None = None,
                 taken: DataFrame | None = None, replaced: DataFrame | None = None) -> Inserted:
    """The rows a batch adds to the article table.

    URL conflicts are dropped, ids continue after the stored ones in the given order, and rows that
    resemble an earlier one are flagged. Without vectors only the URL counts. `known` holds the stored
    sets by kind ('content', 'general'); without it they are made from `stored`. Flags are found on ids
    and feature sets; texts join them at the end.

    `taken` are the rows whose URLs are not free, where these are not just `stored`; `replaced` are rows
    that this insert replaces: their URLs keep their ids.
    """
    taken = stored if taken is None else taken
    ids = taken.select("id") if replaced is None else taken.select("id").unionByName(replaced.select("id"))
    last = ids.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last")).scalar()
    # Only places and URLs are compared, sorted and numbered; the rows that stay are moved once, to their ids.
    placed = batch.withColumn("_at", F.struct(*dict.fromkeys([*order, "url"])))
    fresh = new_urls(placed.select("_at", *dict.fromkeys([*order, "url"])), taken, order)
    if replaced is None or replaced.isEmpty():
        fresh = assign_ids(fresh, order, last)
    else:
        had = replaced.select(url_key(F.col("url")).alias("_key"), F.col("id").alias("_had"))
        fresh = stage(fresh.withColumn("_key", url_key(F.col("url"))).join(had, "_key", "left").drop("_key"), "replayed")
        new = assign_ids(fresh.where("_had IS NULL").drop("_had"), order, last)
        fresh = new.unionByName(fresh.where("_had IS NOT NULL").withColumnRenamed("_had", "id"))
    numbered = stage(fresh.select("_at", "id"), "numbered-urls")
    mine = placed.where(Bits(numbered, "_at").maybe("_at")).join(numbered, "_at")
    fresh = keep_first(mine, F.col("_at"), ["id"]).drop("_at")
    if "scraped_at" not in fresh.columns:
        fresh = fresh.withColumn("scraped_at", scraped_at if scraped_at is not None else F.current_timestamp())
    if use_vectors and not numbered.isEmpty():
        fresh = stage(with_vectors(fresh, category).withColumn("asks", long_enough(F.col("full_text"))), "fresh")
        matches = duplicate_matches(stored, fresh.select("id", "embedding", "content_embedding", "asks"), threshold, general, known)
        flags = with_flags(fresh.select("id"), matches)
        # Rows that certainly match nothing stay where they are.
        maybe = Bits(matches, "id").maybe("id")
        alone = with_flags(fresh.where(~maybe), matches.where("false"))
        flagged = with_flags(fresh.where(maybe), matches).unionByName(alone)
    else:
        fresh = stage(fresh, "fresh")
        flagged = fresh.withColumns({
            "is_duplicate": F.lit(False),
            "duplicate_of_id": F.lit(None).cast("bigint"),
            "similarity_score": F.lit(None).cast("double"),
            "embedding": F.lit(None).cast("array<bigint>"),
            "content_embedding": F.lit(None).cast("array<bigint>"),
        })
        flags = fresh.select("id", F.lit(False).alias("is_duplicate"))
    rows = flagged.select(*[F.col(f.name).cast(f.dataType) for f in ARTICLES.fields])
    return Inserted(rows, insert_counters(batch, flags))


def insert_counters(batch: DataFrame, rows: DataFrame) -> DataFrame:
    """found, inserted, skipped_vector, skipped_url, skipped. Flagged rows count as skipped too."""
    found = batch.agg(F.count("*").alias("found"))
    stored = rows.agg(F.count("*").alias("inserted"), F.count_if("is_duplicate").alias("skipped_vector"))
    both = stored.withColumn("found", found.scalar())
    return both.select(
        "found", "inserted", "skipped_vector",
        (F.col("found") - F.col("inserted")).alias("skipped_url"),
        (F.col("skipped_vector") + F.col("found") - F.col("inserted")).alias("skipped"),
    )


def insert_articles(stored: DataFrame, articles: DataFrame, order: list[str],
                    threshold: float = THRESHOLD) -> Inserted:
    """Insert articles given by hand: `(url, title, summary, full_text, category)`.

    Only content is compared; a missing title becomes "(untitled)"; there is no source, and the row
    is not marked clean.
    """
    filled = articles.select(
        *[c for c in order if c not in ("url", "title", "summary", "full_text", "category")],
        F.lit(None).cast("int").alias("source_id"),
        F.coalesce(F.nullif("title", F.lit("")), F.lit(UNTITLED)).alias("title"),
        "url",
        F.lit(None).cast("string").alias("author"),
        F.lit(None).cast("timestamp").alias("published_at"),
        F.nullif("summary", F.lit("")).alias("summary"),
        F.nullif("full_text", F.lit("")).alias("full_text"),
        F.lit(None).cast("int").alias("word_count"),
        F.lit("en").alias("language"),
        F.lit(False).alias("is_clean"),
        "category",
    )
    return dedup_insert(stored, filled, order, threshold, general=False, category="category")


def with_originals(articles: DataFrame) -> DataFrame:
    """Flagged articles with the title and URL of the article each one repeats."""
    originals = articles.select(
        F.col("id").alias("duplicate_of_id"),
        F.col("title").alias("original_title"), F.col("url").alias("original_url"),
    )
    flagged = articles.where("is_duplicate").select("id", "url", "duplicate_of_id", "similarity_score")
    return skew_safe_join(flagged, originals, ["duplicate_of_id"], "left")


def resolve_roots(articles: DataFrame) -> DataFrame:
    """`(id, root_id)` of every article: the article that its chain of `duplicate_of_id` ends at, itself if it repeats none.

    Pointers are doubled: in each round every article takes over what its target points to, so a chain
    of n articles takes some log2(n) rounds, each one join, written before the next. Only pointers to a smaller id that is
    there are followed, as flags are made; a chain whose next article is gone, or which doesn't lead
    back, ends before it.
    """
    ids = articles.select(F.col("id").alias("to"))
    followed = articles.where("duplicate_of_id < id").select("id", F.col("duplicate_of_id").alias("to"))
    links = stage(skew_safe_join(followed, ids, ["to"]).select("id", "to"), "links")
    left = links.count()
    while left:
        ends = links.select(F.col("id").alias("to"), F.col("to").alias("further"))
        doubled = stage(skew_safe_join(links, ends, ["to"], "left"), "doubled-links")
        left = doubled.where("further IS NOT NULL").count()
        links = doubled.select("id", F.coalesce("further", "to").alias("to"))
    return articles.select("id").join(links, "id", "left").select("id", F.coalesce("to", "id").alias("root_id"))
