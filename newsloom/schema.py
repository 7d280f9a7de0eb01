"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

SOURCES = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("last_fetched_at", T.TimestampType()),
])

RAW_ENTRIES = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("published", T.TimestampType()),
    T.StructField("author", T.StringType()),
    T.StructField("source_id", T.IntegerType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("category", T.StringType()),
])

CLEAN_ARTICLES = T.StructType([
    T.StructField("source_id", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("summary", T.StringType()),
    T.StructField("full_text", T.StringType()),
    T.StructField("word_count", T.IntegerType()),
    T.StructField("language", T.StringType()),
    T.StructField("is_clean", T.BooleanType()),
])

# Feature sets are the sparse form of a unit vector: every listed coordinate weighs 1/sqrt(size).
ARTICLES = T.StructType(
    [T.StructField("id", T.LongType())]
    + CLEAN_ARTICLES.fields
    + [
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("is_duplicate", T.BooleanType()),
        T.StructField("duplicate_of_id", T.LongType()),
        T.StructField("similarity_score", T.DoubleType()),
        T.StructField("embedding", T.ArrayType(T.LongType())),
        T.StructField("content_embedding", T.ArrayType(T.LongType())),
    ]
)

RUNS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("finished_at", T.TimestampType()),
    T.StructField("articles_found", T.LongType()),
    T.StructField("articles_inserted", T.LongType()),
    T.StructField("articles_skipped", T.LongType()),
    T.StructField("errors", T.LongType()),
    T.StructField("status", T.StringType()),
])

# Distinct feature sets of articles, by kind of text, and the coordinates they are found by.
SETS = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("k1", T.LongType()),
    T.StructField("k2", T.LongType()),
    T.StructField("id", T.LongType()),
])

POSTINGS = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("f", T.LongType()),
    T.StructField("id", T.LongType()),
    T.StructField("n", T.IntegerType()),
    T.StructField("pos", T.IntegerType()),
])

# How often coordinates of either kind fell into each bucket when the first postings were made.
WEIGHTS = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("b", T.LongType()),
    T.StructField("n", T.LongType()),
])
