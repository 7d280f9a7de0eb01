"""The built-in list of feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SEED_SCHEMA = "name string, url string, category string"

# Name, feed URL, category.
DEFAULT_FEEDS = (
    ("TechCrunch", "https://techcrunch.com/feed/", "Technology"),
    ("The Verge", "https://www.theverge.com/rss/index.xml", "Technology"),
    ("Wired", "https://www.wired.com/feed/rss", "Technology"),
    ("Ars Technica", "https://feeds.arstechnica.com/arstechnica/index", "Technology"),
    ("Reuters Business", "https://feeds.reuters.com/reuters/businessNews", "Finance"),
    ("Yahoo Finance", "https://finance.yahoo.com/news/rssindex", "Finance"),
    ("MarketWatch", "https://feeds.marketwatch.com/marketwatch/topstories/", "Finance"),
    ("BBC News", "http://feeds.bbci.co.uk/news/rss.xml", "General"),
    ("Reuters Top News", "https://feeds.reuters.com/reuters/topNews", "General"),
    ("NPR News", "https://feeds.npr.org/1001/rss.xml", "General"),
    ("NASA Breaking News", "https://www.nasa.gov/rss/dyn/breaking_news.rss", "Science"),
    ("ScienceDaily", "https://www.sciencedaily.com/rss/all.xml", "Science"),
    ("New Scientist", "https://www.newscientist.com/feed/home/", "Science"),
)


def default_seeds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEFAULT_FEEDS, SEED_SCHEMA)


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Seed list from JSON lines with name, url and an optional category."""
    return spark.read.schema(SEED_SCHEMA).json(path)
