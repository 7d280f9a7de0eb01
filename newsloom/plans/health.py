"""Reports on the state of deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.barrier import with_computed
from newsloom.functions.features import set_cosine
from newsloom.functions.text import similarity_band
from newsloom.operators.dedup import THRESHOLD
from newsloom.plans.report import last_articles, table_counts

LOOSE_THRESHOLD = 0.50
URL_CHARS = 55


def pair_similarity(articles: DataFrame, pairs: DataFrame, similarity=set_cosine,
                    vector: str = "content_embedding") -> DataFrame:
    """Similarity of given pairs `(id1, id2)`, to 4 places, with its band; NULL without a vector."""

    def side(n: str) -> DataFrame:
        return articles.select(
            F.col("id").alias("id" + n), F.left("url", F.lit(URL_CHARS)).alias("url" + n),
            F.col(vector).isNotNull().alias("has_embedding" + n), F.col(vector).alias("_v" + n),
        )

    both = pairs.join(side("1"), "id1").join(side("2"), "id2")
    value = F.round(similarity(F.col("_v1"), F.col("_v2")), 4)
    return both.withColumn("similarity", value).withColumn("band", similarity_band(F.col("similarity"))).drop(
        "_v1", "_v2"
    )


def latest_embedded(articles: DataFrame, vector: str = "content_embedding") -> DataFrame:
    """The newest article that has a vector."""
    return articles.where(F.col(vector).isNotNull()).select("id", F.col(vector).alias("vector"), "url").orderBy(
        F.desc("id")
    ).limit(1)


def latest_match(articles: DataFrame, threshold: float = LOOSE_THRESHOLD, similarity=set_cosine,
                 vector: str = "content_embedding") -> DataFrame:
    """Best match of the newest embedded article among all others, if above `threshold`."""
    newest = latest_embedded(articles, vector).select(F.struct("id", "vector")).scalar()
    scored = (
        with_computed(articles.where(F.col(vector).isNotNull()), _q=newest)
        .where(F.col("id") != F.col("_q.id"))
        .select(
            F.col("_q.id").alias("query_id"), F.col("id").alias("match_id"), F.left("url", F.lit(60)).alias("url"),
            similarity(F.col(vector), F.col("_q.vector")).alias("similarity"),
        )
        .where(F.col("similarity") >= threshold)
        .orderBy(F.desc("similarity"), "match_id").limit(1)
    )
    return scored.withColumn("is_duplicate", F.col("similarity") >= THRESHOLD)


def dedup_health(articles: DataFrame, limit: int = 10) -> dict[str, DataFrame]:
    return {
        "Last Articles": last_articles(articles, limit),
        "Counts": table_counts(articles),
        "Latest Match": latest_match(articles),
    }
