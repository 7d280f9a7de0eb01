"""Joins that hold under skew, and the URL prefix anti join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import stage

# At most this many keys are treated as hot, so their broadcast is bounded whatever the data. A key
# outside the list holds at most 1/HOT_KEYS of the rows.
HOT_KEYS = 1_000


def skew_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join `left` to `right`, which has one row per key, when few keys may hold most of `left`.

    The rows of the most frequent keys meet their (at most HOT_KEYS) partners by broadcast and stay
    where they are; all other rows are joined by shuffle.
    """
    hot = (
        left.groupBy(*on).agg(F.count("*").alias("_n"))
        .where(F.col("_n") > 1)
        .orderBy(F.desc("_n"), *on).limit(HOT_KEYS)
        .select(*on, F.lit(True).alias("_hot"))
    )
    marked = left.join(F.broadcast(hot), on, "left")
    hot_right = right.join(F.broadcast(hot.drop("_hot")), on, "left_semi")
    return (
        marked.where("_hot").drop("_hot").join(F.broadcast(hot_right), on, how)
        .unionByName(marked.where("_hot IS NULL").drop("_hot").join(right, on, how))
    )


def without_stored_prefix(fresh: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of `fresh` whose `key` is not a prefix of any `key` in `stored`.

    A string is a prefix of some stored string exactly when it is one of the smallest stored string
    that is not below it. So both sides are range partitioned on the key together, and a running
    minimum inside each partition finds that string; for the last rows of a partition it is the
    smallest stored string of a later one. Two sorts, no pairwise comparison.
    """
    mixed = (
        fresh.select(F.col(key).alias("_key")).distinct().withColumn("_stored", F.lit(None).cast("string"))
        .unionByName(stored.select(F.col(key).alias("_key"), F.col(key).alias("_stored")).distinct())
        .where(F.col("_key").isNotNull())
        .repartitionByRange("_key")
        .withColumn("_part", F.spark_partition_id())
    )
    # The partition number is data from here on, so it must not change between the two uses below.
    mixed = stage(mixed, "prefix")
    upwards = Window.partitionBy("_part").orderBy(F.desc("_key")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # One row per partition: few enough for a single ordered window.
    later = (
        mixed.groupBy("_part").agg(F.min("_stored").alias("_first"))
        .withColumn("_later", F.min("_first").over(
            Window.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)))
        .select("_part", "_later")
    )
    known = (
        mixed.withColumn("_next", F.min("_stored").over(upwards))
        .where(F.col("_stored").isNull())
        .join(later, "_part")
        .where(F.startswith(F.coalesce("_next", "_later"), F.col("_key")))
        .select(F.col("_key").alias(key))
        .distinct()
    )
    return fresh.join(known, key, "left_anti")
