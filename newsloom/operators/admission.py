"""Admission of new sources: a source that resembles a stored one is turned away."""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.features import with_dense_vector
from newsloom.functions.text import strip_tags
from newsloom.functions.urls import url_key
from newsloom.operators.dedup import THRESHOLD
from newsloom.operators.nearest import PLACES, nearest_earlier_of, nearest_earlier_vectors, nearest_vectors
from newsloom.session import stage

# Fixed values.
SOURCE_ENTRIES = 5
SOURCE_DESCRIPTION_CHARS = 200
ENTRY_SUMMARY_CHARS = 150
SOURCE_TEXT_CHARS = 700
EMBED_CHARS = 1_024

# So many open candidates are judged by one task (12 MB of vectors at a width of 384).
IN_ONE_TASK = 4_096


def _part(label: str, text: Column) -> Column:
    return F.when(text != "", F.concat(F.lit(label), text))


def feed_text(channels: DataFrame, entries: DataFrame) -> DataFrame:
    """`(source_id, feed_text)`: channel title and description, then the first five entries.

    Inputs: `(source_id, channel_title, channel_description)` and
    `(source_id, position, title, summary)`.
    """
    order = Window.partitionBy("source_id").orderBy("position")
    title, summary = strip_tags(F.col("title")), strip_tags(F.col("summary"))
    sample = (
        entries.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= SOURCE_ENTRIES)
        .select("source_id", "_rn", F.concat_ws(
            " ", _part("article: ", title), _part("", F.substring(summary, 1, ENTRY_SUMMARY_CHARS))
        ).alias("_text"))
        .groupBy("source_id")
        .agg(F.array_sort(F.collect_list(F.struct("_rn", "_text"))).alias("_sample"))
    )
    about = F.substring(strip_tags(F.col("channel_description")), 1, SOURCE_DESCRIPTION_CHARS)
    sampled = F.filter(F.transform("_sample", lambda e: e["_text"]), lambda t: t != "")
    return channels.join(sample, "source_id", "left").select(
        "source_id",
        F.substring(F.concat_ws(
            " ", _part("feed: ", strip_tags(F.col("channel_title"))), _part("about: ", about),
            F.array_join(F.coalesce(sampled, F.array().cast("array<string>")), " "),
        ), 1, SOURCE_TEXT_CHARS).alias("feed_text"),
    )


def source_text(name: Column, category: Column, feed: Column) -> Column:
    """Text a source is compared by."""
    labelled = F.concat(
        F.lit("name: "), name, F.lit(" category: "), category, F.lit(" "), F.coalesce(feed, F.lit(""))
    )
    return F.substring(F.trim(labelled), 1, EMBED_CHARS)


def admit_sources(stored: DataFrame, candidates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Candidates with the decision on each.

    `stored`: `(id, name, url, category, source_embedding)`; `candidates`: `(id, name, url,
    category, source_embedding)` with ids of their own. Result: the candidate columns plus
    `accepted`, `reason` ('similar', 'url' or NULL) and the match.

    Candidates are judged as if one came after the other, in the order of ids: each meets the stored
    sources and the candidates accepted before it, by text and by URL (ignoring case). A match among
    the stored ones is named first, else the nearest candidate accepted earlier; 'similar' comes before 'url'.
    """
    match = nearest_vectors(_vectors(candidates), _vectors(stored), threshold)
    taken = stored.select(url_key(F.col("url")).alias("_key"), F.lit(True).alias("_taken")).distinct()
    judged = stage(
        candidates.join(match, "id", "left").withColumn("_key", url_key(F.col("url"))).join(taken, "_key", "left")
        .withColumn("reason", F.when(F.col("match_id").isNotNull(), "similar").when(F.col("_taken"), "url")), "judged-sources")
    turned_away = _in_turn(judged.where("reason IS NULL").select("id", "_key", "source_embedding"), threshold)
    sources = [
        known.select(F.lit(new).alias("_new"), F.col("id").cast("bigint").alias("match_id"), F.col("name").alias("match_name"),
                     F.col("url").alias("match_url"), F.col("category").alias("match_category"))
        for new, known in ((False, stored), (True, candidates))]
    return (
        judged.join(turned_away, "id", "left")
        .withColumns({
            "_new": F.col("match_id").isNull(),
            "match_id": F.coalesce(F.col("match_id"), F.col("_match")), "similarity": F.coalesce("similarity", "_similarity"),
            "reason": F.coalesce("reason", "_reason")})
        .join(sources[0].unionByName(sources[1]), ["_new", "match_id"], "left")
        .withColumn("accepted", F.col("reason").isNull())
        .drop("_key", "_taken", "_new", "_match", "_similarity", "_reason", "source_embedding")
    )


def _vectors(sources: DataFrame) -> DataFrame:
    return sources.select(F.col("id").cast("bigint").alias("id"), F.col("source_embedding").alias("vector"))


def _in_turn(rows: DataFrame, threshold: float, in_one_task: int | None = None) -> DataFrame:
    """`(id, _match, _similarity, _reason)` of those of `rows` `(id, _key, source_embedding)` that an earlier accepted row turns away.

    In each round all rows without an earlier open row that is similar or has the same URL are
    accepted, and what is similar to one of these, or has its URL, is turned away. (An accepted row that is
    similar to an open one is earlier: else it would not have been accepted.) So the rounds follow the longest
    chain of decisions that depend on each other, and pairs are never listed: a row only asks
    whether it has a neighbour. Once at most `in_one_task` rows are open (a bounded number of vectors), one
    task judges them in their order.
    """
    still_open, decided = stage(rows, "open-sources"), []
    bound = IN_ONE_TASK if in_one_task is None else in_one_task
    while (n := still_open.count()) > bound:
        vectors = _vectors(still_open)
        held = nearest_earlier_vectors(vectors.withColumn("asks", F.lit(True)), threshold).select("id")
        twin = F.row_number().over(Window.partitionBy("_key").orderBy("id"))
        first = still_open.withColumn("_twin", F.when(F.col("_key").isNotNull(), twin).otherwise(1))
        accepted = stage(first.where("_twin = 1").drop("_twin").join(held, "id", "left_anti"), "accepted-sources")
        rest = still_open.join(accepted.select("id"), "id", "left_anti")
        similar = nearest_vectors(_vectors(rest), _vectors(accepted), threshold)
        keys = accepted.where("_key IS NOT NULL").select("_key", F.lit(True).alias("_taken"))
        judged = stage(
            rest.join(similar, "id", "left").join(keys, "_key", "left").select(
                *rest.columns, F.when(F.col("match_id").isNotNull(), "similar").when(F.col("_taken"), "url").alias("_reason")), "decided-sources")
        decided += [accepted.select("id", F.lit(None).cast("string").alias("_reason")), judged.where("_reason IS NOT NULL").select("id", "_reason")]
        still_open = judged.where("_reason IS NULL").select(*rows.columns)
    if n:

        def walk(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values("id")
            taken, reasons = set(), []
            vectors = [None if v is None else np.asarray(v, dtype="float64") for v in frame.source_embedding]
            width = max((len(v) for v in vectors if v is not None), default=0)
            units, used = np.zeros((len(frame), width)), 0
            for key, vector in zip(frame["_key"], vectors):
                norm = 0.0 if vector is None else float(np.sqrt(vector @ vector))
                unit = vector / norm if 0 < norm < np.inf else None
                similar = unit is not None and (np.round(units[:used] @ unit, PLACES) >= threshold).any()
                reasons.append("similar" if similar else "url" if key is not None and key in taken else None)
                if reasons[-1] is None:
                    taken.add(key)
                    if unit is not None:
                        units[used], used = unit, used + 1
            return pd.DataFrame({"id": frame.id, "_reason": reasons})

        decided.append(still_open.groupBy().applyInPandas(walk, f"id {rows.schema['id'].dataType.simpleString()}, _reason string"))
    if not decided:
        return rows.sparkSession.createDataFrame([], "id bigint, _match bigint, _similarity double, _reason string")
    away = stage(functools.reduce(DataFrame.unionByName, decided).join(rows.drop("_key"), "id"), "judged-in-turn")
    match = nearest_earlier_of(_vectors(away.where("_reason = 'similar'")), _vectors(away.where("_reason IS NULL")), threshold)
    return away.where("_reason IS NOT NULL").select("id", "_reason").join(match, "id", "left").select(
        "id", F.col("match_id").alias("_match"), F.col("similarity").alias("_similarity"), "_reason")


def with_source_vectors(sources: DataFrame, text: str = "source_text", out: str = "source_embedding") -> DataFrame:
    return with_dense_vector(sources, text, out)
