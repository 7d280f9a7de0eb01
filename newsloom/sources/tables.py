"""Stored tables: scans, parameterised SQL, and the append-only article store.

Layout under one root: `<table>/batch=<n>/attempt=<name>` for the tables articles, sources, sets,
postings and runs. An attempt at a batch writes its own folders, its run row last. Readers take, of
each batch, the attempt whose run row is the newest without failure: a batch is visible whole or not
at all, and no attempt touches what another has written. Batch 0 holds the first sources.
`weights` is outside the batches: it is written once, before the first postings, and never again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from newsloom.operators.dedup import THRESHOLD
from newsloom.operators.nearest import KnownSets, bucket_counts, bucket_weights, new_sets
from newsloom.schema import ARTICLES, POSTINGS, RUNS, SETS, SOURCES, WEIGHTS

FIRST = "first"
KINDS = {"content": "content_embedding", "general": "embedding"}


def active_sources(sources: DataFrame) -> DataFrame:
    return sources.where("is_active").select("id", "name", "url", "category").orderBy("id")


def all_sources(sources: DataFrame) -> DataFrame:
    return sources.select("id", "name", "url", "category", "is_active", "last_fetched_at").orderBy("id")


def active_names(sources: DataFrame) -> DataFrame:
    return sources.where("is_active").select("name", "url", "category")


def query(spark: SparkSession, sql: str, args: dict | None = None, **tables: DataFrame) -> DataFrame:
    """Run SQL with named parameters over the given tables. Errors are raised, not swallowed."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    try:
        return spark.sql(sql, args=args or {})
    finally:  # names are resolved by now
        for name in tables:
            spark.catalog.dropTempView(name)


@dataclass
class Seen:
    """Articles of the batches before one, of all batches but it, and those that an earlier attempt at it stored."""

    stored: DataFrame
    taken: DataFrame
    replaced: DataFrame


class TableStore:
    """Reads and writes the tables under one root folder.

    `least_threshold`: the lowest similarity that stored postings can answer (a lower one needs longer
    prefixes); it must stay what it was when the store began.
    """

    def __init__(self, spark: SparkSession, root: str, least_threshold: float = THRESHOLD):
        self.spark, self.root, self.least_threshold = spark, root.rstrip("/"), least_threshold

    @staticmethod
    def new_attempt() -> str:
        return uuid.uuid4().hex

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        return self._read_as(name, T.StructType(
            [*schema.fields, T.StructField("batch", T.LongType()), T.StructField("attempt", T.StringType())]))

    def _read_as(self, name: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame, name: str, batch: int, attempt: str) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/batch={batch}/attempt={attempt}")

    def _valid_runs(self) -> DataFrame:
        """One run row of each batch: the newest that did not fail, else the newest."""
        newest = Window.partitionBy("batch").orderBy(F.col("status") == "failed", F.desc("finished_at"), "attempt")
        rows = self._read("runs", RUNS).withColumn("_rn", F.row_number().over(newest))
        return rows.where("_rn = 1").drop("_rn")

    def _visible(self, name: str, schema: T.StructType, before: int | None) -> DataFrame:
        rows = self._read(name, schema)
        if before is not None:
            rows = rows.where(F.col("batch") < before)
        return self._counting(rows, name)

    def _counting(self, rows: DataFrame, name: str) -> DataFrame:
        valid = self._valid_runs().where("status <> 'failed'").select("batch", "attempt")
        if name == "sources":
            valid = valid.unionByName(self.spark.createDataFrame([(0, FIRST)], "batch bigint, attempt string"))
        # A row for each batch; the articles must not be shuffled for it.
        return rows.join(F.broadcast(valid), ["batch", "attempt"], "left_semi").drop("attempt")

    def runs(self) -> DataFrame:
        return self._valid_runs().drop("batch", "attempt")

    def articles(self, before: int | None = None) -> DataFrame:
        """Articles of finished batches (with a number below `before`, when given)."""
        return self._visible("articles", ARTICLES, before).drop("batch")

    def seen_by(self, batch: int) -> Seen:
        """What a batch meets, whether it is new or written again after later ones."""
        rows = self._visible("articles", ARTICLES, None)
        own = F.col("batch") == batch
        return Seen(self.articles(batch), rows.where(~own).drop("batch"), rows.where(own).drop("batch"))

    def sources(self, before: int | None = None) -> DataFrame:
        """The source table as the newest finished batch (below `before`, when given) left it."""
        rows = self._visible("sources", SOURCES, before)
        newest = rows.agg(F.max("batch")).scalar()
        return rows.where(F.col("batch") == newest).drop("batch")

    def known_sets(self, before: int | None = None) -> dict[str, KnownSets]:
        """The distinct feature sets of finished batches, by kind."""
        keys, postings = self._visible("sets", SETS, before), self._visible("postings", POSTINGS, before)
        articles, weights = self.articles(before), self._weights()
        return {
            kind: KnownSets(
                keys.where(F.col("kind") == kind).select("k1", "k2", "id"),
                postings.where(F.col("kind") == kind).select("f", "id", "n", "pos"),
                articles.where(F.col(vector).isNotNull()).select("id", F.col(vector).alias("features")),
                weights.get(kind),
            ) for kind, vector in KINDS.items()
        }

    def _weights(self) -> dict[str, np.ndarray]:
        """The order of coordinates that all postings are made by; none in a store whose postings are in hash order."""
        rows = self._read_as("weights", WEIGHTS)
        return {} if rows.isEmpty() else {kind: bucket_weights(rows.where(F.col("kind") == kind)) for kind in KINDS}

    def _fixed_weights(self, articles: DataFrame) -> dict[str, np.ndarray]:
        """The weights of the store; where nothing was ever posted, those of `articles` become them.

        Any attempt may fix them, finished or not: they rule what postings are compared by, not what is found.
        """
        weights = self._weights()
        if weights or not self._read("postings", POSTINGS).isEmpty():
            return weights
        counts = [bucket_counts(articles.select(F.col(vector).alias("features"))).withColumn("kind", F.lit(kind)) for kind, vector in KINDS.items()]
        # At most a row for each bucket and kind. One file, which is there whole or not at all.
        counts[0].unionByName(counts[1]).select(*WEIGHTS.fieldNames()).repartition(1).write.mode("overwrite").parquet(f"{self.root}/weights")
        return self._weights()

    def written(self, batch: int, attempt: str) -> DataFrame:
        """Articles of an attempt, whether or not it is finished."""
        return self.spark.read.schema(ARTICLES).parquet(f"{self.root}/articles/batch={batch}/attempt={attempt}")

    def write_articles(self, rows: DataFrame, batch: int, attempt: str = "only") -> None:
        self._write(rows, "articles", batch, attempt)

    def write_sets(self, articles: DataFrame, known: dict[str, KnownSets], batch: int, attempt: str = "only") -> None:
        """Keys and postings of the feature sets that `articles` add to what is known."""
        keys, postings, weights = [], [], self._fixed_weights(articles)
        for kind, vector in KINDS.items():
            by = replace(known[kind], weights=weights.get(kind))
            new = new_sets(articles.select("id", F.col(vector).alias("features")), by, self.least_threshold)
            for part, all_ in zip(new, (keys, postings)):
                all_.append(part.withColumn("kind", F.lit(kind)))
        self._write(keys[0].unionByName(keys[1]).select(*SETS.fieldNames()), "sets", batch, attempt)
        self._write(postings[0].unionByName(postings[1]).select(*POSTINGS.fieldNames()), "postings", batch, attempt)

    def write_run(self, row: DataFrame, batch: int, attempt: str = "only") -> None:
        self._write(row, "runs", batch, attempt)

    def write_sources(self, rows: DataFrame, batch: int, attempt: str = FIRST) -> None:
        self._write(rows, "sources", batch, attempt)
