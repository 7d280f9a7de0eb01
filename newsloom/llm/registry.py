"""Queries of this package and, where SQL can say it, the same as SQL."""

from __future__ import annotations

from newsloom.llm.batches import bounded_batches

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        def run(spark, sf_dir):
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            bounded_batches(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
