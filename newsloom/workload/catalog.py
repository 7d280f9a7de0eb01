"""Registry of the checked queries: a Spark function and, where SQL can say it, the same as SQL."""

from __future__ import annotations

import functools

from newsloom.workload.views import with_views

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def in_utc(function):
    """The query in a session whose clock is UTC, which all time stamps here are in."""

    @functools.wraps(function)
    def run(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    return run


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = in_utc(function)
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return function

    return add
