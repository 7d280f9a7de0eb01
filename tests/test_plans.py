"""Shapes of physical plans that must hold at scale."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from newsloom.operators import dedup
from newsloom.plans import fresh, report
from newsloom.workload import views

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_keep_first_cuts_groups_before_the_shuffle(spark):
    for df in (
        dedup.unique_urls(views.raw_batch(spark, SF), ["ord"]),
        fresh.first_entries(views.raw_batch(spark, SF).withColumn("position", F.col("ord")), 8),
    ):
        assert plan(df).count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", [
    "a2_articles_per_source", "d3_content_duplicates", "d2_new_urls", "j3_fresh_entries", "p10_language",
])
def test_no_pairwise_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_report_does_not_read_texts_it_does_not_need(spark):
    text = plan(report.language_breakdown(views.articles(spark, SF)))
    reads = [line for line in text.splitlines() if line.startswith("ReadSchema") and "lang" in line]
    assert reads and all("text" not in line for line in reads)


def test_entry(spark):
    assert entry.entry(spark).count() == 25


def test_what_is_stored_is_not_exploded_again(spark, tmp_path, monkeypatch):
    """A batch looks its own coordinates up; stored feature sets are read for the articles met, and only joined."""
    from newsloom.operators import nearest

    rows = spark.createDataFrame([(i, [i, i + 1, i + 2, 500 + i // 2]) for i in range(40)], "id bigint, features array<bigint>")
    known = nearest.known_sets(rows, 0.6)
    stored = {}
    for name in ("keys", "postings", "features"):
        getattr(known, name).write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    plans, write = [], nearest.stage
    monkeypatch.setattr(nearest, "stage", lambda df, name: (plans.append(plan(df)), write(df, name))[1])
    batch = spark.createDataFrame([(100 + i, [i, i + 1, i + 2, 900 + i]) for i in range(3)], "id bigint, features array<bigint>")
    found = nearest.nearest_known_sets(batch, nearest.KnownSets(**stored), 0.6)
    assert found.count() == 3
    reading = {name: [p for p in plans if str(tmp_path / name) in p] for name in stored}
    assert reading["features"] and reading["postings"]
    for p in reading["features"]:
        assert "Generate" not in p and "Window" not in p
    for p in reading["postings"]:
        assert "LeftSemi" in p
