"""Entries land in parts that all their tasks write, one micro-batch each."""

from pathlib import Path

from pyspark.sql import functions as F

from newsloom.streaming.ingest import LANDED_ENTRIES
from newsloom.workload import jobs


def test_every_part_is_written_by_many_tasks_and_is_one_batch(spark, monkeypatch):
    known = {"source_id": F.when(F.col("id") % 3 > 0, F.col("id") % 20), "url": F.concat(F.lit("u"), F.col("id").cast("string"))}
    entries = spark.range(0, 400, 1, 4).select(*[
        known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LANDED_ENTRIES])
    paths, batches, files = [], [], []
    monkeypatch.setattr(jobs, "scratch_path", lambda s, name, make=jobs.scratch_path: paths.append(make(s, name)) or paths[-1])

    def run_batch(store, batch, rows, pages, profiles, threshold, damaged=0):
        files.append(len([*Path(paths[0]).glob("part-*")]))
        batches.append((batch, {r.source_id for r in rows.collect()}, rows.count()))

    monkeypatch.setattr("newsloom.streaming.ingest.run_batch", run_batch)
    jobs._ingest_in_two(spark, None, None, entries, None)
    want = [entries.where(c).count() for c in ("source_id < 10", "source_id >= 10")]
    assert batches == [(1, {*range(10)}, want[0]), (2, {*range(10, 20)}, want[1])]
    assert files == [4, 8]
