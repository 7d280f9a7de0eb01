"""Stored sets are found by rare coordinates, and intermediate results of a batch go with it."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators import dedup, maintenance, nearest
from newsloom.session import passing_stages, scratch_path, stage
from newsloom.sources.tables import TableStore


def articles(spark, sets, first=0):
    rows = spark.createDataFrame(
        [(first + i, None if s is None else sorted(s)) for i, s in enumerate(sets)], "id bigint, embedding array<bigint>")
    return maintenance.evolve(rows.withColumn("content_embedding", F.col("embedding")), dedup.ARTICLES, {"is_duplicate": False})


def add(store, rows, batch, attempt="only"):
    known = store.known_sets(before=batch)
    store.write_articles(rows, batch, attempt)
    store.write_sets(store.written(batch, attempt), known, batch, attempt)
    counters = dedup.insert_counters(rows, rows)
    store.write_run(maintenance.run_row(batch, counters, F.current_timestamp(), F.current_timestamp()), batch, attempt)


def make_sets(n, seed=5):
    """Three coordinates are in every set, and first by hash; every tenth set has a near copy among the next n."""
    rng = np.random.default_rng(seed)
    sets = [{1, 2, 3} | {int(x) for x in rng.integers(100, 1 << 60, 37)} for _ in range(n)]
    later = [set(sorted(s)[:39]) | {int(rng.integers(100, 1 << 60))} if i % 10 == 0
             else {1, 2, 3} | {int(x) for x in rng.integers(100, 1 << 60, 37)} for i, s in enumerate(sets)]
    return sets, later


def test_sets_with_common_coordinates_do_not_all_meet(spark, tmp_path, monkeypatch):
    sets, later = make_sets(200)
    store = TableStore(spark, str(tmp_path / "store"))
    add(store, articles(spark, sets), 1)
    pairs, write = [], nearest.stage

    def counted(df, name):
        out = write(df, name)
        if name in ("pairs", "crowded"):
            pairs.append(out.count())
        return out

    monkeypatch.setattr(nearest, "stage", counted)
    asking = articles(spark, later, 1_000).select("id", F.col("embedding").alias("features"))
    found = nearest.nearest_known_sets(asking, store.known_sets(before=2)["content"], 0.92).collect()
    assert {(r.id, r.match_id) for r in found} == {(1_000 + i, i) for i in range(0, 200, 10)}
    assert pairs and sum(pairs) < 400  # hash order makes 40,000


def test_the_order_of_a_store_never_changes(spark, tmp_path):
    """The second batch is unlike the first, a third finds what either has stored, and replays change no weight."""
    sets, later = make_sets(60)
    other = [{7, 8, 9} | {int(x) for x in np.random.default_rng(i).integers(100, 1 << 60, 37)} for i in range(60)]
    store = TableStore(spark, str(tmp_path / "store"))
    add(store, articles(spark, [None, None]), 1)  # without a set there is no order yet
    add(store, articles(spark, sets, 10), 2)
    before = store.known_sets()["content"].weights
    add(store, articles(spark, other, 1_000), 3)
    add(store, articles(spark, sets, 10), 2, "again")
    known = store.known_sets()["content"]
    assert before.sum() == 60 * 40 and (known.weights == before).all()
    ask = later[:10] + [set(sorted(s)[:39]) | {5} for s in other[:10]]
    asking = articles(spark, ask, 5_000).select("id", F.col("embedding").alias("features"))
    found = {(r.id, r.match_id) for r in nearest.nearest_known_sets(asking, known, 0.92).collect()}
    assert found == {(5_000, 10)} | {(5_010 + i, 1_000 + i) for i in range(10)}


def test_postings_in_hash_order_are_still_found(spark, tmp_path):
    """A store that was begun without weights goes on without."""
    sets, later = make_sets(40)
    store = TableStore(spark, str(tmp_path / "store"))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(TableStore, "_fixed_weights", lambda self, articles: {})
        add(store, articles(spark, sets), 1)
    add(store, articles(spark, later, 1_000), 2)
    assert not os.path.exists(tmp_path / "store/weights")
    asking = articles(spark, later, 5_000).select("id", F.col("embedding").alias("features"))
    found = {(r.id, r.match_id) for r in nearest.nearest_known_sets(asking, store.known_sets()["content"], 0.92).collect()}
    assert found == {(5_000 + i, 1_000 + i) for i in range(40)}


def test_stages_of_a_batch_are_removed(spark, tmp_path):
    outside = stage(spark.range(5), "outside")
    with pytest.raises(ValueError), passing_stages(spark):
        inside, kept = stage(spark.range(3), "inside"), stage(spark.range(4), "kept", lasting=True)
        raise ValueError
    folders = [os.path.dirname(f.removeprefix("file://")) for df in (inside, kept, outside) for f in df.inputFiles()[:1]]
    assert [os.path.exists(f) for f in folders] == [False, True, True]
    assert kept.count() == 4 and stage(spark.range(6), "after").count() == 6 and scratch_path(spark, "x")
