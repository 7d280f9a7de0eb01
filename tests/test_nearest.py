"""Neighbour joins against brute force, with hot groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators import nearest
from newsloom.operators.joins import skew_safe_join, without_stored_prefix


def brute_sets(queries, candidates, threshold, allowed):
    best = {}
    for q, a in queries.items():
        for c, b in candidates.items():
            if allowed(q, c):
                s = len(a & b) / (len(a) * len(b)) ** 0.5
                if s >= threshold and (q not in best or (-s, c) < best[q]):
                    best[q] = (-s, c)
    return {q: (c, -s) for q, (s, c) in best.items()}


def make_sets(n, seed=1):
    """A third exact copies, a third near copies of one template, a third of its own."""
    rng = np.random.default_rng(seed)
    template = list(range(60))
    sets = {}
    for i in range(n):
        if i % 3 == 0:
            sets[i] = frozenset(range(1000, 1040))
        elif i % 3 == 1:
            changed = [f for f in template if rng.random() > 0.03] + list(rng.integers(10_000, 10_040, 2))
            sets[i] = frozenset(int(x) for x in changed)
        else:
            sets[i] = frozenset(int(x) for x in rng.integers(100_000, 100_000 + 20 * n, rng.integers(1, 30)))
    return sets


def frame(spark, sets):
    return spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "id bigint, features array<bigint>")


def result(df):
    return {r.id: (r.match_id, r.similarity) for r in df.collect()}


@pytest.mark.parametrize("threshold, light", [(0.92, 65_536), (0.8, 20)])
def test_earlier_sets(spark, monkeypatch, threshold, light):
    monkeypatch.setattr(nearest, "LIGHT_PAIRS", light)
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 16)
    sets = make_sets(240)
    asks = F.col("id") % 10 != 9
    got = result(nearest.nearest_earlier_sets(frame(spark, sets).withColumn("asks", asks), threshold))
    want = brute_sets(sets, sets, threshold, lambda q, c: c < q and q % 10 != 9)
    assert got == want


def test_sets_of_two_tables(spark, monkeypatch):
    monkeypatch.setattr(nearest, "LIGHT_PAIRS", 20)
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 16)
    a, b = make_sets(150, 2), make_sets(200, 3)
    got = result(nearest.nearest_sets(frame(spark, a), frame(spark, b), 0.9))
    assert got == brute_sets(a, b, 0.9, lambda q, c: True)


def make_vectors(n):
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(n, 12)) * 0.3 + 1 * (rng.integers(0, 3, n)[:, None] == np.arange(12) % 3)
    rows[::3] = rows[0]
    rows[1::6] = rows[0] * 3
    return rows


def brute_vectors(q, c, threshold, allowed):
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = np.round(unit(q) @ unit(c).T, 9)
    out = {}
    for i in range(len(q)):
        fit = [(-sims[i, j], j) for j in range(len(c)) if allowed(i, j) and sims[i, j] >= threshold]
        if fit:
            out[i] = min(fit)[1]
    return out


def vector_frame(spark, rows):
    return spark.createDataFrame(
        [(i, [float(x) for x in r]) for i, r in enumerate(rows)], "id bigint, vector array<double>")


def test_earlier_vectors(spark, monkeypatch):
    monkeypatch.setattr(nearest, "DENSE_BLOCK_ROWS", 20)
    rows = make_vectors(240)
    df = vector_frame(spark, rows).withColumn("asks", F.lit(True))
    got = {i: m for i, (m, s) in result(nearest.nearest_earlier_vectors(df, 0.9, pivots=12)).items()}
    assert got == brute_vectors(rows, rows, 0.9, lambda q, c: c < q)


def test_vectors_of_two_tables_and_probes(spark, monkeypatch):
    monkeypatch.setattr(nearest, "DENSE_BLOCK_ROWS", 20)
    rows = make_vectors(240)
    q, c = rows[:90], rows[60:]
    exact = {i: m for i, (m, s) in result(
        nearest.nearest_vectors(vector_frame(spark, q), vector_frame(spark, c), 0.9)).items()}
    assert exact == brute_vectors(q, c, 0.9, lambda a, b: True)
    approximate = nearest.nearest_vectors(vector_frame(spark, q), vector_frame(spark, c), 0.9, probes=1)
    assert set(result(approximate)) <= set(exact)


def test_nearest_to_leaves_out_the_query(spark):
    rows = vector_frame(spark, np.eye(4) + 0.1)
    hit = nearest.nearest_to(rows, rows.where("id = 2"), "vector", ["id"]).first()
    assert hit.id == 0 and hit.query_id == 2


def test_skew_safe_join_keeps_everything(spark):
    left = spark.range(3000).select("id", F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("k"))
    right = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v")).union(
        spark.createDataFrame([(7, 70)], "k bigint, v bigint"))
    for how in ("inner", "left"):
        want = sorted(map(tuple, left.join(right, "k", how).collect()), key=str)
        assert sorted(map(tuple, skew_safe_join(left, right, ["k"], how).collect()), key=str) == want


def test_prefix_anti_join(spark):
    stored = ["http://a/1", "http://a/12", "http://b/%", "http://c/x_y", "http://d/long/path/1"]
    fresh = ["http://a/1", "http://a/", "http://a/2", "http://b/%", "http://b/_", "http://c/x-y", "http://d/long",
             "http://e", "http://d/long/path/11", "http://d/long", None]
    left = spark.createDataFrame([(f,) for f in fresh], "k string")
    right = spark.createDataFrame([(s,) for s in stored], "k string")
    got = [r.k for r in without_stored_prefix(left, right, "k").collect()]
    want = [f for f in fresh if f is None or not any(s.startswith(f) for s in stored)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_known_sets_give_what_one_table_gives(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 16)
    stored, batch = make_sets(200, 3), {1000 + i: s for i, s in make_sets(150, 2).items()}
    for light in (65_536, 20):
        monkeypatch.setattr(nearest, "LIGHT_PAIRS", light)
        rows = frame(spark, stored)
        first = nearest.known_sets(rows.where("id < 100"), 0.9)
        keys, postings = nearest.new_sets(rows.where("id >= 100"), first, 0.9)
        known = nearest.KnownSets(first.keys.unionByName(keys), first.postings.unionByName(postings), rows)
        assert known.keys.count() == len(set(stored.values()))
        got = result(nearest.nearest_known_sets(frame(spark, batch), known, 0.9))
        assert got == brute_sets(batch, stored, 0.9, lambda q, c: True)


def test_zero_and_endless_vectors_hide_nothing(spark):
    rows = [(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.01]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, None)]
    df = spark.createDataFrame(rows, "id bigint, vector array<double>")
    got = result(nearest.nearest_earlier_vectors(df.withColumn("asks", F.lit(True)), 0.9, pivots=2, cell_rows=1))
    assert {i: m for i, (m, _) in got.items()} == {2: 1}
    got = result(nearest.nearest_vectors(df, df, 0.9, exclude_self=True))
    assert {i: m for i, (m, _) in got.items()} == {1: 2, 2: 1}
    assert nearest.nearest_to(df, df.where("id = 1"), "vector", ["id"]).first().id == 2


def test_nearest_others_with_copies(spark):
    m = make_vectors(60)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id bigint, vector array<double>")
    got = result(nearest.nearest_vectors(df, df, 0.5, cell_rows=8, exclude_self=True))
    assert {i: v[0] for i, v in got.items()} == brute_vectors(m, m, 0.5, lambda q, c: q != c)
