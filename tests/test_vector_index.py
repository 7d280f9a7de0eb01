"""The stored vector index and the hash tables against brute force."""

import contextlib
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators.lsh import lsh_nearest, planes, probe_order
from newsloom.operators.nearest import nearest_vectors
from newsloom.operators.vector_index import VectorIndex


def vectors(n, width=12, seed=5):
    """Groups of near vectors, exact copies over all of them, a zero vector and one that is not finite."""
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, width)) * 0.25 + rng.normal(size=(n // 8 + 1, width))[rng.integers(0, n // 8 + 1, n)]
    rows[::7] = rows[0] * 2
    rows[5], rows[6, 0] = 0, np.nan
    return rows


def brute(asked, stored, threshold, exclude_self=False):
    unit = lambda v: v / np.linalg.norm(v)
    fine = lambda v: np.isfinite(v).all() and np.linalg.norm(v) > 0
    out = {}
    for q, a in asked.items():
        sims = [(-round(float(unit(a) @ unit(b)), 9), c) for c, b in stored.items() if fine(a) and fine(b) and (c != q or not exclude_self)]
        if sims and -min(sims)[0] >= threshold:
            out[q] = min(sims)[1]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows.items()], "id bigint, vector array<double>")


@pytest.fixture
def filled(spark, tmp_path):
    rows = dict(enumerate(vectors(300)))
    index = VectorIndex(spark, str(tmp_path / "index"))
    index.fit(frame(spark, {i: v for i, v in rows.items() if i % 3 == 0}), cell_rows=8)
    for batch in (1, 2, 3):
        index.add(frame(spark, {i: v for i, v in rows.items() if i % 3 == batch - 1}), batch)
    return index, rows


def test_batches_give_what_one_table_gives(spark, filled):
    index, rows = filled
    asked = {i: v for i, v in rows.items() if i % 4 == 1}
    for threshold, own in ((0.9, False), (0.9, True), (0.6, True)):
        got = {r.id: r.match_id for r in index.nearest(frame(spark, asked), threshold, exclude_self=own).collect()}
        assert got == brute(asked, rows, threshold, own) and len(got) > 40
    before = {i: v for i, v in rows.items() if i % 3 < 2}
    got = {r.id: r.match_id for r in index.nearest(frame(spark, asked), 0.9, before=3).collect()}
    assert got == brute(asked, before, 0.9)


def test_a_batch_written_again_replaces_itself(spark, filled):
    index, rows = filled
    again = {1000 + i: v for i, v in rows.items() if i % 3 == 1}
    index.add(frame(spark, again), 2)
    now = {i: v for i, v in rows.items() if i % 3 != 1} | again
    got = {r.id: r.match_id for r in index.nearest(frame(spark, rows), 0.9).collect()}
    assert got == brute(rows, now, 0.9)


def test_a_search_opens_only_its_cells(spark, filled):
    index, rows = filled
    stored = index.vectors()
    cells = {r.cell for r in stored.select("cell").distinct().collect()}
    some = sorted(cells)[:2]
    pruned = index.vectors(some)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        pruned.explain("formatted")
    filters = next(line for line in out.getvalue().splitlines() if "PartitionFilters" in line)
    assert len(cells) > 5 and "cell#" in filters and "attempt#" in filters
    assert {r.cell for r in pruned.select("cell").distinct().collect()} == set(some)
    files = {r[0] for r in pruned.select(F.input_file_name()).distinct().collect()}
    assert files and all(any(f"/cell={c}/" in f for c in some) for f in files)


def test_empty_tables(spark, tmp_path):
    index = VectorIndex(spark, str(tmp_path / "none"))
    none = spark.createDataFrame([], "id bigint, vector array<double>")
    one = frame(spark, {1: np.ones(3)})
    assert index.nearest(one, 0.5).count() == 0
    with pytest.raises(ValueError):
        index.add(one, 1)
    index.fit(one)
    index.add(none, 1)
    assert index.nearest(one, 0.5).count() == 0
    index.add(one, 2)
    assert [tuple(r) for r in index.nearest(one, 0.5).collect()] == [(1, 1, 1.0)] and index.nearest(none, 0.5).count() == 0
    assert index.nearest(one, 0.5, exclude_self=True).count() == 0
    assert lsh_nearest(one, none, 0.5).count() == 0 and lsh_nearest(none, one, 0.5).count() == 0


def test_probes_come_in_the_order_of_their_distance():
    margins = np.random.default_rng(1).normal(size=(50, 5))
    turned = probe_order(margins, 26)
    for row, masks in zip(margins, turned, strict=True):
        cost = [sum(row[b] ** 2 for b in range(5) if m >> b & 1) for m in masks.tolist()]
        every = sorted(sum(row[b] ** 2 for b in range(5) if m >> b & 1) for m in range(32) if bin(m).count("1") <= 3)
        assert masks[0] == 0 and len(set(masks.tolist())) == 26 and np.allclose(cost, every)
    assert planes(4, 2, 3).shape == (2, 3, 4)


def test_hash_tables_find_most_neighbours_and_nothing_wrong(spark):
    rows = dict(enumerate(vectors(4000, 32, 7)))
    asked = {i: v for i, v in rows.items() if i % 50 == 0}
    want = brute(asked, rows, 0.8, True)
    exact = {r.id: r.similarity for r in nearest_vectors(frame(spark, asked), frame(spark, rows), 0.8, exclude_self=True).collect()}
    found = lsh_nearest(frame(spark, asked), frame(spark, rows), 0.8, exclude_self=True, bits=8).collect()
    assert len(want) > 60 and set(exact) == set(want)
    assert sum(r.match_id == want.get(r.id) for r in found) >= 0.9 * len(want)
    for r in found:
        assert r.id in exact and r.similarity <= exact[r.id]
    met = lsh_nearest(frame(spark, asked), frame(spark, rows), 0.8, bits=8).collect()
    assert all(r.similarity == 1.0 for r in met) and len(met) == sum(np.isfinite(v).all() and v.any() for v in asked.values())
