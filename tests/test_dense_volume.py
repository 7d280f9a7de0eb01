"""What dense searches move and hold."""

import numpy as np
from pyspark.sql import functions as F

from newsloom.operators import nearest


def vectors(spark, n, width=16):
    rng = np.random.default_rng(8)
    rows = rng.normal(size=(n, width))
    rows[n // 2:] = rows[:n - n // 2] + rng.normal(size=(n - n // 2, width)) * 0.3
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    return unit, spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)], "id bigint, vector array<double>")


def best_others(unit, threshold):
    sims = np.round(unit @ unit.T, 9)
    np.fill_diagonal(sims, -1)
    return {i: int(sims[i].argmax()) for i in range(len(unit)) if sims[i].max() >= threshold}


def test_a_query_is_sent_once_to_a_shelf(spark, monkeypatch):
    """300 vectors in cells of 3: a query visits many cells, but no more than three shelves."""
    visits, write = [], nearest.stage

    def seen(df, name):
        out = write(df, name)
        if name == "visits":
            visits.append(out.select(F.max(F.size("cells"))).first()[0])
        return out

    monkeypatch.setattr(nearest, "stage", seen)
    monkeypatch.setattr(nearest, "SHELF_ROWS", 128)
    unit, df = vectors(spark, 300)
    found = nearest.nearest_vectors(df, df, 0.4, cell_rows=3, exclude_self=True)
    assert {r.id: r.match_id for r in found.collect()} == best_others(unit, 0.4)
    assert visits and max(visits) <= 4


def test_shelves_with_blocks_and_slices(spark, monkeypatch):
    """Cells above a shelf's size are cut into blocks, similarities are held a few rows at once."""
    monkeypatch.setattr(nearest, "SHELF_ROWS", 20)
    monkeypatch.setattr(nearest, "HELD_NUMBERS", 64)
    unit, df = vectors(spark, 150)
    found = nearest.nearest_vectors(df, df, 0.4, pivots=2, exclude_self=True)
    assert {r.id: r.match_id for r in found.collect()} == best_others(unit, 0.4)


def test_probes_keep_pivots_apart():
    cell = np.array([0, 1, 64, 65, 128])
    assert nearest._shelved(cell, np.ones(5, int), 100, True).tolist() == [0, 0, 1, 1, 2]
    assert nearest._shelved(cell, np.ones(5, int), 100, False).tolist() == [0] * 5
    assert nearest._shelved(cell, np.array([2, 2, 2, 5, 1]), 4, False).tolist() == [0, 0, 1, 2, 3]


def test_distances_are_held_in_slices(spark, monkeypatch):
    """No more than HELD_NUMBERS distances at once, whatever an Arrow batch holds."""
    monkeypatch.setattr(nearest, "HELD_NUMBERS", 1_000)
    import pandas as pd

    pivots = np.eye(50)
    cells = nearest.Cells(spark, pivots, 1 / 16)
    frame = pd.DataFrame({"id": range(333), "vector": list(np.ones((333, 50)))})
    parts = list(cells._slices([frame]))
    assert max(len(p) for p in parts) == 20 and sum(map(len, parts)) == 333
