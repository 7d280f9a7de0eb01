"""Blocks of dense vectors: sketches rule pairs out, and never a match."""

import numpy as np
import pytest

from newsloom.operators import nearest


def unit(rows):
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def word_counts(n, width=96, seed=2):
    """Counts with a common mean, as of texts of one language, and near copies of some."""
    rng = np.random.default_rng(seed)
    rows = rng.poisson(rng.gamma(0.5, 2.0, width), (n, width)).astype("float64") + 1e-3
    rows[n // 2::5] = rows[:n // 2:5][:len(rows[n // 2::5])] + (rng.random((len(rows[n // 2::5]), width)) < 0.05)
    return unit(rows)


def brute(q_id, a, c_id, b, threshold, earlier, exclude_self):
    sims, found = np.round(a @ b.T, 9), {}
    for i, row in enumerate(sims):
        allowed = (c_id < q_id[i]) if earlier else (c_id != q_id[i]) if exclude_self else np.ones(len(c_id), bool)
        row = np.where(allowed, row, -2)
        if row.max() >= threshold:
            found[int(q_id[i])] = (int(c_id[row.argmax()]), float(row.max()))
    return found


@pytest.mark.parametrize("threshold", [0.4, 0.92, 0.97, 1.0])
@pytest.mark.parametrize("earlier, exclude_self", [(True, False), (False, True), (False, False)])
def test_best_of_a_block(monkeypatch, threshold, earlier, exclude_self):
    monkeypatch.setattr(nearest, "SKETCH_PAIRS", 1)
    monkeypatch.setattr(nearest, "HELD_NUMBERS", 20_000)
    v, ids = word_counts(600), np.arange(600) * 3
    q, c = slice(0, 600, 2), slice(0, 600)
    got = nearest._block_best(ids[q], v[q], ids[c], v[c], threshold, earlier, exclude_self)
    want = brute(ids[q], v[q], ids[c], v[c], threshold, earlier, exclude_self)
    assert {int(i): int(m) for i, m in zip(got.id, got.match_id)} == {i: m for i, (m, _) in want.items()}
    assert np.allclose(sorted(got.similarity), sorted(s for _, s in want.values()), atol=1e-9) if want else got.empty


def test_few_pairs_are_compared_exactly(monkeypatch):
    monkeypatch.setattr(nearest, "SKETCH_PAIRS", 1)
    monkeypatch.setattr(nearest, "HELD_NUMBERS", 40_000)
    compared, best = [], nearest._row_best

    def counted(q_id, c_id, similarity, *more):
        compared.append(similarity.size)
        return best(q_id, c_id, similarity, *more)

    monkeypatch.setattr(nearest, "_row_best", counted)
    v, ids = word_counts(2_000), np.arange(2_000)
    x, y, limit = nearest._sketched(v, v, 0.97)
    assert x.shape[1] < v.shape[1] and x.dtype == y.dtype == np.float32
    assert (v @ v.T)[x @ y.T < limit].max() < 0.97
    found = nearest._block_best(ids, v, ids, v, 0.97, True, False)
    assert len(found) > 100 and sum(compared) < len(v) ** 2 / 20


def test_no_sketches_where_most_pairs_match(monkeypatch):
    monkeypatch.setattr(nearest, "SKETCH_PAIRS", 1)
    v = unit(1 + 0.01 * np.random.default_rng(1).normal(size=(300, 32)))
    assert nearest._sketched(v, v, 0.92) is None
    ids = np.arange(300)
    assert dict(zip(*[nearest._block_best(ids, v, ids, v, 0.92, True, False)[c] for c in ("id", "match_id")])) == {
        i: m for i, (m, _) in brute(ids, v, ids, v, 0.92, True, False).items()}
