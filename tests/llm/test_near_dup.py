import random

import numpy as np
import pytest

from newsloom.llm import shingle_sets
from newsloom.llm.components import connected_components
from newsloom.llm.simhash import fingerprint_of, keep_first, near_duplicates
from newsloom.llm.vantage import Leaf, plant, route, union


def clustered(n, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64)
    near = base[: n // 2].copy()
    for _ in range(3):
        near ^= np.uint64(1) << rng.integers(0, 64, len(near), dtype=np.uint64)
    return np.unique(np.concatenate([base, near]))


def brute(prints, radius=3):
    root = np.arange(len(prints))
    i, j = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius)
    union(root, i, j)
    return root


def test_tree_finds_every_link():
    prints = clustered(1500)
    want = brute(prints)
    for depth in (0, 3, 6):
        tree = plant(prints[::3], depth)
        leaf, visitor, who = route(tree, prints, 3)
        got = np.arange(len(prints))
        at = {int(p): i for i, p in enumerate(prints)}
        for x in np.unique(leaf):
            own = leaf == x
            home = Leaf(prints[who[own & ~visitor]], 3)
            guests = prints[who[own & visitor]]
            i, partner = home.visit(guests)
            for a, b in [*zip(guests[i], partner, strict=True), *zip(*home.links(), strict=True)]:
                union(got, np.array([at[int(a)]]), np.array([at[int(b)]]))
        assert np.array_equal(got, want)
        assert sorted(who[~visitor]) == list(range(len(prints)))


def test_equal_distances_do_not_stop_a_leaf():
    prints = np.array([1 << i for i in range(64)] * 6, dtype=np.uint64)
    assert len(np.unique(Leaf(prints, 3).root)) == 1


def test_components_of_chains_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    hub = [(5, i) for i in range(1000, 1300)]
    found = connected_components(spark.createDataFrame(chain + hub + [(7, 7)], "a bigint, b bigint")).collect()
    want = {i: 100 for i in range(100, 141)} | {5: 5} | {i: 5 for i in range(1000, 1300)}
    assert {r.node: r.root for r in found} == want and len(found) == len(want)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_links_chain_and_keys(spark, documents):
    rng = random.Random(3)
    words = [f"word{rng.randint(0, 10**6)}" for _ in range(400)]
    near = words.copy()
    near[200] = "changed"
    rows = [(10, " ".join(words)), (3, " ".join(near)), (7, " ".join(words)), (20, "something else entirely, quite short"), (21, ""), (22, None)]
    found = {r.doc_id: r for r in near_duplicates(documents([(*r, "en", "s") for r in rows])).collect()}
    prints = {k: fingerprint_of((t or "").encode()) for k, t in rows}
    linked = bin(prints[10] ^ prints[3]).count("1") <= 3
    assert found[10].component == (3 if linked else 7) and found[7].component == found[10].component
    assert found[20].component == 20 and found[21].component == found[22].component == 21
    assert found[21].print == 0


def test_odd_rows(spark, odd_documents):
    rows = near_duplicates(odd_documents, leaf_prints=2).collect()
    assert len(rows) == odd_documents.count()
    firsts = [r for r in rows if r.is_first]
    assert len(firsts) == len({(r.component, r.print) for r in firsts})
    assert len(keep_first(odd_documents).collect()) == len(firsts)
    assert {r.component for r in rows if r.print == 0} == {2}
    assert near_duplicates(odd_documents.limit(0)).count() == 0
    only_null = near_duplicates(odd_documents.where("doc_id IS NULL AND text IS NULL")).collect()
    assert [(r.component, r.is_first) for r in only_null] == [(None, True)]


def test_clashing_columns(documents):
    df = documents([(1, "a b c d", "en", "s"), (2, "a b c d", "en", "s")], extra=["print", "component", "c0", "_row", "is_first"])
    kept = keep_first(df)
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()] == [1]


def test_a_sketch_never_rules_out_what_is_shared():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n, m = rng.integers(1, 400, 2)
        shared = rng.integers(0, min(n, m) + 1)
        pool = rng.integers(0, 2**63, n + m, dtype=np.uint64)
        a, b = np.sort(pool[:n]), np.sort(pool[n - shared:n + m - shared])
        row = np.repeat([0, 1], [n, m])
        x, y = shingle_sets.sketches(row, np.concatenate([a, b]), np.array([n, m]))
        assert shared <= shingle_sets.most_shared(x, y) <= min(n, m)
    many = np.full(300, 8, dtype=np.uint64)
    assert shingle_sets.most_shared(*shingle_sets.sketches(np.zeros(300, int), many, np.array([300, 0]))) == float("inf")


def test_fingerprints_are_those_of_the_bits():
    rng = np.random.default_rng(6)
    n = np.array([3, 0, 1, 50])
    hashed = rng.integers(0, 2**63, int(n.sum()), dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, int(n.sum()), dtype=np.uint64)
    got = shingle_sets._fingerprints(np.repeat(np.arange(4), n), hashed, n)
    for i, at in enumerate(np.cumsum(n) - n):
        own = [int(h) for h in hashed[at:at + n[i]]]
        assert int(got[i]) == sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in own) > len(own))


@pytest.mark.parametrize("small", [False, True])
def test_stage_against_brute_force_similarity(spark, documents, monkeypatch, small):
    import corpus_pipeline

    if small:  # many blocks, heavy shingles in every round, nothing known from the sample
        for name, value in (("BLOCK", 3), ("HEAVY", 4), ("SHARED", 10**6)):
            monkeypatch.setattr(shingle_sets, name, value)
    rng = random.Random(7)
    pool = [[f"w{rng.randint(0, 9999)}" for _ in range(rng.choice([3, 12, 40, 120]))] for _ in range(25)]
    common = [f"c{i}" for i in range(30)]
    rows = []
    for key in range(150):
        words = rng.choice(pool).copy()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 5)}"
        words += common if rng.random() < 0.3 else []
        rows.append((key, " ".join(w.upper() if rng.random() < 0.1 else w for w in words)))
    rows += [(200, ""), (201, " \n"), (202, None)]

    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    sets = [shingles(t) for _, t in rows]
    root, far = np.arange(len(rows)), 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                union(root, np.array([i]), np.array([j]))
                far += bin(fingerprint_of((rows[i][1] or "").encode()) ^ fingerprint_of((rows[j][1] or "").encode())).count("1") > 3
    want = {rows[r][0] for r in range(len(rows)) if not any(root[q] == root[r] for q in range(r))}
    assert far > 10 and len(want) < 140
    rows += [rows[0], (-1, None)]
    got = corpus_pipeline.simhash_near_dedup(spark, documents([(*r, "en", "s") for r in rows], extra=["set", "_set", "n", "first"]), "")
    assert sorted(r.doc_id for r in got.collect()) == sorted([-1, *(want - {200})])
