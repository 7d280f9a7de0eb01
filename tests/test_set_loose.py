"""What the join of feature sets compares at a loose threshold."""

import numpy as np

from newsloom.operators import nearest
from newsloom.session import stage


def test_unlike_sets_with_rare_coordinates_in_common_are_ruled_out(spark, monkeypatch):
    """30 pairs at cosine 0.6 share their rarest coordinates; their features need not meet at threshold 0.80, those of 10 near copies do."""
    rng = np.random.default_rng(5)
    own = lambda n: [int(x) for x in rng.integers(1 << 40, 1 << 60, n)]
    pool = own(300)
    often = lambda: [pool[i] for i in rng.choice(300, 75, replace=False)]
    sets = []
    for _ in range(30):
        shared = own(75)
        sets += [shared + often(), shared + often()]
    for s in sets[:20:2]:
        sets.append(s[:65] + own(10) + s[75:])
    rows = spark.createDataFrame([(i, sorted(s), True) for i, s in enumerate(sets)], "id bigint, features array<bigint>, asks boolean")
    rows, kept, write = stage(rows, "rows"), {}, nearest.stage

    def counted(df, name):
        out = write(df, name)
        kept[name] = out.count()
        return out

    monkeypatch.setattr(nearest, "stage", counted)
    found = {(r.id, r.match_id) for r in nearest.nearest_earlier_sets(rows, 0.80).collect()}
    assert found == {(60 + i, 2 * i) for i in range(10)}
    assert kept["pairs"] >= 40 and kept["near-pairs"] == 10
