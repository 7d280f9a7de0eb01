"""Trigrams of long texts are counted a few texts at once."""

import pyarrow as pa

from newsloom.operators import language


def test_batches_are_cut_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(language, "SLICE_BYTES", 1_000)
    texts = ["ab" * 10] * 50 + ["long text " * 300] + ["cd" * 200] * 40
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], names=["lang", "text"])
    parts = list(language.slices(batch))
    assert sum(p.num_rows for p in parts) == len(texts)
    assert all(p.num_rows == 1 or p.nbytes <= 2_000 for p in parts)
    df = spark.createDataFrame([("en", t) for t in texts] + [(None, "x" * 9), ("fr", None)], "lang string, text string")
    got = {(r.lang, r.gram): r.n for r in language.trigram_counts(df).collect()}
    want = {}
    for t in texts:
        for i in range(len(t) - 2):
            want[("en", t[i:i + 3])] = want.get(("en", t[i:i + 3]), 0) + 1
    assert got == want
