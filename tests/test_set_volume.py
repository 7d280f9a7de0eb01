"""What the joins of feature sets move."""

import numpy as np
from pyspark.sql import functions as F

from newsloom.operators import dedup, nearest
from newsloom.operators.bits import Bits
from newsloom.session import stage


def test_bits_lose_nothing(spark):
    values = stage(spark.range(0, 5000, 5).withColumn("v", F.when(F.col("id") > 0, F.col("id"))), "values")
    found = spark.range(5000).withColumn("v", F.when(F.col("id") > 0, F.col("id"))).where(Bits(values, "v").maybe("v"))
    ids = {r.id for r in found.collect()}
    assert ids >= set(range(0, 5000, 5)) and len(ids) < 1500


def test_only_sets_that_are_compared_are_moved(spark, monkeypatch):
    """Of 600 sets, 20 have a near copy; features of the others are neither shuffled nor written."""
    rng = np.random.default_rng(3)
    sets = [sorted(int(x) for x in rng.integers(0, 1 << 60, 50)) for _ in range(600)]
    sets += [s[:48] + [int(x) for x in rng.integers(0, 1 << 60, 2)] for s in sets[:20]]
    rows = spark.createDataFrame([(i, sorted(s), True) for i, s in enumerate(sets)], "id bigint, features array<bigint>, asks boolean")
    rows, written, write = stage(rows, "rows"), {}, nearest.stage

    def counted(df, name):
        out = write(df, name)
        if "features" in out.columns:
            written[name] = out.count()
        return out

    monkeypatch.setattr(nearest, "stage", counted)
    found = nearest.nearest_earlier_sets(rows, 0.92).collect()
    assert {(r.id, r.match_id) for r in found} == {(600 + i, i) for i in range(20)}
    assert written and max(written.values()) < 100


def test_parities_rule_out_no_match(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(200):
        a = {int(x) for x in rng.integers(-(1 << 62), 1 << 62, 40)}
        rows.append((i, sorted(a), sorted({x for x in a if rng.random() > 0.1} | {int(x) for x in rng.integers(0, 1 << 62, 3)})))
    df = spark.createDataFrame(rows, "id bigint, a array<bigint>, b array<bigint>")
    pa, pb = nearest._parities(F.col("a")), nearest._parities(F.col("b"))
    apart = sum(F.bit_count(x.bitwiseXOR(y)) for x, y in zip(pa, pb))
    differ = F.size(F.array_except("a", "b")) + F.size(F.array_except("b", "a"))
    assert df.select("id", apart.alias("x"), differ.alias("d")).where("x > d").count() == 0
    assert df.where(apart > 0).count() > 150


def test_insert_orders_only_urls(spark):
    """Rows that repeat each other in place and URL, and rows without a URL, come once, as before."""
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, "u/a", text), (1, "u/a", text), (2, None, text), (3, None, "x"), (4, "U/A", "y"), (5, "u/b", "of its own " * 9)]
    batch = stage(spark.createDataFrame(rows, "ord long, url string, full_text string").select(
        "ord", F.lit(1).alias("source_id"), F.lit("t").alias("title"), "url", F.lit(None).cast("string").alias("author"),
        F.lit(None).cast("timestamp").alias("published_at"), F.lit(None).cast("string").alias("summary"), "full_text",
        F.lit(1).alias("word_count"), F.lit("en").alias("language"), F.lit(True).alias("is_clean")), "batch")
    added = dedup.dedup_insert(spark.createDataFrame([], dedup.ARTICLES), batch, ["ord"])
    got = [(r.id, r.url, r.is_duplicate) for r in added.rows.orderBy("id").collect()]
    assert got == [(1, "u/a", False), (2, None, True), (3, "u/b", False)]
    assert added.counters.first().found == 6
