"""The registered queries against their SQL, and the pipeline against its stages by brute force."""

import os

import pytest

import corpus_pipeline
from compare import check, duck
from newsloom.llm import all_queries
from newsloom.session import stage

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def similar(a, b):
    return min(len(a), len(b)) * 5 >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b)


@pytest.mark.parametrize("name", sorted(all_queries.ORACLE))
def test_query(spark, name):
    assert check(spark, duck(SF), SF, name, all_queries.QUERIES[name], all_queries.ORACLE[name]) is None


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in all_queries.QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = stage(function(spark, docs, SF), name)
        assert docs.columns == columns
        now = {r.doc_id: r for r in docs.collect()}
        assert set(now) <= set(kept) and len(now) > 0.7 * len(kept)
        if name == "simhash_near_dedup":
            gone = set(kept) - set(now)
            sets = {k: shingles(r.text) for k, r in kept.items()}
            assert not any(similar(sets[a], sets[b]) for a in now for b in now if a < b)
            # What goes has a similar text, the first of each group stays.
            assert all(any(similar(sets[a], sets[b]) for b in kept if b != a) for a in gone)
        kept = now
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert mixed.columns[:len(columns)] == columns and 0 < mixed.count() and {r.doc_id for r in mixed.collect()} <= set(kept)


def test_pipeline_on_odd_rows(spark, odd_documents):
    from pyspark.sql import functions as F

    for docs in (odd_documents, odd_documents.limit(0)):
        docs = docs.withColumns({"kept": F.lit(1), "c0": F.lit("x"), "print": F.lit(2), "places": F.lit("y")})
        columns = docs.columns
        for name, function in corpus_pipeline.STAGES:
            docs = stage(function(spark, docs, SF), name)
            assert docs.columns[:len(columns)] == columns
        rows = docs.collect()
        # Of the two texts of 30,000 words one is left, of the repeated rows one, and the text without a key.
        assert {(r.doc_id, r.source) for r in rows} <= {(1, "src1"), (1, "src2"), (None, None), (5, "src1")}


def test_operators_import_nothing_the_library_does_not_have():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(os.path.join(root, "newsloom")):
        if "llm" in folder.split(os.sep):
            continue
        for n in names:
            if n.endswith(".py"):
                assert "newsloom.llm" not in open(os.path.join(folder, n)).read()
