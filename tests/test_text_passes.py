"""Texts are gone over once, not once for each use or pattern."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from newsloom.functions import features, page_text, text as tx
from newsloom.operators import language
from newsloom.workload import views


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_no_pattern_runs_over_whole_texts(spark):
    rows = spark.createDataFrame([(" \x85　a &amp; b c\t",), ("   ",), ("",), (None,)], "t string")
    spaces = rows.select(features.trimmed(F.col("t")).alias("trimmed"), tx.normalise(F.col("t")).alias("plain"))
    assert "regexp" not in _plan(spaces)
    assert [tuple(r) for r in spaces.collect()] == [("a &amp; b c", "a & b c"), ("", None), ("", None), (None, None)]
    counted = rows.select(tx.collapsed_word_count(tx.normalise(F.col("t"))).alias("n"), tx.word_count(F.col("t")).alias("w")).collect()
    assert [r.n for r in counted] == [r.w for r in counted] == [4, 0, 0, 0]


def test_titles_and_summaries_are_made_once(spark, tmp_path):
    spark.createDataFrame([(1, "A title \n more \nrest\nof it"), (2, "one"), (3, "\n\nx"), (4, None)], "doc_id bigint, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    rows = views.embedded(spark, str(tmp_path))
    assert _plan(rows).count("split_part") + _plan(rows).count("StringSplitSQL") + _plan(rows).count("stringsplitsql") <= 2
    lines = spark.read.parquet(f"{tmp_path}/documents.parquet").select("doc_id", views._title().alias("t"), views._summary().alias("s"))
    assert {r.doc_id: (r.t, r.s) for r in lines.collect()} == {1: ("A title", "more"), 2: ("one", None), 3: ("", None), 4: (None, None)}


@pytest.mark.parametrize("n", range(1, 6))
def test_sets_of_short_and_long_texts(spark, n):
    words = ["b", "a", "b", "a", "b"][:n]
    runs = {" ".join(words[i:i + 3]) for i in range(max(n - 2, 1))}
    want = [r.h for r in spark.createDataFrame([(r,) for r in runs], "t string").select(F.xxhash64("t").alias("h")).collect()]
    got = spark.createDataFrame([(" ".join(words),)], "t string").select(features.feature_set(F.col("t")).alias("s")).first().s
    assert got == sorted(want)


@pytest.mark.parametrize("cells", [0, 1 << 21])
def test_trigrams_by_table_and_by_sorting(monkeypatch, cells):
    monkeypatch.setattr(language, "CELLS", cells)
    texts = ["", "ab", "abcab\x00", "x", "", "\U0001f600\U0001f600abc", "abcabc", ""]
    grams, n = language._counted(texts)
    assert dict(zip(grams, n.tolist())) == Counter(t[i:i + 3] for t in texts for i in range(len(t) - 2))
    assert language._counted(["ab", "", "c"])[0] == []


def test_only_elements_that_are_closed_are_searched(spark):
    long = "word " * 9
    html = (f"<NAV a='1'>x</Nav ><div><p>{long}</p><p>short</p><Script>var t='</p>'</script><p>&lt;{long}<footer>kept <p>{long}</div>")
    page = spark.createDataFrame([(html,), ("",), (None,)], "html string")
    out = [r.o for r in page_text.with_page_text(page, "html", "o").collect()]
    plain = long.strip()
    assert out == [f"{plain}\n\n<{plain} kept\n\n{plain}", "", ""]
    noise = page.select(page_text.drop_noise(F.col("html")).alias("n")).first().n
    assert "Script" not in noise and "NAV" not in noise and "<footer>" in noise
