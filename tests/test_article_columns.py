"""What the view of articles moves."""

import re

from newsloom.workload import views


def test_joins_move_texts_only_for_those_who_ask(spark, tmp_path):
    """Titles and URLs are made before the joins; with large tables on both sides no shuffle holds the text."""
    docs = [(i, f"Title {i}\nSummary\nbody", "en", "src1", 20) for i in range(40)]
    docs = spark.createDataFrame([*docs, (None, None, None, None, None), (7, "Again", "en", "src2", 5)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.repartition(12).write.parquet(f"{tmp_path}/documents.parquet")
    spark.sql("select id event_id, timestamp_seconds(id) ts, id user_id from range(30)").write.parquet(f"{tmp_path}/events.parquet")
    spark.sql("select id doc_id, 1L quality from range(20)").write.parquet(f"{tmp_path}/labels.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = views.articles(spark, str(tmp_path)).select("id", "title", "url")
        plan = found._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        moved = re.findall(r"\) Exchange\nInput[^\n]*", plan)
        rows = sorted(map(tuple, found.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert moved and not any("text#" in m for m in moved)
    assert len(rows) == 42 and (None, None, None) in rows
    assert [r for r in rows if r[0] == 7] == [
        (7, "Again", "https://src2.example.com/a/7"), (7, "Title 7", "https://src1.example.com/a/7")]
