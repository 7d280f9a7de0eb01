"""Operator 7 learns from every training document."""

from newsloom.llm import scoring


def test_every_training_document_is_learned_from(spark, monkeypatch):
    rows = [(i, f"the cat number{i % 7} sat on mat{i % 3} and looked at dog{i % 5}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    monkeypatch.setattr(scoring, "learn_in_tasks", lambda model, learn, text: seen.append({r.key for r in learn.collect()}))
    scoring.language_model_scores(docs, sample=20).collect()
    want = {r.doc_id for r in docs.where(~scoring.held_out(docs.doc_id)).collect()}
    assert seen == [want] and len(want) > 120
