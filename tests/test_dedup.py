"""Deduplicating insert, cleaning, admission and maintenance on hand-made rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.operators import admission, clean, dedup, maintenance
from newsloom.operators.ids import assign_ids
from newsloom.operators.language import train_profiles
from newsloom.plans import report
from newsloom.schema import ARTICLES, CLEAN_ARTICLES, SOURCES

ROCKET = (
    "The small rocket left the coast at dawn and carried twelve weather satellites into orbit, where they will "
    "watch storms over the ocean for the next ten years, according to the agency that paid for the flight."
)
BREAD = (
    "Bakers across the valley say that slow dough, cool cellars and patience make better bread than any machine, "
    "and a new school wants to teach the craft to young people who are looking for steady work."
)
BATCH = T.StructType([T.StructField("ord", T.LongType())] + CLEAN_ARTICLES.fields)


def batch(spark, rows):
    """rows: (ord, url, title, full_text)"""
    return spark.createDataFrame(
        [(o, 1, t, u, None, None, None, x, None, "en", True) for o, u, t, x in rows], BATCH)


def empty(spark):
    return spark.createDataFrame([], ARTICLES)


def rows_of(df):
    return {r.url: r for r in df.collect()}


def test_flagged_rows_are_stored_and_chain_to_the_nearest(spark):
    added = dedup.dedup_insert(empty(spark), batch(spark, [
        (1, "http://a/1", "Rocket", ROCKET), (2, "http://a/2", "Bread", BREAD),
        (3, "http://b/1", "Other", ROCKET), (4, "http://c/1", "Third", ROCKET.replace("the flight.", "the trip.")),
        (5, "HTTP://A/1", "Again", BREAD), (6, "http://d/1", "Short", "tiny"), (7, "http://e/1", "Tiny", "tiny"),
    ]), ["ord"])
    got = rows_of(added.rows)
    assert set(got) == {"http://a/1", "http://a/2", "http://b/1", "http://c/1", "http://d/1", "http://e/1"}
    assert [got[u].id for u in ("http://a/1", "http://a/2", "http://b/1", "http://c/1")] == [1, 2, 3, 4]
    assert (got["http://b/1"].is_duplicate, got["http://b/1"].duplicate_of_id, got["http://b/1"].similarity_score) == (
        True, 1, 1.0)
    assert got["http://c/1"].duplicate_of_id == 1 and 0.92 <= got["http://c/1"].similarity_score < 1
    # Texts under 50 characters are candidates but do not ask.
    assert not got["http://e/1"].is_duplicate and got["http://e/1"].content_embedding
    # Flagged rows count as inserted and as skipped.
    assert added.counters.first().asDict() == {
        "found": 7, "inserted": 6, "skipped_vector": 2, "skipped_url": 1, "skipped": 3}


def test_general_match_has_the_threshold_as_score(spark):
    long = " ".join(f"word{i}" for i in range(80))
    other = " ".join(f"word{i}" for i in range(60)) + " " + " ".join(f"tail{i}" for i in range(400))
    same = dedup.dedup_insert(empty(spark), batch(spark, [
        (1, "http://a/1", long, other), (2, "http://a/2", long, other[:470] + " changed" * 90),
    ]), ["ord"]).rows
    second = rows_of(same)["http://a/2"]
    assert second.is_duplicate and second.duplicate_of_id == 1 and second.similarity_score == 0.92


def test_one_batch_equals_two(spark):
    rows = [(1, "http://a/1", "Rocket", ROCKET), (2, "http://a/2", "Bread", BREAD), (3, "http://a/3", "Copy", BREAD),
            (4, "http://A/1", "Twin", ROCKET), (5, "http://a/5", "Rocket two", ROCKET + " It rained.")]
    whole = dedup.dedup_insert(empty(spark), batch(spark, rows), ["ord"]).rows
    first = dedup.dedup_insert(empty(spark), batch(spark, rows[:2]), ["ord"]).rows
    second = dedup.dedup_insert(first, batch(spark, rows[2:]), ["ord"]).rows
    keep = ["id", "url", "is_duplicate", "duplicate_of_id", "similarity_score"]
    assert sorted(map(tuple, whole.select(keep).collect())) == sorted(
        map(tuple, first.select(keep).union(second.select(keep)).collect()))
    for r in whole.where("is_duplicate").collect():
        assert r.duplicate_of_id < r.id and r.similarity_score >= 0.92


def test_without_vectors_only_the_url_counts(spark):
    added = dedup.dedup_insert(empty(spark), batch(spark, [
        (1, "http://a/1", "Rocket", ROCKET), (2, "http://a/2", "Copy", ROCKET), (3, "http://a/1", "Twin", BREAD),
    ]), ["ord"], use_vectors=False)
    assert [(r.is_duplicate, r.content_embedding) for r in added.rows.collect()] == [(False, None)] * 2
    assert added.counters.first().skipped == 1


def test_insert_by_hand(spark):
    stored = dedup.dedup_insert(empty(spark), batch(spark, [(1, "http://a/1", "Rocket", ROCKET)]), ["ord"]).rows
    hand = spark.createDataFrame(
        [("http://z/1", None, "", ROCKET, "Science")], "url string, title string, summary string, full_text string, category string")
    row = dedup.insert_articles(stored, hand, ["url"]).rows.first()
    assert (row.id, row.title, row.source_id, row.is_clean, row.is_duplicate, row.duplicate_of_id) == (
        2, "(untitled)", None, False, True, 1)
    strict = dedup.insert_articles(stored, hand.withColumn("full_text", F.lit(BREAD)), ["url"], threshold=0.99).rows.first()
    assert not strict.is_duplicate
    assert dedup.with_originals(stored.unionByName(dedup.insert_articles(stored, hand, ["url"]).rows)).first().original_title == "Rocket"


def test_a_dropped_first_row_still_hides_its_twin(spark):
    entries = spark.createDataFrame([
        (1, 1, "abc", "http://a/1", "", None, "text"), (2, 1, "A good title", "http://a/1", "", None, "text"),
        (3, 1, "Caps &amp; more", "http://A/1", " ", None, " some  text "), (4, 1, "No text", "http://a/4", "", None, " &nbsp; "),
    ], "ord int, source_id int, title string, url string, author string, published_at timestamp, full_text string").withColumn(
        "summary", F.lit(None).cast("string"))
    profiles = train_profiles(spark.createDataFrame([("some english text here", "en")], "text string, lang string"))
    rows = clean.clean_articles(entries, profiles, ["ord"]).collect()
    assert [(r.url, r.title, r.full_text, r.author, r.word_count, r.language, r.is_clean) for r in rows] == [
        ("http://A/1", "Caps & more", "some text", None, 2, "en", True)]
    assert rows[0].asDict().keys() == {"ord", *CLEAN_ARTICLES.fieldNames()}
    assert clean.cleaning_counters(entries, ["ord"]).first().asDict() == {
        "rows_in": 4, "duplicate_urls": 1, "no_text": 1, "short_title": 1, "rows_out": 1}


def sources(spark, *rows):
    return spark.createDataFrame([(i, n, u, c, True, None, None) for i, n, u, c in rows], SOURCES)


def test_source_admission(spark):
    text = {"http://f/1": "feed: Space today article: Rocket launch " + ROCKET, "http://f/2": "feed: Bread daily " + BREAD,
            "http://f/3": "feed: Space today article: Rocket launch " + ROCKET, "http://F/2": "feed: Chess " + "knight bishop queen"}
    def with_text(rows):
        df = spark.createDataFrame(rows, "id int, name string, url string, category string, feed string")
        return admission.with_source_vectors(df.withColumn(
            "source_text", admission.source_text(F.col("name"), F.col("category"), F.col("feed"))))
    stored = with_text([(1, "Space", "http://f/1", "Science", text["http://f/1"]), (2, "Bread", "http://f/2", "Food", text["http://f/2"])])
    asked = with_text([(1, "Space 2", "http://f/3", "Science", text["http://f/3"]), (2, "Chess", "http://F/2", "Games", text["http://F/2"]),
                       (3, "Knights", "http://f/9", "Games", "feed: knights")])
    got = {r.name: (r.accepted, r.reason, r.match_name) for r in admission.admit_sources(stored, asked).collect()}
    assert got == {"Space 2": (False, "similar", "Space"), "Chess": (False, "url", None), "Knights": (True, None, None)}


def in_turn(vectors, keys, threshold):
    """Accepted rows when one is judged after the other."""
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in vectors.items() if np.linalg.norm(v)}
    accepted = []
    for i in sorted(vectors):
        similar = any(i in unit and j in unit and round(float(unit[i] @ unit[j]), 9) >= threshold for j in accepted)
        if not similar and not (keys[i] is not None and keys[i].lower() in {(keys[j] or "").lower() for j in accepted}):
            accepted.append(i)
    return accepted


def judged(spark, vectors, keys, threshold):
    schema = "id int, name string, url string, category string, source_embedding array<double>"
    rows = spark.createDataFrame([(i, f"n{i}", keys[i], "c", [float(x) for x in v]) for i, v in vectors.items()], schema)
    return {r.id: r for r in admission.admit_sources(rows.limit(0), rows, threshold).collect()}


@pytest.mark.parametrize("in_one_task", [0, 4_096])
def test_candidates_meet_those_accepted_before_them(spark, monkeypatch, in_one_task):
    monkeypatch.setattr(admission, "IN_ONE_TASK", in_one_task)
    rng = np.random.default_rng(3)
    vectors = {i: rng.normal(size=4) for i in range(24)}
    vectors[7] = vectors[3] * 2
    vectors[9] = np.zeros(4)
    keys = {i: None if i == 5 else f"http://F/{i % 11}" if i % 2 else f"http://f/{i % 11}" for i in vectors}
    got = judged(spark, vectors, keys, 0.7)
    assert sorted(i for i, r in got.items() if r.accepted) == in_turn(vectors, keys, 0.7)
    unit = {i: v / max(np.linalg.norm(v), 1e-9) for i, v in vectors.items()}
    for i, r in got.items():
        if r.reason == "similar":
            best = max((round(float(unit[i] @ unit[j]), 9), -j) for j in got if j < i and got[j].accepted)
            assert (r.similarity, r.match_id, r.match_name) == (best[0], -best[1], f"n{r.match_id}")
    assert {r.reason for r in got.values()} == {None, "similar", "url"}


def test_a_chain_of_candidates_is_judged_link_by_link(spark):
    # Each resembles the one before and the one behind it, and no other.
    vectors = {i: [1.0 if j in (i, i + 1) else 0.0 for j in range(51)] for i in range(50)}
    got = judged(spark, vectors, dict.fromkeys(vectors), 0.45)
    assert sorted(i for i, r in got.items() if r.accepted) == list(range(0, 50, 2))
    assert all(got[i].match_id == i - 1 for i in range(1, 50, 2))


def test_feed_text(spark):
    channels = spark.createDataFrame([(1, "<b>News</b>", "About " * 60), (2, "", "")], "source_id int, channel_title string, channel_description string")
    entries = spark.createDataFrame([(1, i, f"T{i}", "s" * 300 if i == 0 else "") for i in range(7)], "source_id int, position int, title string, summary string")
    got = {r.source_id: r.feed_text for r in admission.feed_text(channels, entries).collect()}
    assert got[1] == "feed: News about: " + ("About " * 60)[:200] + " article: T0 " + "s" * 150 + " article: T1 article: T2 article: T3 article: T4"
    assert got[2] == ""


def test_table_maintenance(spark):
    now = F.lit("2024-02-01").cast("timestamp")
    old = sources(spark, (1, "One", "http://f/1", "A"), (5, "Five", "http://f/5", "A"))
    seeds = spark.createDataFrame([("Uno", "HTTP://F/1", "B"), ("New", "http://f/9", None)], "name string, url string, category string")
    got = {r.id: (r.name, r.url, r.category, r.is_active) for r in maintenance.upsert_sources(old, seeds, now).collect()}
    assert got == {1: ("Uno", "http://f/1", "B", True), 5: ("Five", "http://f/5", "A", True), 6: ("New", "http://f/9", "General", True)}
    assert [r.is_active for r in maintenance.toggle_source(old, False, name="One").orderBy("id").collect()] == [False, True]
    assert maintenance.has_source(old, 5) and not maintenance.has_source(old, 2)
    arts = spark.createDataFrame([(1, 1, None), (2, 5, 1)], "id bigint, source_id int, duplicate_of_id bigint")
    kept, freed = maintenance.delete_source(old, arts, 5)
    assert kept.count() == 1 and [r.source_id for r in freed.orderBy("id").collect()] == [1, None]
    assert [tuple(r) for r in maintenance.delete_article(arts, 1).collect()] == [(2, 5, None)]
    fetched = maintenance.mark_fetched(old, arts.where("source_id = 5"), now)
    assert [r.last_fetched_at is not None for r in fetched.orderBy("id").collect()] == [False, True]
    assert [r.id for r in maintenance.find_source(old, "FIV").collect()] == [5]


def test_roots_of_long_chains(spark, monkeypatch):
    rounds, write = [], dedup.stage
    monkeypatch.setattr(dedup, "stage", lambda df, name: (rounds.append(name), write(df, name))[1])
    rows = [(i, i - 1 if i > 1 else None) for i in range(1, 1001)] + [(2000 + i, 1) for i in range(50)]
    rows += [(3000, 2999), (3001, 3000), (4000, 4001), (4001, 4000), (5000, 5000)]
    got = {r.id: r.root_id for r in dedup.resolve_roots(spark.createDataFrame(rows, "id bigint, duplicate_of_id bigint")).collect()}
    want = {i: 1 for i, _ in rows if i < 3000} | {3000: 3000, 3001: 3000, 4000: 4000, 4001: 4000, 5000: 5000}
    assert got == want and rounds.count("doubled-links") <= 12


def test_serial_ids_are_dense_and_ordered(spark):
    rows = spark.range(5000).select((F.xxhash64("id")).alias("k"))
    got = assign_ids(rows, ["k"], 10).orderBy("k").select("id").collect()
    assert [r.id for r in got] == list(range(11, 5011))


@pytest.mark.parametrize("mean", [1.5, 2.5])
def test_mean_is_rounded_not_cut(spark, mean):
    arts = spark.createDataFrame(
        [(1, 1, int(mean - 0.5)), (2, 1, int(mean + 0.5))], "id bigint, source_id int, word_count int"
    ).withColumn("scraped_at", F.lit(None).cast("timestamp"))
    got = report.articles_per_source(arts, sources(spark, (1, "One", "u", "A"), (2, "Two", "v", "A")))
    assert [(r.source, r.article_count, r.avg_words) for r in got.collect()] == [("One", 2, int(mean + 0.5)), ("Two", 0, None)]
