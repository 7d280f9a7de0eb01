"""Feed files, the ingest job, and its streaming form."""

import os

import pytest
from pyspark.sql import functions as F

from newsloom.operators.language import train_profiles
from newsloom.plans.ingest import run_batch
from newsloom.schema import SOURCES
from newsloom.sources import export, feeds, seeds
from newsloom.sources.tables import TableStore
from newsloom.streaming.ingest import feed_stream, start_ingest

RSS = """<?xml version="1.0"?><rss xmlns:content="urn:c" xmlns:dc="urn:d"><channel><title>Daily</title><description>All news</description>
<item><title>First &lt;b&gt;story&lt;/b&gt;</title><link> http://n/1 </link><description>plain</description>
<content:encoded>rich &amp; long</content:encoded><pubDate>Tue, 02 Jan 2024 10:00:00 GMT</pubDate><dc:creator>Ann</dc:creator></item>
<item><title></title><link>http://n/2</link></item>
<item><title>Third story here</title><link>http://n/3</link><description>The third story has a summary of its own.</description></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>Weekly</title><subtitle>Some news</subtitle>
<entry><title>Atom story</title><link href="http://m/1.atom" rel="self"/><link href="http://m/1"/><summary>sum</summary>
<updated>2024-01-03T00:00:00Z</updated><author><name>Bob</name></author></entry></feed>"""


@pytest.fixture
def landed(tmp_path):
    for source, name, text in ((1, "a.xml", RSS), (2, "a.xml", ATOM), (2, "b.xml", "<rss><channel><item>"), (3, "a.xml", RSS)):
        folder = tmp_path / "feeds" / f"source_id={source}"
        os.makedirs(folder, exist_ok=True)
        (folder / name).write_text(text)
    return str(tmp_path / "feeds")


@pytest.mark.parametrize("encoding, declared, mark", [
    ("utf-8", None, b""), ("utf-8", "UTF-8", b""), ("utf-8", None, b"\xef\xbb\xbf"), ("iso-8859-1", "ISO-8859-1", b""), ("cp1252", "Windows-1252", b""),
    ("utf-16-le", "UTF-16", b"\xff\xfe"), ("utf-16-be", "UTF-16", b"\xfe\xff"), ("utf-16-be", "utf-16", b""), ("koi8-r", "koi8-r", b""),
    ("utf-8", "no-such-name", b""), ("utf-8", "UTF-16", b"")])
def test_a_feed_is_read_in_the_encoding_it_declares(spark, tmp_path, encoding, declared, mark):
    title = "\u043f\u0440\u0438\u0432\u0435\u0442" if encoding == "koi8-r" else "Cr\u00e8me \u00e9t\u00e9"
    text = f"<rss><channel><title>{title}</title><item><title>{title} today</title><link>http://n/1</link></item></channel></rss>"
    head = f'<?xml version="1.0" encoding="{declared}"?>' if declared else ""
    os.makedirs(tmp_path / "source_id=1")
    (tmp_path / "source_id=1" / "a.xml").write_bytes(mark + (head + text).encode(encoding))
    got = feeds.read_feed_documents(spark, str(tmp_path))
    assert [tuple(r) for r in got.collect()] == [(1, text)]
    assert [r.title for r in feeds.entries(feeds.parse_feeds(got)).collect()] == [f"{title} today"]


def test_damaged_and_empty_bytes(spark):
    rows = [(1, b""), (2, None), (3, b"a\xffb"), (4, b'<?xml encoding="utf-16-be"?>x'), (5, b"\xff\xfea")]
    got = {r.id: r.text for r in spark.createDataFrame(rows, "id int, content binary").select("id", feeds.decoded(F.col("content")).alias("text")).collect()}
    assert got == {1: "", 2: None, 3: "a\ufffdb", 4: "x", 5: "\ufffd"}


def test_a_dump_is_read_by_many_tasks(spark, tmp_path):
    items = "".join(f"<item><title>Story {i} {'x' * 200}</title><link>http://n/{i}</link><description>\u00e9 {i}</description>"
                    f"<media:x a='1'/><dc:creator>Ann</dc:creator><pubDate>Tue, 02 Jan 2024 10:00:00 GMT</pubDate></item>\n" for i in range(3000))
    (tmp_path / "dump.xml").write_text(f"<rss><channel><title>All</title>{items}<item><title>cut off</titl", encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        got = feeds.read_feed_dump(spark, str(tmp_path / "dump.xml"))
        assert got.rdd.getNumPartitions() > 5
        rows = got.orderBy("position").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.url for r in rows] == [f"http://n/{i}" for i in range(3000)]
    assert rows[7].summary == "\u00e9 7" and rows[7].author == "Ann" and str(rows[7].published) == "2024-01-02 10:00:00"
    atom = ATOM.replace("</feed>", '<entry><title>Two</title><link href="http://m/2"/></entry></feed>')
    (tmp_path / "atom.xml").write_text(atom)
    assert [(r.url, r.author) for r in feeds.read_feed_dump(spark, str(tmp_path / "atom.xml"), atom=True).orderBy("position").collect()] == [
        ("http://m/1", "Bob"), ("http://m/2", "")]


@pytest.fixture
def sources(spark):
    return spark.createDataFrame(
        [(1, "Daily", "http://n/feed", "News", True, None, None), (2, "Weekly", "http://m/feed", "News", True, None, None),
         (3, "Off", "http://o/feed", "News", False, None, None), (4, "Silent", "http://p/feed", "News", True, None, None)], SOURCES)


@pytest.fixture
def profiles(spark):
    return train_profiles(spark.createDataFrame([("the story of the day and the news", "en")], "text string, lang string"))


def test_feed_files(spark, landed, sources):
    parsed = feeds.parse_feeds(feeds.read_feed_documents(spark, landed))
    got = sorted((r.source_id, r.position, r.url, r.title, r.summary, str(r.published), r.author, r.source_name)
                 for r in feeds.collect(parsed, sources).collect())
    assert got == [
        (1, 0, "http://n/1", "First story", "rich & long", "2024-01-02 10:00:00", "Ann", "Daily"),
        (1, 2, "http://n/3", "Third story here", "The third story has a summary of its own.", "None", "", "Daily"),
        (2, 0, "http://m/1", "Atom story", "sum", "2024-01-03 00:00:00", "Bob", "Weekly"),
    ]
    counts = {r.name: (r.documents, r.entries, r.errors) for r in feeds.feed_counts(parsed, sources).collect()}
    assert counts == {"Daily": (1, 2, 0), "Weekly": (2, 1, 1), "Silent": (0, 0, 0)}
    channels = {r.source_id: (r.channel_title, r.channel_description) for r in feeds.channels(parsed).where("source_id < 2").collect()}
    assert channels == {1: ("Daily", "All news")}


def test_damaged_guid_only_and_rss_1_feeds(spark):
    item = "<item><title>{0} story</title><link>http://n/{0}</link></item>"
    documents = [
        (1, '<?xml version="1.0"?><rss xmlns:dc="http://d/"><channel><title>T</title>' + item.format("One")
         + "<item><title>Two story</title><dc:date>2024-01-02</dc:date><link>http://n/2</link></item><item><title>Cut"),
        (2, "<rss><channel><item><title>Guid story</title><guid>http://n/g</guid></item>"
            '<item><title>No link</title><guid isPermaLink="false">17</guid></item></channel></rss>'),
        (3, '<rdf:RDF xmlns:rdf="http://r/" xmlns="http://p/"><channel><title>C</title></channel>' + item.format("Old") + "</rdf:RDF>"),
        (4, "nothing of the kind"), (5, None), (6, "<feed><entry><title>A</title><link href='http://n/a'/></entry><entry>"),
    ]
    parsed = feeds.parse_feeds(spark.createDataFrame(documents, "source_id int, document string"))
    got = {(r.source_id, r.url, r.title) for r in feeds.entries(parsed).collect()}
    assert got == {(1, "http://n/One", "One story"), (1, "http://n/2", "Two story"), (2, "http://n/g", "Guid story"),
                   (3, "http://n/Old", "Old story"), (6, "http://n/a", "A")}
    broken = {r.source_id for r in parsed.where("feed._broken IS NOT NULL").collect()}
    assert broken == {1, 4, 6}


def pages(spark):
    body = "".join(f"<p>Sentence number {i} of the body text is long enough to be kept.</p>" for i in range(9))
    return spark.createDataFrame([("http://n/3", f"<article>{body}</article>")], "url string, html string")


def test_ingest_twice_and_replay(spark, landed, sources, profiles, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    store.write_sources(sources, 0)
    entries = feeds.collect(feeds.parse_feeds(feeds.read_feed_documents(spark, landed)), sources)
    run = run_batch(store, 1, entries, pages(spark), profiles).first()
    assert (run.articles_found, run.articles_inserted, run.articles_skipped, run.status) == (3, 3, 0, "success")
    again = run_batch(store, 2, entries, pages(spark), profiles).first()
    assert (again.articles_found, again.articles_inserted, again.articles_skipped) == (3, 0, 3)
    run_batch(store, 1, entries, pages(spark), profiles)
    rows = {r.url: r for r in store.articles().collect()}
    assert len(rows) == 3 and rows["http://n/3"].full_text.startswith("Sentence number 0")
    assert rows["http://n/1"].full_text is None and store.runs().count() == 2
    fetched = {r.name: r.last_fetched_at is not None for r in store.sources().collect()}
    assert fetched == {"Daily": True, "Weekly": True, "Off": False, "Silent": False}
    empty = run_batch(store, 3, entries.where("false"), pages(spark), profiles).first()
    assert (empty.articles_found, empty.articles_inserted, empty.status) == (0, 0, "partial")


def test_failed_batch_is_invisible(spark, landed, sources, profiles, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    store.write_sources(sources, 0)
    entries = feeds.collect(feeds.parse_feeds(feeds.read_feed_documents(spark, landed)), sources)
    broken = entries.withColumn("title", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        run_batch(store, 1, broken, pages(spark), profiles)
    assert store.articles().count() == 0
    run = store.runs().first()
    assert (run.status, run.errors, run.articles_inserted) == ("failed", 1, 0)


def test_failed_replay_leaves_the_batch(spark, landed, sources, profiles, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "tables"))
    store.write_sources(sources, 0)
    entries = feeds.collect(feeds.parse_feeds(feeds.read_feed_documents(spark, landed)), sources)
    run_batch(store, 1, entries, pages(spark), profiles)
    before = sorted(store.articles().collect())
    broken = entries.withColumn("title", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        run_batch(store, 1, broken, pages(spark), profiles)
    assert sorted(store.articles().collect()) == before and [r.status for r in store.runs().collect()] == ["success"]
    # A crash between the writes: articles and sources are there, the run row is not.
    monkeypatch.setattr(TableStore, "write_run", lambda *a: None)
    run_batch(store, 1, entries.limit(1), pages(spark), profiles)
    run_batch(store, 2, entries.limit(1), pages(spark), profiles)
    assert sorted(store.articles().collect()) == before and store.runs().count() == 1
    assert {r.name for r in store.sources().collect()} == {"Daily", "Weekly", "Off", "Silent"}


def test_lower_threshold_than_the_postings_is_refused(spark, sources, profiles, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    with pytest.raises(ValueError):
        run_batch(store, 1, None, None, profiles, threshold=0.5)


def test_stream_of_feed_files(spark, landed, sources, profiles, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    store.write_sources(sources, 0)
    for _ in range(2):  # the second start finds nothing new
        start_ingest(feed_stream(spark, landed), store, pages(spark), profiles, str(tmp_path / "log"), feeds=True,
                     once=True).awaitTermination()
    assert store.articles().count() == 3
    assert [(r.status, r.errors) for r in store.runs().collect()] == [("success", 1)]


def test_seeds_and_csv(spark, tmp_path):
    assert seeds.default_seeds(spark).groupBy("category").count().count() == 4
    df = spark.createDataFrame([(1, 'a "quoted", value')], "id int, t string")
    path = export.export_articles(df, str(tmp_path), "20240101_000000")
    assert spark.read.option("header", True).option("escape", '"').csv(path).first().t == 'a "quoted", value'
