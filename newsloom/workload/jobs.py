"""Whole jobs: batch ingest and its streaming form."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.operators.language import train_profiles
from newsloom.plans.ingest import run_batch
from newsloom.session import scratch_path, stage
from newsloom.sources.feeds import collect
from newsloom.sources.tables import TableStore
from newsloom.streaming.ingest import entry_stream, start_ingest, unique_url_stream
from newsloom.workload import views
from newsloom.workload.catalog import ORACLE, query
from newsloom.workload.similarity import FLAGGED
from newsloom.workload.tables import FEED_ROWS
from newsloom.workload.texts import CLEAN_LANGUAGE, LANGUAGE, PAGE_TEXT, collapse, decode
from newsloom.workload.views import spread, table


# The job in SQL: entries of the landed feeds, page text, cleaning, languages, ids, and flags.
_JOB = rf"""
    articles as ({views.VIEWS["articles"]}), sources as ({views.VIEWS["sources"]}),
    {FEED_ROWS},
    {PAGE_TEXT},
    entries as (
        select l.source_id, l.position, l.url, l.title, l.summary, l.author, l.published, a.text
        from landed l join sources s on s.id = l.source_id
        left join (select x.url, p.text from page_text p join articles x on x.id = p.page_id) a on a.url = l.url
        where s.is_active and l.title <> ''),
    plain_rows as (
        select source_id, position, url, nullif({collapse(decode('title'))}, '') as title,
               nullif({collapse(decode('summary'))}, '') as summary,
               nullif({collapse(decode("nullif(text[1:50000], '')"))}, '') as full_text from entries),
    kept as (select *, coalesce(full_text, summary) as t from plain_rows
             where (full_text is not null or summary is not null) and length(title) >= 5),
    {LANGUAGE},
    {CLEAN_LANGUAGE},
    numbered as (
        select row_number() over (order by source_id, position, k.url) as id, k.url, title, summary, full_text,
               coalesce(b.lang, 'en') as language, cast(len(regexp_extract_all(t, '{views.WORD}')) as int) as word_count
        from kept k left join kbest b on b.url = k.url and b.rk = 1),
    texts as ({views.VIEWS["texts"].replace("from articles", "from numbered")}),
    shingled as ({views.VIEWS["shingled"]}),
    {FLAGGED}"""
_ARTICLES = f"""
    with {_JOB}
    select n.id, n.url, n.title, n.language, n.word_count, f.is_duplicate, f.duplicate_of_id, f.similarity_score
    from numbered n join flagged f on f.id = n.id"""


def job_query(name: str, sql: str):
    """Register a query whose SQL spells out its own views."""

    def add(function):
        query(name)(function)
        ORACLE[name] = sql
        return function

    return add


def _inputs(spark, sf):
    store = TableStore(spark, scratch_path(spark, "store"))
    store.write_sources(views.sources(spark, sf), 0)
    profiles = train_profiles(spread(table(spark, sf, "documents"), "doc_id"))
    entries = collect(views.feeds(spark, sf), views.sources(spark, sf))
    # Pages stand under the URLs of the articles with their numbers.
    urls = views.articles(spark, sf).select(F.col("id").alias("page_id"), "url")
    pages = table(spark, sf, "pages").select("page_id", "html").join(urls, "page_id").select("url", "html")
    return store, profiles, entries, pages


def _stored(store):
    return store.articles().select(
        "id", "url", "title", "language", "word_count", "is_duplicate", "duplicate_of_id", "similarity_score")


@job_query("r8_ingest_job", _ARTICLES)
def _(spark, sf):
    store, profiles, entries, pages = _inputs(spark, sf)
    run_batch(store, 1, entries, pages, profiles)
    return _stored(store)


@job_query("r8_run_row", f"""
    with {_JOB}
    select 1::bigint as id, (select count(*) from entries) as articles_found, count(*) as articles_inserted,
           count(*) filter (where is_duplicate) as articles_skipped, 0::bigint as errors, 'success' as status from flagged""")
def _(spark, sf):
    store, profiles, entries, pages = _inputs(spark, sf)
    return run_batch(store, 1, entries, pages, profiles).select(
        "id", "articles_found", "articles_inserted", "articles_skipped", "errors", "status")


def _ingest_in_two(spark, store, profiles, entries, pages):
    """Two parts land one after the other, each written by as many tasks as hold it; each is one micro-batch."""
    path, log = scratch_path(spark, "landed"), scratch_path(spark, "ingest")
    for part in (entries.where("source_id < 10"), entries.where("source_id >= 10")):
        part.write.mode("append").parquet(path)
        start_ingest(entry_stream(spark, path), store, pages, profiles, log, once=True).awaitTermination()


@job_query("st1_incremental_ingest", _ARTICLES)
def _(spark, sf):
    """Two landed parts, one micro-batch each: ST1, ST2, ST4 and ST5 in one job; the rows of one batch."""
    store, profiles, entries, pages = _inputs(spark, sf)
    _ingest_in_two(spark, store, profiles, entries, pages)
    return _stored(store)


@job_query("st5_fetched_sources", f"""
    with {_JOB}
    select s.id, s.name, s.url, s.category, s.is_active, s.id in (select source_id from entries) as fetched from sources s""")
def _(spark, sf):
    """The source table that the last of two micro-batches leaves: those with entries in either have a fetch time."""
    store, profiles, entries, pages = _inputs(spark, sf)
    store.write_sources(views.sources(spark, sf).withColumn("last_fetched_at", F.lit(None).cast("timestamp")), 0)
    _ingest_in_two(spark, store, profiles, entries, pages)
    return store.sources().select("id", "name", "url", "category", "is_active", F.col("last_fetched_at").isNotNull().alias("fetched"))


@query("st3_expired_urls", """
    select lower(url) as url_key, count(distinct (ord - 1) // 2 % 3) as times from raw_batch group by 1""")
def _(spark, sf):
    """Three days under a watermark of an hour: a URL comes once within a day, and again when its state is gone.

    Between the days come two batches of one row each: the first moves the watermark, and in the
    second what is older is dropped from the state. Rows older than the watermark are dropped as well.
    """
    rows = stage(views.raw_batch(spark, sf).select("url", F.floor((F.col("ord") - 1) / 2 % 3).cast("int").alias("day")), "rows")
    path, out = scratch_path(spark, "landed"), scratch_path(spark, "unique")

    def land(urls, day):
        urls.select(
            "url", F.lit("").alias("title"), F.lit("").alias("summary"), F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp").alias("published"),
            F.lit("").alias("author"), F.lit(0).alias("source_id"), F.lit("").alias("source_name"), F.lit("").alias("category"),
            F.lit(0).alias("position")).coalesce(1).write.mode("append").parquet(path)

    for day in range(3):
        if day:
            for tick in (5, 6):
                land(spark.range(1).select(F.lit(f"tick:{day}-{tick}").alias("url")), 10 * day - 9 + tick)
            land(rows.where(F.col("day") == 0).select(F.concat(F.lit("late:"), "url").alias("url")), 1)
        land(rows.where(F.col("day") == day), 10 * day + 1)
    (
        unique_url_stream(entry_stream(spark, path, files_per_batch=1), "1 hour").writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, "unique-log")).trigger(availableNow=True).start(out).awaitTermination()
    )
    found = spark.read.parquet(out).where(~F.col("url_key").startswith("tick:"))
    return found.groupBy("url_key").agg(F.count("*").alias("times"))


@query("st3_watermarked_urls", "select distinct lower(url) as url_key from raw_batch where published_at is not null")
def _(spark, sf):
    """With a watermark of ten years no state is dropped, so every URL with a time comes once."""
    return _unique(spark, sf, "3650 days").where("published IS NOT NULL").select("url_key").distinct()


@query("st3_unique_url_stream", "select distinct lower(url) as url_key from raw_batch")
def _(spark, sf):
    return _unique(spark, sf, None).select("url_key")


def _unique(spark, sf, watermark):
    path = scratch_path(spark, "landed")
    views.raw_batch(spark, sf).select(
        "url", "title", "summary", F.col("published_at").alias("published"), "author", "source_id",
        F.lit("").alias("source_name"), F.lit("").alias("category"), F.col("ord").cast("int").alias("position"),
    ).write.parquet(path)
    out = scratch_path(spark, "unique")
    (
        unique_url_stream(entry_stream(spark, path), watermark).writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, "unique-log"))
        .trigger(availableNow=True).start(out).awaitTermination()
    )
    return spark.read.parquet(out)
