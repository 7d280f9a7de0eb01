"""Scans, reports, aggregations, windows, sorts."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators import clean, maintenance
from newsloom.plans import fresh, report
from newsloom.session import scratch_path
from newsloom.sources import export, feeds, seeds, tables
from newsloom.workload import views
from newsloom.workload.catalog import query
from newsloom.workload.views import WS, table

AS_OF = "2024-01-20 12:00:00"


@query("s1_active_sources", "select id, name, url, category from sources where is_active")
def _(spark, sf):
    return tables.active_sources(views.sources(spark, sf))


@query("s2_all_sources", """
    select id, name, url, category, is_active, cast(null as timestamp) as last_fetched_at from sources""")
def _(spark, sf):
    return tables.all_sources(views.sources(spark, sf))


@query("s3_active_names", "select name, url, category from sources where is_active")
def _(spark, sf):
    return tables.active_names(views.sources(spark, sf))


# Files 0, 7, 14, ... of source 3 are cut off within their last entry.
FEED_ROWS = rf"""
    feed_rows as (
        select source_id, cast(id // {views.FEED_SPAN} as bigint) as snapshot, id, url,
               trim(regexp_replace(regexp_replace(title, '<[^>]+>', ' ', 'g'), '{WS}', ' ', 'g')) as title,
               substr(trim(regexp_replace(regexp_replace(full_text, '<[^>]+>', ' ', 'g'), '{WS}', ' ', 'g')), 1, 2000)
                   as summary,
               date_trunc('second', published_at) as published, coalesce(author, '') as author
        from articles where source_id is not null
    ),
    readable as (
        select * exclude (last_id) from (select *, max(id) over (partition by source_id, snapshot) as last_id from feed_rows)
        where not (source_id = 3 and snapshot % 7 = 0 and id = last_id)),
    landed as (
        select *, cast(row_number() over (partition by source_id, snapshot order by id) - 1 as int) as position
        from readable)"""


@query("s4_feed_entries", f"""
    with {FEED_ROWS}
    select source_id, snapshot, position, url, title, summary, published, author from landed where title <> ''""")
def _(spark, sf):
    return feeds.entries(views.feeds(spark, sf), carry=("source_id", "snapshot"))


@query("s4_feed_encodings", f"""
    with {FEED_ROWS}
    select source_id, snapshot, position, url, title, summary, published, author from landed where title <> ''""")
def _(spark, sf):
    """The same documents as bytes, in five encodings: what their twins in UTF-8 give."""
    d = views.feed_documents(spark, sf)
    turn = F.pmod(F.xxhash64("source_id", "snapshot"), F.lit(5))
    latin = ~F.col("document").rlike(r"[^\x00-\xFF]")
    def declared(name):
        return F.concat(F.lit(f'<?xml version="1.0" encoding="{name}"?>\n'), F.col("document"))
    content = (
        F.when((turn == 0) & latin, F.encode(declared("ISO-8859-1"), "ISO-8859-1"))
        .when(turn == 1, F.encode(declared("UTF-16"), "UTF-16"))
        .when(turn == 2, F.encode(declared("utf-16"), "UTF-16LE"))
        .when((turn == 3) & latin & ~F.col("document").rlike(r"[\x80-\x9F]"), F.encode(declared("windows-1252"), "ISO-8859-1"))
        .otherwise(F.encode(F.concat(F.lit("\ufeff"), F.col("document")), "UTF-8")))
    landed = d.select("source_id", "snapshot", feeds.decoded(content).alias("document"))
    return feeds.entries(feeds.parse_feeds(landed), carry=("source_id", "snapshot"))


@query("s5_all_feeds", f"""
    with {FEED_ROWS}
    select position, source_id, f.url, f.title, summary, published, author, s.name as source_name, s.category
    from landed f join sources s on s.id = f.source_id where s.is_active and f.title <> ''""")
def _(spark, sf):
    return feeds.collect(views.feeds(spark, sf), views.sources(spark, sf))


@query("a13_feed_counts", f"""
    with {FEED_ROWS}, per_file as (
        select source_id, count(distinct snapshot) as documents,
               count(distinct snapshot) filter (where source_id = 3 and snapshot % 7 = 0) as errors
        from feed_rows group by 1),
    per_source as (select source_id, count(*) as entries from landed where title <> '' group by 1)
    select s.id as source_id, s.name, coalesce(documents, 0) as documents, coalesce(entries, 0) as entries,
           coalesce(errors, 0) as errors
    from sources s left join per_file f on f.source_id = s.id left join per_source p on p.source_id = s.id
    where s.is_active""")
def _(spark, sf):
    return feeds.feed_counts(views.feeds(spark, sf), views.sources(spark, sf))


@query("s7_sql_scan", "select id, title, word_count from articles where language = 'fr' and word_count >= 100")
def _(spark, sf):
    return tables.query(
        spark, "select id, title, word_count from articles where language = :lang and word_count >= :words",
        {"lang": "fr", "words": 100}, articles=views.articles(spark, sf),
    )


@query("s8_article_csv", "select id, source_id, title, url, author, published_at, word_count, language, is_clean from articles")
def _(spark, sf):
    rows = views.articles(spark, sf).select(
        "id", "source_id", "title", "url", "author", "published_at", "word_count", "language", "is_clean")
    path = export.export_articles(rows, scratch_path(spark, "export"), "20240120_120000")
    return spark.read.option("header", True).option("escape", '"').schema(rows.schema).csv(path)


@query("s11_seed_rows", "select name, url, category from sources")
def _(spark, sf):
    path = scratch_path(spark, "seeds")
    views.sources(spark, sf).select("name", "url", "category").write.json(path)
    return seeds.read_seeds(spark, path)


@query("o1_bag_union", """
    select source_id, url, title from raw_batch union all select source_id, url, title from articles""")
def _(spark, sf):
    return views.raw_batch(spark, sf).select("source_id", "url", "title").unionByName(
        views.articles(spark, sf).select("source_id", "url", "title"))


# --- aggregations -------------------------------------------------------------------------------


@query("a1_overall_stats", """
    select count(*) as total_articles, count(distinct source_id) as active_sources,
           count(*) filter (where is_clean) as clean_articles, cast(round(avg(word_count)) as int) as avg_word_count,
           cast(min(published_at) as date) as earliest_article, cast(max(published_at) as date) as latest_article,
           max(scraped_at) as last_scraped_at
    from articles""")
def _(spark, sf):
    return report.overall_stats(views.articles(spark, sf))


_PER_SOURCE = """
    select s.name as source, s.category, count(a.id) as article_count,
           cast(round(avg(a.word_count)) as int) as avg_words, cast(max(a.scraped_at) as date) as last_scraped
    from sources s left join articles a on a.source_id = s.id
    group by s.name, s.category"""


@query("a2_articles_per_source", _PER_SOURCE)
def _(spark, sf):
    return report.articles_per_source(views.articles(spark, sf), views.sources(spark, sf))


@query("a3_articles_per_day", """
    select cast(published_at as date) as date, count(*) as articles from articles
    where published_at is not null group by 1 order by date desc limit 30""")
def _(spark, sf):
    return report.articles_per_day(views.articles(spark, sf))


@query("a4_last_seven_days", f"""
    select cast(published_at as date) as date, count(*) as articles from articles
    where published_at >= (select max(published_at) from articles) - interval 7 days group by 1""")
def _(spark, sf):
    a = views.articles(spark, sf)
    return report.articles_since(a, a.agg(F.max("published_at")).scalar())


@query("a5_top_authors", """
    select author, count(*) as articles from articles where author is not null and author <> ''
    group by author order by articles desc, author limit 10""")
def _(spark, sf):
    return report.top_authors(views.articles(spark, sf))


@query("a6_language_counts", "select language, count(*) as articles from articles group by language")
def _(spark, sf):
    return report.language_counts(views.articles(spark, sf))


_SHARE = """
    select language, count(*) as articles,
           round(cast(count(*) as double) * 100.0 / sum(count(*)) over (), 1) as pct
    from articles group by language"""


@query("a7_language_breakdown", _SHARE)
def _(spark, sf):
    return report.language_breakdown(views.articles(spark, sf))


@query("w1_share_of_total", """
    select author, cast(count(*) as double) * 100.0 / sum(count(*)) over () as pct from articles
    where author is not null group by author""")
def _(spark, sf):
    named = views.articles(spark, sf).where("author IS NOT NULL")
    total = named.agg(F.count("*").alias("n")).scalar()
    counts = named.groupBy("author").agg(F.count("*").alias("n")).withColumn("total", total)
    return counts.select("author", (F.col("n") * F.lit(100.0) / F.col("total")).alias("pct"))


@query("a10_cleaning_counters", f"""
    with firsts as (select * from (select *, row_number() over (partition by url order by ord) as rn from raw_batch)
                    where rn = 1),
    plain as (select nullif(trim(regexp_replace(title, '{WS}', ' ', 'g')), '') as title,
                     nullif(trim(regexp_replace(summary, '{WS}', ' ', 'g')), '') as summary,
                     nullif(trim(regexp_replace(full_text, '{WS}', ' ', 'g')), '') as full_text from firsts)
    select (select count(*) from raw_batch) as rows_in,
           (select count(*) from raw_batch) - count(*) as duplicate_urls,
           count(*) filter (where full_text is null and summary is null) as no_text,
           count(*) filter (where (full_text is not null or summary is not null)
                            and (title is null or length(title) < 5)) as short_title,
           count(*) filter (where (full_text is not null or summary is not null) and length(title) >= 5) as rows_out
    from plain""")
def _(spark, sf):
    return clean.cleaning_counters(views.raw_batch(spark, sf), ["ord"])


@query("a12_source_counts", "select count(*) filter (where is_active) as active, count(*) as total from sources")
def _(spark, sf):
    return report.source_counts(views.sources(spark, sf))


# --- windows, sorts, joins ------------------------------------------------------------------------


@query("j1_articles_of_source", """
    select a.id, a.title, a.word_count, a.published_at from articles a join sources s on a.source_id = s.id
    where s.name = 'NATION_3' 
    order by a.published_at desc nulls last, a.id limit 10""")
def _(spark, sf):
    return report.articles_of_source(views.articles(spark, sf), views.sources(spark, sf), "NATION_3")


@query("j2_sources_with_articles", """
    select s.id as source_id, s.name, a.id as article_id from sources s left join articles a on a.source_id = s.id""")
def _(spark, sf):
    return report.sources_with_articles(views.articles(spark, sf), views.sources(spark, sf))


_ENTRIES = """
    entries as (
        select coalesce(a.source_id, -1) as source_id, a.ord as position, a.url, a.title from raw_batch a)"""


def _entries(spark, sf):
    return views.raw_batch(spark, sf).select(
        F.coalesce("source_id", F.lit(-1)).alias("source_id"), F.col("ord").alias("position"), "url", "title")


# Stored: the articles of every second source, so that about half of the entries are fresh.
_STORED = "stored as (select lower(url) as k from articles where source_id % 2 = 0)"


def _stored(spark, sf):
    return views.articles(spark, sf).where("source_id % 2 = 0")


_FRESH = f"""
    {_ENTRIES}, {_STORED},
    sample as (select source_id, position, split_part(url, '?', 1) as url, title,
                      row_number() over (partition by source_id order by position, url) as rn from entries),
    fresh as (select source_id, position, url, title from sample s
              where rn <= 8 and url <> '' and title <> ''
                and not exists (select 1 from stored where starts_with(k, lower(s.url))))"""


@query("j3_fresh_entries", f"with {_FRESH} select * from fresh")
def _(spark, sf):
    return fresh.fresh_entries(_entries(spark, sf), _stored(spark, sf))


@query("j3_all_entries_without_stored_prefix", f"""
    with {_ENTRIES}, {_STORED}
    select source_id, position, e.url from entries e
    where not exists (select 1 from stored where starts_with(k, lower(split_part(e.url, '?', 1))))""")
def _(spark, sf):
    from newsloom.operators.joins import without_stored_prefix

    keyed = _entries(spark, sf).withColumn("k", F.lower(F.split_part("url", F.lit("?"), F.lit(1))))
    stored = _stored(spark, sf).select(F.lower("url").alias("k"))
    return without_stored_prefix(keyed, stored, "k").select("source_id", "position", "url")


@query("w2_first_entries", f"""
    with {_ENTRIES}
    select source_id, position, url, title, rank from (
        select *, cast(row_number() over (partition by source_id order by position, url) as int) as rank from entries)
    where rank <= 8""")
def _(spark, sf):
    return fresh.first_entries(_entries(spark, sf), 8)


_SHOWN = """
    shown as (select * from (select source_id, position, url, title,
                 cast(row_number() over (partition by source_id order by position, url) as int) as rank from fresh)
              where rank <= 2)"""


@query("w3_fresh_commands", f"with {_FRESH}, {_SHOWN} select * from shown order by source_id, rank limit 8")
def _(spark, sf):
    return fresh.fresh_report(_entries(spark, sf), _stored(spark, sf))[1]


@query("r6_fresh_report", f"with {_FRESH}, {_SHOWN} select * from shown")
def _(spark, sf):
    return fresh.fresh_report(_entries(spark, sf), _stored(spark, sf))[0]


@query("r7_latest_per_feed", f"""
    with {_ENTRIES}
    select source_id, rank, title[1:65] as title, url from (
        select *, cast(row_number() over (partition by source_id order by position, url) as int) as rank from entries)
    where rank <= 2""")
def _(spark, sf):
    return fresh.latest_per_feed(_entries(spark, sf))


@query("t1_latest_scraped", """
    select id, title, word_count, language, scraped_at from articles order by scraped_at desc, id limit 10""")
def _(spark, sf):
    return report.latest_scraped(views.articles(spark, sf))


@query("t4_run_history", "select * from runs order by started_at desc, id desc limit 10")
def _(spark, sf):
    return report.run_history(views.runs(spark, sf))


@query("t4_run_history_all", "select * from runs")
def _(spark, sf):
    return report.run_history(views.runs(spark, sf), None)


@query("p23_title_search", "select id, title, url, published_at from articles where contains(lower(title), 'tion')")
def _(spark, sf):
    return report.search_titles(views.articles(spark, sf), "TION", None)


@query("p23_title_search_first", """
    select id, title, url, published_at from articles where contains(lower(title), 'the') order by id limit 10""")
def _(spark, sf):
    return report.search_titles(views.articles(spark, sf), "The")


@query("p24_find_by_name", "select id, name from sources where contains(lower(name), 'on_1')")
def _(spark, sf):
    return maintenance.find_source(views.sources(spark, sf), "ON_1").select("id", "name")


@query("p24_find_by_id", "select id, name from sources where id = 7")
def _(spark, sf):
    return maintenance.find_source(views.sources(spark, sf), "7").select("id", "name")


_REPORT = f"""
    select 'Overall Stats' as section, concat_ws('|', count(*), count(distinct source_id),
           count(*) filter (where is_clean), cast(round(avg(word_count)) as int),
           cast(min(published_at) as date), cast(max(published_at) as date)) as line from articles
    union all select 'Articles per Source', concat_ws('|', source, category, article_count, avg_words, last_scraped)
              from ({_PER_SOURCE})
    union all select 'Articles per Day', concat_ws('|', date, articles) from (
        select cast(published_at as date) as date, count(*) as articles from articles
        where published_at is not null group by 1 order by date desc limit 30)
    union all select 'Top Authors', concat_ws('|', author, articles) from (
        select author, count(*) as articles from articles where author <> ''
        group by author order by articles desc, author limit 10)
    union all select 'Language Breakdown', concat_ws('|', language, articles) from ({_SHARE})
    union all select 'Pipeline Run History', concat_ws('|', id, articles_found, articles_inserted, articles_skipped,
                     errors, status) from (select * from runs order by started_at desc limit 10)"""
_HIDDEN = {"last_scraped_at", "pct", "started_at", "finished_at"}


def _lines(sections):
    parts = [
        df.select(F.lit(title).alias("section"), F.concat_ws(
            "|", *[F.col(c).cast("string") for c in df.columns if c not in _HIDDEN]).alias("line"))
        for title, df in sections.items()
    ]
    return functools.reduce(DataFrame.unionByName, parts)


@query("r1_report", _REPORT)
def _(spark, sf):
    return _lines(report.report(views.articles(spark, sf), views.sources(spark, sf), views.runs(spark, sf)))


@query("r1_report_times", """
    select 'Overall Stats' as section, cast(max(scraped_at) as varchar) as name, null::double as pct, null::timestamp as finished_at from articles
    union all select 'Language Breakdown', language, round(count(*) * 100.0 / sum(count(*)) over (), 1), null from articles
              where language is not null group by language
    union all select * from (select 'Pipeline Run History', cast(started_at as varchar), null::double, finished_at from runs
              order by started_at desc limit 10)""")
def _(spark, sf):
    """What `r1_report` leaves out: times and shares."""
    all_ = report.report(views.articles(spark, sf), views.sources(spark, sf), views.runs(spark, sf))
    none, never = F.lit(None).cast("double").alias("pct"), F.lit(None).cast("timestamp").alias("finished_at")
    head = lambda title, c: (F.lit(title).alias("section"), F.col(c).cast("string").alias("name"))
    return (
        all_["Overall Stats"].select(*head("Overall Stats", "last_scraped_at"), none, never)
        .unionByName(all_["Language Breakdown"].select(*head("Language Breakdown", "language"), F.col("pct").cast("double").alias("pct"), never))
        .unionByName(all_["Pipeline Run History"].select(*head("Pipeline Run History", "started_at"), none, "finished_at")))


@query("s9_report_csv", _REPORT)
def _(spark, sf):
    """All sections written as CSV and read back."""
    paths = export.export_report(
        report.report(views.articles(spark, sf), views.sources(spark, sf), views.runs(spark, sf)),
        scratch_path(spark, "report"), "20240120_120000")
    return _lines({title: spark.read.option("header", True).option("escape", '"').csv(path) for title, path in paths.items()})


# --- maintenance ------------------------------------------------------------------------------------


def _now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


_NOW_SQL = "timestamp '2024-02-01 00:00:00'"
_SEEDS = """
    seeds as (select concat('Seed ', s_name) as name,
                     case when s_suppkey % 2 = 0 then upper(concat('https://feeds.example.com/s', s_suppkey))
                          else concat('https://feeds.example.com/s', s_suppkey) end as url, 'Seeded' as category
              from supplier),
    stored_sources as (select cast(s_suppkey + 1 as int) as id, s_name as name,
                              concat('https://feeds.example.com/s', s_suppkey) as url, 'General' as category,
                              s_nationkey % 2 = 0 as is_active from supplier where s_nationkey < 13)"""


def _supplier_sources(spark, sf):
    url = F.concat(F.lit("https://feeds.example.com/s"), F.col("s_suppkey").cast("string"))
    stored = table(spark, sf, "supplier").where("s_nationkey < 13").select(
        (F.col("s_suppkey") + 1).cast("int").alias("id"), F.col("s_name").alias("name"), url.alias("url"),
        F.lit("General").alias("category"), (F.col("s_nationkey") % 2 == 0).alias("is_active"),
        F.lit(None).cast("timestamp").alias("created_at"), F.lit(None).cast("timestamp").alias("last_fetched_at"))
    seed_rows = table(spark, sf, "supplier").select(
        F.concat(F.lit("Seed "), "s_name").alias("name"),
        F.when(F.col("s_suppkey") % 2 == 0, F.upper(url)).otherwise(url).alias("url"),
        F.lit("Seeded").alias("category"))
    return stored, seed_rows


@query("u1_upsert_sources", f"""
    with {_SEEDS}, added as (
        select row_number() over (order by url) + (select max(id) from stored_sources) as id, name, url, category
        from seeds where lower(url) not in (select lower(url) from stored_sources))
    select o.id, coalesce(n.name, o.name) as name, o.url, coalesce(n.category, o.category) as category, o.is_active
    from stored_sources o left join seeds n on lower(n.url) = lower(o.url)
    union all select cast(id as int), name, url, category, true from added""")
def _(spark, sf):
    stored, seed_rows = _supplier_sources(spark, sf)
    return maintenance.upsert_sources(stored, seed_rows, _now()).select("id", "name", "url", "category", "is_active")


@query("u2_insert_sources", f"""
    with {_SEEDS}
    select cast(row_number() over (order by url) + (select max(id) from stored_sources) as int) as id, name, url,
           category, true as is_active, {_NOW_SQL} as created_at, cast(null as timestamp) as last_fetched_at
    from seeds where lower(url) not in (select lower(url) from stored_sources)""")
def _(spark, sf):
    stored, seed_rows = _supplier_sources(spark, sf)
    twice = seed_rows.unionByName(seed_rows.withColumns({"url": F.lower("url"), "name": F.lit("ZZ")}))
    return maintenance.insert_sources(stored, twice, _now())


@query("u3_toggle_source", """
    select id, name, case when id = 4 then false when name = 'NATION_9' then false else is_active end as is_active
    from sources""")
def _(spark, sf):
    off = maintenance.toggle_source(views.sources(spark, sf), False, source_id=4)
    return maintenance.toggle_source(off, False, name="NATION_9").select("id", "name", "is_active")


@query("u4_delete_source", """
    select id, nullif(source_id, 5) as source_id, (select count(*) from sources where id <> 5) as sources_left
    from articles""")
def _(spark, sf):
    kept, a = maintenance.delete_source(views.sources(spark, sf), views.articles(spark, sf), 5)
    return a.select("id", "source_id").withColumn("sources_left", kept.agg(F.count("*")).scalar())


@query("u6_mark_fetched", f"""
    select id, case when id in (select source_id from articles) then {_NOW_SQL} end as last_fetched_at from sources""")
def _(spark, sf):
    a = views.articles(spark, sf).where("source_id IS NOT NULL")
    return maintenance.mark_fetched(views.sources(spark, sf), a, _now()).select("id", "last_fetched_at")


@query("u7_run_status", """
    select event_type, count(*) as found,
           case when event_type = 'error' then 'failed' when count(*) = 0 then 'partial' else 'success' end as status
    from events group by event_type""")
def _(spark, sf):
    counts = table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("found"))
    return counts.withColumn("status", maintenance.run_status(F.col("found"), F.col("event_type") == "error"))


@query("u8_defaults", f"""
    select id, coalesce(nullif(title, ''), '(untitled)') as title,
           case when language = 'en' then 'en' else language end as language,
           case when id % 3 = 0 then scraped_at else {_NOW_SQL} end as scraped_at, false as is_duplicate
    from articles""")
def _(spark, sf):
    a = views.articles(spark, sf).withColumns({
        "title": F.nullif("title", F.lit("")), "language": F.nullif("language", F.lit("en")),
        "scraped_at": F.when(F.col("id") % 3 == 0, F.col("scraped_at")),
        "is_duplicate": F.lit(None).cast("boolean"),
    })
    return maintenance.with_defaults(a, _now()).select("id", "title", "language", "scraped_at", "is_duplicate")


@query("u9_evolve", """
    select id, title, false as is_duplicate, cast(null as bigint) as duplicate_of_id,
           cast(null as double) as similarity_score from articles""")
def _(spark, sf):
    from newsloom.schema import ARTICLES

    old = views.articles(spark, sf)
    return maintenance.evolve(old, ARTICLES, {"is_duplicate": False}).select(
        "id", "title", "is_duplicate", "duplicate_of_id", "similarity_score")


@query("u10_serial_ids", """
    select row_number() over (order by title, url) + 1000 as id, url from articles""")
def _(spark, sf):
    from newsloom.operators.ids import assign_ids

    return assign_ids(views.articles(spark, sf).select("title", "url"), ["title", "url"], 1000).select("id", "url")
