"""The news tables as views over the given tables, for Spark and as SQL for the check.

The SQL constants are common table expressions; `with_views` puts the ones a query needs in front.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.barrier import with_computed
from newsloom.functions.features import content_text, feature_set, general_text, with_dense_vector
from newsloom.functions.text import word_count
from newsloom.session import stage
from newsloom.sources.feeds import parse_feeds

WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"
WORD = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores when the table is a few unsplittable files; untouched when it is many."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if len(df.inputFiles()) < cores else df


def sources(spark, sf_dir) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
        F.concat(F.lit("https://feeds.example.com/"), F.lower("n_name")).alias("url"),
        F.col("r_name").alias("category"), (F.col("n_nationkey") % 7 != 0).alias("is_active"),
        F.lit(None).cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("last_fetched_at"),
    )


def _source_id():
    return F.when(F.col("doc_id") % 50 == 49, None).otherwise(F.substring("source", 4, 10).cast("int"))


def _line(n):
    """Line `n` of a text; what comes after it is not split."""
    return F.split_part(F.substring_index("text", "\n", n), F.lit("\n"), F.lit(n))


def _title():
    return F.trim(F.substring(_line(1), 1, 80))


def _summary():
    return F.nullif(F.trim(_line(2)), F.lit(""))


def articles(spark, sf_dir) -> DataFrame:
    # What a document alone gives is computed before the joins, so that they move texts only for those who ask for them.
    d = spread(table(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id", _source_id().alias("source_id"), _title().alias("title"),
        F.concat(F.lit("https://"), "source", F.lit(".example.com/a/"), F.col("doc_id").cast("string")).alias("url"),
        _summary().alias("summary"),
        F.col("text").alias("full_text"), word_count(F.col("text")).alias("word_count"), F.col("lang").alias("language"),
    )
    e = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("doc_id"), F.col("ts").cast("timestamp").alias("ts"), "user_id"
    )
    l = table(spark, sf_dir, "labels").select("doc_id", "quality")
    user = F.concat(F.lit("user"), (F.col("user_id") % 40).cast("string"))
    return d.join(e, "doc_id", "left").join(l, "doc_id", "left").select(
        F.col("doc_id").alias("id"), "source_id", "title", "url",
        F.when(F.col("user_id") % 5 == 0, None).otherwise(user).alias("author"),
        F.when(F.col("doc_id") % 20 == 19, None).otherwise(F.col("ts")).alias("published_at"),
        "summary", "full_text", "word_count", "language", (F.coalesce("quality", F.lit(0)) == 1).alias("is_clean"),
        F.col("ts").alias("scraped_at"),
    )


def runs(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    days = e.groupBy(F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"),
        F.count("*").alias("articles_found"),
        F.count_if(F.col("event_type").isin("view", "click", "purchase")).alias("articles_inserted"),
        F.count_if(F.col("event_type") == "signup").alias("articles_skipped"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
    )
    status = F.when(F.col("articles_inserted") == 0, "failed").when(
        F.col("errors") * 5 > F.col("articles_found"), "partial").otherwise("success")
    # The day number since 2024 serves as id: one row per day, no global ordering needed.
    number = F.date_diff("day", F.lit("2024-01-01").cast("date")) + 1
    return days.select(
        number.cast("bigint").alias("id"), "started_at", "finished_at", "articles_found",
        "articles_inserted", "articles_skipped", "errors", status.alias("status"),
    )


def embedded(spark, sf_dir) -> DataFrame:
    """(id, full_text, embedding, content_embedding) as feature sets."""
    a = spread(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "text")
    return with_computed(a, title=_title(), summary=_summary()).select(
        F.col("doc_id").alias("id"), F.col("text").alias("full_text"),
        feature_set(general_text(F.col("title"), F.col("summary"), F.col("text"))).alias("embedding"),
        feature_set(content_text(F.col("text"))).alias("content_embedding"),
    )


def dense(spark, sf_dir) -> DataFrame:
    """(id, full_text, vector): 384-wide unit vectors of the content text."""
    d = spread(table(spark, sf_dir, "documents"), "doc_id").select(
        F.col("doc_id").alias("id"), F.col("text").alias("full_text"), content_text(F.col("text")).alias("body")
    )
    return with_dense_vector(d, "body", "vector").drop("body")


def raw_batch(spark, sf_dir, written: bool = False) -> DataFrame:
    """Collected entries with twins: every article twice, the twin under the same URL, the same URL
    in capitals, or a URL of its own; some without text, some with a short title.

    With `written`, the articles are joined and written once, for those who read the entries several times."""
    a = articles(spark, sf_dir)
    if written:
        a = stage(a.select("id", "source_id", "title", "url", "author", "published_at", "summary", "full_text"), "entries")
    first = a.select(
        (F.col("id") * 2).alias("ord"), "source_id",
        F.when(F.col("id") % 11 == 5, "News").otherwise(F.col("title")).alias("title"), "url", "author",
        "published_at",
        F.when(F.col("id") % 13 == 6, F.lit(None)).otherwise(
            F.concat(F.lit("A &amp; B &lt;b&gt; &copy;  "), F.coalesce("summary", F.lit("")))).alias("summary"),
        F.when(F.col("id") % 26 == 6, F.lit(None)).otherwise(F.col("full_text")).alias("full_text"),
    )
    twin_url = (
        F.when(F.col("id") % 3 == 0, F.col("url")).when(F.col("id") % 3 == 1, F.upper("url"))
        .otherwise(F.concat("url", F.lit("?x=1")))
    )
    twin = a.select(
        (F.col("id") * 2 + 1).alias("ord"), "source_id", F.concat(F.lit("Twin of "), "title").alias("title"),
        twin_url.alias("url"), "author", "published_at", F.lit(None).cast("string").alias("summary"), "full_text",
    )
    return first.unionByName(twin)


_BAD_XML = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x{FFFE}\x{FFFF}]"


def _xml(column):
    plain = F.regexp_replace(F.coalesce(column, F.lit("")), _BAD_XML, " ")
    return F.replace(F.replace(F.replace(plain, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _tag(name, value):
    return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))


FEED_SPAN = 100


def feed_documents(spark, sf_dir) -> DataFrame:
    """(source_id, snapshot, document): feed files built from articles, RSS for even and Atom for odd
    sources. A file holds one source's entries out of 100 consecutive ids; every seventh one of
    source 3 is cut off."""
    a = articles(spark, sf_dir).where("source_id IS NOT NULL")
    rss_date = F.concat(F.date_format("published_at", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    atom_date = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rss = F.concat(
        F.lit("<item>"), _tag("title", _xml(F.col("title"))), _tag("link", _xml(F.col("url"))),
        _tag("description", _xml(F.col("full_text"))), _tag("author", _xml(F.col("author"))),
        F.coalesce(_tag("pubDate", rss_date), F.lit("")), F.lit("</item>"),
    )
    atom = F.concat(
        F.lit("<entry>"), _tag("title", _xml(F.col("title"))),
        F.lit('<link href="'), _xml(F.col("url")), F.lit('" rel="alternate"/>'),
        _tag("content", _xml(F.col("full_text"))), _tag("author", _tag("name", _xml(F.col("author")))),
        F.coalesce(_tag("published", atom_date), F.lit("")), F.lit("</entry>"),
    )
    even = F.col("source_id") % 2 == 0
    files = (
        a.select("source_id", F.floor(F.col("id") / FEED_SPAN).alias("snapshot"), "id",
                 F.when(even, rss).otherwise(atom).alias("item"))
        .groupBy("source_id", "snapshot")
        .agg(F.array_sort(F.collect_list(F.struct("id", "item"))).alias("items"))
    )
    name = F.concat(F.lit("Source "), F.col("source_id").cast("string"))
    body = F.array_join(F.transform("items", lambda i: i["item"]), "")
    document = F.when(even, F.concat(
        F.lit("<rss><channel>"), _tag("title", name), _tag("description", F.concat(F.lit("All of "), name)), body,
        F.lit("</channel></rss>"),
    )).otherwise(F.concat(
        F.lit("<feed>"), _tag("title", name), _tag("subtitle", F.concat(F.lit("All of "), name)), body, F.lit("</feed>"),
    ))
    broken = (F.col("source_id") == 3) & (F.col("snapshot") % 7 == 0)
    cut = F.substring(document, F.lit(1), F.length(document) - 25)
    return files.select("source_id", "snapshot", F.when(broken, cut).otherwise(document).alias("document"))


def feeds(spark, sf_dir) -> DataFrame:
    return parse_feeds(feed_documents(spark, sf_dir))


# --- the same views as SQL ------------------------------------------------------------------------

VIEWS = {
    "sources": """
        select n_nationkey as id, n_name as name,
               concat('https://feeds.example.com/', lower(n_name)) as url,
               r_name as category, n_nationkey % 7 <> 0 as is_active
        from nation join region on n_regionkey = r_regionkey""",
    "articles": rf"""
        select d.doc_id as id,
               case when d.doc_id % 50 = 49 then null else cast(substr(d.source, 4) as int) end as source_id,
               trim(substr(split_part(d.text, chr(10), 1), 1, 80)) as title,
               concat('https://', d.source, '.example.com/a/', cast(d.doc_id as varchar)) as url,
               case when e.user_id % 5 = 0 then null
                    else concat('user', cast(e.user_id % 40 as varchar)) end as author,
               case when d.doc_id % 20 = 19 then null else e.ts end as published_at,
               nullif(trim(split_part(d.text, chr(10), 2)), '') as summary,
               d.text as full_text,
               cast(len(regexp_extract_all(d.text, '{WORD}')) as int) as word_count,
               d.lang as language, coalesce(l.quality, 0) = 1 as is_clean, e.ts as scraped_at
        from documents d
        left join events e on e.event_id = d.doc_id
        left join labels l on l.doc_id = d.doc_id""",
    "runs": """
        select cast(date_diff('day', date '2024-01-01', day) + 1 as bigint) as id, started_at, finished_at,
               articles_found, articles_inserted, articles_skipped, errors,
               case when articles_inserted = 0 then 'failed'
                    when errors * 5 > articles_found then 'partial' else 'success' end as status
        from (select cast(ts as date) as day, min(ts) as started_at, max(ts) as finished_at,
                     count(*) as articles_found,
                     count(*) filter (where event_type in ('view', 'click', 'purchase')) as articles_inserted,
                     count(*) filter (where event_type = 'signup') as articles_skipped,
                     count(*) filter (where event_type = 'error') as errors
              from events group by 1)""",
    "raw_batch": """
        select id * 2 as ord, source_id, case when id % 11 = 5 then 'News' else title end as title, url, author,
               published_at,
               case when id % 13 = 6 then null
                    else concat('A &amp; B &lt;b&gt; &copy;  ', coalesce(summary, '')) end as summary,
               case when id % 26 = 6 then null else full_text end as full_text
        from articles
        union all
        select id * 2 + 1, source_id, concat('Twin of ', title),
               case when id % 3 = 0 then url when id % 3 = 1 then upper(url) else concat(url, '?x=1') end,
               author, published_at, null, full_text
        from articles""",
    # 3-word runs of a text, as a list of distinct strings
    "shingled": r"""
        select id, full_text, list_distinct(case when len(c) > 0 then list_transform(
                   range(1, greatest(len(c) - 2, 1) + 1), lambda i: array_to_string(c[i:i+2], ' ')) end) as cs,
               list_distinct(case when len(g) > 0 then list_transform(
                   range(1, greatest(len(g) - 2, 1) + 1), lambda i: array_to_string(g[i:i+2], ' ')) end) as gs
        from (select id, full_text,
                     list_filter(regexp_split_to_array(lower(ct), '[^\p{L}\p{N}]+'), lambda x: x <> '') as c,
                     list_filter(regexp_split_to_array(lower(gt), '[^\p{L}\p{N}]+'), lambda x: x <> '') as g
              from texts)""",
    "texts": rf"""
        select id, full_text,
               case when body <> '' then substr('content: ' || substr(body, 1, 1024), 1, 1024) end as ct,
               substr(concat_ws(' ', case when t <> '' then 'title: ' || t end,
                                case when s <> '' then 'description: ' || substr(s, 1, 400) end,
                                case when body <> '' then 'content: ' || substr(body, 1, 500) end), 1, 1024) as gt
        from (select id, full_text, regexp_replace(full_text, '^{WS}|{WS}$', '', 'g') as body,
                     regexp_replace(title, '^{WS}|{WS}$', '', 'g') as t,
                     regexp_replace(summary, '^{WS}|{WS}$', '', 'g') as s
              from articles)""",
    "buckets": r"""
        select id, b, count(*) as w
        from (select id, cast('0x' || substr(md5(unnest(list_filter(regexp_split_to_array(lower(ct),
                     '[^\p{L}\p{N}]+'), lambda x: x <> ''))), 1, 8) as bigint) % 384 as b from texts)
        group by id, b""",
    "unit": """
        select id, b, w / sqrt(sum(w * w) over (partition by id)) as v from buckets""",
}
_NEEDS = {
    "raw_batch": ["articles"], "texts": ["articles"], "shingled": ["texts"], "buckets": ["texts"], "unit": ["buckets"],
}


def with_views(sql: str) -> str:
    """`sql` with the views it names (and those they need) in front of it."""
    wanted: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS.get(name, []):
            need(other)
        if name not in wanted:
            wanted.append(name)

    for name in VIEWS:
        if re.search(rf"(?:from|join|,)\s+{name}\b", sql):
            need(name)
    sql = sql.strip()
    if not wanted:
        return sql
    heads = ", ".join(f"{name} as ({VIEWS[name]})" for name in wanted)
    if sql.lower().startswith("with recursive "):
        return f"with recursive {heads}, {sql[15:]}"
    if sql.lower().startswith("with "):
        return f"with {heads}, {sql[5:]}"
    return f"with {heads} {sql}"
