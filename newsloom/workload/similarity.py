"""Vectors, neighbours, deduplication and what builds on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.functions import features
from newsloom.operators import admission, dedup, maintenance, nearest
from newsloom.operators.lsh import lsh_nearest
from newsloom.operators.vector_index import VectorIndex
from newsloom.plans import health, report
from newsloom.session import passing_stages, scratch_path, stage
from newsloom.workload import views
from newsloom.workload.catalog import ORACLE, query
from newsloom.workload.views import WS, table

# Vectors of `embeddings` are far apart: their closest pairs reach about 0.5.
LOOSE = 0.40


def _embeddings(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


_LONG = """
    coords as (select vec_id as id, label, unnest(embedding) as x, unnest(range(1, len(embedding) + 1)) as i from embeddings),
    norms as (select id, any_value(label) as label, sqrt(sum(cast(x as double) * x)) as n from coords group by id)"""
_SIMS = f"""{_LONG},
    sims as (select a.id as id, b.id as other, any_value(na.label) as label, any_value(nb.label) as other_label,
                    round(sum(cast(a.x as double) * b.x) / any_value(na.n * nb.n), 9) as s
             from coords a join coords b on a.i = b.i join norms na on na.id = a.id join norms nb on nb.id = b.id
             group by a.id, b.id)"""


@query("p25_cosine", f"""
    with {_LONG}, nxt as (select vec_id as id, lead(vec_id) over (order by vec_id) as other from embeddings)
    select n.id, n.other, round(sum(cast(a.x as double) * b.x) / any_value(na.n * nb.n), 6) as similarity
    from nxt n join coords a on a.id = n.id join coords b on b.id = n.other and b.i = a.i
    join norms na on na.id = n.id join norms nb on nb.id = n.other group by 1, 2""")
def _(spark, sf):
    e = _embeddings(spark, sf)
    # ids are consecutive
    other = e.select((F.col("id") - 1).alias("id"), F.col("id").alias("other"), F.col("vector").alias("w"))
    return e.join(other, "id").select(
        "id", "other", F.round(features.cosine(F.col("vector"), F.col("w")), 6).alias("similarity"))


@query("p26_rounded", f"""
    with {_LONG}
    select n.id, case when n.id % 10 = 0 then null else round(sum(cast(a.x as double) * b.x) / any_value(na.n * nb.n), 4) end
               as similarity
    from (select vec_id as id, vec_id + 1 as other from embeddings) n
    join coords a on a.id = n.id join coords b on b.id = n.other and b.i = a.i
    join norms na on na.id = n.id join norms nb on nb.id = n.other group by n.id""")
def _(spark, sf):
    e = _embeddings(spark, sf)
    other = e.select((F.col("id") - 1).alias("id"), F.col("vector").alias("w"))
    mine = F.when(F.col("id") % 10 == 0, None).otherwise(F.col("vector"))
    return e.join(other, "id").select("id", features.rounded(features.cosine(mine, F.col("w"))).alias("similarity"))


@query("p30_dense_vectors", "select id, cast(b as int) as bucket, round(v, 9) as weight from unit")
def _(spark, sf):
    v = views.dense(spark, sf).select("id", F.posexplode("vector").alias("bucket", "weight"))
    return v.where("weight <> 0").select("id", "bucket", F.round("weight", 9).alias("weight"))


_SET_SIZES = """
    select id, cast(len(cs) as int) as content_size, cast(len(gs) as int) as general_size,
           cast(len(list_intersect(cs, gs)) as int) as shared from shingled"""


def _set_sizes(rows):
    """Hashes have no SQL form; how many two sets share shows that equal runs of words have equal ones."""
    return rows.select(
        "id", F.size("content_embedding").alias("content_size"), F.size("embedding").alias("general_size"),
        F.size(F.array_intersect("content_embedding", "embedding")).alias("shared"))


@query("p30_feature_sets", _SET_SIZES)
def _(spark, sf):
    return _set_sizes(views.embedded(spark, sf))


_SETS = """
    cpost as (select id, len(cs) as n, unnest(cs) as f from shingled),
    gpost as (select id, len(gs) as n, unnest(gs) as f from shingled),
    csim as (select a.id, b.id as m, count(*) / sqrt(any_value(a.n) * any_value(b.n)) as s
             from cpost a join cpost b on a.f = b.f and b.id < a.id group by a.id, b.id),
    gsim as (select a.id, b.id as m, count(*) / sqrt(any_value(a.n) * any_value(b.n)) as s
             from gpost a join gpost b on a.f = b.f and b.id < a.id group by a.id, b.id),
    asks as (select id from texts where length(regexp_replace(full_text, '^\\s+|\\s+$', '', 'g')) >= 50),
    content as (select id, m as match_id, s as similarity from (
                    select id, m, s, row_number() over (partition by id order by s desc, m) as rk from csim
                    where s >= 0.92 and id in (select id from asks)) where rk = 1),
    general as (select id, m as match_id, s as similarity from (
                    select id, m, s, row_number() over (partition by id order by s desc, m) as rk from gsim
                    where s >= 0.92 and id not in (select id from content)) where rk = 1)""".replace("\\\\", "\\")


def _batch(spark, sf):
    """Nothing stored yet, every document in the batch."""
    rows = views.embedded(spark, sf).withColumn("asks", dedup.long_enough(F.col("full_text"))).drop("full_text")
    rows = stage(rows, "embedded")
    return rows.where("false"), rows


@query("d3_content_duplicates", f"with {_SETS} select * from content")
def _(spark, sf):
    return dedup.content_matches(*_batch(spark, sf))


@query("d3_heavy_blocks", f"with {_SETS} select * from content")
def _(spark, sf):
    """The same with every shared coordinate of more than twenty pairs compared in blocks."""
    rows = _batch(spark, sf)[1].select(
        "id", F.col("content_embedding").alias("features"), "asks")
    return nearest.nearest_earlier_sets(rows, dedup.THRESHOLD, light_pairs=20)


@query("d4_general_duplicates", f"with {_SETS} select * from general")
def _(spark, sf):
    stored, batch = _batch(spark, sf)
    return dedup.general_matches(stored, batch, dedup.content_matches(stored, batch))


FLAGGED = f"""{_SETS},
    flagged as (
        select t.id, c.match_id is not null or g.match_id is not null as is_duplicate,
               coalesce(c.match_id, g.match_id) as duplicate_of_id,
               case when c.match_id is not null then c.similarity when g.match_id is not null then 0.92 end as similarity_score
        from texts t left join content c on c.id = t.id left join general g on g.id = t.id)"""


def _flagged(spark, sf):
    """Flags, and whether there is a vector, without the texts and vectors themselves."""
    stored, batch = _batch(spark, sf)
    matches = dedup.duplicate_matches(stored, batch)
    slim = stage(batch.select("id", F.col("content_embedding").isNotNull().alias("has_embedding")), "slim")
    return dedup.with_flags(slim, matches)


@query("d9_threshold_override", f"""
    with {_SETS.replace('0.92', '0.80')} select id, match_id, round(similarity, 9) as similarity from content""")
def _(spark, sf):
    return dedup.content_matches(*_batch(spark, sf), threshold=0.80).withColumn("similarity", F.round("similarity", 9))


# The table before: even documents, by their own ids. The batch: every entry of raw_batch.
_STORED_URLS = "stored as (select id, url from articles where id % 4 = 0)"


@query("d2_new_urls", f"""
    with {_STORED_URLS}, firsts as (
        select ord, url, row_number() over (partition by lower(url) order by ord) as rn from raw_batch)
    select ord, url from firsts where rn = 1 and lower(url) not in (select lower(url) from stored)""")
def _(spark, sf):
    stored = views.articles(spark, sf).where("id % 4 = 0")
    return dedup.new_urls(views.raw_batch(spark, sf), stored, ["ord"]).select("ord", "url")


@query("j4_url_conflicts", f"""
    with {_STORED_URLS}
    select ord, url from raw_batch where lower(url) not in (select lower(url) from stored)""")
def _(spark, sf):
    stored = views.articles(spark, sf).where("id % 4 = 0").select(F.lower("url").alias("k"))
    batch = views.raw_batch(spark, sf).select("ord", "url", F.lower("url").alias("k"))
    return batch.join(stored, "k", "left_anti").drop("k")


def _insert(spark, sf, **options):
    """Twins of every article meet an empty table: URL twins go, text twins are flagged."""
    batch = stage(views.raw_batch(spark, sf), "batch")
    empty = spark.createDataFrame([], dedup.ARTICLES)
    return dedup.dedup_insert(empty, batch.select(
        "ord", "source_id", "title", "url", "author", "published_at", "summary", "full_text",
        F.lit(None).cast("int").alias("word_count"), F.lit("en").alias("language"), F.lit(True).alias("is_clean"),
    ), ["ord"], **options)


_INSERTED = """
    firsts as (select *, row_number() over (partition by lower(url) order by ord) as rn from raw_batch),
    numbered as (select *, row_number() over (order by ord) as id from firsts where rn = 1)"""


@query("d6_url_only_insert", f"""
    with {_INSERTED}
    select id, url, title, false as is_duplicate, cast(null as bigint) as duplicate_of_id from numbered""")
def _(spark, sf):
    return _insert(spark, sf, use_vectors=False).rows.select("id", "url", "title", "is_duplicate", "duplicate_of_id")


# Rows of the insert in the form the shared text views expect.
def _insert_sql(tail: str) -> str:
    texts = views.VIEWS["texts"].replace("from articles", "from numbered")
    shingled = views.VIEWS["shingled"]
    return f"with {_INSERTED}, texts as ({texts}), shingled as ({shingled}), {FLAGGED} {tail}"


def _insert_oracle(tail: str) -> str:
    base = f"articles as ({views.VIEWS['articles']}), raw_batch as ({views.VIEWS['raw_batch']})"
    return f"with {base}, {_insert_sql(tail).strip()[5:]}"


def insert_query(name: str, tail: str):
    """Register a query over the insert; its views are already spelled out."""

    def add(function):
        query(name)(function)
        ORACLE[name] = _insert_oracle(tail)
        return function

    return add


@insert_query("d5_dedup_insert", """
    select n.id, n.url, f.is_duplicate, f.duplicate_of_id, f.similarity_score
    from numbered n join flagged f on f.id = n.id""")
def _(spark, sf):
    return _insert(spark, sf).rows.select("id", "url", "is_duplicate", "duplicate_of_id", "similarity_score")


@insert_query("a9_insert_counters", """
    select (select count(*) from raw_batch) as found, count(*) as inserted,
           count(*) filter (where is_duplicate) as skipped_vector,
           (select count(*) from raw_batch) - count(*) as skipped_url,
           count(*) filter (where is_duplicate) + (select count(*) from raw_batch) - count(*) as skipped
    from flagged""")
def _(spark, sf):
    return _insert(spark, sf).counters


@insert_query("d7_insert_by_hand", """
    select n.id, n.url, '(untitled)' as title, c.match_id is not null as is_duplicate, c.match_id as duplicate_of_id,
           c.similarity as similarity_score
    from numbered n left join content c on c.id = n.id""")
def _(spark, sf):
    batch = stage(views.raw_batch(spark, sf), "batch").select(
        "ord", "url", F.lit("").alias("title"), "summary", "full_text", F.lit("General").alias("category"))
    empty = spark.createDataFrame([], dedup.ARTICLES)
    return dedup.insert_articles(empty, batch, ["ord"]).rows.select(
        "id", "url", "title", "is_duplicate", "duplicate_of_id", "similarity_score")


# --- the insert into a filled table ---------------------------------------------------------------


def _insert_in_two(spark, sf):
    """The same insert in two batches through the table store: the second meets what the first stored."""
    from newsloom.session import scratch_path
    from newsloom.sources.tables import TableStore

    rows = views.raw_batch(spark, sf, written=True).select(
        "ord", "source_id", "title", "url", "author", "published_at", "summary", "full_text",
        F.lit(None).cast("int").alias("word_count"), F.lit("en").alias("language"), F.lit(True).alias("is_clean"))
    half = rows.agg((F.max("ord") / 2).alias("half")).scalar()
    placed = rows.withColumn("late", F.col("ord") > half)
    store, counters = TableStore(spark, scratch_path(spark, "store")), []
    for batch, part in ((1, placed.where("NOT late")), (2, placed.where("late"))):
        with passing_stages(spark):
            known = store.known_sets(before=batch)
            added = dedup.dedup_insert(store.articles(before=batch), part.drop("late"), ["ord"], known=known)
            store.write_articles(added.rows, batch)
            store.write_sets(store.written(batch, "only"), known, batch)
            counters.append(stage(added.counters, "counters", lasting=True))
            store.write_run(maintenance.run_row(batch, counters[-1], F.current_timestamp(), F.current_timestamp()), batch)
    return store, counters


@insert_query("d5_insert_into_stored", """
    select n.id, n.url, n.title, f.is_duplicate, f.duplicate_of_id, f.similarity_score
    from numbered n join flagged f on f.id = n.id""")
def _(spark, sf):
    """One batch or two: the rows are the same."""
    return _insert_in_two(spark, sf)[0].articles().select("id", "url", "title", "is_duplicate", "duplicate_of_id", "similarity_score")


_LATE = "select id, ord > (select max(ord) / 2.0 from raw_batch) as late from numbered"


@insert_query("a9_counters_of_stored", f"""
    select p.late, (select count(*) from raw_batch r where (r.ord > (select max(ord) / 2.0 from raw_batch)) = p.late) as found,
           count(*) as inserted, count(*) filter (where is_duplicate) as skipped_vector
    from flagged f join ({_LATE}) p on p.id = f.id group by p.late""")
def _(spark, sf):
    first, second = _insert_in_two(spark, sf)[1]
    return (
        first.withColumn("late", F.lit(False)).unionByName(second.withColumn("late", F.lit(True)))
        .select("late", "found", "inserted", "skipped_vector"))


@insert_query("d6_url_only_into_stored", """
    select n.id, n.url from numbered n where n.ord > (select max(ord) / 2.0 from raw_batch)""")
def _(spark, sf):
    """The second half by URL only, after the first."""
    rows = stage(views.raw_batch(spark, sf), "batch").select(
        "ord", "source_id", "title", "url", "author", "published_at", "summary", "full_text",
        F.lit(None).cast("int").alias("word_count"), F.lit("en").alias("language"), F.lit(True).alias("is_clean"))
    half = rows.agg((F.max("ord") / 2).alias("half")).scalar()
    placed = rows.withColumn("late", F.col("ord") > half)
    empty = spark.createDataFrame([], dedup.ARTICLES)
    stored = stage(dedup.dedup_insert(empty, placed.where("NOT late").drop("late"), ["ord"], use_vectors=False).rows, "stored")
    return dedup.dedup_insert(stored, placed.where("late").drop("late"), ["ord"], use_vectors=False).rows.select("id", "url")


@query("s10_article_append", "select count(*) as articles, count(distinct id) as ids from articles")
def _(spark, sf):
    """Append through the table store in two batches, then read back what is visible."""
    from newsloom.session import scratch_path
    from newsloom.sources.tables import TableStore

    store = TableStore(spark, scratch_path(spark, "store"))
    a = views.articles(spark, sf)
    rows = stage(maintenance.evolve(a, dedup.ARTICLES, {"is_duplicate": False}), "rows")
    early = F.coalesce(F.col("source_id") < 10, F.lit(False))
    for batch, part in ((1, rows.where(early)), (2, rows.where(~early))):
        store.write_articles(part, batch)
        counters = dedup.insert_counters(part, part)
        store.write_run(maintenance.run_row(batch, counters, F.current_timestamp(), F.current_timestamp()), batch)
    return store.articles().agg(F.count("*").alias("articles"), F.countDistinct("id").alias("ids"))


_PARTS = """
    parts as (select max(ord) as m from raw_batch),
    a as (select lower(url) as k, min(ord) as ord from raw_batch, parts where ord <= m / 4.0 group by 1),
    a_ids as (select k, row_number() over (order by ord) as id from a),
    b as (select lower(url) as k, min(ord) as ord from raw_batch, parts where ord > m / 2.0 and lower(url) not in (select k from a) group by 1),
    b_ids as (select k, ord, (select count(*) from a) + row_number() over (order by ord) as id from b),
    again as (select lower(url) as k, min(ord) as ord from raw_batch, parts where ord <= 3 * m / 4.0 and lower(url) not in (select k from b) group by 1),
    more as (select k, (select count(*) from a) + (select count(*) from b) + row_number() over (order by ord) as id
             from again where k not in (select k from a))"""


@query("s10_replayed_batch", f"""
    with {_PARTS},
    rows as (select ord, coalesce(o.id, m.id) as id from again g left join a_ids o on o.k = g.k left join more m on m.k = g.k
             union all select ord, id from b_ids)
    select r.id, x.url from rows r join raw_batch x on x.ord = r.ord""")
def _(spark, sf):
    """Batch 1, batch 2, then batch 1 again with more rows, some of them under URLs that batch 2 has stored."""
    from newsloom.sources.tables import TableStore

    rows = stage(views.raw_batch(spark, sf), "batch").select(
        "ord", "source_id", "title", "url", "author", "published_at", "summary", "full_text",
        F.lit(None).cast("int").alias("word_count"), F.lit("en").alias("language"), F.lit(True).alias("is_clean"))
    most = rows.agg(F.max("ord").alias("most")).scalar()
    placed = rows.withColumn("part", F.col("ord") / most)
    store = TableStore(spark, scratch_path(spark, "store"))
    for batch, part in ((1, "part <= 0.25"), (2, "part > 0.5"), (1, "part <= 0.75")):
        seen, attempt = store.seen_by(batch), store.new_attempt()
        added = dedup.dedup_insert(
            seen.stored, placed.where(part).drop("part"), ["ord"], use_vectors=False, taken=seen.taken, replaced=seen.replaced)
        store.write_articles(added.rows, batch, attempt)
        store.write_run(maintenance.run_row(batch, added.counters, F.current_timestamp(), F.current_timestamp()), batch, attempt)
    return store.articles().select("id", "url")


# --- dense neighbours ---------------------------------------------------------------------------


@query("d3_dense_duplicates", """
    with sims as (select a.id, b.id as m, round(sum(a.v * b.v), 9) as s from unit a join unit b on a.b = b.b and b.id < a.id
                  group by a.id, b.id)
    select id, m as match_id, round(s, 6) as similarity from (
        select id, m, s, row_number() over (partition by id order by s desc, m) as rk from sims where s >= 0.92
          and id in (select id from texts where length(trim(full_text)) >= 50)) where rk = 1""")
def _(spark, sf):
    rows = stage(views.dense(spark, sf).select("id", "vector", dedup.long_enough(F.col("full_text")).alias("asks")), "dense")
    return nearest.nearest_earlier_vectors(rows, dedup.THRESHOLD).withColumn("similarity", F.round("similarity", 6))


@query("j5_nearest_by_content", f"""
    with {_SIMS}
    select id, other as match_id, round(s, 6) as similarity from (
        select id, other, s, row_number() over (partition by id order by s desc, other) as rk from sims
        where label <= 4 and other_label > 4 and s >= {LOOSE}) where rk = 1""")
def _(spark, sf):
    e = _embeddings(spark, sf)
    found = nearest.nearest_vectors(e.where("label <= 4"), e.where("label > 4"), LOOSE)
    return found.withColumn("similarity", F.round("similarity", 6))


@query("j5_pruned_cells", f"""
    with {_SIMS}
    select id, other as match_id, round(s, 6) as similarity from (
        select id, other, s, row_number() over (partition by id order by s desc, other) as rk from sims
        where label <= 4 and other_label > 4 and s >= {LOOSE}) where rk = 1""")
def _(spark, sf):
    """Cells of some 16 vectors, so that queries pass over cells and rings."""
    e = _embeddings(spark, sf)
    found = nearest.nearest_vectors(e.where("label <= 4"), e.where("label > 4"), LOOSE, cell_rows=16)
    return found.withColumn("similarity", F.round("similarity", 6))


@query("j8_nearest_others", f"""
    with {_SIMS}
    select id, other as match_id, round(s, 6) as similarity from (
        select id, other, s, row_number() over (partition by id order by s desc, other) as rk from sims
        where other <> id and s >= {LOOSE}) where rk = 1""")
def _(spark, sf):
    """The nearest other vector of every vector."""
    e = _embeddings(spark, sf)
    return nearest.nearest_vectors(e, e, LOOSE, exclude_self=True).withColumn("similarity", F.round("similarity", 6))


@query("d3_probe_recall", f"""
    with {_SIMS} select count(distinct id) as matches, true as recall_reached from sims where other < id and s >= {LOOSE}""")
def _(spark, sf):
    """How many rows exact search matches, and whether visiting seven of eight cells finds 0.9 of these."""
    rows = _embeddings(spark, sf).select("id", "vector", F.lit(True).alias("asks"))
    n = rows.count()
    exact = stage(nearest.nearest_earlier_vectors(rows, LOOSE), "exact")
    few = nearest.nearest_earlier_vectors(rows, LOOSE, probes=7, pivots=8, cell_rows=max(1, n // 8))
    return _recall(exact, few)


def _recall(exact, found):
    both = exact.join(found.select("id", F.col("match_id").alias("found")), "id", "left")
    return both.agg(
        F.count("*").alias("matches"),
        (F.count_if(F.col("found") == F.col("match_id")) >= 0.9 * F.count("*")).alias("recall_reached"))


_FIFTIETH = f"""
    with {_SIMS}
    select id, other as match_id, round(s, 6) as similarity from (
        select id, other, s, row_number() over (partition by id order by s desc, other) as rk from sims
        where id % 50 = 0 and other <> id and s >= {LOOSE}) where rk = 1"""


@query("j5_into_stored_cells", _FIFTIETH)
def _(spark, sf):
    """An index on disk, filled in two batches, asked by every fiftieth vector: what one batch would give."""
    e = _embeddings(spark, sf).select("id", "vector", "label")
    index = VectorIndex(spark, scratch_path(spark, "index"))
    late = F.col("label") > 4
    index.fit(e.where(~late), cell_rows=16)
    for batch, part in ((1, e.where(~late)), (2, e.where(late | late.isNull()))):
        index.add(part.select("id", "vector"), batch)
    return index.nearest(e.where("id % 50 = 0").select("id", "vector"), LOOSE, exclude_self=True).withColumn("similarity", F.round("similarity", 6))


@query("j5_lsh_recall", f"""
    with {_SIMS} select count(distinct id) as matches, true as recall_reached from sims where id % 50 = 0 and other <> id and s >= {LOOSE}""")
def _(spark, sf):
    """How many of every fiftieth vector have a neighbour, and whether the hash tables name 0.9 of these neighbours."""
    e = _embeddings(spark, sf).select("id", "vector")
    asked = e.where("id % 50 = 0")
    exact = stage(nearest.nearest_vectors(asked, e, LOOSE, exclude_self=True), "exact")
    return _recall(exact, lsh_nearest(asked, e, LOOSE, exclude_self=True, bits=6))


@query("j6_nearest_by_general", f"""
    with {_SIMS}
    select id, other as match_id from (
        select id, other, s, row_number() over (partition by id order by s desc, other) as rk from sims
        where other < id and s >= {LOOSE}) where rk = 1""")
def _(spark, sf):
    rows = _embeddings(spark, sf).select("id", "vector", F.lit(True).alias("asks"))
    return nearest.nearest_earlier_vectors(rows, LOOSE).select("id", "match_id")


@query("j5_nearest_sets", """
    with post as (select id, len(cs) as n, unnest(cs) as f from shingled),
    sims as (select a.id, b.id as m, count(*) / sqrt(any_value(a.n) * any_value(b.n)) as s
             from post a join post b on a.f = b.f join articles x on x.id = a.id join articles y on y.id = b.id
             where coalesce(x.source_id, -1) < 10 and y.source_id >= 10 group by a.id, b.id)
    select id, m as match_id, s as similarity from (
        select *, row_number() over (partition by id order by s desc, m) as rk from sims where s >= 0.92) where rk = 1""")
def _(spark, sf):
    a = views.articles(spark, sf).select("id", "source_id")
    rows = stage(views.embedded(spark, sf).join(a, "id"), "embedded").withColumnRenamed("content_embedding", "features")
    asking = rows.where(F.coalesce("source_id", F.lit(-1)) < 10).select("id", "features")
    return nearest.nearest_sets(asking, rows.where("source_id >= 10").select("id", "features"), dedup.THRESHOLD)


_TOP = f"""
    with {_SIMS}, q as (select max(vec_id) as id from embeddings)
    select id as query_id, other as id, round(s, 6) as similarity from sims
    where id = (select id from q) and other <> id order by s desc, other limit 1"""


@query("t5_nearest_to_latest", _TOP)
def _(spark, sf):
    e = _embeddings(spark, sf)
    newest = e.orderBy(F.desc("id")).limit(1)
    return nearest.nearest_to(e, newest, "vector", ["id"]).withColumn("similarity", F.round("similarity", 6))


@query("j8_nearest_excluding_self", _TOP.replace("max(vec_id)", "min(vec_id)"))
def _(spark, sf):
    e = _embeddings(spark, sf)
    oldest = e.orderBy("id").limit(1)
    return nearest.nearest_to(e, oldest, "vector", ["id"], exclude_self=True).withColumn(
        "similarity", F.round("similarity", 6))


@query("j10_similarity_to_one", f"""
    with {_SIMS} select other as id, round(s, 6) as similarity from sims where id = 7""")
def _(spark, sf):
    e = _embeddings(spark, sf)
    return nearest.similarity_to(e, e.where("id = 7"), "vector").select("id", F.round("similarity", 6).alias("similarity"))


@query("t6_dedup_health", f"""
    with {FLAGGED}, last as (
        select a.id from articles a order by a.id desc limit 10),
    newest as (select max(id) as id from shingled where len(cs) > 0),
    post as (select id, len(cs) as n, unnest(cs) as f from shingled),
    sims as (select b.id as m, count(*) / sqrt(any_value(a.n) * any_value(b.n)) as s from post a join post b on a.f = b.f
             where a.id = (select id from newest) and b.id <> a.id group by b.id)
    select 'Last Articles' as section, id, null::double as similarity from last
    union all select 'Latest Match', m, round(s, 6) from (select m, s from sims where s >= 0.5 order by s desc, m limit 1)
    union all select 'Counts', count(*), null from articles""")
def _(spark, sf):
    rows = stage(views.embedded(spark, sf), "embedded")
    flags = stage(_flagged(spark, sf), "flagged").select("id", "is_duplicate", "duplicate_of_id", "similarity_score")
    articles = views.articles(spark, sf).join(rows.select("id", "embedding", "content_embedding"), "id").join(flags, "id")
    parts = health.dedup_health(articles)
    none = F.lit(None).cast("double").alias("similarity")
    counts = parts["Counts"]
    return (
        parts["Last Articles"].select(F.lit("Last Articles").alias("section"), F.col("id").cast("bigint").alias("id"), none)
        .unionByName(parts["Latest Match"].select(F.lit("Latest Match").alias("section"), F.col("match_id").alias("id"), F.round("similarity", 6).alias("similarity")))
        .unionByName(counts.select(F.lit("Counts").alias("section"), F.col(counts.columns[0]).cast("bigint").alias("id"), none)))


@query("t6_latest_embedded", "select max(vec_id) as id from embeddings")
def _(spark, sf):
    rows = _embeddings(spark, sf).withColumn("url", F.lit(""))
    return health.latest_embedded(rows, "vector").select("id")


@query("j9_pair_similarity", f"""
    with {_LONG}, pairs as (select event_id % (select count(*) from embeddings) as id1, user_id as id2 from events),
    distinct_pairs as (select distinct id1, id2 from pairs
                       where id1 in (select vec_id from embeddings) and id2 in (select vec_id from embeddings)),
    sims as (select p.id1, p.id2, round(sum(cast(a.x as double) * b.x) / any_value(na.n * nb.n), 4) as similarity
             from distinct_pairs p join coords a on a.id = p.id1 join coords b on b.id = p.id2 and a.i = b.i
             join norms na on na.id = p.id1 join norms nb on nb.id = p.id2 group by p.id1, p.id2)
    select id1, id2, similarity, case when similarity >= 0.92 then 'duplicate' when similarity >= 0.8 then 'near'
                                      else 'different' end as band from sims""")
def _(spark, sf):
    n = _embeddings(spark, sf).agg(F.count("*")).scalar()
    pairs = table(spark, sf, "events").withColumn("n", n).select(
        (F.col("event_id") % F.col("n")).alias("id1"), F.col("user_id").alias("id2")).distinct()
    rows = _embeddings(spark, sf).withColumn("url", F.concat(F.lit("https://example.com/"), "id"))
    return health.pair_similarity(rows, pairs, features.cosine, "vector").select("id1", "id2", "similarity", "band")


# --- the flagged table ----------------------------------------------------------------------------


def _flagged_articles(spark, sf):
    flagged = stage(_flagged(spark, sf), "flagged")
    urls = views.articles(spark, sf).select("id", "title", "url")
    return flagged.join(urls, "id")


@query("t2_last_articles", f"""
    with {FLAGGED}
    select f.id, f.is_duplicate, f.duplicate_of_id, f.similarity_score, t.ct is not null as has_embedding, a.url[1:60] as url
    from flagged f join articles a on a.id = f.id join texts t on t.id = f.id order by f.id desc limit 20""")
def _(spark, sf):
    return report.last_articles(_flagged_articles(spark, sf), 20)


@query("t3_duplicates", f"""
    with {FLAGGED}
    select f.id, f.is_duplicate, f.duplicate_of_id, f.similarity_score, a.url[1:65] as url
    from flagged f join articles a on a.id = f.id where f.is_duplicate""")
def _(spark, sf):
    return report.duplicates(_flagged_articles(spark, sf))


@query("a8_table_counts", f"""
    with {FLAGGED}
    select count(*) as total, count(t.ct) as with_embedding, count(*) - count(t.ct) as without_embedding,
           count(*) filter (where f.is_duplicate) as duplicates
    from flagged f join texts t on t.id = f.id""")
def _(spark, sf):
    return report.table_counts(_flagged_articles(spark, sf))


@query("j11_originals", f"""
    with {FLAGGED}
    select f.id, a.url, f.duplicate_of_id, f.similarity_score, o.title as original_title, o.url as original_url
    from flagged f join articles a on a.id = f.id left join articles o on o.id = f.duplicate_of_id where f.is_duplicate""")
def _(spark, sf):
    return dedup.with_originals(_flagged_articles(spark, sf))


@query("j11_resolved_roots", f"""
    with recursive {FLAGGED.strip()},
    chain as (
        select id, id as root_id from flagged where duplicate_of_id is null
        union all
        select f.id, c.root_id from flagged f join chain c on f.duplicate_of_id = c.id)
    select id, root_id from chain""")
def _(spark, sf):
    return dedup.resolve_roots(_flagged_articles(spark, sf))


@query("u5_delete_article", f"""
    with {FLAGGED}, victim as (select min(duplicate_of_id) as v from flagged)
    select id, nullif(duplicate_of_id, (select v from victim)) as duplicate_of_id from flagged
    where id <> (select v from victim)""")
def _(spark, sf):
    rows = stage(_flagged(spark, sf), "flagged")
    victim = rows.agg(F.min("duplicate_of_id").alias("v")).first()["v"]
    return maintenance.delete_article(rows, victim).select("id", "duplicate_of_id")


@query("r4_latest_match", f"""
    with {_SETS}, q as (select max(id) as id from shingled where len(cs) > 0),
    sims as (select a.id as query_id, b.id as match_id, count(*) / sqrt(any_value(a.n) * any_value(b.n)) as similarity
             from cpost a join cpost b on a.f = b.f where a.id = (select id from q) and b.id <> a.id group by 1, 2)
    select query_id, match_id, url[1:60] as url, similarity, similarity >= 0.92 as is_duplicate
    from sims join articles a on a.id = match_id where similarity >= 0.01 order by similarity desc, match_id limit 1""")
def _(spark, sf):
    rows = views.embedded(spark, sf).join(views.articles(spark, sf).select("id", "url"), "id")
    return health.latest_match(rows, 0.01)


@query("r5_pair_report", f"""
    with {_SETS}, pairs as (select id as id1, match_id as id2 from content)
    select p.id1, p.id2, a.url[1:55] as url1, b.url[1:55] as url2, round(s.s, 4) as similarity,
           case when round(s.s, 4) >= 0.92 then 'duplicate' when round(s.s, 4) >= 0.8 then 'near' else 'different' end as band
    from pairs p join csim s on s.id = p.id1 and s.m = p.id2 join articles a on a.id = p.id1 join articles b on b.id = p.id2""")
def _(spark, sf):
    stored, batch = _batch(spark, sf)
    rows = batch.join(views.articles(spark, sf).select("id", "url"), "id")
    pairs = dedup.content_matches(stored, batch).select(F.col("id").alias("id1"), F.col("match_id").alias("id2"))
    return health.pair_similarity(rows, pairs).select("id1", "id2", "url1", "url2", "similarity", "band")


@query("a11_backfill_counters", """
    select count(*) filter (where body <> '') as embedded, count(*) filter (where body = '') as skipped, count(*) as total
    from (select case when id % 5 = 0 then '' else trim(full_text) end as body from articles where id % 2 = 1)""")
def _(spark, sf):
    return maintenance.backfill_counters(_half_embedded(spark, sf))


def _half_embedded(spark, sf):
    """Even articles have a vector, odd ones not; every fifth text is blank."""
    rows = views.embedded(spark, sf)
    return rows.select(
        "id", F.when(F.col("id") % 5 == 0, F.lit("  ")).otherwise(F.col("full_text")).alias("full_text"),
        F.when(F.col("id") % 2 == 0, F.col("content_embedding")).alias("content_embedding"))


@query("u11_backfill_content", """
    select id, cast(case when id % 2 = 1 and id % 5 = 0 then -1 else coalesce(len(cs), -1) end as int) as size from shingled""")
def _(spark, sf):
    rows = maintenance.backfill_content(_half_embedded(spark, sf))
    return rows.select("id", F.coalesce(F.size("content_embedding"), F.lit(-1)).alias("size"))


@query("u13_vectors_of_new_rows", _SET_SIZES)
def _(spark, sf):
    return _set_sizes(dedup.with_vectors(views.articles(spark, sf).select("id", "title", "summary", "full_text")))


# --- sources ----------------------------------------------------------------------------------------

_SOURCE_TEXT = rf"""
    firsts as (select source_id, id, title, full_text, row_number() over (partition by source_id order by id) as rn
               from articles where source_id is not null),
    items as (select source_id, string_agg(concat_ws(' ', case when t <> '' then 'article: ' || t end,
                         case when s <> '' then s[1:150] end), ' ' order by rn) as items
              from (select source_id, rn, trim(regexp_replace(title, '{WS}', ' ', 'g')) as t,
                           trim(regexp_replace(full_text, '{WS}', ' ', 'g')) as s from firsts where rn <= 5)
              group by source_id),
    source_text as (
        select s.id, s.name, s.category, trim('name: ' || s.name || ' category: ' || s.category || ' ' ||
               substr('feed: Source ' || s.id || ' about: All of Source ' || s.id || ' ' || i.items, 1, 700)) as text
        from sources s join items i on i.source_id = s.id)"""


def _source_texts(spark, sf):
    a = views.articles(spark, sf).where("source_id IS NOT NULL")
    entries = a.select("source_id", F.col("id").alias("position"), "title", F.col("full_text").alias("summary"))
    s = views.sources(spark, sf)
    name = F.concat(F.lit("Source "), F.col("id").cast("string"))
    channels = s.select(
        F.col("id").alias("source_id"), name.alias("channel_title"),
        F.concat(F.lit("All of "), name).alias("channel_description"))
    texts = admission.feed_text(channels, entries).withColumnRenamed("source_id", "id")
    seen = a.select(F.col("source_id").alias("id")).distinct()
    return s.join(texts, "id").join(seen, "id", "left_semi").select(
        "id", "name", "url", "category",
        admission.source_text(F.col("name"), F.col("category"), F.col("feed_text")).alias("source_text"))


@query("p31_source_text", f"with {_SOURCE_TEXT} select id, text as source_text from source_text")
def _(spark, sf):
    return _source_texts(spark, sf).select("id", "source_text")


_SOURCE_SIM = _SOURCE_TEXT + r""",
    sb as (select id, b, count(*) as w from (
               select id, cast('0x' || substr(md5(unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
                   lambda x: x <> ''))), 1, 8) as bigint) % 384 as b from source_text) group by id, b),
    su as (select id, b, w / sqrt(sum(w * w) over (partition by id)) as v from sb),
    ss as (select a.id, m.id as other, round(sum(a.v * m.v), 9) as s from su a join su m on a.b = m.b group by 1, 2),
    match as (select id, other, s from (
                  select id, other, s, row_number() over (partition by id order by s desc, other) as rk from ss
                  where id >= 10 and other < 10 and s >= 0.5) where rk = 1)"""


def _source_vectors(spark, sf):
    return stage(admission.with_source_vectors(_source_texts(spark, sf)), "source-vectors")


@query("j7_nearest_source", f"""
    with {_SOURCE_SIM}
    select cast(m.id as bigint) as id, cast(m.other as bigint) as match_id, s.name as match_name, round(m.s, 6) as similarity
    from match m join sources s on s.id = m.other""")
def _(spark, sf):
    rows = _source_vectors(spark, sf)
    asked = rows.where("id >= 10").select(F.col("id").cast("bigint").alias("id"), F.col("source_embedding").alias("vector"))
    stored = rows.where("id < 10").select(F.col("id").cast("bigint").alias("id"), F.col("source_embedding").alias("vector"))
    names = rows.select(F.col("id").alias("match_id"), F.col("name").alias("match_name"))
    return nearest.nearest_vectors(asked, stored, 0.5).join(names, "match_id").select(
        "id", "match_id", "match_name", F.round("similarity", 6).alias("similarity"))


@query("d8_source_admission", f"""
    with {_SOURCE_SIM}
    select t.id, m.id is null as accepted, case when m.id is not null then 'similar' end as reason, cast(m.other as bigint) as match_id
    from source_text t left join match m on m.id = t.id where t.id >= 10""")
def _(spark, sf):
    rows = _source_vectors(spark, sf)
    judged = admission.admit_sources(rows.where("id < 10"), rows.where("id >= 10"), 0.5)
    return judged.select("id", "accepted", "reason", "match_id")


@query("d8_ordered_admission", f"""
    with recursive {_SOURCE_SIM.replace("with ", "", 1)},
    near as (select id, list(other) as l from ss where other < id and s >= 0.5 group by id),
    line as (select t.id, coalesce(n.l, []) as l, row_number() over (order by t.id) as rn from source_text t left join near n on n.id = t.id),
    walk(rn, id, accepted, taken) as (
        select 0::bigint, null::int, true, []::int[]
        union all
        select l.rn, l.id::int, not list_has_any(w.taken, l.l::int[]),
               case when list_has_any(w.taken, l.l::int[]) then w.taken else list_append(w.taken, l.id::int) end
        from walk w join line l on l.rn = w.rn + 1)
    select id, accepted, case when not accepted then 'similar' end as reason from walk where rn > 0""")
def _(spark, sf):
    """All sources as candidates of one call: each is judged by those accepted before it."""
    rows = _source_vectors(spark, sf)
    return admission.admit_sources(rows.limit(0), rows, 0.5).select("id", "accepted", "reason")


@query("u12_backfill_sources", f"""
    with {_SOURCE_SIM} select id, cast(b as int) as bucket, round(v, 9) as weight from su""")
def _(spark, sf):
    rows = _source_vectors(spark, sf)
    missing = rows.withColumn("source_embedding", F.when(F.col("id") % 2 == 0, F.col("source_embedding")))
    filled = maintenance.backfill_sources(
        missing, rows.where("id % 2 = 1").select("id", F.col("source_embedding").alias("vector")))
    values = filled.select("id", F.posexplode("source_embedding").alias("bucket", "weight")).where("weight <> 0")
    return values.select("id", "bucket", F.round("weight", 9).alias("weight"))
