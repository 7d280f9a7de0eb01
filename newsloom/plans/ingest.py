"""The full ingest job: entries, pages, cleaning, deduplicated insert, run accounting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.clean import clean_articles
from newsloom.operators.dedup import THRESHOLD, dedup_insert, unique_urls
from newsloom.operators.enrich import enrich
from newsloom.operators.maintenance import mark_fetched, run_row
from newsloom.session import stage
from newsloom.sources.tables import TableStore

# Order in which entries count as earlier: by source, then by position in the feed.
ENTRY_ORDER = ["source_id", "position", "url"]


def run_batch(store: TableStore, batch: int, entries: DataFrame, pages: DataFrame, profiles: DataFrame,
              threshold: float = THRESHOLD, use_vectors: bool = True, damaged: int = 0) -> DataFrame:
    """Ingest one batch of collected entries; returns its run row.

    Works on what earlier batches stored and writes only to folders of this attempt, the run row last,
    so nothing is visible before all of it is, a replay replaces the batch at once and whole, and a replay
    that fails leaves the batch as it was. A batch without entries leaves one 'partial' run. On an error
    nothing of the attempt becomes visible but a 'failed' run row, and the error is raised. Texts are
    written when cleaned, when numbered, and in the result; all that is compared are ids and feature sets.

    A batch that is run again after later ones meets the batches before it, but leaves URLs to whichever
    other batch stored them; URLs that it had itself keep their ids, which later rows may refer to, and new
    ones are numbered after all ids ever visible. So ids and URLs stay unique whatever is replayed.
    """
    if threshold < store.least_threshold:
        raise ValueError("the store's postings are for thresholds from %s" % store.least_threshold)
    attempt = store.new_attempt()
    started = store.spark.range(1).select(F.current_timestamp().alias("t")).first().t
    seen = store.seen_by(batch)
    try:
        entries = stage(entries, "entries")
        # Cleaning keeps the first row of a URL whatever its text, so the others need no page.
        first = unique_urls(entries, ENTRY_ORDER)
        cleaned = stage(clean_articles(enrich(first, pages), profiles, ENTRY_ORDER), "cleaned")
        known = store.known_sets(before=batch)
        added = dedup_insert(
            seen.stored, cleaned, ENTRY_ORDER, threshold, use_vectors, scraped_at=F.lit(started), known=known,
            taken=seen.taken, replaced=seen.replaced)
        store.write_articles(added.rows, batch, attempt)
        written = store.written(batch, attempt)
        if use_vectors and not written.isEmpty():
            store.write_sets(written, known, batch, attempt)
        store.write_sources(mark_fetched(store.sources(before=batch), entries, F.lit(started)), batch, attempt)
        found = entries.agg(F.count("*").alias("found")).scalar()
        counters = added.counters.withColumn("found", found)
        run = run_row(batch, counters, F.lit(started), F.current_timestamp(), damaged=damaged)
        store.write_run(run, batch, attempt)
    except Exception:
        none = store.spark.range(1).select(
            *[F.lit(0).cast("bigint").alias(c) for c in ("found", "inserted", "skipped_vector", "skipped_url", "skipped")]
        )
        store.write_run(run_row(batch, none, F.lit(started), F.current_timestamp(), failed=True), batch, attempt)
        raise
    return store.runs().where(F.col("id") == batch)
