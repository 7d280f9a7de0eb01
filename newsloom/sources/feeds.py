"""Landed feed documents (RSS 2.0, RSS 1.0 and Atom) to entry rows.

A feed document is one file: `<root>/source_id=<id>/<name>.xml`. Documents are read whole, one row
each, in the encoding that they declare, and entries keep their position in the document. Dumps of many
entries are scanned entry by entry instead.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.barrier import with_computed
from newsloom.functions.dates import first_date
from newsloom.functions.text import SUMMARY_CHARS, clip, first_non_empty, strip_tags

_ITEM = (
    "title STRING, link STRING, guid STRUCT<_VALUE: STRING, _isPermaLink: STRING>, "
    "description STRING, summary STRING, `content:encoded` STRING, "
    "pubDate STRING, `dc:date` STRING, author STRING, `dc:creator` STRING"
)
_ENTRY = (
    "title STRING, link ARRAY<STRUCT<_href: STRING, _rel: STRING>>, summary STRING, content STRING, "
    "published STRING, updated STRING, created STRING, author STRUCT<name: STRING>"
)
# RSS 2.0 keeps its entries in <channel>, RSS 1.0 beside it, Atom directly in the root.
DOCUMENT = (
    f"channel STRUCT<title: STRING, description: STRING, item: ARRAY<STRUCT<{_ITEM}>>>, item ARRAY<STRUCT<{_ITEM}>>, "
    f"title STRING, subtitle STRING, entry ARRAY<STRUCT<{_ENTRY}>>, _broken STRING"
)


#: Encodings that the JVM decodes without a complaint about any byte; others are decoded by Python, on Arrow batches.
_PLAIN = {"utf-8": "UTF-8", "utf8": "UTF-8", "us-ascii": "UTF-8", "ascii": "UTF-8", "iso-8859-1": "ISO-8859-1", "latin1": "ISO-8859-1", "latin-1": "ISO-8859-1"}


def declared_encoding(content: Column) -> Column:
    """The encoding of a document's bytes, in lower case: of its byte-order mark, else of the zero bytes that the two-byte
    forms of `<?` have, else what its XML declaration names, else UTF-8."""
    front = F.hex(F.substring(content, 1, 4))
    head = F.decode(F.substring(content, 1, 400), "ISO-8859-1")
    named = F.lower(F.regexp_extract(head, r"""^\s*<\?xml[^>]*?\sencoding\s*=\s*["']([A-Za-z0-9._:-]+)["']""", 1))
    return (
        F.when(front.startswith("EFBBBF"), "utf-8")
        .when(front.isin("FFFE0000", "0000FEFF"), "utf-32")
        .when(front.startswith("FFFE") | (front == "3C003F00"), "utf-16-le")
        .when(front.startswith("FEFF") | (front == "003C003F"), "utf-16-be")
        # A document whose declaration can be read byte by byte is in no two-byte form, whatever it says.
        .when((named == "") | named.startswith("utf-16") | named.startswith("utf-32"), "utf-8").otherwise(named))


@F.arrow_udf(T.StringType())
def _decoded_by_name(content: pa.Array, encoding: pa.Array) -> pa.Array:
    def text(raw, name):
        if raw is None:
            return None
        try:
            return raw.decode(name, "replace")
        except LookupError:  # a name that nobody knows
            return raw.decode("utf-8", "replace")

    return pa.array([text(r, n) for r, n in zip(content.to_pylist(), encoding.to_pylist())], pa.string())


def decoded(content: Column) -> Column:
    """The text of a document's bytes, without byte-order mark and XML declaration, which name an encoding that is none of
    the text's any more. Bytes that are none in the encoding become U+FFFD; unknown encodings count as UTF-8."""
    encoding = declared_encoding(content)
    plain = F.lit(None).cast("string")
    for charset in ("UTF-8", "ISO-8859-1"):
        names = [n for n, c in _PLAIN.items() if c == charset]
        whole = F.make_valid_utf8(content.cast("string")) if charset == "UTF-8" else F.decode(content, charset)
        plain = F.when(encoding.isin(names), whole).otherwise(plain)
    other = ~encoding.isin(list(_PLAIN))
    text = F.coalesce(plain, _decoded_by_name(F.when(other, content), F.when(other, encoding)))
    return F.regexp_replace(text, r"^\x{FEFF}?\s*(?:<\?xml[^>]*\?>)?", "")


def read_feed_documents(spark: SparkSession, root: str) -> DataFrame:
    """`(source_id, document)` of every landed feed file, each in the encoding that it declares."""
    files = spark.read.format("binaryFile").load(root)
    return files.select(F.col("source_id").cast("int").alias("source_id"), decoded(F.col("content")).alias("document"))


def read_feed_dump(spark: SparkSession, path: str, atom: bool = False) -> DataFrame:
    """All entries of RSS (or Atom) files in UTF-8 that are too large to be one row: position, url, title, summary, published, author.

    The closing tag of an entry is the line separator of Spark's text source, so a file is read by as many
    tasks as it has splits and an entry is a row from the start. Positions grow in the order of the file,
    but not by one. Entries without a link or a title are left out, as in `entries`, and so is one that is cut
    off or can't be read.
    """
    tag, schema, form = ("entry", _ENTRY, _atom_entry) if atom else ("item", _ITEM, _rss_entry)
    rows = spark.read.option("lineSep", f"</{tag}>").text(path).select(F.monotonically_increasing_id().alias("position"), "value")
    whole = F.concat(F.regexp_extract("value", rf"(?s)<{tag}[\s>].*$", 0), F.lit(f"</{tag}>"))
    rows = rows.where(F.col("value").rlike(rf"<{tag}[\s>]"))
    read = with_computed(rows, _entry=F.from_xml(whole, f"{schema}, _broken STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}))
    return _finished(read.where("_entry._broken IS NULL").select("position", form(F.col("_entry")).alias("e")), ())


def _parsed(document: Column) -> Column:
    return F.from_xml(document, DOCUMENT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})


def _salvaged(document: Column) -> Column:
    """What is whole in a damaged document: its root tag, which declares name spaces, and all complete entries."""
    root = F.regexp_extract(document, r"<(?:rss|feed|rdf:RDF)\b[^>]*>", 0)
    name = F.regexp_extract(root, r"<([^\s>]+)", 1)
    whole = F.regexp_extract_all(document, F.lit(r"(?s)<(item|entry)\b[^>]*>.*?</\1>"), F.lit(0))
    return F.concat(root, F.array_join(whole, ""), F.lit("</"), name, F.lit(">"))


def parse_feeds(documents: DataFrame) -> DataFrame:
    """`(…, feed)`: each document as one nested value. Of a damaged one, `feed` holds the complete
    entries and `feed._broken` its text."""
    read = with_computed(documents, _feed=_parsed(F.col("document")))
    broken = F.col("_feed._broken").isNotNull()
    saved = _parsed(F.when(broken, _salvaged(F.col("document"))))
    read = with_computed(read, _saved=saved)
    feed = F.when(broken, F.coalesce("_saved", "_feed").withField("_broken", F.col("_feed._broken"))).otherwise(F.col("_feed"))
    return read.withColumn("feed", feed).drop("document", "_feed", "_saved")


def channels(feeds: DataFrame) -> DataFrame:
    """`(source_id, channel_title, channel_description)`."""
    return feeds.select(
        "source_id",
        first_non_empty(F.col("feed.channel.title"), F.col("feed.title")).alias("channel_title"),
        first_non_empty(F.col("feed.channel.description"), F.col("feed.subtitle")).alias("channel_description"),
    )


def _atom_link(links: Column) -> Column:
    main = F.filter(links, lambda l: F.coalesce(l["_rel"], F.lit("alternate")) == "alternate")
    return F.coalesce(F.get(main, 0)["_href"], F.get(links, 0)["_href"])


def _rss_link(e: Column) -> Column:
    """The link, or else a guid that isn't said to be no link."""
    guid = F.when(F.coalesce(F.lower(e["guid"]["_isPermaLink"]), F.lit("true")) != "false", F.trim(e["guid"]["_VALUE"]))
    return F.coalesce(F.nullif(F.trim(e["link"]), F.lit("")), guid)


def _rss_entry(e: Column) -> Column:
    return F.struct(
        _rss_link(e).alias("url"), e["title"].alias("title"),
        first_non_empty(e["content:encoded"], e["summary"], e["description"]).alias("summary"),
        first_date(e["pubDate"], e["dc:date"]).alias("published"),
        first_non_empty(e["author"], e["dc:creator"]).alias("author"),
    )


def _atom_entry(e: Column) -> Column:
    return F.struct(
        F.trim(_atom_link(e["link"])).alias("url"), e["title"].alias("title"),
        first_non_empty(e["content"], e["summary"]).alias("summary"),
        first_date(e["published"], e["updated"], e["created"]).alias("published"),
        F.coalesce(e["author"]["name"], F.lit("")).alias("author"),
    )


def entries(feeds: DataFrame, carry: tuple[str, ...] = ("source_id",)) -> DataFrame:
    """All entries: carried columns, position, url, title, summary, published, author.

    Entries without a link or a title are left out. The summary is the first of content, summary
    and description that is not empty; the date the first of published, updated and created that
    can be read. A document is read once, whichever of the two forms it has.
    """
    found = F.coalesce(
        F.transform("feed.channel.item", _rss_entry), F.transform("feed.item", _rss_entry),
        F.transform("feed.entry", _atom_entry)
    )
    return _finished(feeds.select(*carry, F.posexplode(found).alias("position", "e")), carry)


def _finished(rows: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    return rows.select(
        *carry, "position", "e.url", strip_tags(F.col("e.title")).alias("title"),
        clip(strip_tags(F.col("e.summary")), SUMMARY_CHARS).alias("summary"), "e.published",
        strip_tags(F.col("e.author")).alias("author"),
    ).where("url <> '' AND title <> ''")


def collect(feeds: DataFrame, sources: DataFrame) -> DataFrame:
    """Entries of the active sources with the source's name and category."""
    known = sources.where("is_active").select(
        F.col("id").alias("source_id"), F.col("name").alias("source_name"), "category"
    )
    return entries(feeds).join(known, "source_id")


def feed_counts(feeds: DataFrame, sources: DataFrame) -> DataFrame:
    """Per active source: documents, entries, and documents that were damaged."""
    per_feed = feeds.groupBy("source_id").agg(
        F.count("*").alias("documents"), F.count_if(F.col("feed._broken").isNotNull()).alias("errors")
    )
    per_source = entries(feeds).groupBy("source_id").agg(F.count("*").alias("entries"))
    zero = F.lit(0).cast("bigint")
    return (
        sources.where("is_active").select(F.col("id").alias("source_id"), "name")
        .join(per_feed, "source_id", "left").join(per_source, "source_id", "left")
        .select("source_id", "name", *[F.coalesce(c, zero).alias(c) for c in ("documents", "entries", "errors")])
    )
