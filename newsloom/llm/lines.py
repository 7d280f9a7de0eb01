"""Line deduplication (operator 2): a deletion-neighbourhood join over the words of lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.registry import query, table
from newsloom.llm.words import Runs, Splitter, counted, mix, pieces
from newsloom.session import stage

#: Shorter lines (headings, single sentences of few words) are never near copies of others; their exact copies go
#: (`exact_words`).
MIN_WORDS = 10
#: Half keys are looked up in a bit map of so many bits (32 MB at most, whatever the data); keys that
#: share a bit by chance only cost work.
FILTER_BITS = 1 << 24
_BUCKET = 32_768
_NEWLINE = 10
#: Kinds of keys: a line without one word and the place of that word; without its place; a whole line.
SUBSTITUTED, SHORTENED, WHOLE = 0, 1, 2


class _Lines:
    """The lines of a piece of whole texts that are long enough, with the running hashes of their words."""

    def __init__(self, splitter: Splitter, data: np.ndarray, offsets: np.ndarray, min_words: int):
        breaks = np.flatnonzero(data == _NEWLINE) + 1
        # Every text begins a line, even an empty text.
        edges = np.concatenate([breaks, offsets])
        order = np.argsort(edges, kind="stable")
        is_text = order >= len(breaks)
        edges = edges[order]
        words = splitter.split(data, edges)
        text = np.cumsum(is_text)[:-1] - 1
        first = np.flatnonzero(is_text)
        place = np.arange(len(edges) - 1) - first[text]
        long = np.flatnonzero(np.diff(words.bounds) >= min_words)
        self.text, self.place = text[long], place[long]
        self.start, self.end = words.bounds[long], words.bounds[long + 1]
        self.bytes = edges[long], edges[long + 1]
        self.runs = Runs(words.hash)
        size = (self.end - self.start).astype(np.uint64)
        self.whole = mix(self.runs.of(self.start, self.end) + size)

    def halves(self) -> np.ndarray:
        """Four keys a line: two lines within one word of each other share one.

        Around one edit the shorter line (m words) has floor(m / 2) untouched words in front or
        behind; m is the line's own number of words or one less.
        """
        n = self.end - self.start
        keys = []
        for half in (n // 2, (n - 1) // 2):
            size = half.astype(np.uint64)
            keys.append(mix(self.runs.of(self.start, self.start + half) * np.uint64(3) + size))
            keys.append(mix(self.runs.of(self.end - half, self.end) * np.uint64(5) + size))
        return np.stack(keys, axis=1)

    def variants(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, kind, line): all keys of the chosen lines, each once."""
        start, end = self.start[chosen], self.end[chosen]
        sizes = end - start
        line, place = counted(np.concatenate([[0], np.cumsum(sizes)]))
        left_out = start[line] + place
        shorter = mix(self.runs.without(start[line], end[line], left_out) + (sizes[line] - 1).astype(np.uint64))
        substituted = mix(shorter ^ mix(place.astype(np.uint64)))
        key = np.concatenate([substituted, shorter, self.whole[chosen]])
        kind = np.repeat(np.array([SUBSTITUTED, SHORTENED, WHOLE], dtype=np.int8), [len(line), len(line), len(chosen)])
        return key, kind, np.concatenate([chosen[line], chosen[line], chosen])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _occurrences(docs: DataFrame, min_words: int, exact_words: int) -> DataFrame:
    """(key, version, place, line, halves): every line of at least `exact_words` words of every text; halves of long lines only."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter()
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(2)):
                own = _Lines(splitter, data, offsets, min(exact_words, min_words))
                row, halves = pa.array(lo + own.text), own.halves()
                short = own.end - own.start < min_words
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row), pa.array(own.place.astype(np.int32)), _signed(own.whole),
                     *[pa.array(np.ascontiguousarray(halves[:, i]).view(np.int64), mask=short) for i in range(4)]],
                    names=["key", "version", "place", "line", "h0", "h1", "h2", "h3"])

    return docs.select("key", "version", "text").mapInArrow(
        scan, "key bigint, version bigint, place int, line bigint, h0 bigint, h1 bigint, h2 bigint, h3 bigint")


def _half_filter(spark, occurrences: DataFrame) -> np.ndarray:
    """Bits of the half keys that two different lines share."""
    keys = occurrences.where("h0 IS NOT NULL").select("line", F.explode(F.array("h0", "h1", "h2", "h3")).alias("half"))
    shared = keys.groupBy("half").agg(F.min("line").alias("a"), F.max("line").alias("b")).where("a <> b")
    bit = F.pmod(F.col("half"), F.lit(FILTER_BITS))
    rows = shared.groupBy((bit / _BUCKET).cast("int").alias("bucket")).agg(
        F.bitmap_construct_agg((bit % _BUCKET)).alias("bits"))
    found = np.zeros(FILTER_BITS, dtype=bool)
    for bucket, bits in rows.toLocalIterator():  # at most FILTER_BITS / _BUCKET rows of 4 kB
        own = np.unpackbits(np.frombuffer(bytes(bits), dtype=np.uint8), bitorder="little")
        found[bucket * _BUCKET:(bucket + 1) * _BUCKET] = own
    return np.packbits(found, bitorder="little")


def _neighbourhoods(docs: DataFrame, shared: np.ndarray, min_words: int) -> DataFrame:
    """(key, kind, line, content): all keys of the lines that may have a partner; content only with a whole line."""
    filter_ = docs.sparkSession.sparkContext.broadcast(shared)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, bits, seen = Splitter(), filter_.value, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column(0)):
                own = _Lines(splitter, data, offsets, min_words)
                at = own.halves() & np.uint64(FILTER_BITS - 1)
                hit = (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
                _, first = np.unique(own.whole, return_index=True)
                chosen = first[hit[first].any(axis=1)]
                chosen = np.sort(chosen[~np.isin(own.whole[chosen], seen)])  # copies met in this task
                seen = np.concatenate([seen, own.whole[chosen]])
                if not len(chosen):
                    continue
                key, kind, line = own.variants(chosen)
                lo, hi = own.bytes
                content = [bytes(data[lo[i]:hi[i]]).decode("utf-8", "replace") for i in chosen]
                content = pa.concat_arrays([pa.nulls(len(key) - len(chosen), pa.string()), pa.array(content, pa.string())])
                for a in range(0, len(key), 1 << 16):
                    part = slice(a, a + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [_signed(key[part]), pa.array(kind[part]), _signed(own.whole[line[part]]), content[part]],
                        names=["key", "kind", "line", "content"])

    return docs.select("text").mapInArrow(scan, "key bigint, kind tinyint, line bigint, content string")


def one_word_apart(a: str, b: str) -> bool:
    """Whether the word sequences of two lines differ by at most one inserted, lost or changed word."""
    x, y = a.encode().split(), b.encode().split()
    if abs(len(x) - len(y)) > 1:
        return False
    short = min(len(x), len(y))
    front = next((i for i in range(short) if x[i] != y[i]), short)
    behind = next((i for i in range(short - front) if x[-1 - i] != y[-1 - i]), short - front)
    return max(len(x), len(y)) - front - behind <= 1


def _verified(a: Column, b: Column) -> Column:
    @F.arrow_udf(T.BooleanType())
    def apart(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array([one_word_apart(x, y) for x, y in zip(left.to_pylist(), right.to_pylist(), strict=True)], pa.bool_())

    return apart(a, b)


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, exact_words: int = 1) -> DataFrame:
    """(key, version, place) of the lines to drop from `docs` (key bigint, version bigint, text).

    Lines are cut at line feeds and compared as sequences of words. A line of at least `min_words`
    words goes when the same words, or words one edit away (one word inserted, lost or changed),
    occur earlier: in a smaller key, then version, then line number. It is judged by the lines that
    were there, dropped or not, so decisions don't depend on each other. A shorter line of at least
    `exact_words` words goes when the same words occur earlier.

    Equal lines are one line with its first place. Each distinct line emits hashes of itself and of
    all its variants with one word left out. Two lines of equal length are one change apart just
    when they agree without the same word; of unequal length, when the shorter is a variant of the
    longer. So a group of equal keys never has to be paired up: every member is compared with its
    first member. Only lines that share their first or last half with another line, which one edit
    cannot avoid, emit variants. All found pairs are verified on their words.

    NULL text has no lines; NULL keys come last; rows with equal key and version are one document; an
    empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    found = stage(_occurrences(docs, min_words, exact_words), "lines")
    order = F.struct(F.col("key").isNull().alias("last"), "key", "version", "place")
    lines = stage(found.groupBy("line").agg(F.min(order).alias("first"), F.count("*").alias("n")), "distinct_lines")
    keys = stage(_neighbourhoods(docs, _half_filter(spark, found), min_words), "neighbourhoods")
    shared = keys.groupBy("key").agg(F.min("line").alias("a"), F.max("line").alias("b")).where("a <> b").select("key")
    members = (
        keys.select("key", "kind", "line").join(shared, "key", "left_semi").distinct()
        .join(lines.select("line", "first"), "line")
    )
    members = stage(members, "members")
    # One word changed: all members of a key are one change apart, the first is witness to the rest.
    heads = members.where(F.col("kind") == SUBSTITUTED).groupBy("key").agg(F.min(F.struct("first", "line")).alias("head"))
    changed = members.where(F.col("kind") == SUBSTITUTED).join(heads, "key").select("line", F.col("head.line").alias("witness"))
    # One word more: a key has one whole line at most; it meets its first longer line, they meet it.
    whole = members.where(F.col("kind") == WHOLE).select("key", F.struct("first", "line").alias("whole"))
    longer = members.where(F.col("kind") == SHORTENED).join(whole, "key")
    earliest = longer.groupBy("key").agg(F.min(F.struct("first", "line")).alias("head"), F.first("whole").alias("whole"))
    pairs = (
        changed
        .union(longer.where("first > whole.first").select("line", "whole.line"))
        .union(earliest.where("whole.first > head.first").select("whole.line", "head.line"))
        .where("line <> witness").distinct()
    )
    content = keys.where(F.col("kind") == WHOLE).groupBy("line").agg(F.first("content").alias("content"))
    content = stage(content, "contents")
    near = (
        pairs.join(content.withColumnRenamed("content", "a"), "line")
        .join(content.select(F.col("line").alias("witness"), F.col("content").alias("b")), "witness")
        .where(_verified(F.col("a"), F.col("b"))).select("line", F.lit(True).alias("near")).distinct()
    )
    decided = lines.join(near, "line", "left").where("n > 1 OR near").select("line", "first", "near")
    return (
        found.select("key", "version", "place", "line").join(decided, "line")
        .where(F.coalesce("near", F.lit(False)) | (order != F.col("first")))
        .select("key", "version", "place")
    )


def _placed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("bigint").alias("key"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))


def without_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
                           exact_words: int = 1) -> DataFrame:
    """`docs` with repeated lines cut out of `text` (see `repeated_lines`); other columns stay as they are.

    A document that loses lines and keeps none with a word is dropped: all it says is in earlier
    ones. Documents that lose nothing stay unchanged, NULL and empty texts among them, and so do
    repeated rows (equal key and text): they are one document here. An empty table stays empty;
    columns of any name are kept.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    own = docs.toDF(*names)
    drops = repeated_lines(_placed(own, at[key], at[text]), min_words, exact_words)
    drops = stage(drops.groupBy("key", "version").agg(F.collect_set("place").alias("places")), "drops")
    body, places = F.col(at[text]), F.col("places")
    kept = F.filter(F.split(body, "\n"), lambda _, i: ~F.array_contains(places, i))
    cut = F.when(places.isNull(), body).otherwise(F.array_join(kept, "\n"))
    joined = own.join(
        drops, F.col(at[key]).cast("bigint").eqNullSafe(F.col("key")) & (F.xxhash64(at[text]) == F.col("version")), "left")
    return (
        joined.withColumn("cut", cut)
        .where(places.isNull() | F.col("cut").rlike(r"[^\x20\x09-\x0D]"))
        .select(*[F.col("cut").alias(n) if n == at[text] else F.col(n) for n in names]).toDF(*docs.columns)
    )


SQL = f"""
with lines as (
  select doc_id, i - 1 as place, list_filter(regexp_split_to_array(l, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
  from (select doc_id, unnest(l) as l, unnest(range(1, len(l) + 1)) as i
        from (select doc_id, string_split(text, chr(10)) as l from documents))),
worded as (select doc_id, place, w from lines where len(w) >= 1),
first as (select w, min((doc_id, place)) as p from worded group by w),
cut as (select w, p, i, list_concat(list_slice(w, 1, i - 1), list_slice(w, i + 1, len(w))) as v
        from (select w, p, unnest(range(1, len(w) + 1)) as i from first where len(w) >= {MIN_WORDS})),
changed as (select w from (select w, p, min(p) over (partition by v, i) as head from cut) where head < p),
pairs as (select c.w as x, c.p as xp, f.w as y, f.p as yp from cut c join first f on c.v = f.w where len(f.w) >= {MIN_WORDS}),
near as (select w from changed union select x from pairs where yp < xp union select y from pairs where xp < yp),
drops as (
  select l.doc_id, l.place from worded l join first f on l.w = f.w
  where (l.doc_id, l.place) <> f.p or l.w in (select w from near))
select d.doc_id, coalesce(n, 0)::bigint as n_dropped, coalesce(places, '') as dropped
from documents d left join (
  select doc_id, count(*) as n, string_agg(place::varchar, ',' order by place) as places from drops group by doc_id) using (doc_id)"""


@query("op2_line_dedup", SQL)
def op2(spark, sf_dir):
    """For every document: how many lines go, and their numbers from 0."""
    docs = table(spark, sf_dir, "documents")
    own = _placed(docs, "doc_id", "text")
    drops = repeated_lines(own).groupBy("key", "version").agg(F.array_sort(F.collect_set("place")).alias("places"))
    joined = own.select("key", "version").join(drops, own["key"].eqNullSafe(drops["key"]) & (own["version"] == drops["version"]), "left")
    return joined.select(
        own["key"].alias("doc_id"), F.when(F.col("places").isNull(), 0).otherwise(F.size("places")).cast("bigint").alias("n_dropped"),
        F.coalesce(F.array_join("places", ","), F.lit("")).alias("dropped"))
