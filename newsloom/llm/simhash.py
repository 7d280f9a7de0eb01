"""SimHash near-duplicates (operator 4): fingerprints, and all links by a vantage-point tree."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.components import connected_components
from newsloom.llm.registry import query, table
from newsloom.llm.vantage import Leaf, plant, route
from newsloom.session import stage

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Distinct fingerprints that a leaf of the shared tree should hold; a leaf is split further in its task.
LEAF_PRINTS = 4_096
#: The shared tree has at most 2**MAX_DEPTH leaves and is planted from SAMPLE_PER_LEAF fingerprints for each,
#: so what the driver gets and sends is bounded (16 MB) whatever the data.
MAX_DEPTH = 16
SAMPLE_PER_LEAF = 32
_ROWS = 1 << 16


def fingerprint_of(text: bytes, width: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the word shingles of a text in UTF-8; no words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_digest
    if len(words) > width:
        hashed = b"".join([digest(line[a:b - 1], seed) for a, b in zip(starts, ends[width - 1:], strict=False)])
    else:
        hashed = digest(line, seed)
    rows = np.frombuffer(hashed, dtype=np.uint8).reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(rows), 4096):
        ones += np.unpackbits(rows[lo:lo + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(rows)).tobytes(), "big")


def fingerprint(text: Column, width: int = SHINGLE, seed: int = SEED) -> Column:
    """Column of fingerprints as bigint (the same 64 bits); NULL text: 0."""

    @F.arrow_udf(T.LongType())
    def prints(texts: pa.Array) -> pa.Array:
        raw = texts.cast(pa.large_binary())
        values = [fingerprint_of(raw[i].as_py() or b"", width, seed) for i in range(len(raw))]
        return pa.array(np.array(values, dtype=np.uint64).view(np.int64))

    return prints(text)


def _placed(prints: DataFrame, tree, radius: int) -> DataFrame:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            leaf, visitor, who = route(tree, own, radius)
            for lo in range(0, len(leaf), _ROWS):
                part = slice(lo, lo + _ROWS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf[part].astype(np.int32)), pa.array(visitor[part]), pa.array(own[who[part]].view(np.int64))],
                    names=["leaf", "visitor", "print"])

    return prints.select("print").mapInArrow(place, "leaf int, visitor boolean, print bigint")


def _linked(placed: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) that connect exactly what pairs within the radius connect.

    The rows of a leaf come one after the other, residents first; visitors stream past them, so a
    task holds the residents of one leaf and one batch.
    """
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, gathered, leaf = None, [], None

        def edges(a, b):
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            leaves = batch.column(0).to_numpy(zero_copy_only=False)
            visitor = batch.column(1).to_numpy(zero_copy_only=False)
            prints = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            starts = np.flatnonzero(np.diff(leaves, prepend=leaves[:1] - 1)) if len(leaves) else []
            for lo, hi in zip(starts, [*starts[1:], len(leaves)], strict=True):
                if leaves[lo] != at:
                    if leaf is None and gathered:
                        leaf = Leaf(np.concatenate(gathered), radius)
                    if leaf is not None:
                        yield edges(*leaf.links())
                    at, gathered, leaf = leaves[lo], [], None
                own = prints[lo:hi]
                guests = own[visitor[lo:hi]]
                if len(own) > len(guests):
                    gathered.append(own[~visitor[lo:hi]])
                if len(guests) and gathered:
                    leaf = leaf or Leaf(np.concatenate(gathered), radius)
                    i, partner = leaf.visit(guests)
                    yield edges(guests[i], partner)
        if leaf is None and gathered:
            leaf = Leaf(np.concatenate(gathered), radius)
        if leaf is not None:
            yield edges(*leaf.links())

    dealt = placed.repartition("leaf").sortWithinPartitions("leaf", "visitor")
    return dealt.mapInArrow(link, "a bigint, b bigint")


def print_links(prints: DataFrame, radius: int = RADIUS, leaf_prints: int = LEAF_PRINTS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (`print`) whose components are those of all pairs
    with at most `radius` differing bits."""
    n = prints.count()
    depth = min(MAX_DEPTH, max(0, int(np.ceil(np.log2(max(n, 1) / leaf_prints)))))
    share = min(1.0, SAMPLE_PER_LEAF * 2**depth / max(n, 1))
    picked = prints.where(F.pmod(F.xxhash64("print"), F.lit(1 << 30)) < int(share * (1 << 30))) if depth else prints.limit(0)
    sample = np.array([r[0] for r in picked.select("print").toLocalIterator()], dtype=np.int64).view(np.uint64)
    return _linked(_placed(prints, plant(sample, depth), radius), radius)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE,
                    radius: int = RADIUS, leaf_prints: int = LEAF_PRINTS, carry: tuple = ()) -> DataFrame:
    """(key, print, component, is_first, *carry) for each row of `docs`.

    Rows link when their fingerprints differ in at most `radius` bits. `component`: the smallest key
    reachable; `is_first`: true for exactly one row of each component, one with that key. Equal
    fingerprints are folded before anything is compared, so a group of copies is one fingerprint.
    NULL or empty text has fingerprint zero, linked like any other; NULL keys come last, and a
    component of NULL keys only is NULL. Repeated rows stay, one of them is first. An empty table
    gives no rows. Only `key`, `text` and `carry` are read.
    """
    own = docs.select(F.col(key).alias("_key"), fingerprint(F.col(text), width).alias("_print"),
                      F.struct(*[docs[c] for c in carry] or [F.lit(None).alias("none")]).alias("_rest"))
    own = stage(own.withColumn("_row", F.monotonically_increasing_id()), "prints")
    order = F.struct(F.col("_key").isNull().alias("last"), F.col("_key").alias("key"), F.col("_row").alias("row"))
    prints = stage(own.groupBy(F.col("_print").alias("print")).agg(F.min(order).alias("first")), "distinct")
    roots = stage(connected_components(print_links(prints, radius, leaf_prints)), "roots")
    joined = prints.join(roots, prints["print"] == roots["node"])
    firsts = joined.groupBy("root").agg(F.min("first").alias("_first"))
    linked = roots.join(firsts, "root").select(F.col("node").alias("_print"), "_first")
    by_print = (
        prints.select(F.col("print").alias("_print"), "first").join(linked, "_print", "left")
        .select("_print", F.coalesce("_first", "first").alias("_first"))
    )
    return own.join(by_print, "_print").select(
        F.col("_key").alias(key), F.col("_print").alias("print"), F.col("_first.key").alias("component"),
        (F.col("_first.row") == F.col("_row")).alias("is_first"), *[F.col("_rest")[c].alias(c) for c in carry])


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row of each group of near-duplicates, that with the smallest key."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*names)
    at = {c: n for c, n in zip(docs.columns, names, strict=True)}
    found = near_duplicates(
        renamed.withColumn("k", F.col(at[key])), "k", at[text], carry=tuple(names))
    return found.where("is_first").select(*names).toDF(*docs.columns)


@query("op4_simhash_near_dedup")
def op4(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))
