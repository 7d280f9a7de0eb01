"""Texts that share most of their word shingles: SimHash links by a vantage-point tree, completed by an exact set join.

Fingerprints within a few bits are found by operator 4's tree. A radius that reached all pairs of similarity 0.8 (some 10 of
64 bits apart, with a tail) would leave the tree nothing to prune, so the pairs beyond it come from a prefix
join over the shingles. Every link of either kind is verified on the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.components import connected_components
from newsloom.llm.simhash import RADIUS, print_links
from newsloom.llm.words import Runs, Splitter, counted, mix, pieces
from newsloom.session import stage

WIDTH = 5
SIMILARITY = 0.8
#: Shingles that many texts share come last in the order of prefixes, at most HOT of them (0.5 MB): first those that so
#: many of SAMPLE_DOCS distinct texts share, then those that turn out to begin the prefixes of more than HEAVY sets. The
#: order decides what is compared, not what is found.
SAMPLE_DOCS, SHARED, HOT, HEAVY, ROUNDS = 10_000, 5, 1 << 16, 1_024, 3
#: Sets of one shingle that are compared at once.
BLOCK = 1_024
_ROUNDING = 1e-9
_ROWS = 1 << 16
#: A bit map has some 16 bits for every member, 2**28 (32 MB) at most. Chance hits only cost work: where they become many,
#: rows that the map would have held back are shuffled, which is linear in the input.
_LEAST_BITS, _MOST_BITS, _BUCKET = 16, 28, 32_768


def shingles_of(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct word shingles of texts, in order; a text of fewer than `width` words is one shingle."""
    splitter, rows, hashes = Splitter(lower=True), [], []
    for lo, _, data, offsets in pieces(texts):
        words = splitter.split(data, offsets)
        size = np.diff(words.bounds)
        count = np.where(size > 0, np.maximum(size - width + 1, 1), 0)
        row, place = counted(np.concatenate([[0], np.cumsum(count)]))
        start = words.bounds[row] + place
        end = np.minimum(start + width, words.bounds[row + 1])
        hashed = mix(Runs(words.hash).of(start, end) + (end - start).astype(np.uint64))
        order = np.lexsort((hashed, row))
        row, hashed = row[order], hashed[order]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (hashed[1:] != hashed[:-1])
        rows.append(lo + row[new])
        hashes.append(hashed[new])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(hashes)


_DIGEST = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("print", T.LongType()), T.StructField("sketch", T.BinaryType())])


def _fingerprints(row: np.ndarray, hashed: np.ndarray, n: np.ndarray) -> np.ndarray:
    """SimHash of each row's shingles: the bits that more than half of them have."""
    ones = np.zeros((len(n), 64), dtype=np.int32)
    full = np.flatnonzero(n)
    first = (np.cumsum(n) - n)[full]
    if len(full):
        for bit in range(64):
            ones[full, bit] = np.add.reduceat(((hashed >> np.uint64(63 - bit)) & np.uint64(1)).astype(np.int32), first)
    return np.frombuffer(np.packbits(2 * ones > n[:, None], axis=1).tobytes(), dtype=">u8").astype(np.uint64)


def sketches(row: np.ndarray, hashed: np.ndarray, n: np.ndarray) -> list[bytes]:
    """How many of each row's shingles fall into each of some n / 4 buckets (a power of two of them), in a byte each."""
    level = np.maximum(np.log2(np.maximum(n, 1) / 4).astype(np.int64), 0)
    size = np.where(n > 0, 1 << level, 0)
    first = np.concatenate([[0], np.cumsum(size)])
    counts = np.bincount(first[row] + (hashed.view(np.int64) & (size[row] - 1)), minlength=int(first[-1]))
    # 255 or more of one bucket: no sketch, which rules nothing out.
    kept = np.minimum(counts, 255).astype(np.uint8).tobytes()
    return [b"" if b"\xff" in (own := kept[a:b]) else own for a, b in zip(first, first[1:], strict=False)]


def most_shared(a: bytes, b: bytes) -> float:
    """A bound of the shingles that two sets share, from their sketches."""
    if not a or not b:
        return float("inf")
    x, y = np.frombuffer(a, dtype=np.uint8).astype(np.int64), np.frombuffer(b, dtype=np.uint8).astype(np.int64)
    m = min(len(x), len(y))
    return float(np.minimum(x.reshape(-1, m).sum(axis=0), y.reshape(-1, m).sum(axis=0)).sum())


def _digest(text: Column, width: int) -> Column:
    """struct<n, print, sketch> of a text's shingles: their number, SimHash and sketch."""
    @F.arrow_udf(_DIGEST)
    def digest(texts: pa.Array) -> pa.Array:
        numbers, prints, drawn = [], [], []
        for lo in range(0, len(texts), 256):
            own = texts.slice(lo, 256)
            row, hashed = shingles_of(own, width)
            n = np.bincount(row, minlength=len(own))
            numbers.append(n.astype(np.int32))
            prints.append(_fingerprints(row, hashed, n).view(np.int64))
            drawn += sketches(row, hashed, n)
        parts = [pa.array(np.concatenate(x) if x else np.zeros(0, t), k) for x, t, k in (
            (numbers, np.int32, pa.int32()), (prints, np.int64, pa.int64()))]
        return pa.StructArray.from_arrays([*parts, pa.array(drawn, pa.binary())], names=["n", "print", "sketch"])

    return digest(text)


class _Bits:
    """A broadcast bit map of 64-bit values, sized by how many there are."""

    def __init__(self, values: DataFrame, column: str):
        spark = values.sparkSession
        self.size = 1 << min(max(int(np.ceil(np.log2(16 * max(values.count(), 1)))), _LEAST_BITS), _MOST_BITS)
        bit = F.pmod(column, F.lit(self.size))
        rows = values.groupBy((bit / _BUCKET).cast("int").alias("bucket")).agg(F.bitmap_construct_agg(bit % _BUCKET).alias("bits"))
        found = np.zeros(self.size // 8, dtype=np.uint8)
        for bucket, bits in rows.toLocalIterator():  # at most size / _BUCKET rows of 4 kB
            own = np.frombuffer(bytes(bits), dtype=np.uint8)
            found[bucket * _BUCKET // 8:bucket * _BUCKET // 8 + len(own)] = own
        self.shared = spark.sparkContext.broadcast(found)

    def has(self, values: np.ndarray) -> np.ndarray:
        at = values.view(np.uint64) & np.uint64(self.size - 1)
        return (self.shared.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def maybe(self, column: Column) -> Column:
        @F.arrow_udf(T.BooleanType())
        def maybe(own: pa.Array) -> pa.Array:
            return pa.array(self.has(own.to_numpy(zero_copy_only=False)))

        return maybe(column)


def _prefixes(sets: DataFrame, width: int, least: float, hot: np.ndarray | None, only: _Bits | None = None) -> DataFrame:
    """(shingle, set, n, place): the first shingles of every set (set, text), of which two similar sets share one.

    `hot`: shingles that come last, the rarest of them first; None gives all shingles of every set. `only`: shingles to write.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.argsort(hot) if hot is not None else np.zeros(0, dtype=np.int64)
        known = hot[rank] if hot is not None else np.zeros(0, dtype=np.uint64)
        seen = np.zeros(0, dtype=np.int64)
        for batch in batches:
            own = batch.column(0).to_numpy()
            _, first = np.unique(own, return_index=True)
            first = np.sort(first[~np.isin(own[first], seen)])  # copies met in this task
            seen = np.concatenate([seen, own[first]])
            batch = batch.take(pa.array(first))
            row, hashed = shingles_of(batch.column(1), width)
            size = np.bincount(row, minlength=batch.num_rows)
            first = np.concatenate([[0], np.cumsum(size)])
            late = np.zeros(len(row), dtype=np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, hashed), len(known) - 1)
                late = np.where(known[at] == hashed, rank[at] + 1, 0)
                order = np.lexsort((hashed, late, row))
                row, hashed = row[order], hashed[order]
            place = np.arange(len(row)) - first[row]
            if hot is not None:
                chosen = place <= size[row] - np.ceil(least * size[row] - _ROUNDING)
                row, hashed, place = row[chosen], hashed[chosen], place[chosen]
            if only is not None:
                chosen = only.has(hashed.view(np.int64))
                row, hashed, place = row[chosen], hashed[chosen], place[chosen]
            for lo in range(0, len(row), _ROWS):
                part = slice(lo, lo + _ROWS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashed[part].view(np.int64)), batch.column(0).take(pa.array(row[part])),
                     pa.array(size[row[part]].astype(np.int32)), pa.array(place[part].astype(np.int32))],
                    names=["shingle", "set", "n", "place"])

    return sets.select("set", "text").mapInArrow(scan, "shingle bigint, set bigint, n int, place int")


def _hot(sets: DataFrame, count: int, width: int) -> np.ndarray:
    """The shingles that most texts of a sample share, rarest first."""
    share = int(min(1.0, SAMPLE_DOCS / max(count, 1)) * (1 << 30))
    sample = sets.where(F.pmod(F.xxhash64("set"), F.lit(1 << 30)) < share)
    often = _prefixes(sample, width, 0, None).groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") >= SHARED)
    rows = often.orderBy(F.desc("n"), "shingle").limit(HOT).select("shingle").collect()
    return np.array([r[0] for r in reversed(rows)], dtype=np.int64).view(np.uint64)


def _shared_prefixes(sets: DataFrame, count: int, width: int, least: float) -> DataFrame:
    """(shingle, set, n, place, sets): prefixes whose shingle several sets have, and how often it was met, each row once.

    First only shingles are shuffled, to see which are met in several sets; then the rows that have them.
    """
    hot = _hot(sets, count, width)
    for _ in range(ROUNDS):
        met = _prefixes(sets, width, least, hot).groupBy("shingle").agg(
            F.min("set").alias("a"), F.max("set").alias("b"), F.count("*").alias("sets")).where("a <> b").drop("a", "b")
        met = stage(met, "met_shingles")
        room = HOT - len(hot)
        heavy = met.where(F.col("sets") > HEAVY).orderBy(F.desc("sets"), "shingle").limit(room).collect() if room else []
        heavy = np.array([r["shingle"] for r in reversed(heavy)], dtype=np.int64).view(np.uint64)
        heavy = heavy[~np.isin(heavy, hot)]
        if not len(heavy):
            break
        hot = np.concatenate([hot, heavy])
    else:
        met = stage(_prefixes(sets, width, least, hot).groupBy("shingle").agg(
            F.min("set").alias("a"), F.max("set").alias("b"), F.count("*").alias("sets")).where("a <> b").drop("a", "b"), "met_shingles")
    rows = _prefixes(sets, width, least, hot, _Bits(met, "shingle"))
    return stage(rows.join(met, "shingle").distinct(), "shared_prefixes")


def _possible(an, ai, bn, bi, least: float, lesser=F.least, greater=F.greatest):
    """Whether sets of these sizes whose first common shingle has these places can be similar enough."""
    shared = lesser(an - ai, bn - bi)
    return (lesser(an, bn) >= least * greater(an, bn) - _ROUNDING) & (shared >= least / (1 + least) * (an + bn) - _ROUNDING)


def _similar(a: Column, b: Column, width: int, least: float) -> Column:
    @F.arrow_udf(T.BooleanType())
    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for lo in range(0, len(left), 256):
            (i, x), (j, y) = shingles_of(left.slice(lo, 256), width), shingles_of(right.slice(lo, 256), width)
            size = min(256, len(left) - lo)
            row, hashed = np.concatenate([i, j]), np.concatenate([x, y])
            order = np.lexsort((hashed, row))
            row, hashed = row[order], hashed[order]
            twice = (row[1:] == row[:-1]) & (hashed[1:] == hashed[:-1])
            both = np.bincount(row[1:][twice], minlength=size)
            either = np.bincount(row, minlength=size) - both
            out.append(both >= least * either - _ROUNDING)
        return pa.array(np.concatenate(out) if out else np.zeros(0, bool))

    return similar(a, b)


def _plausible(a: Column, b: Column, an: Column, bn: Column, least: float) -> Column:
    @F.arrow_udf(T.BooleanType())
    def plausible(left: pa.Array, right: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
        enough = least / (1 + least) * (n.to_numpy() + m.to_numpy()) - _ROUNDING
        return pa.array([most_shared(x, y) >= e for x, y, e in zip(left.to_pylist(), right.to_pylist(), enough, strict=True)], pa.bool_())

    return plausible(a, b, an, bn)


def _compared(own: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of sets of one shingle (shingle, set, n, place, root, sets, sketch) that aren't connected and may be similar.

    The sets of a shingle are cut into blocks of some BLOCK, and a task compares two blocks at a time; only
    pairs that sizes, places and sketches don't rule out leave it.
    """
    blocks = F.ceil(F.col("sets") / BLOCK).cast("int")
    dealt = own.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("set", "shingle"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("shingle", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                         (F.col("block") > F.col("other")).alias("second"), "set", "n", "place", "root", "sketch")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None

        def pairs(rows: pa.Table) -> pa.RecordBatch:
            i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
            second = rows["second"].to_numpy()
            first = rows if i == j else rows.filter(pa.array(~second))
            other = rows if i == j else rows.filter(pa.array(second))
            cols = [{c: t[c].to_numpy() for c in ("set", "n", "place", "root")} for t in (first, other)]
            drawn = [t["sketch"].to_pylist() for t in (first, other)]
            a, b = [], []
            for x in range(first.num_rows):
                p, q = {k: v[x].astype(np.int64) for k, v in cols[0].items()}, cols[1]
                good = (p["root"] != q["root"]) & ((p["set"] < q["set"]) if i == j else True)
                good &= _possible(p["n"], p["place"], q["n"].astype(np.int64), q["place"], least, np.minimum, np.maximum)
                for y in np.flatnonzero(good):
                    if most_shared(drawn[0][x], drawn[1][y]) >= least / (1 + least) * (p["n"] + q["n"][y]) - _ROUNDING:
                        a.append(int(p["set"]))
                        b.append(int(q["set"][y]))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(3)])
            starts = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])) if batch.num_rows else []
            for lo, hi in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                if at is not None and tuple(keys[:, lo]) != at:
                    yield pairs(pa.Table.from_batches(held))
                    held = []
                at = tuple(keys[:, lo])
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield pairs(pa.Table.from_batches(held))

    grouped = dealt.repartition("shingle", "i", "j").sortWithinPartitions("shingle", "i", "j")
    return grouped.mapInArrow(compare, "a bigint, b bigint")


def similar_links(docs: DataFrame, sets: DataFrame, width: int = WIDTH, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) between sets whose components are those of all pairs with a Jaccard similarity of at least `least`.

    `docs` (set, text) gives the texts, `sets` (set, n, print, sketch; staged) has each set once. First come
    fingerprints within `radius` bits (the tree), and sets that share a prefix shingle with the smallest set of that
    shingle, which connects families of near copies; then all sets of a shingle that aren't connected yet with each
    other. Similar sets share one of their first n - ceil(least n) + 1 shingles, in any order common to all sets, so
    no pair is missed. Pairs that the sketches don't rule out are verified on their texts.
    """
    prefixes = _shared_prefixes(docs, sets.count(), width, least)
    drawn = sets.select("set", "n", "sketch")

    def verified(pairs: DataFrame, name: str, sketched: bool) -> DataFrame:
        pairs = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if not sketched:
            a, b = (drawn.select(F.col("set").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}")) for s in "ab")
            pairs = pairs.join(a, "a").join(b, "b").where(_plausible(F.col("sketch_a"), F.col("sketch_b"), F.col("n_a"), F.col("n_b"), least))
        pairs = stage(pairs.select("a", "b"), f"{name}_pairs")
        named = stage(pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct(), f"{name}_sets")
        texts = docs.where(_Bits(named, "set").maybe(F.col("set"))).join(named, "set", "left_semi")
        texts = stage(texts.groupBy("set").agg(F.first("text").alias("text")), f"{name}_texts")
        both = (
            pairs.join(texts.select(F.col("set").alias("a"), F.col("text").alias("left")), "a")
            .join(texts.select(F.col("set").alias("b"), F.col("text").alias("right")), "b"))
        return stage(both.where(_similar(F.col("left"), F.col("right"), width, least)).select("a", "b"), name)

    # Sets of one fingerprint hang on the smallest of them, and those of linked fingerprints on each other.
    prints = stage(sets.groupBy("print").agg(F.min("set").alias("first")), "set_prints")
    ends = [prints.select(F.col("print").alias(s), F.col("first").alias(f"first_{s}")) for s in "ab"]
    tree = (
        print_links(prints.select("print"), radius).join(ends[0], "a").join(ends[1], "b").select(F.col("first_a").alias("a"), F.col("first_b").alias("b"))
        .union(sets.join(prints, "print").select(F.col("set").alias("a"), F.col("first").alias("b"))))
    heads = prefixes.groupBy("shingle").agg(F.min(F.struct("set", "n", "place")).alias("head"))
    stars = prefixes.join(heads, "shingle").where(
        _possible(F.col("n"), F.col("place"), F.col("head.n"), F.col("head.place"), least)).select(F.col("set").alias("a"), F.col("head.set").alias("b"))
    found = verified(tree.union(stars), "stars", False)
    roots = stage(connected_components(found).withColumnRenamed("node", "set"), "star_roots")
    own = prefixes.join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    apart = own.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("shingle")
    own = own.join(apart, "shingle", "left_semi").join(drawn.select("set", "sketch"), "set")
    return found.union(verified(_compared(own, least), "rest", True))


def keep_first_similar(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
                       least: float = SIMILARITY) -> DataFrame:
    """`docs` with one row of each group of texts linked by similarity, that with the smallest key.

    Two texts link when the Jaccard similarity of their sets of `width`-word shingles (case of A-Z
    does not count) is at least `least`; a shorter text is one shingle. Equal texts are folded before
    anything is compared. NULL texts and those without a word are all equal; NULL keys come last;
    of repeated rows one stays. An empty table stays empty; columns of any name are kept.

    Texts are read where they are: of a text that nothing resembles only its key, hashes and the
    hashes of its first shingles are ever written or shuffled.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    worded = F.coalesce(F.col(at[text]).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    own = docs.toDF(*names).withColumn("_set", F.when(worded, F.xxhash64(at[text])).otherwise(F.lit(0).cast("bigint")))
    digests = own.select(F.col(at[key]).alias("key"), F.col("_set").alias("set"), _digest(F.col(at[text]), width).alias("own"))
    digests = stage(digests.select("key", "set", "own.*"), "digests")
    order = F.struct(F.col("key").isNull().alias("last"), "key", "set")
    sets = digests.groupBy("set").agg(F.min(order).alias("first"), F.count("*").alias("rows"), F.first(F.struct("n", "print", "sketch")).alias("own"))
    sets = stage(sets.select("set", "first", "rows", "own.*"), "sets")
    texts = own.where("_set <> 0").select(F.col("_set").alias("set"), F.col(at[text]).alias("text"))
    links = similar_links(texts, sets.where("set <> 0").select("set", "n", "print", "sketch"), width, least)
    roots = connected_components(links).withColumnRenamed("node", "set")
    rooted = stage(sets.select("set", "first", "rows").join(roots, "set", "left").withColumn("root", F.coalesce("root", "set")), "rooted")
    groups = rooted.groupBy("root").agg(F.min("first").alias("first"), F.sum("rows").alias("rows")).where("rows > 1")
    members = stage(rooted.select("set", "root").join(groups, "root").select(F.col("set").alias("_set"), "first"), "members")
    # Texts that nothing resembles stay where they are; only the others are joined.
    marked = own.withColumn("_maybe", _Bits(members, "_set").maybe(F.col("_set")))
    joined = marked.where("_maybe").join(members, "_set", "left")
    first = F.col("first")
    winners = joined.where(first.isNotNull() & F.col(at[key]).eqNullSafe(first["key"]) & (F.col("_set") == first["set"])).dropDuplicates(["_set", at[key]])
    return (
        marked.where("NOT _maybe").select(*names).union(joined.where(first.isNull()).select(*names)).union(winners.select(*names)).toDF(*docs.columns))
