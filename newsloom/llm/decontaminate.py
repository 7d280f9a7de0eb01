"""Benchmark decontamination (operator 8): SimHash of item-sized windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.registry import query, table
from newsloom.llm.words import PUNCTUATION, WHITE_SPACE, Runs, Splitter, mix, pieces

SHINGLE = 5
SIMILARITY = 0.8
#: Blocks of 8 bits are looked up with up to NEAR_BITS wrong ones, so every fingerprint within
#: 8 * NEAR_BITS + 7 = 23 of 64 bits is met. Unrelated ones differ in 32 bits on average, windows at
#: similarity 0.8 in about 10.
NEAR_BITS = 2
RADIUS = 8 * NEAR_BITS + 7
#: Items go to the tasks in blocks of at most so many; a larger benchmark takes several passes.
ITEMS_PER_PASS = 4_096
_TABLE_BITS = 22
#: Windows times items that are looked up at once (4 MB).
_AT_ONCE = 1 << 22


def _splitter() -> Splitter:
    """Case, punctuation and white space don't matter."""
    return Splitter(WHITE_SPACE + PUNCTUATION, lower=True)


def _shingles(runs: Runs, lo: int, hi: int, width: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of `width` words of words lo ... hi-1; of fewer words: the whole."""
    if hi - lo < width:
        size = np.array([hi - lo], dtype=np.uint64)
        return mix(runs.of(np.array([lo]), np.array([hi])) + size) if hi > lo else np.zeros(0, np.uint64)
    starts = np.arange(lo, hi - width + 1)
    return mix(runs.of(starts, starts + width) + np.uint64(width))


def window_prints(shingles: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of shingles[s:s+size] for every start s, from running sums of the bits."""
    bits = np.unpackbits(shingles.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.zeros((len(shingles) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    ones = 2 * (sums[starts + size] - sums[starts]) > size
    return np.packbits(ones, axis=1).view(">u8").ravel().astype(np.uint64)


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the smaller over sum of the larger weights of shingles; a weight is a number of occurrences."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    shared = int(np.minimum(n[i], m[j]).sum())
    return shared / (len(a) + len(b) - shared) if len(a) + len(b) > shared else 0.0


class Benchmark:
    """Shingles, fingerprints and block tables of at most ITEMS_PER_PASS items."""

    def __init__(self, ids: list[int], texts: list[str]):
        splitter, self.ids, self.shingles, lengths = _splitter(), [], [], []
        for _id, text in zip(ids, texts, strict=True):
            for _, _, data, offsets in pieces(pa.array([text], pa.large_string())):
                words = splitter.split(data, offsets)
                own = _shingles(Runs(words.hash), 0, len(words.hash))
                if len(own):
                    self.ids.append(_id)
                    lengths.append(len(words.hash))
                    self.shingles.append(own)
        self.sizes = np.array([len(s) for s in self.shingles], dtype=np.int64)
        self.prints = np.array([window_prints(s, np.array([0]), len(s))[0] for s in self.shingles], dtype=np.uint64)
        # Items of fewer words than a shingle are looked for as they are, by their number of words.
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        words = np.array(lengths, dtype=np.int64)
        for n in np.unique(words[words < SHINGLE]):
            those = np.flatnonzero(words == n)
            hashes = np.concatenate([self.shingles[i] for i in those])
            order = np.argsort(hashes, kind="stable")
            self.short[int(n)] = hashes[order], those[order]
        # Shingle -> items that have it.
        flat = np.concatenate(self.shingles) if self.shingles else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(self.ids)), self.sizes)
        pairs = np.unique(np.rec.fromarrays([flat, item], names="s,i"))
        self.known, self.first = np.unique(pairs.s, return_index=True)
        self.first = np.append(self.first, len(pairs))
        self.item = np.asarray(pairs.i)
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[self.known >> np.uint64(64 - _TABLE_BITS)] = True
        # Block tables: near[b][v] marks the items whose block b differs from v in at most NEAR_BITS bits.
        blocks = self.prints.astype(">u8").view(np.uint8).reshape(-1, 8)
        values = np.arange(256, dtype=np.uint8)
        self.near = [np.bitwise_count(values[:, None] ^ blocks[:, b][None, :]) <= NEAR_BITS for b in range(8)]

    def anchors(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, row of `known`) of the shingles that occur in some item."""
        at = np.flatnonzero(self.table[shingles >> np.uint64(64 - _TABLE_BITS)])
        row = np.searchsorted(self.known, shingles[at])
        row[row == len(self.known)] = 0
        good = self.known[row] == shingles[at] if len(self.known) else np.zeros(0, bool)
        return at[good], row[good]

    def matches(self, shingles: np.ndarray, at: np.ndarray, row: np.ndarray, least: float) -> dict[int, float]:
        """Item id -> best similarity of a window of the item's size, if at least `least`.

        A window that shares no shingle with an item has similarity 0, so windows are taken around
        the places of shared shingles.
        """
        found: dict[int, float] = {}
        count = self.first[row + 1] - self.first[row]
        place = np.repeat(at, count)
        item = np.concatenate([self.item[self.first[r]:self.first[r + 1]] for r in row])
        for size in np.unique(self.sizes[item]):
            mine = self.sizes[item] == size
            window = min(int(size), len(shingles))
            reach = np.unique(place[mine])[:, None] + np.arange(-window + 1, 1)[None, :]
            starts = np.unique(reach)
            starts = starts[(starts >= 0) & (starts <= len(shingles) - window)]
            lo = int(starts[0])
            local = shingles[lo:int(starts[-1]) + window]
            prints = window_prints(local, starts - lo, window)
            blocks = prints.astype(">u8").view(np.uint8).reshape(-1, 8)
            those = np.flatnonzero(self.sizes == size)
            i, j, step = [], [], max(1, _AT_ONCE // len(those))
            for at in range(0, len(starts), step):
                met = np.zeros((min(step, len(starts) - at), len(those)), dtype=bool)
                for b in range(8):
                    met |= self.near[b][blocks[at:at + step, b]][:, those]
                some, other = np.nonzero(met)
                close = np.bitwise_count(prints[at + some] ^ self.prints[those[other]]) <= RADIUS
                i.append(at + some[close])
                j.append(other[close])
            i, j = np.concatenate(i), np.concatenate(j)
            for k in np.unique(j):
                own = self.shingles[those[k]]
                best = max(weighted_similarity(shingles[starts[w]:starts[w] + window], own) for w in i[j == k])
                if best >= least:
                    name = self.ids[those[k]]
                    found[name] = max(best, found.get(name, 0.0))
        return found


def _short_items(bench: Benchmark, runs: Runs, n: int, end: np.ndarray) -> dict[int, set[int]]:
    """Text -> ids of items of fewer words than a shingle that stand in it, of a piece of n words whose texts end at `end`."""
    found: dict[int, set[int]] = {}
    for size, (hashes, items) in bench.short.items():
        every = _shingles(runs, 0, n, size) if n >= size else np.zeros(0, np.uint64)
        lo, hi = np.searchsorted(hashes, every, side="left"), np.searchsorted(hashes, every, side="right")
        at = np.flatnonzero(lo < hi)
        text = np.searchsorted(end, at, side="right")
        inside = at + size <= end[text] if len(at) else np.zeros(0, bool)
        for place, t in zip(at[inside], text[inside], strict=True):
            found.setdefault(int(t), set()).update(bench.ids[i] for i in items[lo[place]:hi[place]])
    return found


_RESULT = T.StructType([T.StructField("items", T.ArrayType(T.LongType())), T.StructField("best", T.DoubleType())])


def _scan(text: Column, bench: Benchmark, least: float) -> Column:
    @F.arrow_udf(_RESULT)
    def scan(texts: pa.Array) -> pa.Array:
        splitter, items, best = _splitter(), [], []
        for lo, hi, data, offsets in pieces(texts):
            words = splitter.split(data, offsets)
            runs, n = Runs(words.hash), len(words.hash)
            # All five-word runs of the piece at once; those across texts are struck out by row below.
            every = _shingles(runs, 0, n) if n >= SHINGLE else np.zeros(0, np.uint64)
            at, row = bench.anchors(every)
            begin, end = words.bounds[:-1], words.bounds[1:]
            text_of = np.searchsorted(end, at, side="right")
            inside = at + SHINGLE <= end[text_of] if len(at) else np.zeros(0, bool)
            at, row, text_of = at[inside], row[inside], text_of[inside]
            hits = np.searchsorted(text_of, np.arange(hi - lo + 1))
            whole = _short_items(bench, runs, n, end)
            for t in range(hi - lo):
                a, b = int(begin[t]), int(end[t])
                found: dict[int, float] = {}
                if hits[t + 1] > hits[t]:
                    some = slice(hits[t], hits[t + 1])
                    found = bench.matches(every[a:b - SHINGLE + 1], at[some] - a, row[some], least)
                found |= dict.fromkeys(whole.get(t, ()), 1.0)
                items.append(sorted(found))
                best.append(max(found.values(), default=0.0))
        return pa.StructArray.from_arrays([pa.array(items, pa.list_(pa.int64())), pa.array(best, pa.float64())], names=["items", "best"])

    return scan(text)


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                  item_text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """`docs` with `contamination`: struct<items: array<bigint>, best: double>.

    `items`: the benchmark items that a window of the document resembles: as many five-word shingles
    as the item has (the whole document, if it has fewer), fingerprints within RADIUS bits, and
    exact weighted similarity of at least `least`. `best` is the highest such similarity, else 0. Items of fewer than
    five words match documents in which just these words stand one after the other.

    No shuffle: the benchmark goes to the tasks, at most ITEMS_PER_PASS items at a time (a larger
    one in several passes over `docs`). NULL or empty texts match nothing, and so do NULL or empty items; items with a NULL
    id are left out; repeated rows get equal results; an empty benchmark matches nothing.
    """
    rows = benchmark.where(F.col(item).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item).cast("bigint"), item_text)
    passes = max(1, -(-rows.count() // ITEMS_PER_PASS))
    found = []
    for p in range(passes):
        own = rows.where(F.pmod(F.xxhash64(item), F.lit(passes)) == p).collect()
        for lo in range(0, max(len(own), 1), ITEMS_PER_PASS):
            part = own[lo:lo + ITEMS_PER_PASS]
            found.append(_scan(F.col(text), Benchmark([r[0] for r in part], [r[1] for r in part]), least))
    columns = {f"_pass{i}": c for i, c in enumerate(found)}
    made = docs.withColumns(columns)
    items = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(c)["items"] for c in columns]))))
    best = F.array_max(F.array(*[F.col(c)["best"] for c in columns]))
    return made.withColumn("contamination", F.struct(items.alias("items"), best.alias("best"))).drop(*columns)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` that resemble no benchmark item, with just their columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    found = contamination(docs.toDF(*names), benchmark, at[text])
    return found.where(F.size("contamination.items") == 0).select(*names).toDF(*docs.columns)


@query("op8_decontaminate")
def op8(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", (F.size("contamination.items") > 0).alias("contaminated"),
        F.array_join("contamination.items", ",").alias("item_ids"), F.col("contamination.best").alias("best_similarity"))
