"""Cross-tokenizer alignment (operator 13): which tokens of two tokenizers cover the same bytes.

Tokens of both sides are intervals of the text's bytes. Every token points to the farthest-right token
that overlaps it; doubling these pointers leads each token to the last one of its group, in as many
vectorised rounds as the logarithm of the longest chain.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.bpe import Encoder, Vocabulary, _found, _hashes, _valid, automaton, expanded, merge_vocabulary
from newsloom.llm.registry import query, table
from newsloom.llm.words import inverse, pieces, powers
from newsloom.session import scratch_path

A_VOCABULARY, B_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Pairs whose counts are sent to all tasks, at most (12 bytes each); the others are joined.
FREQUENT = 1 << 20
#: Words whose pieces a task keeps, and distinct pairs that it adds up before it hands them on. Only speed depends on them.
CACHED, PENDING = 1 << 19, 1 << 20
_BASE = 0x9E3779B97F4A7C15
_ID_BITS = 20
_TEXTS = 1 << 20


class Pieces:
    """A sentencepiece model as an encoder of words: no piece goes on behind a blank, so words are independent, and
    a frequent one is encoded once a task. Ids of texts with U+2581, the model's own sign for a blank, may differ from
    the model's; such texts never come back as they were."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.whole = any("\u2581" in n.lstrip("\u2581") for n in names)
        own = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("\u2581", " ").encode() for i, n in enumerate(names)]
        self.bytes = np.frombuffer(b"".join(own), dtype=np.uint8)
        self.bounds = np.concatenate([[0], np.cumsum([len(o) for o in own])])
        self.up = self.down = np.zeros(0, dtype=np.uint64)
        self._forget()

    def _forget(self) -> None:
        self.key, self.where, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, dtype=np.int32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds by text) of texts that begin with the blank which the model puts before them."""
        if len(self.up) < len(data):
            self.up, self.down = powers(_BASE, 2 * len(data)), powers(inverse(_BASE), 2 * len(data))
        opens = np.zeros(len(data), dtype=bool)
        opens[offsets[:-1]] = True
        if not self.whole:
            blank = data == 32
            opens[1:] |= blank[1:] & ~blank[:-1]
        start = np.flatnonzero(opens)
        end = np.append(start[1:], len(data))
        each, first, of = np.unique(_hashes(data, start, end, self.up, self.down), return_index=True, return_inverse=True)
        _, known = _found(self.key, each)
        if not known.all():
            if len(self.key) > CACHED:
                self._forget()
                known[:] = False
            raw = data.tobytes()
            found = self.model.encode([raw[start[i] + 1:end[i]].decode() for i in first[~known]], num_threads=1)
            # A blank alone: the model gives nothing for an empty text.
            blank = self.model.piece_to_id("\u2581")
            found = [f or [blank] * int(end[i] - start[i]) for f, i in zip(found, first[~known], strict=True)]
            count = np.array([len(f) for f in found], dtype=np.int64)
            where = len(self.ids) + np.cumsum(count) - count
            self.ids = np.concatenate([self.ids, np.fromiter((x for f in found for x in f), dtype=np.int32, count=int(count.sum()))])
            key = np.concatenate([self.key, each[~known]])
            order = np.argsort(key, kind="stable")
            self.key, self.where, self.count = key[order], np.concatenate([self.where, where])[order], np.concatenate([self.count, count])[order]
        at = _found(self.key, each)[0][of]
        ids = self.ids[expanded(self.where[at], self.count[at])]
        total = np.concatenate([[0], np.cumsum(self.count[at])])
        return ids, total[np.searchsorted(start, offsets)]


class Side(NamedTuple):
    """Ids of many texts one after the other: ids[bounds[i]:bounds[i+1]] belong to text i; end: behind their last bytes,
    counted through all texts."""
    ids: np.ndarray
    bounds: np.ndarray
    end: np.ndarray


class Alignment(NamedTuple):
    group_a: np.ndarray  # number of the group of each token of A, counted through all texts
    group_b: np.ndarray
    link_a: np.ndarray  # token of A and of B of every overlapping pair
    link_b: np.ndarray


def align(a: Side, b: Side) -> Alignment:
    """Groups and links of tokens that cover the same bytes; both sides end where a text ends."""
    n = len(a.ids)
    over = np.searchsorted(b.end, a.end)  # token of B that holds the last byte of each token of A
    back = np.searchsorted(a.end, b.end)
    last = a.end[np.minimum(back, max(n - 1, 0))] == b.end if n else np.zeros(0, dtype=bool)
    to = np.concatenate([n + over, np.where(last, n + np.arange(len(b.ids)), back)])
    while True:
        further = to[to]
        if np.array_equal(further, to):
            break
        to = further
    ends = n + np.flatnonzero(last)
    group = np.searchsorted(ends, to)
    # Each token of A ends a link with the token of B over its last byte, and the other way round; where both end, that is one link.
    own = np.concatenate([np.arange(n), back[~last]])
    order = np.argsort(np.concatenate([a.end, b.end[~last]]), kind="stable")
    return Alignment(group[:n], group[n:], own[order], np.concatenate([over, np.flatnonzero(~last)])[order])


def _joined(bytes_: np.ndarray, bounds: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = bounds[ids + 1] - bounds[ids]
    return bytes_[expanded(bounds[ids], width)], np.cumsum(width)


def _same(joined: np.ndarray, ends: np.ndarray, bounds: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether the tokens of each text give the text's bytes."""
    if np.array_equal(joined, data) and np.array_equal(np.concatenate([[0], ends])[bounds], offsets):
        return np.ones(len(offsets) - 1, dtype=bool)
    at = np.concatenate([[0], ends])[bounds]
    return np.array([np.array_equal(joined[at[i]:at[i + 1]], data[offsets[i]:offsets[i + 1]]) for i in range(len(offsets) - 1)], dtype=bool)


def tokenise(docs: DataFrame, a: Vocabulary, b: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, key, a, b): the ids of a blank and the text by the vocabulary `a`, and of the text by the sentencepiece model `b`.

    NULL and empty texts have no ids, nor have texts whose tokens' bytes aren't the blank and the
    text. Bytes that are no UTF-8 count as U+FFFD. NULL keys stay NULL and repeated rows stay, each
    with a `row` of its own; an empty table gives no rows. Only `key` and `text` are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast((a, automaton(), b))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, found, model = shared.value
        first, second = Encoder(vocabulary, found), Pieces(model)
        for batch in batches:
            texts = batch.column(2).cast(pa.large_string()).fill_null("")
            texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), pa.scalar("", pa.large_string()),
                               pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())))
            for lo, hi, data, offsets in pieces(texts):
                data, offsets = _valid(data, offsets)
                full = np.flatnonzero(np.diff(offsets) > 0)
                cut = np.append(offsets[:-1][full], len(data))
                columns = []
                ids_a, ends_a, bounds_a = first.encode(data, cut)
                ids_b, bounds_b = second.encode(data, cut) if len(data) else (np.zeros(0, np.int32), np.zeros(1, np.int64))
                good = np.ones(len(full), dtype=bool)
                for ids, bounds, of in ((ids_a, bounds_a, vocabulary), (ids_b, bounds_b, second)):
                    joined, ends = _joined(of.bytes, of.bounds, ids)
                    good &= _same(joined, ends, bounds, data, cut)
                for ids, bounds in ((ids_a, bounds_a), (ids_b, bounds_b)):
                    size = np.zeros(hi - lo, dtype=np.int64)
                    size[full] = np.where(good, np.diff(bounds), 0)
                    own = ids if good.all() else ids[np.repeat(good, np.diff(bounds))]
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(own.astype(np.int32))))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), *columns], names=["row", key, "a", "b"])

    own = docs.select(F.monotonically_increasing_id().alias("row"), key, F.col(text).cast("string").alias("_text"))
    return own.mapInArrow(run, f"row bigint, `{key}` {kind}, a array<int>, b array<int>")


def _sides(a: pa.Array, b: pa.Array, bounds: tuple) -> Iterator[tuple[int, int, Side, Side]]:
    """(first row, row behind the last, A, B) for runs of about a million bytes of whole texts."""
    at_a, at_b = np.asarray(a.offsets).astype(np.int64), np.asarray(b.offsets).astype(np.int64)
    ids_a, ids_b = a.values.to_numpy(), b.values.to_numpy()
    lo = 0
    while lo < len(a):
        hi = int(np.searchsorted(at_a, at_a[lo] + (1 << 18), side="right")) - 1
        hi = min(max(hi, lo + 1), len(a), lo + _TEXTS)
        sides = []
        for ids, at, width in ((ids_a, at_a, bounds[0]), (ids_b, at_b, bounds[1])):
            own = ids[at[lo]:at[hi]]
            sides.append(Side(own, at[lo:hi + 1] - at[lo], np.cumsum(width[own])))
        yield lo, hi, *sides
        lo = hi


def _widths(a: Vocabulary, b: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.diff(a.bounds), np.diff(Pieces(b).bounds)


def _links(a: Side, b: Side) -> tuple[Alignment, np.ndarray, np.ndarray]:
    """(alignment, text, pair) of all links; a pair of ids as one number."""
    found = align(a, b)
    text = np.searchsorted(a.bounds, found.link_a, side="right") - 1
    return found, text, a.ids[found.link_a].astype(np.int64) << _ID_BITS | b.ids[found.link_b]


def _in_texts(text: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pair, links) of the distinct pairs of each text."""
    both = np.sort(text.astype(np.int64) << 2 * _ID_BITS | pair)  # a run of texts has far fewer than 2**23 of them
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
    return both[first] >> 2 * _ID_BITS, both[first] & ((1 << 2 * _ID_BITS) - 1), np.diff(first, append=len(both))


def aligned(tokens: DataFrame, a: Vocabulary, b: bytes) -> DataFrame:
    """`tokens` (tokenise) with `groups`, an array of (a, b): the ids of both sides in each group, in order."""
    widths = tokens.sparkSession.sparkContext.broadcast(_widths(a, b))

    @F.arrow_udf("array<struct<a: array<int>, b: array<int>>>")
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for lo, hi, x, y in _sides(a, b, widths.value):
            found = align(x, y)
            size = int(found.group_b[-1]) + 1 if len(found.group_b) else 0
            lists = [pa.ListArray.from_arrays(pa.array(np.searchsorted(g, np.arange(size + 1)).astype(np.int32)), pa.array(s.ids))
                     for g, s in ((found.group_a, x), (found.group_b, y))]
            at = np.concatenate([found.group_a, [size]])[x.bounds]
            out.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.StructArray.from_arrays(lists, names=["a", "b"])))
        kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
        return pa.chunked_array(out, type=kind).combine_chunks() if out else pa.array([], kind)

    return tokens.withColumn("groups", run("a", "b"))


def pair_counts(tokens: DataFrame, a: Vocabulary, b: bytes) -> DataFrame:
    """(a, b, n): in how many rows of `tokens` an id pair is linked.

    A task adds up pairs before they are shuffled, so a frequent pair is some rows a task, not one a document.
    """
    widths = tokens.sparkSession.sparkContext.broadcast(_widths(a, b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def added(parts):
            pair, n = np.concatenate([p for p, _ in parts]), np.concatenate([n for _, n in parts])
            each, of = np.unique(pair, return_inverse=True)
            sums = np.zeros(len(each), dtype=np.int64)
            np.add.at(sums, of, n)
            return each, sums

        def rows(each, sums):
            return pa.RecordBatch.from_arrays([pa.array(each), pa.array(sums)], names=["pair", "n"])

        held, total = [], 0
        for batch in batches:
            for _, _, x, y in _sides(batch.column(0), batch.column(1), widths.value):
                _, text, pair = _links(x, y)
                each, n = np.unique(_in_texts(text, pair)[1], return_counts=True)
                held.append((each, n))
                total += len(each)
                if total > 2 * PENDING:
                    held = [added(held)]
                    total = len(held[0][0])
                    if total > PENDING:
                        yield rows(*held[0])
                        held, total = [], 0
        if held:
            yield rows(*added(held))

    parts = tokens.select("a", "b").mapInArrow(run, "pair bigint, n bigint")
    summed = parts.groupBy("pair").agg(F.sum("n").alias("n"))
    return summed.select(F.shiftright("pair", _ID_BITS).cast("int").alias("a"), F.col("pair").bitwiseAND((1 << _ID_BITS) - 1).cast("int").alias("b"), "n")


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _texts_of_groups(a: Side, b: Side, found: Alignment, spelled: list[np.ndarray]) -> list[bytes]:
    """`a1,a2|b1;a3|b2,b3` of every text. `spelled`: an id with `,`, with `|` and with `;` behind it."""
    group = np.concatenate([2 * found.group_a, 2 * found.group_b + 1])
    order = np.argsort(group, kind="stable")
    ids, group = np.concatenate([a.ids, b.ids])[order], group[order]
    out = spelled[0][ids]
    last = np.flatnonzero(np.diff(group, append=-1))
    side = group[last] & 1
    out[last[side == 0]], out[last[side == 1]] = spelled[1][ids[last[side == 0]]], spelled[2][ids[last[side == 1]]]
    at = a.bounds + b.bounds
    return [b"".join(out[at[i]:at[i + 1]])[:-1] for i in range(len(at) - 1)]


def alignment_report(tokens: DataFrame, a: Vocabulary, b: bytes, key: str = "doc_id", frequent: int = FREQUENT) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row of `tokens` (staged).

    n_best: links whose pair is in as many rows as any pair of its A id; count_sum: over links, in
    how many rows their pair is. Counts of at most `frequent` pairs, the most frequent ones, go to
    the tasks; what is left of a row is its rare pairs, which are joined. Rows without tokens have
    zeros and an empty digest.
    """
    import hashlib

    spark = tokens.sparkSession
    counts = _staged(pair_counts(tokens, a, b), "pair_counts")
    highest = np.zeros(len(a.bounds), dtype=np.int64)  # by A id, so bounded by the vocabulary
    for r in counts.groupBy("a").agg(F.max("n").alias("n")).toArrow().to_pylist():
        highest[r["a"]] = r["n"]
    sizes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("level")).agg(F.count("*").alias("n")).collect()  # at most 63 rows, of levels to 62
    level, total = 62, 0
    for r in sorted(sizes, key=lambda r: -r["level"]):
        total += r["n"]
        if total > frequent:
            break
        level = r["level"]
    least = 1 << level
    often = counts.where(F.col("n") >= least).toArrow()
    pair = often["a"].to_numpy().astype(np.int64) << _ID_BITS | often["b"].to_numpy()
    order = np.argsort(pair)
    shared = spark.sparkContext.broadcast((_widths(a, b), pair[order], often["n"].to_numpy()[order], highest))
    kind = tokens.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        widths, pairs, counted, most = shared.value
        spelled = []
        for sign in ",|;":
            own = np.empty(max(len(w) for w in widths), dtype=object)
            own[:] = [f"{i}{sign}".encode() for i in range(len(own))]
            spelled.append(own)
        for batch in batches:
            for lo, hi, x, y in _sides(batch.column(2), batch.column(3), widths):
                found, text, own = _links(x, y)
                size = hi - lo
                n_links = np.bincount(text, minlength=size)
                of, own, links = _in_texts(text, own)
                at, there = _found(pairs, own)
                n = np.where(there, counted[at], 0) if len(pairs) else np.zeros(len(own), dtype=np.int64)
                best = there & (n == most[own >> _ID_BITS])
                sums = np.zeros(size, dtype=np.int64)
                np.add.at(sums, of, n * links)
                n_best = np.zeros(size, dtype=np.int64)
                np.add.at(n_best, of[best], links[best])
                rare = np.flatnonzero(~there)
                at = np.searchsorted(of[rare], np.arange(size + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(v[rare])) for v in (own, links)]
                ends = np.concatenate([found.group_a, [found.group_b[-1] + 1 if len(found.group_b) else 0]])[x.bounds]
                digests = [hashlib.sha256(t).hexdigest() if t else "" for t in _texts_of_groups(x, y, found, spelled)]
                numbers = [pa.array(v.astype(np.int64)) for v in (np.diff(x.bounds), np.diff(y.bounds), np.diff(ends), n_links, n_best, sums)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, size), batch.column(1).slice(lo, size), *numbers, pa.array(digests, pa.string()), *lists],
                    names=["row", key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "rare", "links"])

    found = _staged(tokens.select("row", key, "a", "b").mapInArrow(
        run, f"row bigint, `{key}` {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
             "groups_sha256 string, rare array<bigint>, links array<bigint>"), "aligned")
    columns = [key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rare = found.where(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "links")).alias("p")).select(
        "row", F.col("p.rare").alias("pair"), "p.links")
    tops = counts.groupBy("a").agg(F.max("n").alias("top"))
    rest = counts.where(F.col("n") < least).join(tops, "a").select(
        F.shiftleft(F.col("a").cast("bigint"), _ID_BITS).bitwiseOR(F.col("b").cast("bigint")).alias("pair"), "n", (F.col("n") == F.col("top")).alias("best"))
    more = rare.join(rest, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("_best"), F.sum(F.col("links") * F.col("n")).alias("_sum"))
    joined = found.select("row", *columns).join(more, "row", "left")
    return joined.withColumns({
        "n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0))}).select(*columns)


def public_pair(a: str = A_VOCABULARY, b: str = B_VOCABULARY) -> tuple[Vocabulary, bytes]:
    """The two public tokenizers, read on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path(b), "rb") as file:
        return merge_vocabulary(public_tokenizers.path(a)), file.read()


@query("op13_align_tokenizers")
def op13(spark, sf_dir):
    """Groups, links and their counts of two public tokenizers over every document."""
    a, b = public_pair()
    tokens = _staged(tokenise(table(spark, sf_dir, "documents"), a, b), "tokens")
    return alignment_report(tokens, a, b)
