"""Byte-level BPE (operator 12): pre-tokenisation by transition-function scans, cached pair merging, decoding.

The pattern that cuts a text into slices is a finite automaton over classes of code points. Each code
point is a function from state to state; composing functions is associative, so the states of a whole
buffer come from a blocked scan over a table of the automaton's few distinct functions. No regex runs.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.registry import query, table
from newsloom.llm.words import inverse, mix, pieces, powers

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Slices whose ids a task keeps (a few dozen MB); beyond that it starts anew. Only speed depends on it.
CACHED = 1 << 19
#: Slices of more bytes are merged with a heap, one at a time.
LONG = 512
_BASE = 0x9E3779B97F4A7C15
_NONE = np.int32(2**31 - 1)

# Classes of code points, and the kinds of characters once their neighbours are known.
_OTHER, _LETTER, _NUMBER, _WHITE, _BLANK, _QUOTE = range(6)
_O, _L, _N, _W, _PREFIX, _ALONE, _SHORT, _LONGER, _KINDS = range(9)
# States: at a boundary, in letters, numbers, others, white space, behind a blank that belongs to what
# follows, and with one or two characters of a contraction to come.
_EDGE, _IN_L, _IN_N, _IN_O, _IN_W, _IN_PREFIX, _ONE, _TWO, _STATES = range(9)


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The state behind a character, and whether a slice starts at it."""
    if state == _TWO:
        return _ONE, False
    if state == _ONE:
        return _EDGE, False
    free = state != _IN_PREFIX
    if kind == _L:
        return _IN_L, free and state != _IN_L
    if kind == _N:
        return _IN_N, free and state != _IN_N
    if kind in (_O, _SHORT, _LONGER):
        if state in (_IN_O, _IN_PREFIX) or kind == _O:
            return _IN_O, free and state != _IN_O
        return (_ONE if kind == _SHORT else _TWO), True
    if kind == _W:
        return _IN_W, state != _IN_W
    return (_IN_PREFIX if kind == _PREFIX else _EDGE), True


class Automaton(NamedTuple):
    compose: np.ndarray  # number of the function "first a, then b", at a * n + b
    of_kind: np.ndarray  # number of a kind's function; kinds from _KINDS on are a text's first characters
    state: np.ndarray  # state that a function gives at a boundary
    starts: np.ndarray  # by state and kind


def automaton() -> Automaton:
    """The transition functions that characters and their compositions can be, each with a number; 0 changes nothing."""
    steps = [tuple(_step(s, k)[0] for s in range(_STATES)) for k in range(_KINDS)]
    steps += [(_step(_EDGE, k)[0],) * _STATES for k in range(_KINDS)]
    found = {tuple(range(_STATES)): 0}
    waiting = list(found)
    while waiting:
        own = waiting.pop()
        for step in steps:
            then = tuple(step[s] for s in own)
            if then not in found:
                found[then] = len(found)
                waiting.append(then)
    each = list(found)
    compose = np.array([found[tuple(b[s] for s in a)] for a in each for b in each], dtype=np.int16)
    starts = np.array([[_step(s, k)[1] for k in range(_KINDS)] + [True] * _KINDS for s in range(_STATES)])
    return Automaton(compose, np.array([found[s] for s in steps], dtype=np.int16), np.array([a[_EDGE] for a in each], dtype=np.int8), starts)


def scan(functions: np.ndarray, compose: np.ndarray, width: int = 64) -> np.ndarray:
    """The composition of the first i+1 functions, for every i: within blocks, then over blocks, then joined."""
    n, size = len(functions), int(round(len(compose) ** 0.5))
    if n == 0:
        return functions
    rows = -(-n // width)
    own = np.zeros(rows * width, dtype=np.int16)
    own[:n] = functions
    own = np.ascontiguousarray(own.reshape(rows, width).T)
    for j in range(1, width):
        own[j] = compose[own[j - 1].astype(np.intp) * size + own[j]]
    if rows > 1:
        before = np.zeros(rows, dtype=np.int16)
        before[1:] = scan(own[-1, :-1], compose, width)
        own = compose[before.astype(np.intp)[None, :] * size + own]
    return np.ascontiguousarray(own.T).reshape(-1)[:n]


def classes() -> np.ndarray:
    """The class of every code point, as the library whose ids are to be equalled knows them (its Unicode version counts)."""
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out = np.full(0x110000, _OTHER, dtype=np.uint8)
    for which, property_ in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_WHITE, r"\s")):
        asked = tiktoken.Encoding("classes", pat_str=property_, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        out[np.frombuffer(bytes(asked.encode_ordinary(every)).decode().encode("utf-32-le"), dtype=np.uint32)] = which
    out[ord(" ")], out[ord("'")] = _BLANK, _QUOTE
    return out


class PreTokenizer:
    """Cuts texts where the pattern `'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+` does."""

    def __init__(self, classes: np.ndarray, automaton: Automaton):
        self.classes, self.automaton = classes, automaton

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """First bytes of all slices of the texts data[offsets[i]:offsets[i+1]] (valid UTF-8)."""
        if not len(data):
            return np.zeros(0, dtype=np.int64)
        leads = (data & 0xC0) != 0x80
        if leads.all():
            code, place = data, None
        else:
            code, place = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32), np.flatnonzero(leads)
        n = len(code)
        opens = np.zeros(n + 1, dtype=bool)  # first characters of texts, and the end
        opens[offsets if place is None else np.searchsorted(place, offsets)] = True
        opens[n] = True
        kind_of = np.array([_O, _L, _N, _W, _W, _O], dtype=np.uint8)
        own = self.classes[code]
        kind = kind_of[own]
        white = kind == _W
        # The last white character before another one belongs to it (a blank) or stands alone.
        last = np.flatnonzero(white[:-1] & ~white[1:] & ~opens[1:n])
        kind[last] = np.where(own[last] == _BLANK, _PREFIX, _ALONE)
        quotes = np.flatnonzero(own == _QUOTE)
        if len(quotes):
            ends = np.flatnonzero(opens)
            left = ends[np.searchsorted(ends, quotes, side="right")] - quotes  # to the text's end, itself included
            one = np.where(left > 1, code[np.minimum(quotes + 1, n - 1)], 0)
            two = np.where(left > 2, code[np.minimum(quotes + 2, n - 1)], 0)
            kind[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = _SHORT
            pairs = np.zeros(len(quotes), dtype=bool)
            for a, b in ("re", "ve", "ll"):
                pairs |= (one == ord(a)) & (two == ord(b))
            kind[quotes[pairs]] = _LONGER
        kind[opens[:n]] += _KINDS
        found = self.automaton
        state = found.state[scan(found.of_kind[kind], found.compose)]
        before = np.concatenate([[_EDGE], state[:-1]])
        at = np.flatnonzero(found.starts[before, kind])
        return at if place is None else place[at]


class Vocabulary(NamedTuple):
    """A byte-pair vocabulary as arrays; its size is that of the vocabulary, whatever the texts."""
    bytes: np.ndarray  # all tokens' bytes, one after the other
    bounds: np.ndarray  # of token i: bounds[i] ... bounds[i+1]-1
    pair: np.ndarray  # left << 32 | right, sorted
    merged: np.ndarray  # id of the pair's bytes
    whole: np.ndarray  # hashes of whole tokens, sorted
    whole_id: np.ndarray
    single: np.ndarray  # id of each byte
    classes: np.ndarray


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """64 bits of data[start:end] each."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(mix(np.arange(256) + 1)[data] * up[:len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def vocabulary(path: str) -> Vocabulary:
    """The ranks in a file of lines `base64 rank`. Read on the driver only."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    missing = [i for i in range(256) if bytes([i]) not in ranks]
    if missing or sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("a byte-level vocabulary has every byte, and ranks from 0 on")
    tokens = sorted(ranks, key=ranks.get)
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left << 32 | right] = rank
    pair = np.array(sorted(pairs), dtype=np.int64)
    data = np.frombuffer(b"".join(tokens), dtype=np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
    whole = _hashes(data, bounds[:-1], bounds[1:], powers(_BASE, len(data)), powers(inverse(_BASE), len(data)))
    order = np.argsort(whole)
    return Vocabulary(data, bounds, pair, np.array([pairs[int(p)] for p in pair], dtype=np.int32), whole[order], order.astype(np.int32),
                      np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32), classes())


def merge_vocabulary(path: str) -> Vocabulary:
    """A byte-level vocabulary with a list of merges, in a JSON file of the `tokenizers` library. Read on the driver only.

    Only listed pairs merge, in the order of the list, and a slice that is a token is merged like any other.
    """
    import json

    from tokenizers import pre_tokenizers

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    # Bytes stand for themselves where they print in Latin-1, the others for characters from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    ids = model["vocab"]
    tokens = [b""] * (max(ids.values()) + 1)
    for token, i in ids.items():
        tokens[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    merged = [ids[a + b] for a, b in merges]
    if any(x >= y for x, y in zip(merged, merged[1:], strict=False)):
        raise ValueError("merges and their tokens are expected in one order")
    pairs = {ids[a] << 32 | ids[b]: m for (a, b), m in zip(merges, merged, strict=True)}
    pair = np.array(sorted(pairs), dtype=np.int64)
    by_char = {b: ids[c] for c, b in byte_of.items()}
    known = classes()
    cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    asked = np.flatnonzero((known == _LETTER) | (known == _NUMBER) | (known == _WHITE))
    which = np.full(len(asked), _WHITE, dtype=np.uint8)
    for mark, of in (("a", _LETTER), ("1", _NUMBER), ("!", _OTHER)):  # what follows a mark of its class without a cut
        starts = np.zeros(2 * len(asked) + 1, dtype=bool)
        starts[[at[0] for _, at in cut("".join(mark + chr(c) for c in asked))]] = True
        which[~starts[1::2]] = of
    known[asked] = which
    return Vocabulary(np.frombuffer(b"".join(tokens), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in tokens])]), pair,
                      np.array([pairs[int(p)] for p in pair], dtype=np.int32), np.zeros(0, np.uint64), np.zeros(0, np.int32),
                      np.array([by_char[i] for i in range(256)], dtype=np.int32), known)


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the sorted keys, whether it is there) of each wanted."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Merger:
    """Merges the bytes of slices: always the pair of lowest rank, the first of equal ones."""

    def __init__(self, vocabulary: Vocabulary):
        self.of, self._by_pair = vocabulary, None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        at, there = _found(self.of.pair, left.astype(np.int64) << 32 | right)
        return np.where(there, self.of.merged[at], _NONE)

    def one(self, symbols: list[int]) -> list[int]:
        """A single long slice, by a heap over a linked list."""
        if self._by_pair is None:
            self._by_pair = dict(zip(self.of.pair.tolist(), self.of.merged.tolist(), strict=True))
        rank_of, n = self._by_pair.get, len(symbols)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i) for i in range(n - 1) if (r := rank_of(symbols[i] << 32 | symbols[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or rank_of(symbols[i] << 32 | symbols[j]) != r:
                continue
            symbols[i], alive[j], after[i] = r, False, after[j]
            if after[j] < n:
                before[after[j]] = i
                if (new := rank_of(r << 32 | symbols[after[j]])) is not None:
                    heapq.heappush(heap, (new, i))
            if before[i] >= 0 and (new := rank_of(symbols[before[i]] << 32 | r)) is not None:
                heapq.heappush(heap, (new, before[i]))
        return [s for s, a in zip(symbols, alive, strict=True) if a]

    def many(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each) of slices of `sizes` symbols, all at once: one merge in each slice per round."""
        n = len(sizes)
        own = np.repeat(np.arange(n), sizes)
        rank = np.full(len(symbols), _NONE)
        inner = np.flatnonzero(own[1:] == own[:-1])
        rank[inner] = self.rank(symbols[inner], symbols[inner + 1])
        done = []
        while len(symbols):
            first = np.flatnonzero(np.diff(own, prepend=-1))
            sizes = np.diff(first, append=len(own))
            best = np.repeat(np.minimum.reduceat(rank, first), sizes)
            ready = best == _NONE
            if ready.any():
                done.append((own[ready], symbols[ready]))
                own, symbols, rank, best = own[~ready], symbols[~ready], rank[~ready], best[~ready]
                if not len(own):
                    break
            hits = np.flatnonzero(rank == best)
            hits = hits[np.diff(own[hits], prepend=-1) != 0]
            symbols[hits] = rank[hits]
            kept = np.ones(len(own), dtype=bool)
            kept[hits + 1] = False
            own, symbols, rank = own[kept], symbols[kept], rank[kept]
            at = hits - np.arange(len(hits))
            changed = np.unique(np.concatenate([at, at[at > 0] - 1]))
            inner = changed[changed < len(own) - 1]
            rank[changed] = _NONE
            inner = inner[own[inner] == own[inner + 1]]
            rank[inner] = self.rank(symbols[inner], symbols[inner + 1])
        if not done:
            return np.zeros(0, dtype=np.int32), np.zeros(n, dtype=np.int64)
        own = np.concatenate([d[0] for d in done])
        order = np.argsort(own, kind="stable")
        return np.concatenate([d[1] for d in done])[order], np.bincount(own, minlength=n)


def expanded(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... count[0] of them, then those of start[1], and so on."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + count, count)


class Encoder:
    """Texts to ids. What a slice becomes is kept by its hash, so that a frequent slice is merged once a task."""

    def __init__(self, vocabulary: Vocabulary, automaton: Automaton):
        self.of, self.merger = vocabulary, Merger(vocabulary)
        self.pre = PreTokenizer(vocabulary.classes, automaton)
        self.up = self.down = np.zeros(0, dtype=np.uint64)
        self._forget()

    def _forget(self) -> None:
        self.key, self.where, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, dtype=np.int32)

    def _learn(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        at, whole = _found(self.of.whole, hashes)
        ids, count = [self.of.whole_id[at[whole]]], np.ones(len(hashes), dtype=np.int64)
        long = ~whole & (end - start > LONG)
        short = np.flatnonzero(~whole & ~long)
        sizes = (end - start)[short]
        merged, count[short] = self.merger.many(self.of.single[data[expanded(start[short], sizes)]], sizes)
        ids.append(merged)
        for i in np.flatnonzero(long):
            one = self.merger.one(self.of.single[data[start[i]:end[i]]].tolist())
            ids.append(np.array(one, dtype=np.int32))
            count[i] = len(one)
        order = np.concatenate([np.flatnonzero(whole), short, np.flatnonzero(long)])
        where = np.zeros(len(hashes), dtype=np.int64)
        where[order] = len(self.ids) + np.cumsum(count[order]) - count[order]
        self.ids = np.concatenate([self.ids, *ids])
        key = np.concatenate([self.key, hashes])
        by_key = np.argsort(key, kind="stable")
        self.key, self.where, self.count = key[by_key], np.concatenate([self.where, where])[by_key], np.concatenate([self.count, count])[by_key]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, last byte + 1 of every id in data, ids bounds[i] ... bounds[i+1]-1 belong to text i)."""
        if len(self.up) < len(data):
            self.up, self.down = powers(_BASE, 2 * len(data)), powers(inverse(_BASE), 2 * len(data))
        start = self.pre.starts(data, offsets)
        end = np.append(start[1:], len(data)) if len(start) else start
        each, first, of = np.unique(_hashes(data, start, end, self.up, self.down), return_index=True, return_inverse=True)
        at, known = _found(self.key, each)
        if not known.all():
            if len(self.key) > CACHED:
                self._forget()
                known[:] = False
            new = first[~known]
            self._learn(each[~known], data, start[new], end[new])
            at, _ = _found(self.key, each)
        at = at[of]
        count = self.count[at]
        ids = self.ids[expanded(self.where[at], count)]
        total = np.concatenate([[0], np.cumsum(count)])
        width = self.of.bounds[ids + 1] - self.of.bounds[ids]
        return ids, np.cumsum(width), total[np.searchsorted(start, offsets)]


def _valid(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same texts in valid UTF-8: what is not becomes U+FFFD."""
    try:
        data.tobytes().decode()
        return data, offsets
    except UnicodeDecodeError:
        whole = [data[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(offsets, offsets[1:], strict=False)]
        return np.frombuffer(b"".join(whole), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(w) for w in whole])])


def encode(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, ends) for each row of `docs`: the ids of its whole text, and the byte behind each in the text's UTF-8.

    NULL and empty texts have no ids, bytes that are no UTF-8 count as U+FFFD, NULL keys stay NULL,
    repeated rows stay, an empty table gives no rows. Only `key` and `text` are read. Rows stay in
    their tasks; the vocabulary is broadcast (6 MB for 50,000 tokens, whatever the texts). A text is never
    cut; one of n bytes takes some 150 n bytes of its task.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((vocabulary, automaton()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*shared.value)
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(1)):
                data, offsets = _valid(data, offsets)
                ids, ends, bounds = encoder.encode(data, offsets)
                ends = ends - np.repeat(offsets[:-1], np.diff(bounds))
                lists = [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(v.astype(np.int32))) for v in (ids, ends)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *lists], names=[key, "ids", "ends"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).cast("string").alias("_text")).mapInArrow(run, f"`{key}` {kind}, ids array<int>, ends array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """`encoded` (ids, ends) with `bytes`: the tokens' bytes, each written where its offset says.

    Rows without ids give no bytes. An id that isn't in the vocabulary, or offsets that are not
    those of the tokens, fail the job.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("binary")
    def run(ids: pa.Array, ends: pa.Array) -> pa.Array:
        of = shared.value
        bounds = np.asarray(ids.offsets)
        own, end = ids.flatten().to_numpy(), ends.flatten().to_numpy()
        width = of.bounds[own + 1] - of.bounds[own]
        first = np.zeros(len(own), dtype=bool)
        first[bounds[:-1][np.diff(bounds) > 0] - bounds[0]] = True
        begins = np.where(first, 0, np.concatenate([[0], end[:-1]])[:len(own)])
        if not np.array_equal(end - begins, width):
            raise ValueError("offsets are not those of the tokens")
        data = of.bytes[expanded(of.bounds[own], width)]
        places = np.concatenate([[0], np.cumsum(width)])[bounds - bounds[0]]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())

    return encoded.withColumn("bytes", run("ids", "ends"))


def public_vocabulary(name: str = VOCABULARY) -> Vocabulary:
    import public_tokenizers

    return vocabulary(public_tokenizers.path(name))


@query("op12_byte_bpe")
def op12(spark, sf_dir):
    """Digests of every document's ids and of the bytes that they decode to."""
    own = public_vocabulary()
    found = decode(encode(table(spark, sf_dir, "documents"), own), own)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"),
                        F.sha2("bytes", 256).alias("decoded_sha256"))
