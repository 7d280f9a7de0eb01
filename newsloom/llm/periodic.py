"""Periodic runs (operator 11): a suffix automaton whose link paths are recoloured as words are appended.

The suffix links of the automaton form a tree; the path from a prefix to the root holds all suffixes
of the prefix. Every node has the end of its last occurrence as colour. Appending a word recolours
the path of the new prefix (the `access` of a link-cut tree): the segments of equal colour on it are
met, from the deepest up, and become one. A segment of colour e that holds the lengths lo+1 ... hi says
that the new prefix (end i) and that of end e agree on hi words and on no nearer end; if d = i - e lies
in lo+1 ... hi, a square of period d ends here, and the words of period d reach back to i - hi - d.
Preferred paths are kept as stacks of segments on the heavy chains of the finished tree instead of
in splay trees: the same segments, and O(log n) of them for an appended word on average.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.registry import query, table
from newsloom.llm.words import Runs, Splitter, counted, mix, pieces

#: Runs are reported from so many words on, and from so many repetitions on.
MIN_WORDS, MIN_REPEATS = 6, 4


class SuffixAutomaton:
    """States by number: `length` of the longest word sequence, suffix `link`; `prefix[i]` is the state of the first i+1 words."""

    def __init__(self, words: list[int]):
        length, link, word, to, more = [0], [-1], [-1], [0], {}
        prefix, last = [], 0
        # Most states have one transition; only the others have a table.
        for w in words:
            new, p, q = len(length), last, -1
            length.append(length[last] + 1)
            link.append(0)
            word.append(-1)
            to.append(0)
            while p != -1:
                if word[p] == w:
                    q = to[p]
                    break
                if word[p] == -1:
                    word[p], to[p] = w, new
                else:
                    others = more.get(p)
                    if others is None:
                        more[p] = {w: new}
                    elif w in others:
                        q = others[w]
                        break
                    else:
                        others[w] = new
                p = link[p]
            if q != -1:
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    copy = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    word.append(word[q])
                    to.append(to[q])
                    if q in more:
                        more[copy] = dict(more[q])
                    while p != -1:
                        if word[p] == w:
                            if to[p] != q:
                                break
                            to[p] = copy
                        else:
                            others = more.get(p)
                            if others is None or others.get(w) != q:
                                break
                            others[w] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            prefix.append(new)
            last = new
        self.length, self.link, self.prefix = length, link, prefix

    def heads(self) -> list[int]:
        """The topmost state of each state's heavy chain; the root is in none."""
        order = np.argsort(np.array(self.length), kind="stable").tolist()
        link, n = self.link, len(order)
        size, heavy, best = [1] * n, [-1] * n, [0] * n
        for v in reversed(order[1:]):
            up, own = link[v], size[v]
            size[up] += own
            if own > best[up]:
                best[up], heavy[up] = own, v
        head = list(range(n))
        for v in order[1:]:
            if link[v] and heavy[link[v]] == v:
                head[v] = head[link[v]]
        return head


def squares(words: list[int]) -> dict[tuple[int, int], int]:
    """{(start, period): end} of all maximal runs of at least two repetitions of `words`; `period` is the smallest."""
    automaton = SuffixAutomaton(words)
    length, link, head = automaton.length, automaton.link, automaton.heads()
    # Of each chain: (longest length, colour) of its segments, the topmost one last.
    chains: dict[int, list[tuple[int, int]]] = {}
    found: dict[tuple[int, int], int] = {}
    for i, v in enumerate(automaton.prefix, 1):
        colour = deepest = -1
        while v:
            top, h = length[v], head[v]
            up = link[h]
            lo = length[up]
            segments = chains.get(h)
            if segments is None:
                chains[h] = [(top, i)]
            else:
                met = []
                while segments and segments[-1][0] <= top:
                    hi, e = segments.pop()
                    met.append((lo, hi, e))
                    lo = hi
                if segments and lo < top:
                    met.append((lo, top, segments[-1][1]))
                segments.append((top, i))
                for low, hi, e in reversed(met):
                    if e != colour:
                        colour, deepest = e, hi
                    if low < i - e <= hi:
                        found[i - deepest - i + e, i - e] = i
            v = up
    return found


def stretches(hashes: np.ndarray, bounds: np.ndarray, min_words: int = MIN_WORDS, repeats: int = MIN_REPEATS) -> tuple[np.ndarray, np.ndarray]:
    """(first word, word behind the last) of the stretches of texts that may hold a run; no run reaches beyond one.

    In a run of at least `repeats` periods (and six words) every three words in a row occur as often as
    `repeats` - 1 times and again within a `repeats`-th of the stretch. What is left by that is asked again,
    until nothing changes.
    """
    n = len(hashes)
    least = max(min_words, 3)
    lo, hi = bounds[:-1], bounds[1:]
    size = hi - lo
    lo, hi = lo[size >= least], hi[size >= least]
    times = max(repeats - 1, 2)
    # A run may be too short for so many triples: 4 words of period 2 hold two.
    times = min(times, max(min_words - 2, 1))
    threes = Runs(hashes)
    while len(lo):
        own, place = counted(np.concatenate([[0], np.cumsum(hi - lo - 2)]))
        at = lo[own] + place
        key = mix(threes.of(at, at + 3) ^ mix(own.astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key, kind="stable")
        key, sorted_at = key[order], at[order]
        same = np.concatenate([[False], key[1:] == key[:-1]])
        first = np.flatnonzero(~same)
        count = np.repeat(np.diff(first, append=len(key)), np.diff(first, append=len(key)))
        gap = np.full(len(key) + 1, n + 1)
        gap[1:-1] = np.where(same[1:], sorted_at[1:] - sorted_at[:-1], n + 1)
        near = np.minimum(gap[:-1], gap[1:]) <= ((hi - lo) // repeats)[own[order]]
        good = np.zeros(len(at), dtype=bool)
        good[order] = (count >= times) & near
        inside = np.zeros(n + 1, dtype=np.int32)
        np.add.at(inside, at[good], 1)
        np.add.at(inside, at[good] + 3, -1)
        covered = np.cumsum(inside) > 0
        # A stretch never grows beyond the one that it is part of, nor joins the next.
        edge = np.zeros(n + 1, dtype=bool)
        edge[lo] = True
        opens = np.flatnonzero(covered[:n] & (edge[:n] | ~np.concatenate([[False], covered[:n - 1]])))
        closes = np.flatnonzero(covered[:n] & (edge[1:] | ~covered[1:])) + 1
        long = closes - opens >= least
        if np.array_equal(opens[long], lo) and np.array_equal(closes[long], hi):
            break
        lo, hi = opens[long], closes[long]
    return lo, hi


def runs_of(hashes: np.ndarray, bounds: np.ndarray, min_words: int = MIN_WORDS, repeats: int = MIN_REPEATS) -> tuple[np.ndarray, np.ndarray]:
    """(text, (start, length, period)) of all runs of at least `min_words` words and `repeats` periods in texts of word hashes, in order."""
    rows = []
    lo, hi = stretches(hashes, bounds, min_words, repeats)
    text = np.searchsorted(bounds, lo, side="right") - 1
    for a, b, t in zip(lo.tolist(), hi.tolist(), text.tolist(), strict=True):
        _, words = np.unique(hashes[a:b], return_inverse=True)
        base = a - int(bounds[t])
        rows += [(t, base + start, end - start, period) for (start, period), end in squares(words.tolist()).items()
                 if end - start >= max(min_words, repeats * period)]
    rows.sort(key=lambda r: (r[0], r[1], r[3]))
    found = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return found[:, 0], found[:, 1:]


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, repeats: int = MIN_REPEATS) -> DataFrame:
    """(key, n_words, runs, collapsed) for each row of `docs`: the runs of words of its whole text, in order of start and
    period, each once; and its words, joined by one blank, without those that a run repeats.

    A run is a stretch of words with smallest period q (words q apart are identical), of at least
    `min_words` words and `repeats` (at least 4) times q, that no neighbouring word extends; a word goes if it
    is in a run behind that run's first q words. NULL and empty texts have no words and no runs, NULL keys stay NULL, repeated rows
    stay, an empty table gives no rows; only `key` and `text` are read. Rows stay in their tasks.
    The automaton is only built over stretches that may hold a run; it takes about half a kilobyte of its task for
    each word of the longest of them.
    """
    if repeats < 4 or min_words < 6:
        raise ValueError("stretches are cut for runs of at least 6 words and 4 periods")
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter()
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(1)):
                words = splitter.split(data, offsets)
                where, found = runs_of(words.hash, words.bounds, min_words, repeats)
                at = np.searchsorted(where, np.arange(hi - lo + 1))
                raw, left = data.tobytes(), []
                for i in range(hi - lo):
                    own = raw[offsets[i]:offsets[i + 1]].split()
                    if at[i] < at[i + 1]:
                        kept = np.ones(len(own), dtype=bool)
                        for start, length, period in found[at[i]:at[i + 1]]:
                            kept[start + period:start + length] = False
                        own = [own[j] for j in np.flatnonzero(kept)]
                    left.append(b" ".join(own))
                structs = pa.StructArray.from_arrays([pa.array(found[:, j]) for j in range(3)], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(words.bounds)),
                     pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), structs), pa.array(left, pa.binary()).cast(pa.string(), safe=False)],
                    names=[key, "n_words", "runs", "collapsed"])

    return docs.select(key, F.col(text).cast("string").alias("_text")).mapInArrow(
        run, f"`{key}` {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def with_repeated_tails(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with the texts of one document in ten (by the CRC-32 of its key) repeated from some word on.

    With h the CRC-32 of the key in decimal and g = h // 10, the texts of n > 0 words with h % 10 = 0 become, from
    word a = g % n on, repetitions of the p = 1 + (n - a) // (3 + g % 8) words there. Other texts, and those of
    NULL keys, stay as they are.
    """
    @F.arrow_udf("string")
    def repeated(hashes: pa.Array, texts: pa.Array) -> pa.Array:
        out = []
        for h, value in zip(hashes.to_pylist(), texts.cast(pa.large_binary()), strict=True):
            raw = value.as_py() or b""
            words = raw.split()
            n, g = len(words), h // 10
            a = g % max(n, 1)
            p = 1 + (n - a) // (3 + g % 8)
            words[a:] = [words[a + (i - a) % p] for i in range(a, n)]
            out.append(b" ".join(words))
        return pa.array(out, pa.binary()).cast(pa.string(), safe=False)

    h = F.crc32(F.col(key).cast("string").cast("binary"))
    # Only the chosen texts are sent to Python.
    chosen = F.when(h % 10 == 0, F.col(text))
    return docs.withColumn("_tail", repeated(F.coalesce(h, F.lit(1)), chosen)).withColumn(
        text, F.when((h % 10 == 0) & F.col(text).isNotNull(), F.col("_tail")).otherwise(F.col(text))).drop("_tail")


@query("op11_periodic_runs")
def op11(spark, sf_dir):
    """Runs of every document's words, the longest of them, and digests of all and of the text without repetitions."""
    own = with_repeated_tails(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs(own)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    return found.withColumn("top", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"), F.floor(1000 * F.col("top.length") / -F.col("top.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
