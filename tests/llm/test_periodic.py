"""Periodic runs against a plain search for them."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from newsloom.llm.all_queries import QUERIES
from newsloom.llm.periodic import SuffixAutomaton, periodic_runs, runs_of, squares, stretches

SF = "/root/testdata/sf0.001"


def plain_runs(words, least=2):
    """(start, length, period) of all maximal runs of `least` periods or more, by the definition."""
    n, found = len(words), set()
    for period in range(1, n // 2 + 1):
        i = 0
        while i + period < n:
            if words[i] != words[i + period]:
                i += 1
                continue
            j = i
            while j + period < n and words[j] == words[j + period]:
                j += 1
            length = j + period - i
            if length >= least * period and not any(s <= i and i + length <= s + m for s, m, q in found if period % q == 0 and q < period):
                found.add((i, length, period))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def sequences(seed=1):
    rng = random.Random(seed)
    for n in range(60):
        yield [rng.randrange(1 + n % 4) for _ in range(rng.randint(0, 60))]
    for _ in range(40):
        words = [rng.randrange(50) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(1, 4)):
            part = [rng.randrange(rng.randint(1, 9)) for _ in range(rng.randint(1, 9))]
            words += (part * rng.randint(2, 9))[:rng.randint(4, 50)] + [rng.randrange(50) for _ in range(rng.randint(0, 6))]
        yield words
    fib = ([0], [0, 1])
    while len(fib[1]) < 150:
        fib = (fib[1], fib[1] + fib[0])
    yield fib[1]
    yield [bin(i).count("1") % 2 for i in range(128)]  # no cubes
    yield [0] * 100


def test_all_squares_are_found_and_grown_to_runs():
    for words in sequences():
        got = sorted(((s, e - s, p) for (s, p), e in squares(words).items()), key=lambda r: (r[0], r[2]))
        assert got == plain_runs(words)


def test_automaton_has_a_state_for_every_set_of_ends():
    for words in sequences(2):
        ends = {}
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                ends.setdefault(tuple(words[i:j]), set()).add(j)
        assert len(SuffixAutomaton(words).length) == 1 + len({frozenset(e) for e in ends.values()})


def test_runs_of_many_texts_at_once():
    texts = list(sequences(3)) * 2 + [[7] * 6, [7] * 5, [1, 2] * 4, [1, 2] * 3 + [1], [1, 2, 3] * 4, [1, 2, 3] * 4 + [1]]
    bounds = np.cumsum([0, *map(len, texts)])
    hashes = np.array([w * 0x9E3779B9 + 12345 for t in texts for w in t], dtype=np.uint64)
    text, found = runs_of(hashes, bounds)
    want = [(i, *r) for i, t in enumerate(texts) for r in plain_runs(t, 4) if r[1] >= 6]
    assert [(int(t), *r) for t, r in zip(text, found.tolist(), strict=True)] == want and len(want) > 80
    lo, hi = stretches(hashes, bounds)
    assert (hi - lo).sum() < len(hashes)


def report(key, text, plant=True):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(key).encode()), len(words)
    if plant and key is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = [r for r in plain_runs(words, 4) if r[1] >= 6]
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None,) * 3
    digests = [hashlib.sha256(b).hexdigest() for b in (
        "".join(f"{s},{m},{q}\n" for s, m, q in runs).encode(), b" ".join(w for i, w in enumerate(words) if i not in gone))]
    return (key, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *digests)


def test_odd_rows(spark, documents):
    long = "a b c " * 4000
    rows = [(1, "x " * 7, "en", "s"), (1, "x " * 7, "en", "s"), (2, "", "en", "s"), (3, None, None, None), (None, "a b\x0ba\tb\na b a b", "en", "s"),
            (4, " \n ", "en", "s"), (5, long, "en", "s"), (6, "é à " * 5 + "é", "fr", "s")]
    docs = documents(rows, extra=["runs", "n_words", "collapsed"])
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic_runs(docs).collect())
    assert got == Counter([
        (1, 7, ((0, 7, 1),), "x"), (1, 7, ((0, 7, 1),), "x"), (2, 0, (), ""), (3, 0, (), ""), (None, 8, ((0, 8, 2),), "a b"), (4, 0, (), ""),
        (5, 12_000, ((0, 12_000, 3),), "a b c"), (6, 11, ((0, 11, 2),), "é à")])
    assert periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(docs, repeats=2)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    short = [d for d in docs if len(d.text or "") < 6000]
    assert sum(got[d.doc_id][1] > 0 for d in short) > 8
    for d in short:
        assert got[d.doc_id] == report(d.doc_id, d.text)
