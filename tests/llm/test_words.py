import random

import numpy as np
import pyarrow as pa

from newsloom.llm.words import PUNCTUATION, WHITE_SPACE, Runs, Splitter, pieces


def test_words_equal_python_split():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é\n\t \x0b") for _ in range(rng.randint(0, 30))) for _ in range(300)] + [None, "", "x" * 5000]
    seen = {}
    for limit in (1, 50, 1 << 20):
        for lo, hi, data, offsets in pieces(pa.array(texts), limit):
            words = Splitter().split(data, offsets)
            for i in range(hi - lo):
                own = range(words.bounds[i], words.bounds[i + 1])
                got = [bytes(data[words.start[j]:words.end[j]]) for j in own]
                assert got == (texts[lo + i] or "").encode().split()
                for w, j in zip(got, own, strict=True):
                    assert seen.setdefault(w, words.hash[j]) == words.hash[j]
    assert len(set(seen.values())) == len(seen)


def test_case_and_separators():
    (_, _, data, offsets), = pieces(pa.array(["Ab-C ab. c"]))
    words = Splitter(WHITE_SPACE + PUNCTUATION, lower=True).split(data, offsets)
    assert words.hash[0] == words.hash[2] and words.hash[1] == words.hash[3]


def test_runs_and_runs_without_a_word():
    h = np.arange(1, 9, dtype=np.uint64) * np.uint64(7919)
    runs = Runs(np.concatenate([h, h]))
    a, b = runs.of(np.array([0, 8]), np.array([8, 16]))
    assert a == b
    whole = Runs(np.concatenate([h[:3], h[4:]]))
    assert runs.without(np.array([8]), np.array([16]), np.array([11]))[0] == whole.of(np.array([0]), np.array([7]))[0]
