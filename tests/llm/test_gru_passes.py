"""Operator 7's recurrent model: bounded arrays, and sums that equal plain loops."""

import pickle

import numpy as np

from newsloom.llm.gru import CLASS_SIZE, GRU
from newsloom.llm.scoring import Places


def some_net():
    net = GRU(70, 3, 0, hidden=5, seed=2)
    for p in net.parts[:3]:
        p *= 3
    return net


def plain_score(net, text):
    """One token at a time, in double precision."""
    w = [p.astype(np.float64) for p in net.parts]
    n, h, before, total = net.hidden, np.zeros(net.hidden), net.begin, 0.0
    for token in text:
        x, u = w[0][before], h @ w[1]
        z, r = np.split(1 / (1 + np.exp(-(x[:2 * n] + u[:2 * n]))), 2)
        c = np.tanh(x[2 * n:] + r * u[2 * n:])
        h = c + z * (h - c)
        logits = h @ w[2] + w[3]
        k = token // CLASS_SIZE if token < net.n_words else token - net.n_words + net.n_classes
        total += logits[k] - np.log(np.exp(logits).sum())
        if token < net.n_words:
            logits = h @ w[4][k] + w[5][k]
            total += logits[token % CLASS_SIZE] - np.log(np.exp(logits).sum())
        before = token
    return total


def test_scores_equal_a_plain_loop_and_arrays_stay_small(monkeypatch):
    net, rng, held = some_net(), np.random.default_rng(5), []
    texts = [rng.integers(0, 73, n) for n in rng.integers(1, 90, 1_300)]
    monkeypatch.setattr(net, "log_probability", lambda h, tokens, plain=net.log_probability: held.append(len(h)) or plain(h, tokens))
    found = net.score(texts)
    assert max(held) <= 4_096 and sum(held) == sum(map(len, texts))
    for i in [0, 1, 511, 512, 1_299, int(np.argmax([len(t) for t in texts]))]:
        assert abs(found[i] - plain_score(net, texts[i])) < 1e-3
    assert len(net.score([])) == 0


def test_kept_arrays_leave_no_trace_in_the_next_window():
    net, rng, room = some_net(), np.random.default_rng(6), {}
    for steps, streams in ((6, 4), (6, 4), (3, 4), (6, 2)):
        tokens, targets = rng.integers(0, 73, (2, steps, streams))
        tokens[:, 0] = 7  # one id many times
        h = rng.normal(0, 0.5, (streams, 5)).astype(np.float32)
        fresh, kept = net._gradients(tokens, targets, h), net._gradients(tokens, targets, h, room=room)
        for a, b in zip(fresh[0], kept[0], strict=True):
            assert np.array_equal(a, b)
        assert np.array_equal(fresh[1], kept[1]) and fresh[2] == kept[2]
        alone = sum(net._gradients(tokens[:, s:s + 1], targets[:, s:s + 1], h[s:s + 1])[0][0] for s in range(streams)) / streams
        assert np.allclose(fresh[0][0], alone, atol=1e-6)


def test_places_are_those_of_a_search():
    rng = np.random.default_rng(8)
    keys = np.unique(rng.integers(0, 1 << 63, 3_000, dtype=np.uint64) * np.uint64(2))
    crowded = np.unique(np.concatenate([keys[:50], np.arange(200, dtype=np.uint64), np.uint64((1 << 64) - 1) - np.arange(90, dtype=np.uint64)]))
    for own in (keys, crowded, keys[:1], keys[:0]):
        asked = np.concatenate([own, own + np.uint64(1), rng.integers(0, 1 << 63, 500, dtype=np.uint64), np.array([0, (1 << 64) - 1], dtype=np.uint64)])
        places = pickle.loads(pickle.dumps(Places(own)))
        at, there = places.find(asked)
        assert np.array_equal(there, np.isin(asked, own))
        assert np.array_equal(own[at[there]], asked[there])
