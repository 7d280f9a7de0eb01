"""A gated recurrent language model in numpy, with a class-factored output and carried state."""

from __future__ import annotations

import numpy as np

#: Words a class has; the output is first a class, then a word of it. Classes of single tokens follow.
CLASS_SIZE = 32
#: Texts that are scored side by side: what a step touches stays in the processor's cache.
SIDE_BY_SIDE = 512


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class GRU:
    """Tokens 0 ... n_words-1 are words, grouped into classes of CLASS_SIZE; the following n_single
    tokens are classes of their own (unknown words). The input of a text's first token is `begin`."""

    def __init__(self, n_words: int, n_single: int, begin: int, hidden: int = 24, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.n_words, self.n_single, self.begin, self.hidden = n_words, n_single, begin, hidden
        self.n_classes = -(-n_words // CLASS_SIZE)

        def some(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        h = hidden
        self.inputs = some(n_words + n_single, 3 * h, scale=0.2)  # embeddings, already projected to the gates
        self.inputs[:, :h] += 0.5
        self.recurrent = some(h, 3 * h, scale=h**-0.5)
        self.to_class = some(h, self.n_classes + n_single, scale=0.1)
        self.class_bias = np.zeros(self.n_classes + n_single, np.float32)
        self.to_word = some(self.n_classes, h, CLASS_SIZE, scale=0.1)
        self.word_bias = np.zeros((self.n_classes, CLASS_SIZE), np.float32)
        # The last class may have fewer words than places.
        spare = np.arange(self.n_classes * CLASS_SIZE).reshape(self.n_classes, CLASS_SIZE) >= n_words
        self.word_bias[spare] = -1e4

    @property
    def parts(self) -> list[np.ndarray]:
        return [self.inputs, self.recurrent, self.to_class, self.class_bias, self.to_word, self.word_bias]

    def start_from(self, counts: np.ndarray) -> None:
        """Biases from token counts, so training starts at the unigram distribution."""
        words = np.full(self.n_classes * CLASS_SIZE, 1e-4)
        words[:self.n_words] = counts[:self.n_words] + 0.5
        words = words.reshape(self.n_classes, CLASS_SIZE)
        self.word_bias[:] = np.log(words / words.sum(axis=1, keepdims=True))
        self.word_bias[words < 1e-3] = -1e4
        mass = np.concatenate([words.sum(axis=1), counts[self.n_words:] + 0.5])
        self.class_bias[:] = np.log(mass / mass.sum())

    def _class_of(self, tokens: np.ndarray) -> np.ndarray:
        return np.where(tokens < self.n_words, tokens // CLASS_SIZE, tokens - self.n_words + self.n_classes)

    def _run(self, x: np.ndarray, h: np.ndarray, states: np.ndarray, kept: tuple | None = None) -> None:
        """States (time, number, stream) behind `x` of `_gate_inputs` and the state `h` (number, stream);
        `kept` takes z and r, the candidate, and what r holds back."""
        n, width = self.hidden, x.shape[2]
        u, zr, c, d = (np.empty((k * n, width), np.float32) for k in (3, 2, 1, 1))
        recurrent = np.ascontiguousarray(self.recurrent.T)
        recurrent[:2 * n] *= 0.5  # a sigmoid is a hyperbolic tangent of half its argument
        for t in range(len(x)):
            if kept is not None:
                zr, c, u = kept[0][t], kept[1][t], kept[2][t]
            np.matmul(recurrent, h, out=u)
            np.add(x[t, :2 * n], u[:2 * n], out=zr)
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            np.multiply(zr[n:], u[2 * n:], out=c)
            c += x[t, 2 * n:]
            np.tanh(c, out=c)
            np.subtract(h, c, out=d)
            d *= zr[:n]
            h = np.add(c, d, out=states[t])

    def step(self, tokens: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        """States (stream, number) behind one more token each, and what a gradient needs: z, r, the candidate, what r holds back."""
        n, streams = self.hidden, len(tokens)
        states, zr, c, u = (np.empty((1, k * n, streams), np.float32) for k in (1, 2, 1, 3))
        self._run(self._gate_inputs(tokens[None]), np.ascontiguousarray(h.T), states, (zr, c, u))
        return states[0].T, (zr[0, :n].T, zr[0, n:].T, c[0].T, u[0, 2 * n:].T)

    def _gate_inputs(self, tokens: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
        """(time, gate, stream) of tokens (time, stream); those of z and r are halved."""
        out = np.empty((len(tokens), 3 * self.hidden, tokens.shape[1]), np.float32) if out is None else out
        out[:] = self.inputs[tokens].transpose(0, 2, 1)
        out[:, :2 * self.hidden] *= 0.5
        return out

    def _by_class(self, cls: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Places of words (not of single tokens) by class, and (class, from, to) of each class that has any."""
        order = np.argsort(cls.astype(np.int16), kind="stable")
        edges = np.searchsorted(cls[order], np.arange(self.n_classes + 1))
        return order[:edges[-1]], [(k, int(a), int(b)) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if a < b]

    def _class_shares(self, h: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """exp(logit - largest) of all classes (class, row), and the log of each row's own share."""
        p = self.to_class.T @ h.T
        p += self.class_bias[:, None]
        p -= p.max(axis=0)
        own = p[cls, np.arange(len(cls))]
        np.exp(p, out=p)
        total = p.sum(axis=0)
        p /= total
        return p, own - np.log(total)

    def _word_shares(self, h: np.ndarray, cls: np.ndarray, place: np.ndarray, runs: list) -> tuple[np.ndarray, np.ndarray]:
        """Shares of the words in the class of each row (row, word), rows in the order of classes, and the log of each row's own."""
        q = np.empty((len(h), CLASS_SIZE), np.float32)
        for k, a, b in runs:
            np.matmul(h[a:b], self.to_word[k], out=q[a:b])
        q += self.word_bias[cls]
        q -= q.max(axis=1, keepdims=True)
        own = q[np.arange(len(q)), place]
        np.exp(q, out=q)
        total = q @ np.ones(CLASS_SIZE, np.float32)
        q /= total[:, None]
        return q, own - np.log(total)

    def log_probability(self, h: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each token after each state."""
        cls = self._class_of(tokens)
        out = self._class_shares(h, cls)[1]
        order, runs = self._by_class(cls)
        if runs:
            out[order] += self._word_shares(h[order], cls[order], tokens[order] % CLASS_SIZE, runs)[1]
        return out

    def score(self, texts: list[np.ndarray], window: int = 64) -> np.ndarray:
        """Natural log of the probability of each whole text (ids with the end token).

        Texts advance side by side, longest first, some SIDE_BY_SIDE at a time; the state at the end of a
        window is carried into the next, so no text is cut.
        """
        out = np.zeros(len(texts))
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        for first in range(0, len(order), SIDE_BY_SIDE):
            some = order[first:first + SIDE_BY_SIDE]
            out[some] = self._score_together([texts[i] for i in some], window)
        return out

    def _score_together(self, texts: list[np.ndarray], window: int) -> np.ndarray:
        sizes = np.array([len(t) for t in texts])
        total = np.zeros(len(texts))
        flat = np.concatenate([np.append(t, 0) for t in texts]).astype(np.int64)
        begin = np.cumsum(sizes + 1) - sizes - 1
        h = np.zeros((self.hidden, len(texts)), np.float32)
        before = np.full(len(texts), self.begin)
        lo = 0
        while lo < sizes[0]:
            # Texts that end inside a window go on to its end on padding, which is not counted; few do, as they are in order of length.
            alive = int(np.searchsorted(-sizes, -lo, side="left"))
            steps = int(min(window, max(8, sizes[alive - 1] - lo), sizes[0] - lo))
            at = np.arange(lo, lo + steps)[:, None]
            targets = flat[np.minimum(begin[:alive] + at, len(flat) - 1)]
            inputs = np.concatenate([before[None, :alive], targets[:-1]])
            states = np.empty((steps, self.hidden, alive), np.float32)
            self._run(self._gate_inputs(inputs), np.ascontiguousarray(h[:, :alive]), states)
            h, before = states[-1], targets[-1]
            real = at < sizes[:alive]
            row = np.broadcast_to(np.arange(alive), real.shape)[real]
            found = np.empty(len(row))
            reached, tokens = states.transpose(0, 2, 1)[real], targets[real]
            for a in range(0, len(row), 8 * SIDE_BY_SIDE):
                b = a + 8 * SIDE_BY_SIDE
                found[a:b] = self.log_probability(reached[a:b], tokens[a:b])
            total[:alive] += np.bincount(row, found, alive)
            lo += steps
        return total

    def _gradients(self, tokens: np.ndarray, targets: np.ndarray, h: np.ndarray, grads: list[np.ndarray] | None = None,
                   room: dict | None = None) -> tuple[list[np.ndarray], np.ndarray, float]:
        """Gradients of the mean loss over a window (time, stream), the state behind it, the loss.

        `grads` are zeros to add to; `room` keeps arrays from one window to the next, as fresh memory costs more than the sums.
        """
        n, (steps, streams) = self.hidden, tokens.shape
        grads = [np.zeros_like(p) for p in self.parts] if grads is None else grads
        g_in, g_rec, g_class, g_cbias, g_word, g_wbias = grads
        room = {} if room is None else room

        def held(name: str, rows: int, times: int = steps) -> np.ndarray:
            if room.get(name) is None or room[name].shape != (times, rows, streams):
                room[name] = np.empty((times, rows, streams), np.float32)
            return room[name]

        states = held("states", n, steps + 1)
        states[0] = h.T
        zr, c, u = held("zr", 2 * n), held("c", n), held("u", 3 * n)
        self._run(self._gate_inputs(tokens, held("x", 3 * n)), states[0], states[1:], (zr, c, u))
        all_h, flat = states[1:].transpose(0, 2, 1).reshape(-1, n), targets.ravel()
        size = len(flat)
        cls = self._class_of(flat)
        p, logs = self._class_shares(all_h, cls)
        loss = -float(logs.sum())
        p[cls, np.arange(size)] -= 1
        p /= size
        g_class += (p @ all_h).T
        g_cbias += p.sum(axis=1)
        d_h = p.T @ self.to_class.T
        order, runs = self._by_class(cls)
        if runs:
            own_h, place = all_h[order], flat[order] % CLASS_SIZE
            q, logs = self._word_shares(own_h, cls[order], place, runs)
            loss -= float(logs.sum())
            q[np.arange(len(q)), place] -= 1
            q /= size
            back = np.empty_like(own_h)
            for k, a, b in runs:
                np.matmul(own_h[a:b].T, q[a:b], out=g_word[k])
                np.matmul(q[a:b], self.to_word[k].T, out=back[a:b])
            g_wbias[[k for k, _, _ in runs]] = np.add.reduceat(q, [a for _, a, _ in runs], axis=0)
            d_h[order] += back
        direct = held("direct", n)
        direct[:] = d_h.reshape(steps, streams, n).transpose(0, 2, 1)
        # What a state's gradient is multiplied by on its way to the gates, for all steps at once.
        z, r, before = zr[:, :n], zr[:, n:], states[:-1]
        to_c, to_z, to_r, rest = held("to_c", n), held("to_z", n), held("to_r", n), held("rest", n)
        np.subtract(1, z, out=rest)
        np.multiply(c, c, out=to_c)
        np.subtract(1, to_c, out=to_c)
        to_c *= rest
        np.subtract(before, c, out=to_z)
        to_z *= z
        to_z *= rest
        np.subtract(1, r, out=to_r)
        to_r *= r
        to_r *= u[:, 2 * n:]
        back = held("back", 3 * n)
        carried = np.zeros((n, streams), np.float32)
        for t in range(steps - 1, -1, -1):
            d = direct[t]
            d += carried
            d_c = np.multiply(d, to_c[t], out=to_c[t])  # from here on the gradient of the candidate
            np.multiply(d, to_z[t], out=back[t, :n])
            np.multiply(d_c, to_r[t], out=back[t, n:2 * n])
            np.multiply(d_c, r[t], out=back[t, 2 * n:])
            np.matmul(self.recurrent, back[t], out=carried)
            d *= z[t]
            carried += d
        g_rec += np.matmul(before, back.transpose(0, 2, 1)).sum(axis=0)
        to_inputs, sorted_by_id = (held(name, 3 * n).reshape(steps, streams, 3 * n) for name in ("to_inputs", "sorted"))
        to_inputs[:, :, :2 * n] = back[:, :2 * n].transpose(0, 2, 1)
        to_inputs[:, :, 2 * n:] = to_c.transpose(0, 2, 1)
        ids = tokens.ravel()
        order = np.argsort(ids.astype(np.int16) if len(self.inputs) < 1 << 15 else ids, kind="stable")
        first = np.flatnonzero(np.diff(ids[order], prepend=-1))
        by_id = np.take(to_inputs.reshape(-1, 3 * n), order, axis=0, out=sorted_by_id.reshape(-1, 3 * n), mode="clip")
        g_in[ids[order[first]]] += np.add.reduceat(by_id, first, axis=0)
        return grads, states[-1].T.copy(), loss / size

    def fit(self, texts: list[np.ndarray], epochs: int = 3, streams: int = 64, window: int = 32, rate: float = 0.006, seed: int = 3) -> GRU:
        """Truncated backpropagation: texts are laid end to end into streams, windows follow each
        other with the state carried over and the gradient cut; the end token before a text is its begin."""
        rng = np.random.default_rng(seed)
        bounds = np.cumsum([p.size for p in self.parts])[:-1]

        def split(whole: np.ndarray) -> list[np.ndarray]:
            return [v.reshape(p.shape) for v, p in zip(np.split(whole, bounds), self.parts, strict=True)]

        # All parameters in one array, so that an update is a few passes over it.
        value = np.concatenate([p.ravel() for p in self.parts])
        self.inputs, self.recurrent, self.to_class, self.class_bias, self.to_word, self.word_bias = split(value)
        gradient, first, second, part = (np.zeros_like(value) for _ in range(4))
        grads, room = split(gradient), {}
        step, total = 0, epochs * max(1, sum(map(len, texts)) // (streams * window))
        for _ in range(epochs):
            flat = np.concatenate([[self.begin], *[texts[i] for i in rng.permutation(len(texts))]])
            length = (len(flat) - 1) // streams
            if length < 1:
                return self
            source = np.stack([flat[s * length:s * length + length + 1] for s in range(streams)], axis=1)
            h = np.zeros((streams, self.hidden), np.float32)
            for lo in range(0, length, window):
                hi = min(lo + window, length)
                gradient[:] = 0
                h = self._gradients(source[lo:hi], source[lo + 1:hi + 1], h, grads, room)[1]
                norm = float(np.sqrt(gradient @ gradient))
                step += 1
                now = rate * max(0.05, 1 - step / total)
                gradient *= min(1.0, 1.0 / (norm + 1e-9))
                np.multiply(gradient, gradient, out=part)
                part -= second
                part *= 0.005
                second += part
                gradient -= first
                gradient *= 0.1
                first += gradient
                np.multiply(second, 1 / (1 - 0.995**step), out=part)
                np.sqrt(part, out=part)
                part += 1e-7
                np.divide(first, part, out=part)
                part *= now / (1 - 0.9**step)
                value -= part
        return self
