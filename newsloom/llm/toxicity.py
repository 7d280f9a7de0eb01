"""Toxicity (operator 10): a convolutional text classifier over hashed words, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.registry import query, table
from newsloom.llm.sampling import hashed_sample
from newsloom.llm.words import PUNCTUATION, WHITE_SPACE, Splitter, pieces
from newsloom.session import stage

#: The net is fitted on at most so many labelled documents, and on at most three in four; all others set thresholds.
SAMPLE_DOCS = 6_000
#: Logits from -_REACH to _REACH are counted in so many steps; these languages may have thresholds, from so many toxic rows on.
BINS, _REACH, LANGUAGES, LEAST_TOXIC = 4_096, 16.0, 200, 20
BUCKET_BITS = 15
WIDTH = 8
FILTERS = 8
SIZES = (1, 2, 3)
PREFIX = 6
RARE = 10
LEAK = np.float32(0.1)
#: Passes over the sample, more where it is small: so many steps at least.
EPOCHS, LEAST_STEPS = 6, 320
#: Behind each text; an empty text is that much, so that no filter sees the next.
_PAD = max(SIZES)


def buckets(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(two buckets of every word, first word and number of words of every text), piece by piece.

    The buckets are of the word and of its first PREFIX bytes. Case and ASCII punctuation don't count. Behind each text stand pads, so a filter at its end sees nothing of the next.
    """
    splitter = Splitter(WHITE_SPACE + PUNCTUATION, lower=True, prefix=PREFIX)
    for _, _, data, offsets in pieces(texts):
        words = splitter.split(data, offsets)
        size = np.diff(words.bounds)
        row = np.repeat(np.arange(len(size)), size)
        out = np.full((len(words.hash) + _PAD * len(size), 2), 1 << BUCKET_BITS, dtype=np.int32)
        out[np.arange(len(row)) + _PAD * row] = np.stack([words.hash, words.prefix], axis=1) >> np.uint64(64 - BUCKET_BITS)
        yield out, words.bounds[:-1] + _PAD * np.arange(len(size)), size


def _damped(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x, LEAK * x)


class ConvNet:
    """Embeddings, filters of several sizes, the largest response of each filter in a text, one output."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.embedding = rng.normal(0, 0.1, ((1 << BUCKET_BITS) + 1, WIDTH)).astype(np.float32)
        self.embedding[-1] = 0
        self.filters = [rng.normal(0, 0.2, (k, WIDTH, FILTERS)).astype(np.float32) for k in SIZES]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in SIZES]
        self.out = rng.normal(0, 0.2, len(SIZES) * FILTERS).astype(np.float32)
        self.shift = np.zeros(1, np.float32)
        self.scale = (1.0, 0.0)  # slope and offset of the calibrated logit

    def _responses(self, ids: np.ndarray) -> list[np.ndarray]:
        x = self.embedding[ids].sum(axis=1)
        out = []
        for w, b in zip(self.filters, self.bias, strict=True):
            r = np.repeat(b[None, :], len(ids), axis=0)
            for k in range(len(w)):
                r[:len(ids) - k] += x[k:] @ w[k]
            out.append(r)
        return out

    def pooled(self, ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Largest responses of all filters, negative ones damped; an empty text sees only pads."""
        edges = np.ravel(np.column_stack([start, start + np.maximum(size, 1)]))
        found = [np.maximum.reduceat(np.append(r, r[-1:], axis=0), edges, axis=0)[::2] for r in self._responses(ids)]
        return _damped(np.concatenate(found, axis=1))

    def logits(self, ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        return self.pooled(ids, start, size) @ self.out + self.shift[0]

    def _start_from_odds(self, texts: list[np.ndarray], y: np.ndarray) -> None:
        """One embedding column starts as how much likelier a bucket is in toxic texts."""
        size = (1 << BUCKET_BITS) + 1
        seen = [np.zeros(size), np.zeros(size)]
        for ids, label in zip(texts, y, strict=True):
            seen[int(label)][np.unique(ids)] += 1
        n = np.bincount(y.astype(int), minlength=2)
        odds = np.log((seen[1] + 1) / (n[1] + 2)) - np.log((seen[0] + 1) / (n[0] + 2))
        # Shrunk where few toxic texts have it, so that rare words don't stand out by chance.
        self.embedding[:, 0] = np.maximum(odds, 0) / 4 * seen[1] / (seen[1] + RARE)
        self.embedding[-1] = 0
        for w in self.filters:
            w[:, 0, :] = np.abs(w[:, 0, :])

    def fit(self, texts: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, batch: int = 32, rate: float = 0.002, seed: int = 5) -> ConvNet:
        """Adam on the cross entropy. `texts`: padded buckets of each text. Gradients pass through the largest responses only."""
        self._start_from_odds(texts, y)
        rng = np.random.default_rng(seed)
        parts = [self.embedding, *self.filters, *self.bias, self.out, self.shift]
        first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
        step = 0
        for _ in range(max(epochs, -(-LEAST_STEPS * batch // len(texts)))):
            order = rng.permutation(len(texts))
            for lo in range(0, len(order), batch):
                own = order[lo:lo + batch]
                grads = self._gradients([texts[i] for i in own], y[own])
                step += 1
                for p, g, m, v in zip(parts, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= (rate / (1 - 0.9**step) * m / (np.sqrt(v / (1 - 0.999**step)) + 1e-4)).astype(np.float32)
                self.embedding[-1] = 0
        return self

    def _gradients(self, texts: list[np.ndarray], y: np.ndarray) -> list[np.ndarray]:
        size = np.array([len(t) - _PAD for t in texts])
        start = np.concatenate([[0], np.cumsum(size + _PAD)[:-1]])
        ids = np.concatenate(texts)
        responses = self._responses(ids)
        at = np.stack([np.concatenate([s + r[s:s + max(n, 1)].argmax(axis=0) for r in responses]) for s, n in zip(start, size, strict=True)])
        raw = np.concatenate([r[at[:, k * FILTERS:(k + 1) * FILTERS], np.arange(FILTERS)] for k, r in enumerate(responses)], axis=1)
        top = _damped(raw)
        p = 1 / (1 + np.exp(-(top @ self.out + self.shift[0])))
        d = ((p - y) / len(y)).astype(np.float32)
        back = d[:, None] * self.out[None, :] * np.where(raw > 0, 1, LEAK).astype(np.float32)
        embedding = np.zeros_like(self.embedding)
        filters, bias = [], []
        for k, w in enumerate(self.filters):
            columns = slice(k * FILTERS, (k + 1) * FILTERS)
            g, place = back[:, columns], at[:, columns]
            dw = np.zeros_like(w)
            for j in range(len(w)):
                which = ids[place + j]
                x = self.embedding[which].sum(axis=2)
                dw[j] = np.einsum("bf,bfd->df", g, x)
                each = (g[:, :, None] * w[j].T[None]).reshape(-1, WIDTH)
                for i in (0, 1):
                    np.add.at(embedding, which[:, :, i].ravel(), each)
            filters.append(dw)
            bias.append(g.sum(axis=0))
        return [embedding, *filters, *bias, top.T @ d, np.array([d.sum()], np.float32)]

    def calibrate(self, logits: np.ndarray, ones: np.ndarray, zeros: np.ndarray, steps: int = 100) -> None:
        """Platt scaling (with his softened targets) by Newton steps, so that 0.5 means as likely as not.

        `ones` and `zeros`: how many toxic and other texts have each logit.
        """
        n1, n0 = ones.sum(), zeros.sum()
        n, hits = ones + zeros, ones * (n1 + 1) / (n1 + 2) + zeros / (n0 + 2)
        a, b = 1.0, 0.0
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
            w = n * np.maximum(p * (1 - p), 1e-6)
            g = np.array([((n * p - hits) * logits).sum(), (n * p - hits).sum()])
            h = np.array([[(w * logits**2).sum() + 1e-3, (w * logits).sum()], [(w * logits).sum(), w.sum() + 1e-3]])
            move = np.clip(np.linalg.solve(h, g), -1, 1)
            a, b = a - move[0], b - move[1]
            if np.abs(move).max() < 1e-8:
                break
        self.scale = (float(max(a, 1e-3)), float(b))


def best_bin(ones: np.ndarray, zeros: np.ndarray) -> int:
    """The bin from which calling a text toxic gives the highest F1 (the highest such bin)."""
    hits, called = np.cumsum(ones[::-1])[::-1], np.cumsum((ones + zeros)[::-1])[::-1]
    f1 = 2 * hits / np.maximum(called + ones.sum(), 1)
    return len(f1) - 1 - int(np.argmax(f1[::-1]))


def held_out(key: Column) -> Column:
    """Whether a key's fold is the one that nothing is learned from. A NULL key is not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _usable(labels: DataFrame, key: str, label: str) -> DataFrame:
    return labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.col("key").isNotNull() & ~held_out(F.col("key"))).distinct()


def train(docs: DataFrame, usable: DataFrame, key: str, text: str, sample: int = SAMPLE_DOCS) -> tuple[ConvNet, DataFrame] | None:
    """The net, and which labelled rows (key, label; at most `sample`, and at most three in four) it has seen."""
    seen = stage(hashed_sample(usable, min(sample, usable.count() * 3 // 4), F.col("key"), seed=10), "taught")
    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [out[s:s + n + _PAD].tobytes() for out, start, size in buckets(batch.column(0)) for s, n in zip(start, size, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), batch.column(1), batch.column(2)], names=["ids", "label", "key"])

    rows = own.join(F.broadcast(seen), "key").select("text", "label", "key").mapInArrow(hashed, "ids binary, label int, key bigint").collect()
    rows.sort(key=lambda r: (r["key"], bytes(r["ids"]), r["label"]))
    texts = [np.frombuffer(bytes(r["ids"]), dtype=np.int32).reshape(-1, 2) for r in rows]
    y = np.array([r["label"] for r in rows], dtype=np.float32)
    if not len(rows) or not 0 < y.sum() < len(rows):
        return None
    return ConvNet().fit(texts, y), seen


def thresholds(net: ConvNet, judged: DataFrame) -> dict[str, float]:
    """Calibrates the net on `judged` (lang, logit, label), rows that it was not fitted on, and gives a threshold for
    every language with at least LEAST_TOXIC toxic ones ("": for the others).

    All rows count: they are added up by language, label and one of BINS steps of the logit, so what
    the driver gets is bounded. Of the languages, the LANGUAGES with most toxic rows may have their own.
    """
    judged = judged.withColumn("bin", F.least(F.greatest(F.floor((F.col("logit") + _REACH) * (BINS / (2 * _REACH))), F.lit(0)), F.lit(BINS - 1)).cast("int"))
    counts = stage(judged.groupBy("lang", "bin", "label").agg(F.count("*").alias("n")), "score_bins")
    mids = (np.arange(BINS) + 0.5) * (2 * _REACH / BINS) - _REACH

    def binned(rows: list) -> list[np.ndarray]:
        own = [np.zeros(BINS), np.zeros(BINS)]
        for r in rows:
            own[r["label"]][r["bin"]] += r["n"]
        return own

    def limit(zeros: np.ndarray, ones: np.ndarray) -> float:
        a, b = net.scale
        edge = best_bin(ones, zeros) * (2 * _REACH / BINS) - _REACH
        return float(1 / (1 + np.exp(-(a * edge + b))))

    zeros, ones = binned(counts.groupBy("bin", "label").agg(F.sum("n").alias("n")).collect())
    if not ones.sum() or not zeros.sum():
        return {"": 0.5}
    net.calibrate(mids, ones, zeros)
    limits = {"": limit(zeros, ones)}
    toxic = counts.where("label = 1 AND lang <> ''").groupBy("lang").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TOXIC)
    for r in toxic.orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect():
        zeros, ones = binned(counts.where(F.col("lang") == r["lang"]).collect())
        if zeros.sum():
            limits[r["lang"]] = limit(zeros, ones)
    return limits


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
             label: str = "toxic", sample: int = SAMPLE_DOCS) -> DataFrame:
    """(key, held_out, score, predicted, flagged) for each row of `docs`.

    `score` depends on the text alone; `predicted` is 1 from a score of 0.5; `flagged` compares the
    score with the language's own threshold. The net is fitted on at most `sample` labelled documents
    whose key isn't held out; the calibration of scores and the thresholds of languages come from all other labelled documents
    that aren't. Whole texts are scored, once each, where they are. NULL or
    empty texts get the score of a text without words; NULL labels and keys teach nothing; an unknown or NULL
    language has the common threshold; repeated rows get equal scores; without usable labels all scores are low;
    an empty table gives no rows; other columns are not read.
    """
    usable = _usable(labels, key, label)
    made = train(docs, usable, key, text, sample)
    own = docs.select(F.col(key).alias("key"), F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.col(text).alias("text"))
    if made is None:  # nothing to learn from: nothing is toxic
        found, (a, b), limits = own.withColumn("logit", F.lit(0.0)), (0.0, -3.0), {"": 0.5}
    else:
        net, seen = made
        shared = docs.sparkSession.sparkContext.broadcast(net)

        @F.arrow_udf("double")
        def logits(texts: pa.Array) -> pa.Array:
            parts = [shared.value.logits(*piece).astype(np.float64) for piece in buckets(texts)]
            return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

        found = stage(own.select("key", "lang", logits("text").alias("logit")), "logits")
        rest = usable.join(F.broadcast(seen), ["key", "label"], "left_anti")
        limits = thresholds(net, found.join(rest, "key").select("lang", "logit", "label"))
        a, b = net.scale
    limit = F.lit(limits[""])
    if len(limits) > 1:
        limit = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]), F.col("lang")), limit)
    score = 1 / (1 + F.exp(-(F.lit(a) * F.col("logit") + F.lit(b))))
    out = found.select(F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), score.alias("score"), limit.alias("_limit"))
    return out.select(key, "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                      (F.col("score") >= F.col("_limit")).alias("flagged"))


@query("op10_toxicity")
def op10(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
