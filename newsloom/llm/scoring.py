"""Language-model scores of whole documents (operator 7)."""

from __future__ import annotations

import copy
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.gru import GRU
from newsloom.llm.registry import query, table
from newsloom.llm.sampling import hashed_sample
from newsloom.llm.words import WHITE_SPACE, Splitter, mix, pieces
from newsloom.session import stage

#: Words with places of their own in the model's output, the end token among them.
MODEL_WORDS = 1_024
#: Other words share SHAPES unknown tokens, by their last two bytes.
SHAPES = 16
#: The recurrent model starts from a fit on at most so many documents, and then learns from every training document in the
#: task that holds it; counts are of all training documents too.
SAMPLE_DOCS, RATE = 1_500, 0.002
#: Averages of parameters that the driver adds up.
_SUMS = 8
#: Counts of at most so many frequent words (12 MB) go to every task; those of others are joined.
FREQUENT = 1 << 20
END = np.uint64(0x5D1F0E7C3B2A4968)
_HELD_BACK = 1 << 19


def tokens(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hash of every token, its shape, bounds of the texts), piece by piece: lower-cased words and an end."""
    splitter = Splitter(WHITE_SPACE, lower=True)
    for _, _, data, offsets in pieces(texts):
        words = splitter.split(data, offsets)
        size = np.diff(words.bounds)
        row = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(row)) + row
        hashed = np.full(len(row) + len(size), END, dtype=np.uint64)
        shape = np.zeros(len(hashed), dtype=np.int8)
        if len(row):
            hashed[place] = words.hash
            last = splitter.value[data[words.end - 1]]
            longer = words.end - words.start > 1
            last = last ^ np.where(longer, splitter.value[data[words.end - 2]] << np.uint64(1), np.uint64(0))
            shape[place] = (mix(last) % np.uint64(SHAPES)).astype(np.int8)
        yield hashed, shape, np.concatenate([[0], np.cumsum(size + 1)])


def held_out(key: Column) -> Column:
    """Whether a key's fold is the one that nothing is learned from. A NULL key is not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def token_counts(docs: DataFrame, text: str) -> DataFrame:
    """(token, shape, n) of all tokens of all texts, summed in the tasks first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(parts):
            token, at, which = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
            return token, np.concatenate([p[1] for p in parts])[at], np.bincount(which, np.concatenate([p[2] for p in parts])).astype(np.int64)

        def batch_of(part):
            return pa.RecordBatch.from_arrays([pa.array(part[0].view(np.int64)), pa.array(part[1]), pa.array(part[2])], names=["token", "shape", "n"])

        parts, held = [], 0
        for batch in batches:
            for hashed, shape, _ in tokens(batch.column(0)):
                parts.append(summed([(hashed, shape, np.ones(len(hashed)))]))
                held += len(parts[-1][0])
            if held > _HELD_BACK:
                parts = [summed(parts)]
                held = len(parts[0][0])
                if held > _HELD_BACK // 2:
                    yield batch_of(parts[0])
                    parts, held = [], 0
        if parts:
            yield batch_of(summed(parts))

    found = docs.select(text).mapInArrow(count, "token bigint, shape tinyint, n bigint")
    return stage(found.groupBy("token").agg(F.first("shape").alias("shape"), F.sum("n").alias("n")), "token_counts")


def _frequent(counts: DataFrame) -> DataFrame:
    """The tokens above the lowest power of two that at most FREQUENT tokens reach (tokens, without order)."""
    level = F.length(F.bin("n"))
    by_level = {r[0]: r[1] for r in counts.groupBy(level).count().collect()}  # at most 63 rows
    least, total = 64, 0
    while least > 1 and total + by_level.get(least - 1, 0) <= FREQUENT:
        least -= 1
        total += by_level.get(least, 0)
    return counts.where(level >= least)


class Places:
    """Where hashes are in a sorted array of them: a table of their first bits leads next to the place."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.table = keys, None

    def __getstate__(self) -> dict:
        return {"keys": self.keys, "table": None}  # tables are made where they are used

    def find(self, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether it is there); the place of one that isn't there is any."""
        if not len(self.keys):
            return np.zeros(len(hashed), dtype=np.int64), np.zeros(len(hashed), dtype=bool)
        shift = np.uint64(64 - max(8, len(self.keys).bit_length()))
        if self.table is None:
            bucket = (self.keys >> shift).astype(np.int64)
            n = np.bincount(bucket, minlength=1 << (64 - int(shift)))
            self.table = (np.cumsum(n) - n).astype(np.int32)
        last = len(self.keys) - 1
        at = np.minimum(self.table[(hashed >> shift).astype(np.int64)], last)
        less = np.flatnonzero(self.keys[at] < hashed)
        while len(less):
            at[less] += 1
            less = less[at[less] <= last]
            less = less[self.keys[at[less]] < hashed[less]]
        at = np.minimum(at, last)
        return at, self.keys[at] == hashed


class Model:
    """The recurrent model over the commonest tokens, and the counts of frequent ones.

    An unknown word has the probability of its shape times its share (count + 0.5) of the shape's
    unknown words, unseen ones counting as one more word of each shape.
    """

    def __init__(self, common: np.ndarray, common_counts: np.ndarray, shape_counts: np.ndarray, shape_totals: np.ndarray,
                 frequent: np.ndarray, frequent_counts: np.ndarray):
        order = np.argsort(common)
        self.sorted, self.rank = Places(common[order]), order
        self.n_words = len(common)
        self.frequent, self.counts = Places(frequent), frequent_counts
        self.shape_log = np.log10(shape_totals + 0.5)
        end = np.flatnonzero(common == END)
        self.net = GRU(len(common), SHAPES, int(end[0]) if len(end) else 0)
        self.net.start_from(np.concatenate([common_counts, shape_counts]).astype(float))

    def ids(self, hashed: np.ndarray, shape: np.ndarray) -> np.ndarray:
        if not self.n_words:
            return self.n_words + shape.astype(np.int64)
        at, there = self.sorted.find(hashed)
        return np.where(there, self.rank[at], self.n_words + shape.astype(np.int64))

    def count(self, hashed: np.ndarray) -> np.ndarray:
        """Training counts of frequent tokens, -1 for others."""
        if not len(self.counts):
            return np.full(len(hashed), -1)
        at, there = self.frequent.find(hashed)
        return np.where(there, self.counts[at], -1)


def learn_in_tasks(model: Model, docs: DataFrame, text: str) -> None:
    """One round over `docs`: every task goes on from the model's parameters with its own documents, batch by batch, and
    the results are averaged by tokens. Sums are made in _SUMS tasks, so the driver gets that many sets of
    parameters (0.4 MB each) at any size; a lost task learns again what it had learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    sizes = [p.size for p in model.net.parts]

    def row(part: int, total: np.ndarray, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                                          names=["part", "n", "total"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = copy.deepcopy(shared.value)
        start, n = np.concatenate([p.ravel() for p in own.net.parts]).astype(np.float64), 0
        for batch in batches:
            ids = []
            for value, shape, bounds in tokens(batch.column(0)):
                found = own.ids(value, shape).astype(np.int32)
                ids += [found[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            size = sum(map(len, ids))
            if size:
                # Few tokens make short streams, so that windows are whole.
                own.net.fit(ids, epochs=1, streams=int(np.clip(size // 128, 1, 64)), rate=RATE)
                n += size
        if n:
            end = np.concatenate([p.ravel() for p in own.net.parts]).astype(np.float64)
            yield row(zlib.crc32(end.tobytes()) % _SUMS, (end - start) * n, n)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(sum(sizes)), 0
        for batch in batches:
            for own, raw in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                total += np.frombuffer(raw.as_py(), dtype=np.float64)
                n += own
        if n:
            yield row(0, total, n)

    schema = "part int, n bigint, total binary"
    moved = docs.select(text).mapInArrow(learn, schema).repartition(_SUMS, "part").mapInArrow(add, schema).collect()
    n = sum(r["n"] for r in moved)
    if n:
        step = sum(np.frombuffer(bytes(r["total"]), dtype=np.float64) for r in sorted(moved, key=lambda r: (r["n"], bytes(r["total"])))) / n
        for p, own in zip(model.net.parts, np.split(step, np.cumsum(sizes)[:-1]), strict=True):
            p += own.reshape(p.shape).astype(np.float32)


def train(spark: SparkSession, counts: DataFrame, docs: DataFrame, key: str, text: str, sample: int = SAMPLE_DOCS) -> Model:
    common = counts.orderBy(F.desc("n"), "token").limit(MODEL_WORDS).select("token", "n").collect()
    common_tokens = np.array([r[0] for r in common], dtype=np.int64).view(np.uint64)
    unknown = counts.join(F.broadcast(spark.createDataFrame([(r[0],) for r in common], "token bigint")), "token", "left_anti")
    shapes = unknown.groupBy("shape").agg(F.sum("n").alias("n"), F.sum(F.col("n") + 0.5).alias("total")).collect()
    shape_counts, shape_totals = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in shapes:
        shape_counts[r["shape"]], shape_totals[r["shape"]] = r["n"], r["total"]
    frequent = _frequent(counts).select("token", "n").toArrow()
    token = frequent.column("token").to_numpy().view(np.uint64)
    order = np.argsort(token)
    model = Model(common_tokens, np.array([r[1] for r in common]), shape_counts, shape_totals, token[order],
                  frequent.column("n").to_numpy()[order].astype(np.int64))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = []
            for value, shape, bounds in tokens(batch.column(0)):
                own = model.ids(value, shape).astype(np.int32)
                ids += [own[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["ids"])

    picked = hashed_sample(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), sample, F.col("key"), seed=7)
    rows = sorted(bytes(r[0]) for r in picked.select("text").mapInArrow(hashed, "ids binary").collect())
    if rows and model.n_words:
        model.net.fit([np.frombuffer(r, dtype=np.int32) for r in rows])
        learn_in_tasks(model, docs, text)
    return model


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: its tokens, what frequent tokens contribute, and its other tokens with their numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            ids, size, known, logs, shares, rare, rare_n = [], [], [], [], [], [], []
            for hashed, shape, bounds in tokens(batch.column(2)):
                own = model.ids(hashed, shape)
                count = model.count(hashed)
                frequent = count >= 0
                unknown = own >= model.n_words
                row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                n = len(bounds) - 1
                log = np.where(frequent, np.log10(np.maximum(count, 0) + 0.5), 0.0)
                size.append(np.diff(bounds))
                known.append(np.bincount(row, frequent, n).astype(np.int64))
                logs.append(np.bincount(row, log, n))
                # What the unknown words' shares in their shapes come to, but for the counts of rare ones.
                shares.append(np.bincount(row, np.where(unknown, np.where(frequent, log, 0.0) - model.shape_log[shape], 0.0), n))
                ids += [own[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    t, m = np.unique(hashed[a:b][~frequent[a:b]], return_counts=True)
                    rare.append(t.view(np.int64))
                    rare_n.append(m)
            net = model.net.score(ids) / np.log(10) if ids else np.zeros(0)
            flat = [np.concatenate(x) if x else np.zeros(0) for x in (size, known, logs, shares)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(flat[0].astype(np.int64)), pa.array(flat[1].astype(np.int64)), pa.array(flat[2]),
                 pa.array(net + flat[3]), pa.array(rare, pa.list_(pa.int64())), pa.array(rare_n, pa.list_(pa.int64()))],
                names=["key", "held_out", "n_tokens", "known", "logs", "net", "rare", "rare_n"])

    return docs.mapInArrow(
        score, "key bigint, held_out boolean, n_tokens bigint, known bigint, logs double, net double, rare array<bigint>, rare_n array<bigint>")


def language_model_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE_DOCS) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of `docs`.

    Tokens are words with A-Z in lower case, then one end. Training documents are those that aren't
    held out. `base_score` is the smoothed unigram score over counts of all of them; `score` is
    log10 of the probability that the recurrent model gives the whole text. The model starts from a fit on at most `sample`
    training documents, chosen by a hash of the key, and goes on with all of them; its vocabulary, and the
    shares of words outside of it, come from all counts.

    Counts of frequent words go to the tasks, each document's other words meet their counts by a join on the word, so no
    vocabulary is ever in one place. NULL or empty text is just an end; NULL keys are kept and train; repeated
    rows count each; without training rows all tokens are unknown; an empty table gives no rows.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(key).alias("key"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("text"))
    learn = own.where(~F.col("held_out"))
    counts = token_counts(learn, "text")
    model = train(spark, counts, learn, "key", "text", sample)
    scored = stage(_scored(own, model).withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select("row", F.col("x.rare").alias("token"), F.col("x.rare_n").alias("m"))
    met = rare.join(counts.select("token", "n"), "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    by_row = met.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("m")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("m") * F.log10(F.col("n") + 0.5)).alias("rare_logs"))
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("N"), F.count("*").alias("V")).first()
    space = float(np.log10(totals["N"] + 0.5 * (totals["V"] + 1)))
    logs = F.coalesce("rare_logs", F.lit(0.0))
    return scored.join(by_row, "row", "left").select(
        F.col("key").alias(key), "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(totals["N"]).cast("bigint").alias("train_tokens"),
        (F.col("logs") + logs - F.col("n_tokens") * F.lit(space)).alias("base_score"), (F.col("net") + logs).alias("score"))


@query("op7_lm_scoring")
def op7(spark, sf_dir):
    return language_model_scores(table(spark, sf_dir, "documents"))
