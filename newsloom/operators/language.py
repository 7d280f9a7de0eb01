"""Language identification from character trigram profiles.

Training: the 300 most frequent trigrams of each language (Cavnar and Trenkle, 1994), counted over
whole texts and weighted by rank, 300 for the most frequent one down to 1. Scoring: a text gets, per
language, the sum of the weights of its trigram occurrences, and the highest sum wins. All scores are
integers. Texts under 50 characters, and texts without any known trigram, are `en`; of a text to be
judged only the first 2,000 characters are looked at. These are the fixed rules of the feature.

Scale: trigrams are counted inside the tasks before anything is shuffled. Scoring needs no shuffle
at all: profiles are small, so they go to the tasks and texts stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.barrier import let
from newsloom.session import stage

DETECT_CHARS = 2_000
MIN_CHARS = 50
DEFAULT_LANGUAGE = "en"
PROFILE_SIZE = 300
# Profiles for all 184 codes of ISO 639-1 stay within this many rows: small enough for every task.
MAX_PROFILE_ROWS = 184 * PROFILE_SIZE
# Texts that are counted at once; a trigram takes some 30 bytes for each byte of text.
SLICE_BYTES = 2 << 20
# Trigrams of an alphabet with so many are counted in a table (16 MB), others by sorting.
CELLS = 1 << 21
_BITS = 21


def _codes(text: str) -> np.ndarray:
    """Every trigram of a text as one number, three code points of 21 bits."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    return (c[:-2] << 2 * _BITS) | (c[1:-1] << _BITS) | c[2:] if len(c) > 2 else np.zeros(0, np.int64)


def _counted(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The distinct trigrams of some texts and how often each occurs; none reaches from one text into the next."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([len(t) for t in texts])
    if len(points) < 3:
        return [], np.zeros(0, np.int64)
    across = np.concatenate([ends[ends >= 1] - 1, ends[ends >= 2] - 2])
    across = across[across < len(points) - 2]
    letters = np.flatnonzero(np.bincount(points))
    if len(letters) ** 3 < CELLS:
        place = np.zeros(int(letters[-1]) + 1, dtype=np.int32)
        place[letters] = np.arange(len(letters), dtype=np.int32)
        of, base = place[points], len(letters)
        codes = (of[:-2] * base + of[1:-1]) * base + of[2:]
        codes[across] = base ** 3
        n = np.bincount(codes, minlength=base ** 3)[:base ** 3]
        code = np.flatnonzero(n)
        n = n[code]
    else:
        of, base, letters = points.astype(np.int64), 1 << _BITS, None
        code, n = np.unique(np.delete((of[:-2] * base + of[1:-1]) * base + of[2:], across), return_counts=True)
    three = np.stack([code // (base * base), code // base % base, code % base], axis=1)
    three = three if letters is None else letters[three]
    grams = three.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return [grams[i:i + 3] for i in range(0, len(grams), 3)], n


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of some SLICE_BYTES: what Python holds follows neither the number nor the mean length of texts."""
    rows = max(1, batch.num_rows * SLICE_BYTES // max(batch.nbytes, 1))
    for lo in range(0, batch.num_rows, rows):
        part = batch.slice(lo, rows)
        if part.nbytes > 2 * SLICE_BYTES and part.num_rows > 1:
            yield from slices(part)
        else:
            yield part


def trigram_counts(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, n) over whole texts, lower-cased; counted batch by batch in the tasks."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            parts: dict[str, list[str]] = {}
            for own, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts.setdefault(own, []).append(words)
            for own, texts in parts.items():
                grams, n = _counted(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([own] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(n, pa.int64())],
                    names=["lang", "gram", "n"])

    usable = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    counted = usable.select(F.col(lang).alias("lang"), F.lower(text).alias("text")).mapInArrow(
        count, "lang string, gram string, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train_profiles(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, weight), at most 300 rows per language, stored in the shared folder."""
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = (
        trigram_counts(labelled, text, lang).withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= PROFILE_SIZE)
        .select("lang", "gram", (F.lit(PROFILE_SIZE + 1) - F.col("rank")).alias("weight"))
    )
    return stage(ranked, "profiles")


def _judged(profiles: DataFrame, text: Column) -> Column:
    """Language of each text by profiles small enough for every task."""
    rows = profiles.select("lang", "gram", "weight").collect()  # at most MAX_PROFILE_ROWS
    langs = sorted({r["lang"] for r in rows})
    known = np.array(sorted({int(_codes(r["gram"])[0]) for r in rows if len(r["gram"]) == 3}), dtype=np.int64)
    weights = np.zeros((len(known), len(langs)), dtype=np.int64)
    for r in rows:
        if len(r["gram"]) == 3:
            weights[np.searchsorted(known, _codes(r["gram"])[0]), langs.index(r["lang"])] = r["weight"]

    @F.arrow_udf("string")
    def best(texts: pa.Array) -> pa.Array:
        out = []
        for own in texts:
            codes = _codes(own.as_py() or "")
            at = np.searchsorted(known, codes)
            at[at == len(known)] = 0
            hit = at[known[at] == codes] if len(known) else at[:0]
            out.append(langs[int(weights[hit].sum(axis=0).argmax())] if len(hit) else None)
        return pa.array(out, pa.string())

    return best(F.lower(F.substring(text, 1, DETECT_CHARS)))


def _judged_by_join(texts: DataFrame, profiles: DataFrame, key: str, text: str) -> DataFrame:
    """(key, _lang): the same by a join, for profiles of more languages than there are codes."""
    letters = F.filter(F.split(F.lower(F.substring(text, 1, DETECT_CHARS)), ""), lambda c: c != "")
    grams = let(letters, lambda c: F.when(F.size(c) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(c) - 3), lambda i: F.concat(c[i], c[i + 1], c[i + 2]))))
    scores = (
        texts.where(F.length(text) >= MIN_CHARS).select(key, F.explode(grams).alias("gram"))
        .join(profiles, "gram").groupBy(key, "lang").agg(F.sum("weight").alias("score"))
    )
    return scores.groupBy(key).agg(F.min_by("lang", F.struct(-F.col("score"), F.col("lang"))).alias("_lang"))


def detect_language(texts: DataFrame, profiles: DataFrame, key: str, text: str,
                    out: str = "language") -> DataFrame:
    """`texts` with a language column. `key` identifies a row; `profiles` is a stored table."""
    default = F.lit(DEFAULT_LANGUAGE)
    if profiles.count() <= MAX_PROFILE_ROWS:
        spoken = F.when(F.length(text) >= MIN_CHARS, _judged(profiles, F.col(text)))
        return texts.withColumn(out, F.coalesce(spoken, default))
    best = _judged_by_join(texts, profiles, key, text)
    return texts.join(best, key, "left").withColumn(out, F.coalesce("_lang", default)).drop("_lang")
