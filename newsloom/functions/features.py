"""Text to vectors.

Two vector forms are offered.

*Feature sets* (`array<bigint>`, sorted): hashes of overlapping word triples. The set stands for the
unit vector that gives each listed coordinate the weight 1/sqrt(size), so the cosine of two texts is
`|A ∩ B| / sqrt(|A| |B|)`. Triples are rare, which lets a similarity join find partners by equality
on a few rare coordinates. This is the form used for article deduplication.

*Dense vectors* (`array<double>`, 384 wide by default): hashed word counts scaled to length one, or
the output of a real model through `model_vectors`. Both forms find copies and near copies; only a
model finds rewordings.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.barrier import let, with_computed

# The embedding input is at most 1,024 characters long, the labelled text for the
# general vector takes at most 400 of the description and 500 of the content.
EMBED_CHARS = 1_024
DESCRIPTION_CHARS = 400
CONTENT_CHARS = 500
DENSE_WIDTH = 384
SHINGLE = 3
NON_WORD = r"[^\p{L}\p{N}]+"
# All characters of text.WHITESPACE.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"


def trimmed(text: Column) -> Column:
    """Without white space at either end; only the ends are looked at."""
    return F.btrim(text, F.lit(SPACES))


def _labelled(label: str, text: Column) -> Column:
    return F.when(text != "", F.concat(F.lit(label + ": "), text))


def general_text(title: Column, description: Column, content: Column,
                 category: Column | None = None) -> Column:
    """Labelled text for the general vector; empty parts are left out."""
    parts = [_labelled("title", trimmed(title))]
    if category is not None:
        parts.append(_labelled("category", trimmed(category)))
    parts.append(_labelled("description", F.substring(trimmed(description), 1, DESCRIPTION_CHARS)))
    parts.append(_labelled("content", F.substring(trimmed(content), 1, CONTENT_CHARS)))
    return F.substring(F.concat_ws(" ", *parts), 1, EMBED_CHARS)


def content_text(content: Column, limit: int = EMBED_CHARS) -> Column:
    """Text for the content vector, at most `limit` characters; NULL when there is no content."""
    body = trimmed(content)
    text = F.concat(F.lit("content: "), F.substring(body, 1, limit))
    return F.when(body != "", F.substring(text, 1, limit))


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NON_WORD), lambda w: w != "")


def feature_set(text: Column, size: int = SHINGLE) -> Column:
    """Sorted, distinct hashes of the word runs of length `size`; NULL for text without words.

    A text shorter than `size` words is one run.
    """
    def runs(tokens):
        starts = F.sequence(F.lit(0), F.greatest(F.size(tokens) - size, F.lit(0)))
        # Places beyond the last word are NULL, which concat_ws leaves out.
        hashes = F.transform(starts, lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(tokens, i + k) for k in range(size)])))
        return F.when(F.size(tokens) > 0, F.sort_array(F.array_distinct(hashes)))

    return let(words(text), runs)


def set_cosine(a: Column, b: Column) -> Column:
    """Cosine of two feature sets, exact up to one correctly rounded division."""
    shared = F.size(F.array_intersect(a, b))
    return shared / F.sqrt((F.size(a) * F.size(b)).cast("double"))


def word_buckets(text: Column, width: int = DENSE_WIDTH) -> Column:
    """Bucket of every word occurrence: the first 32 bits of its md5, modulo `width`."""
    return F.transform(
        words(text),
        lambda w: (F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint") % width).cast("int"),
    )


def with_dense_vector(df: DataFrame, text: str, out: str, width: int = DENSE_WIDTH) -> DataFrame:
    """`df` with the unit vector of hashed word counts; NULL for NULL or text without words."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def unit(buckets: pd.Series) -> pd.Series:
        sizes = buckets.map(lambda b: 0 if b is None else len(b)).to_numpy()
        if not sizes.any():
            return pd.Series([None] * len(buckets), index=buckets.index, dtype="object")
        row = np.repeat(np.arange(len(buckets)), sizes)
        flat = np.concatenate([b for b, n in zip(buckets, sizes) if n])
        counts = np.bincount(row * width + flat, minlength=len(buckets) * width).reshape(-1, width).astype("float64")
        counts /= np.maximum(np.sqrt((counts * counts).sum(axis=1, keepdims=True)), 1e-300)
        return pd.Series([v if n else None for v, n in zip(counts, sizes)], index=buckets.index)

    hashed = with_computed(df, **{out: word_buckets(F.col(text), width)})
    return hashed.withColumn(out, unit(F.col(out)))


def model_vectors(make_predict, text: Column, batch_size: int = 256) -> Column:
    """Vectors from a real model, loaded once per Python worker.

    `make_predict` returns a function from an array of strings to a 2-d float array.
    """
    from pyspark.ml.functions import predict_batch_udf

    udf = predict_batch_udf(make_predict, return_type=T.ArrayType(T.FloatType()),
                            batch_size=batch_size)
    return udf(text)


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision; NULL when either vector is."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of vectors of any length; NULL where one of them is zero."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)))


def has_direction(vector: Column) -> Column:
    """Whether a vector can be compared: not NULL, not zero, all numbers finite."""
    square = dot(vector, vector)
    return F.coalesce((square > 0) & ~F.isnan(square) & (square < float("inf")), F.lit(False))


def rounded(similarity: Column, places: int = 4) -> Column:
    return F.round(similarity, places)
