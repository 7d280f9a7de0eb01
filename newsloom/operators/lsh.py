"""Approximate neighbours by random projections: hash tables joined on their buckets, verified exactly.

A table cuts space by `bits` random planes; the side of each is one bit of a vector's bucket. Near
vectors share a bucket in some table, or lie in one that differs in the bits whose planes the query is
closest to, which are probed as well.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.nearest import BLOCK_ROWS, PLACES, _best, _row_best, _unit_rows
from newsloom.session import stage

#: Vectors that a bucket should hold on average, and the widest buckets' number.
BUCKET_ROWS, MOST_BITS = 256, 24


def planes(width: int, tables: int, bits: int, seed: int = 0) -> np.ndarray:
    """tables x bits directions of random planes."""
    return np.random.default_rng(seed).normal(size=(tables, bits, width))


def probe_order(margins: np.ndarray, probes: int) -> np.ndarray:
    """For rows of distances to the planes: which bits to turn for the first `probes` buckets, as masks; 0 comes first.

    Buckets come in the order of the sum of squared distances to the planes that lie between, over
    the sets of at most three of the eight nearest planes.
    """
    rows, bits = margins.shape
    near = np.argsort(np.abs(margins), axis=1)[:, :min(8, bits)]
    sets = [s for k in range(4) for s in combinations(range(near.shape[1]), k)]
    square = np.take_along_axis(margins, near, axis=1) ** 2
    cost = np.stack([square[:, list(s)].sum(axis=1) if s else np.zeros(rows) for s in sets], axis=1)
    turned = np.stack([(np.int64(1) << near[:, list(s)]).sum(axis=1) if s else np.zeros(rows, np.int64) for s in sets], axis=1)
    order = np.argsort(cost, axis=1, kind="stable")[:, :probes]
    return np.take_along_axis(turned, order, axis=1)


def lsh_nearest(queries: DataFrame, candidates: DataFrame, threshold: float, tables: int = 16, probes: int = 24,
                bits: int | None = None, exclude_self: bool = False, seed: int = 0) -> DataFrame:
    """`(id, match_id, similarity)` like `nearest_vectors`, but a neighbour may be missed. Inputs: `(id, vector)`.

    Every candidate has one bucket a table, a query `probes` of them. Whatever meets is compared exactly
    (similarities have 9 places), so what is returned is right, and only its being the best is not sure.
    `bits` follows from the number of candidates, so that buckets hold some 256 of them at any size. A
    bucket with very many rows is cut into blocks that are compared one by one. Zero vectors and those
    with numbers that are not finite have no neighbours; equal vectors are folded; ties go to the smallest id.
    """
    keyed = _unit_rows(candidates)
    width = keyed.select(F.size("vector")).first()
    if width is None:
        return candidates.sparkSession.createDataFrame([], "id bigint, match_id bigint, similarity double")
    if exclude_self:
        stored = stage(keyed.select("id", "vector"), "stored-vectors")
    else:
        stored = stage(keyed.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.any_value("vector").alias("vector")).select("id", "vector"), "stored-vectors")
    asked = stage(_unit_rows(queries).select("id", "vector"), "asked-vectors")
    if bits is None:
        bits = int(np.clip(np.ceil(np.log2(max(stored.count(), 1) / BUCKET_ROWS)), 1, MOST_BITS))
    cut = planes(width[0], tables, bits, seed)
    shared = candidates.sparkSession.sparkContext.broadcast(cut)
    weights = np.int64(1) << np.arange(bits)

    def buckets(batches, wanted):
        for frame in batches:
            if frame.empty:
                continue
            vectors = np.stack(frame.vector.to_numpy())
            vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
            codes = []
            for t in range(tables):
                margin = vectors @ shared.value[t].T
                own = (margin > 0) @ weights
                codes.append((np.int64(t) << np.int64(bits)) | (own[:, None] ^ probe_order(margin, wanted)))
            yield pd.DataFrame({"id": frame.id, "vector": frame.vector, "buckets": list(np.concatenate(codes, axis=1))})

    def hashed(rows, wanted):
        found = rows.mapInPandas(lambda b: buckets(b, wanted), "id bigint, vector array<double>, buckets array<bigint>")
        return stage(found, "hashed").select("id", "vector", F.explode("buckets").alias("bucket"))

    held, visits = hashed(stored, 1), hashed(asked, probes)
    sizes = stage(
        held.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("nc"))
        .join(visits.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("nq")), "bucket"), "bucket-sizes")

    def spread(rows, mine, other, own_n, other_n):
        return (
            rows.join(sizes, "bucket").withColumn(mine, F.pmod(F.xxhash64("id"), F.col(own_n)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1))).select("bucket", "bq", "bc", "id", "vector"))

    def compare(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({"id": [], "match_id": [], "similarity": []})
        c = c.sort_values("id")
        a, b = np.stack(q.vector.to_numpy()), np.stack(c.vector.to_numpy())
        a, b = a / np.linalg.norm(a, axis=1, keepdims=True), b / np.linalg.norm(b, axis=1, keepdims=True)
        return _row_best(q.id.to_numpy(), c.id.to_numpy(), np.round(a @ b.T, PLACES), threshold, False, exclude_self)

    keys = ["bucket", "bq", "bc"]
    met = spread(visits, "bq", "bc", "nq", "nc").groupBy(*keys).cogroup(spread(held, "bc", "bq", "nc", "nq").groupBy(*keys))
    return _best(met.applyInPandas(compare, "id bigint, match_id bigint, similarity double"))
