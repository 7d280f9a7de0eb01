"""Bounded samples for fitting models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 40


def hashed_sample(rows: DataFrame, n: int, by: Column, seed: int = 0) -> DataFrame:
    """About `n` rows, at most `n`: those with the smallest hashes of `by`, whichever order they come in.

    The hash is first cut at a level that leaves some more than `n` rows, so that no large part of the
    table is ever sorted.
    """
    key = F.pmod(F.xxhash64(F.lit(seed), by), F.lit(_RANGE))
    level = int(_RANGE * min(1.0, (1.25 * n + 100) / max(rows.count(), 1)))
    return rows.withColumn("_hash", key).where(F.col("_hash") < level).orderBy("_hash").limit(n).drop("_hash")
