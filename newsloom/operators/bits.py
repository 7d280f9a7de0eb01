"""Bit maps that hold rows back before a shuffle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Some 16 bits for every value, 2**28 (32 MB) at most: beyond that chance hits grow, which cost work and no row.
_LEAST, _MOST, _BUCKET = 15, 28, 32_768


class Bits:
    """Which values a stored column may have: all that it has, and a few by chance."""

    def __init__(self, values: DataFrame, *columns: str):
        spark = values.sparkSession
        self.size = 1 << min(max(int(np.ceil(np.log2(16 * max(values.count(), 1)))), _LEAST), _MOST)
        bit = F.pmod(F.xxhash64(*columns), F.lit(self.size))
        rows = values.groupBy((bit / _BUCKET).cast("int").alias("bucket")).agg(F.bitmap_construct_agg(bit % _BUCKET).alias("bits"))
        found = np.zeros(self.size // 8, dtype=np.uint8)
        for bucket, bits in rows.toLocalIterator():  # at most size / _BUCKET rows of 4 kB
            own = np.frombuffer(bytes(bits), dtype=np.uint8)
            found[bucket * _BUCKET // 8:bucket * _BUCKET // 8 + len(own)] = own
        self.shared = spark.sparkContext.broadcast(found)

    def maybe(self, *columns: str | Column) -> Column:
        shared, size = self.shared, self.size

        @F.arrow_udf("boolean")
        def maybe(hashed: pa.Array) -> pa.Array:
            at = hashed.to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64(size - 1)
            return pa.array((shared.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1)

        return maybe(F.xxhash64(*columns))
