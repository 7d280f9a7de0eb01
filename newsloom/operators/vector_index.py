"""A vector index that outlives a call: pivots kept in the store, vectors written by cell.

Layout below one root: `pivots` (the centres and the width of a ring, written once) and
`cells/batch=<n>/attempt=<name>/cell=<pivot>` with the distinct vectors of a batch. Every batch is placed by the same pivots, so nothing
stored is read, folded or placed again when vectors are added, and a search reads only the cells that
its queries can have neighbours in: they are partitions, pruned before any file is opened.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.joins import skew_safe_join
from newsloom.operators.nearest import DENSE_BLOCK_ROWS, PIVOTS, Cells, _unit_rows, compare_cells
from newsloom.session import stage

_PIVOTS = "n int, ring double, vector array<double>"
_CELLS = "id bigint, second bigint, vector array<double>, ring int, batch bigint, attempt string, cell int"
_DONE = "batch bigint, attempt string, at timestamp"


class VectorIndex:
    """Vectors `(id, vector)` in cells below `root`; searches are exact unless `probes` says how many cells to visit.

    A batch that is written again replaces itself: of each batch the newest finished attempt counts.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def fit(self, rows: DataFrame, pivots: int = PIVOTS, cell_rows: int = DENSE_BLOCK_ROWS, ring: float = 1 / 16) -> None:
        """Choose the pivots, once, from vectors like those to come: one for every `cell_rows`, at most `pivots`.

        They are the first vectors in hash order, so what the driver gets is bounded and spread like the
        data. Other vectors than these can be added later; badly fitting pivots cost work, not results.
        """
        folded = stage(_unit_rows(rows).groupBy("k1", "k2").agg(F.any_value("vector").alias("vector")), "fit-vectors")
        n = max(1, min(pivots, folded.count() // cell_rows))
        chosen = folded.orderBy("k1", "k2").limit(n).select(F.lit(n).alias("n"), F.lit(ring).cast("double").alias("ring"), "vector")
        chosen.coalesce(1).write.mode("error").parquet(f"{self.root}/pivots")

    def _cells(self) -> Cells | None:
        rows = self._read("pivots", _PIVOTS).collect()  # at most PIVOTS
        return Cells(self.spark, np.array([r.vector for r in rows]), rows[0].ring) if rows else None

    def add(self, rows: DataFrame, batch: int) -> None:
        """Write the vectors of a batch to their cells.

        Equal vectors of a batch are stored once, with their two smallest ids: the second is what the
        first is nearest to. Rows are range partitioned by cell, so a crowded cell is several files.
        Zero vectors, and those with numbers that are not finite, are nobody's neighbours and left out.
        """
        cells = self._cells()
        if cells is None:
            raise ValueError("fit the index to vectors first")
        keyed = stage(_unit_rows(rows), "new-vectors")
        firsts = keyed.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.any_value("vector").alias("vector"))
        firsts = stage(firsts, "distinct-vectors")
        later = keyed.select("k1", "k2", "id").join(firsts.select("k1", "k2", F.col("id").alias("first")), ["k1", "k2"]).where("id > first")
        seconds = firsts.join(later.groupBy("k1", "k2").agg(F.min("id").alias("second")), ["k1", "k2"], "left").select("id", "second")
        placed = cells.placed(firsts.select("id", "vector")).join(seconds, "id")
        own = placed.select("id", "second", "vector", F.pmod("cell", F.lit(Cells.RINGS)).alias("ring"),
                            F.floor(F.col("cell") / Cells.RINGS).cast("int").alias("cell"))
        attempt = uuid.uuid4().hex
        (own.repartitionByRange("cell", "ring", "id").sortWithinPartitions("cell", "ring").write.partitionBy("cell")
         .parquet(f"{self.root}/cells/batch={batch}/attempt={attempt}"))
        done = self.spark.range(1).select(F.lit(batch).cast("bigint").alias("batch"), F.lit(attempt).alias("attempt"), F.current_timestamp().alias("at"))
        done.write.mode("append").parquet(f"{self.root}/done")

    def _attempts(self, before: int | None) -> list[tuple[int, str]]:
        """(batch, attempt) of what counts: a row a batch."""
        done = self._read("done", _DONE).groupBy("batch").agg(F.max_by("attempt", F.struct("at", "attempt")).alias("attempt"))
        return [(r.batch, r.attempt) for r in (done if before is None else done.where(F.col("batch") < before)).collect()]

    def vectors(self, cells: list[int] | None = None, before: int | None = None) -> DataFrame:
        """`(id, second, vector, ring, cell)` of what is stored in the given cells (all by default)."""
        rows = self._read("cells", _CELLS)
        attempts = self._attempts(before)
        rows = rows.where(F.col("attempt").isin([a for _, a in attempts]))
        if cells is not None:
            rows = rows.where(F.col("cell").isin(cells))
        return rows.select("id", "second", "vector", "ring", "cell")

    def nearest(self, queries: DataFrame, threshold: float, probes: int | None = None, exclude_self: bool = False,
                before: int | None = None) -> DataFrame:
        """`(id, match_id, similarity)`: the most similar stored vector of every query `(id, vector)` that has
        one at `threshold` or above, the smallest id on a tie. With `exclude_self` a row's own id is no answer."""
        cells = self._cells()
        empty = self.spark.createDataFrame([], "id bigint, match_id bigint, similarity double")
        if cells is None:
            return empty
        reach = math.sqrt(max(2.0 - 2.0 * threshold, 0.0)) + 1e-6
        keyed = stage(_unit_rows(queries), "asked-vectors")
        if exclude_self:  # a copy may not answer what another id asks
            asked = keyed.select("id", "vector")
        else:
            asked = keyed.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.any_value("vector").alias("vector")).select("id", "vector")
        # At most a number a pivot.
        wanted = [r[0] for r in cells.visited(asked, reach, probes).select(F.explode(F.transform("cells", lambda c: F.floor(c / Cells.RINGS).cast("int"))).alias("c")).distinct().collect()]
        if not wanted:
            return empty
        stored = self.vectors(wanted, before)
        stored = stored.select(F.explode(F.array_compact(F.array("id", "second"))).alias("id"), "vector", (F.col("cell") * Cells.RINGS + F.col("ring")).alias("cell"))
        near = compare_cells(stored, asked, cells, reach, probes, threshold, exclude_self=exclude_self)
        if exclude_self:
            return near
        heads = keyed.groupBy("k1", "k2").agg(F.min("id").alias("head"))
        by_key = heads.join(near.withColumnRenamed("id", "head"), "head").select("k1", "k2", "match_id", "similarity")
        return skew_safe_join(keyed.select("id", "k1", "k2"), by_key, ["k1", "k2"]).select("id", "match_id", "similarity")
