"""Arrow batches of bounded size, and the shape all Arrow functions of this package have."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROWS = 1_000
_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(spark: SparkSession, rows: int = ROWS) -> None:
    """Let Python workers get at most `rows` texts at once (the default, 10,000, may be 1 GB)."""
    now = int(spark.conf.get(_SETTING, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(_SETTING, str(rows))
