"""Session settings and durable staging of intermediate results."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "newsloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every job here relies on (UTC, adaptive execution)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_scratch: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: the cluster's `spark.checkpoint.dir`.

    Only where that setting is missing and the master is local (tests, a laptop) is a temporary folder
    used instead; on a cluster each executor would have one of its own, so there it is an error. The
    folder goes with the process; the owner of a shared folder cleans it.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    app, master = spark.sparkContext.applicationId, spark.sparkContext.master
    if not master.startswith("local[") and master != "local":
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="newsloom-")
        atexit.register(shutil.rmtree, _local_scratch[app], ignore_errors=True)
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/newsloom/{name}-{uuid.uuid4().hex}"


_passing: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("_passing", default=None)


@contextlib.contextmanager
def passing_stages(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is removed at the end, however it ends: a job of many batches holds one batch's intermediate results.

    Only for work whose results are written elsewhere inside, or staged with `lasting`.
    """
    paths: list[str] = []
    token = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage (a lost executor only costs a re-read), keeps column pruning for the several
    readers of the result, and gives the optimizer its true size.
    """
    path = scratch_path(df.sparkSession, name)
    if not lasting and (passing := _passing.get()) is not None:
        passing.append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
