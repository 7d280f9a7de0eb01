"""Files in the shared folder, written and read by tasks through whichever file system its address names."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import DataFrame

#: Partitions that the splits of any number of files are dealt over, at most.
MOST_PARTITIONS = 20_000


def located(address: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address (file:, s3:, gs:, hdfs:, or a plain path) and the path in it."""
    return fs.FileSystem.from_uri(address)


def create(address: str):
    system, path = located(address)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def read_range(address: str, start: int, end: int) -> bytes:
    """Bytes start ... end-1, fewer at the end of the file."""
    system, path = located(address)
    with system.open_input_file(path) as file:
        file.seek(min(start, file.size()))
        return file.read(end - start)


def dealt(splits: DataFrame, *by: str) -> DataFrame:
    """`splits` (small rows that name byte ranges of files) with as many partitions as rows.

    The number is given because adaptive execution sees only the rows' few bytes, not the ranges that
    they stand for, and would merge them into one task.
    """
    return splits.repartition(min(max(splits.count(), 1), MOST_PARTITIONS), *by)
