"""Token counts (operator 9): a separator scan over flat token files."""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm.files import create, dealt, read_range
from newsloom.llm.registry import query, table
from newsloom.session import scratch_path, stage

#: Tokens that a scanning task reads at once.
BLOCK_TOKENS = 4 << 20
#: The vocabulary's first free id ends a document.
END_OF_DOCUMENT = 50_256
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def byte_pair_encoder(path: str, pattern: str):
    """A function that makes an encoder (text -> ids) in a task; the vocabulary's file is only read here, on the driver."""
    with open(path, "rb") as file:
        content = file.read()

    def make():
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    return make


def public_encoder(name: str = VOCABULARY):
    import public_tokenizers

    return byte_pair_encoder(public_tokenizers.path(name), public_tokenizers.PATTERN)


def write_token_files(docs: DataFrame, folder: str, make_encoder, end: int = END_OF_DOCUMENT, key: str = "doc_id",
                      text: str = "text", width: str = "<u2") -> DataFrame:
    """Write the tokens of `docs` to flat files (`width`: numpy type), `end` behind each document.

    Returns (path, ordinal, key, bytes): which document is the ordinal-th of a file, and one row of
    ordinal -1 with each file's size. The files hold nothing but ids. NULL and empty texts are an end
    id alone, NULL keys stay NULL, repeated rows are written again each, an empty table gives files
    without documents; columns beside the two named are not read. An attempt of a task writes its own
    file, and only files of accepted attempts are in the result.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, address, n, size = make_encoder(), f"{folder}/{uuid.uuid4().hex}.tokens", 0, 0

        def rows(ordinals, keys, sizes):
            return pa.RecordBatch.from_arrays(
                [pa.array([address] * len(ordinals)), pa.array(ordinals, pa.int64()), keys, pa.array(sizes, pa.int64())],
                names=["path", "ordinal", "key", "bytes"])

        with create(address) as out:
            for batch in batches:
                for value in batch.column(1):
                    ids = np.array([*encode(value.as_py() or ""), end], dtype=width)
                    out.write(ids.tobytes())
                    size += ids.nbytes
                yield rows(range(n, n + len(batch)), batch.column(0), [None] * len(batch))
                n += len(batch)
        yield rows([-1], pa.nulls(1, pa.int64()), [size])

    own = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return stage(own.mapInArrow(write, "path string, ordinal bigint, key bigint, bytes bigint"), "token_files")


def count_tokens(spark: SparkSession, files: DataFrame, end: int = END_OF_DOCUMENT, width: str = "<u2",
                 block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(path, ordinal, n_tokens) of every document of `files` (path, bytes); the end ids aren't counted.

    Each task finds the end ids of its blocks by one vectorised comparison. A running count and a
    running maximum of the last end id over a file's blocks (a row each) say how many documents
    begin before a block and where the one that reaches into it began, however many blocks it spans.
    Tokens behind the last end id of a file are no document; a file without one, or of no bytes, has
    none. Only `path` and `bytes` are read.
    """
    size = np.dtype(width).itemsize
    blocks = files.select("path", (F.col("bytes") / size).cast("bigint").alias("n")).where("n > 0").select(
        "path", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(block_tokens).cast("bigint"))).alias("start"))
    blocks = dealt(blocks.select("path", "start", F.least(F.col("start") + block_tokens, "n").alias("end")), "path", "start")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                ids = np.frombuffer(read_range(b["path"], b["start"] * size, b["end"] * size), dtype=width)
                ends = np.flatnonzero(ids == end) + b["start"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b["path"]]), pa.array([b["start"]], pa.int64()), pa.array([ends], pa.list_(pa.int64()))],
                    names=["path", "start", "ends"])

    found = blocks.mapInArrow(scan, "path string, start bigint, ends array<bigint>")
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.withColumns({
        "before": F.coalesce(F.sum(F.size("ends")).over(earlier), F.lit(0)),
        "last": F.coalesce(F.max(F.try_element_at("ends", F.lit(-1))).over(earlier), F.lit(-1))})
    each = stitched.select("path", "before", "last", "ends", F.posexplode("ends").alias("i", "at"))
    return each.select(
        "path", (F.col("before") + F.col("i")).alias("ordinal"),
        (F.col("at") - F.when(F.col("i") > 0, F.get("ends", F.col("i") - 1)).otherwise(F.col("last")) - 1).alias("n_tokens"))


@query("op9_token_counts")
def op9(spark, sf_dir):
    """Tokens of every document, counted from its file; NULL and empty texts have none."""
    written = write_token_files(table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"), public_encoder())
    counts = count_tokens(spark, written.where("ordinal < 0").select("path", "bytes"))
    return written.where("ordinal >= 0").join(counts.hint("merge"), ["path", "ordinal"], "left").select(F.col("key").alias("doc_id"), "n_tokens")
