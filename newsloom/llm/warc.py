"""WARC archives (operator 5): a writer, and a reader that splits files anywhere."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.files import create, dealt, located
from newsloom.llm.registry import query, table
from newsloom.session import scratch_path, stage

MAGIC = b"\x1f\x8b\x08"
#: A task starts another file beyond so many bytes; a reading task owns so many.
FILE_BYTES = 256 << 20
SPLIT_BYTES = 16 << 20
#: What is read at once behind the end of a split, and decoded to validate a candidate.
_MORE, _PROBE = 1 << 20, 1 << 14
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page: int | None) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'page:{page}'.encode()).hexdigest())}>"


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One record as a gzip member. A revisit has the HTTP header (with the length) but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {url.replace('%', '%25').replace(chr(13), '%0D').replace(chr(10), '%0A')}")
    if page is not None:
        head.append(f"X-Page-ID: {page}")
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + deflate.flush()


def write_archives(pages: DataFrame, folder: str, page: str = "page_id", url: str = "url", html: str = "html",
                   file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row of `pages` to archives below `folder`; (path, bytes) of each archive.

    Among rows with equal payloads those with the largest page id are responses, the others
    revisit it. Only the digests that occur twice or more meet the pages again. NULL html is an
    empty payload, NULL page ids count as smallest (and are responses where there is no other), a
    NULL url has no target field. Repeated rows are written again each; an empty table gives no
    archive; columns beside the three named are not read. A task names its files anew at each
    attempt, and only the files of the attempt that Spark accepts are in the result.
    """
    own = pages.select(F.col(page).cast("bigint").alias("page"), F.col(url).cast("string").alias("url"),
                       F.coalesce(html, F.lit("")).alias("html")).withColumn("digest", F.sha1("html"))
    groups = (
        own.groupBy("digest").agg(F.count("*").alias("n"), F.max("page").alias("first")).where("n > 1 AND first IS NOT NULL").drop("n"))
    typed = own.join(groups, "digest", "left").select(
        "page", "url", "html", "first", F.coalesce(~F.col("page").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False)).alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, number, out, size = uuid.uuid4().hex, 0, None, 0
        done: list[tuple[str, int]] = []
        try:
            for batch in batches:
                for r in batch.to_pylist():
                    if out is None:
                        address = f"{folder}/{attempt}-{number}.warc.gz"
                        out, size, number = create(address), 0, number + 1
                    member = record(r["page"], r["url"], r["html"].encode("utf-8", "surrogatepass"), r["first"], r["revisit"])
                    out.write(member)
                    size += len(member)
                    if size >= file_bytes:
                        out.close()
                        done.append((address, size))
                        out = None
        finally:
            if out is not None:
                out.close()
        if out is not None:
            done.append((address, size))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], names=["path", "bytes"])

    return stage(typed.mapInArrow(write, "path string, bytes bigint"), "archives")


class _Member:
    """A gzip member that is a WARC record, found at a place in a file."""

    def __init__(self, file, buffer: bytearray, base: int, at: int):
        inflate, self.valid, self.end = zlib.decompressobj(31), False, -1
        body, fed = bytearray(), at
        try:
            while not inflate.eof:
                if fed >= len(buffer):
                    file.seek(base + len(buffer))
                    more = file.read(_MORE)
                    if not more:
                        return
                    buffer.extend(more)
                body += inflate.decompress(bytes(buffer[fed:fed + _PROBE]))
                fed = min(fed + _PROBE, len(buffer))
                if len(body) >= 7 and not body.startswith(b"WARC/1."):
                    return
        except zlib.error:
            return
        head, found, self.block = bytes(body).partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "replace").split("\r\n")
        self.fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        self.valid = bool(found) and lines[0].startswith("WARC/1.") and "warc-type" in self.fields and self.fields.get("content-length", "").isdigit()
        self.end = fed - len(inflate.unused_data)


def read_split(address: str, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of the records that start in bytes start ... end-1 of an archive.

    Nothing is known about where records are: every gzip magic is a candidate, and is one only if it
    decodes to a record's header. (A stored, undeflated member inside a payload could pass for one;
    valid UTF-8 cannot hold the magic.) The last record is read on beyond the end.
    """
    system, path = located(address)
    with system.open_input_file(path) as file:
        file.seek(start)
        buffer = bytearray(file.read(end + len(MAGIC) - 1 - start))
        at = buffer.find(MAGIC)
        while 0 <= at < end - start:
            member = _Member(file, buffer, start, at)
            if member.valid:
                length = int(member.fields["content-length"])
                yield member.fields, member.block[:length]
                at = buffer.find(MAGIC, member.end)
            else:
                at = buffer.find(MAGIC, at + 1)


def read_archives(spark: SparkSession, archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload) of all records of
    `archives` (path, bytes); revisits have no payload. A response whose payload isn't what its digest says fails the job."""
    splits = archives.where("bytes > 0").select(
        "path", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(split_bytes).cast("bigint"))).alias("start"), "bytes")
    splits = dealt(splits.select("path", "start", F.least(F.col("start") + split_bytes, "bytes").alias("end")), "path", "start")

    def row(fields: dict[str, str], block: bytes) -> dict:
        http, _, payload = block.partition(b"\r\n\r\n")
        lengths = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        digest = fields["warc-payload-digest"].partition(":")[2]
        revisit = fields["warc-type"] == "revisit"
        if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {fields.get('warc-record-id')} is damaged")
        page, first, url = fields.get("x-page-id"), fields.get("x-refers-to-page"), fields.get("warc-target-uri")
        return {
            "page_id": int(page) if page else None, "record_type": fields["warc-type"], "refers_to": int(first) if first else None,
            "url": url and url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%"), "payload_digest": digest,
            "payload_bytes": int(lengths[0]), "payload": None if revisit else payload}

    schema = "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary"
    arrow = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                       ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                rows, size = [], 0
                for fields, block in read_split(s["path"], s["start"], s["end"]):
                    rows.append(row(fields, block))
                    size += len(block)
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return splits.mapInArrow(read, schema)


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SQL = f"""
with own as (
  select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as hex,
         count(*) over (partition by coalesce(html, '')) as n, max(page_id) over (partition by coalesce(html, '')) as first
  from pages)
select page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('{_LETTERS}',
         (((('0x' || substr(hex, (5 * (i // 4) + 1)::int, 5))::bigint >> (15 - 5 * (i % 4))) & 31) + 1)::int, 1)), '') as payload_digest,
       case when n > 1 and page_id is distinct from first then 'revisit' else 'response' end as record_type,
       case when n > 1 and page_id is distinct from first then first end as refers_to
from own"""


@query("op5_warc", SQL)
def op5(spark, sf_dir):
    archives = write_archives(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read_archives(spark, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
