"""WARC archives: a writer, and a reader that splits files at any byte."""

from __future__ import annotations

import base64
import gzip
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import slices, whole_text
from signalloom.operators.staging import staged, staging_path

MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 20
#: Bytes of an archive that one reading task owns.
SPLIT_BYTES = 32 << 20
#: Most reading tasks; beyond it a task owns several ranges.
READERS = 20_000
#: Payloads of fewer bytes are written each time they occur.
LEAST_REVISIT = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The pages carry no time of capture.
DATE = "1970-01-01T00:00:00Z"


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    for name in ("s3a://", "s3n://"):
        path = path.replace(name, "s3://", 1) if path.startswith(name) else path
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _record_id(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"


def _one_line(value: str) -> str:
    return " ".join(value.split())


def record(page_id, url, payload: bytes, sha1_hex: str, holder: tuple | None) -> bytes:
    """One response record, or a revisit of ``holder`` (page_id, url), as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if holder is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if holder is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id, url)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1_hex)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_one_line(url)}")
    if page_id is not None:
        lines.append(f"WARC-Page-ID: {page_id}")
    if holder is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(*holder)}", f"WARC-Refers-To-Page-ID: {holder[0]}"]
        if holder[1] is not None:
            lines.append(f"WARC-Refers-To-Target-URI: {_one_line(holder[1])}")
    return gzip.compress("\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def written(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) below ``folder``; returns (path, size, records) of the archives.

    Of rows with equal payloads of ``LEAST_REVISIT`` bytes or more, the one of the largest page_id is the
    response and the others revisit it; rows that share that page_id are all responses. Null html is an empty
    payload, a null url or page_id is left out of the record; a row without page_id is never revisited unless no
    row has one, and then all are responses. No rows write no archives.

    Every task writes one file and moves it into place when it is complete. Only the files of tasks whose
    output Spark committed are returned, so a repeated task leaves an unread file at worst.
    """
    html = whole_text("html")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"),
        F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).cast("long").alias("bytes"),
    )
    holders = (
        rows.where(F.col("bytes") >= LEAST_REVISIT)
        .groupBy("digest", "bytes")
        .agg(F.max(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("holder"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and holder is not null")
        .drop("n")
    )
    marked = rows.join(staged(holders, "holders"), ["digest", "bytes"], "left").withColumn(
        "holder", F.when(~F.col("page_id").eqNullSafe(F.col("holder.page_id")), F.col("holder"))
    )

    def run(batches: Iterator[pa.RecordBatch]):
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        fs, root = _opened(folder)
        out, size, records = None, 0, 0
        for batch in slices(batches, "html"):
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "holder")]
            for page_id, url, text, digest, holder in zip(*columns):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/.{name}.tmp")
                pair = (holder["page_id"], holder["url"]) if holder else None
                member = record(page_id, url, text.encode("utf-8", "surrogatepass"), digest, pair)
                out.write(member)
                size += len(member)
                records += 1
        if out is not None:
            out.close()
            fs.move(f"{root}/.{name}.tmp", f"{root}/{name}")
            yield pa.record_batch({"path": [f"{folder}/{name}"], "size": pa.array([size], pa.int64()), "records": pa.array([records], pa.int64())})

    return staged(marked.mapInArrow(run, "path string, size long, records long"), "archives")


class Member:
    """Decodes the gzip member that starts at a place of an open file."""

    def __init__(self, file, start: int):
        self.file, self.at, self.end = file, start, None
        self.unzip = zlib.decompressobj(31)

    def read(self, least: int | None = None) -> bytes:
        """More of the decoded bytes, ``least`` of them unless the member ends before; all of them without it."""
        out = bytearray()
        while self.end is None and (least is None or len(out) < least):
            chunk = self.file.read_at(CHUNK if least is None else 4096, self.at)
            if not chunk:
                raise EOFError("the archive ends inside a record")
            out += self.unzip.decompress(chunk)
            self.at += len(chunk)
            if self.unzip.eof:
                self.end = self.at - len(self.unzip.unused_data)
        return bytes(out)


def headers_of(data: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields (lower-case names) of a record and where its block starts, or None if it isn't one."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(b"WARC/") or end < 0:
        return None
    fields = {}
    for line in data[:end].decode("utf-8", "surrogatepass").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return (fields, end + 4) if "warc-type" in fields and fields.get("content-length", "").isdigit() else None


def starts_record(file, at: int) -> bool:
    """Whether a gzip member with the header of a record, however long, starts here."""
    try:
        member, head, seen = Member(file, at), bytearray(), 0
        while head.find(b"\r\n\r\n", max(seen - 3, 0)) < 0 and member.end is None:
            seen = len(head)
            head += member.read(512)
            if not head.startswith(b"WARC/"):
                return False
        return headers_of(bytes(head)) is not None
    except (zlib.error, EOFError, UnicodeDecodeError):
        return False


def next_record(file, at: int, end: int) -> int | None:
    """The first place from ``at`` on, before ``end``, where a record starts."""
    while at < end:
        window = file.read_at(min(CHUNK, end - at) + len(MAGIC) - 1, at)
        found = window.find(MAGIC)
        while found >= 0:
            if at + found >= end:
                return None
            if starts_record(file, at + found):
                return at + found
            found = window.find(MAGIC, found + 1)
        at += CHUNK
    return None


def records_between(file, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of the records that start in [start, end).

    A member that can't be decoded is passed over, and the search goes on behind its first byte.
    """
    at = next_record(file, start, end)
    while at is not None and at < end:
        member = Member(file, at)
        try:
            data = member.read()
            fields, block = headers_of(data)
        except (zlib.error, EOFError, TypeError, UnicodeDecodeError):
            at = next_record(file, at + 1, end)
            continue
        yield at, fields, data[block : block + int(fields["content-length"])]
        at = member.end if member.end < end and starts_record(file, member.end) else next_record(file, member.end, end)


def _split_http(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, payload = block.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, payload


RECORDS = (
    "path string, offset long, record_type string, record_id string, url string, page_id long, refers_to long, "
    "declared_digest string, declared_bytes long, payload binary"
)


def read(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row per record of ``archives`` (path, size), in any order.

    Files are cut into byte ranges with a task each (``READERS`` at most, then several ranges). A task looks for the gzip magic in its range, takes a place
    for the start of a record if a WARC header can be decoded there, and owns the records that start
    in its range, reading past its end to finish the last. ``payload`` is the body behind the HTTP header, null for
    a revisit, whose size and digest (hexadecimal) are as declared.
    """
    splits = (
        archives.where("size > 0")
        .withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))))
        .withColumn("end", F.least("size", F.col("start") + split_bytes))
    )

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for path, start, end in zip(*[batch.column(c).to_pylist() for c in ("path", "start", "end")]):
                fs, name = _opened(path)
                rows, size = [], 0
                with fs.open_input_file(name) as file:
                    for offset, fields, block in records_between(file, start, end):
                        http, payload = _split_http(block)
                        number = lambda x: int(x) if x and x.lstrip("-").isdigit() else None
                        digest = fields.get("warc-payload-digest", "").rpartition(":")[2]
                        revisit = fields["warc-type"] == "revisit"
                        rows.append(
                            (
                                path, offset, fields["warc-type"], fields.get("warc-record-id"), fields.get("warc-target-uri"),
                                number(fields.get("warc-page-id")), number(fields.get("warc-refers-to-page-id")),
                                base64.b32decode(digest).hex() if digest else None,
                                number(http.get("content-length")), None if revisit else payload,
                            )
                        )
                        size += len(payload)
                        if size >= 4 << 20:
                            yield _batch(rows)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows)

    # A number given is kept: adaptive execution would join the ranges, few bytes each, into one task.
    tasks = splits.count()
    return splits.repartition(max(1, min(tasks, READERS))).mapInArrow(run, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    text, number = pa.string(), pa.int64()
    kinds = (text, number, text, text, text, number, number, text, number, pa.binary())
    names = [x.split()[0] for x in RECORDS.split(", ")]
    return pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, zip(*rows), kinds)})


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back, and digest what was read.

    Fails if other than as many records come back as were written.
    """
    folder = staging_path(pages.sparkSession, "warc")
    archives = written(pages, folder)
    records = read(archives)
    whole = F.col("payload").isNotNull()
    digests = records.select(
        "page_id",
        F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(whole, F.sha1("payload")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
    found = staged(digests, "digests")
    wrote, came = archives.agg(F.sum("records").alias("n")).first()["n"] or 0, found.count()
    if came != wrote:
        raise RuntimeError(f"{wrote} records were written to {folder}, {came} were read")
    return found
