"""WARC archives: writer with revisit records and a splittable gzip reader.

Writer. Of the pages with equal payloads the one with the smallest id is
written as ``response``, the others as ``revisit`` records that refer to it.
The digests decide this in one aggregate (map-side combined, so a payload
held by a third of all pages is one row a task); only digests that occur more
than once are joined back. Every task writes its records as separate gzip
members, to a temporary name that is renamed when complete: a repeated task
replaces its file by one with the same records.

Reader. Archives are cut into byte ranges of ``range_bytes``, a task each. A
task looks for the gzip magic, validates a candidate by inflating its head
and parsing a WARC version line, and owns the records whose member starts
inside its range; it reads on past the range's end to complete the last one.
So no index is needed, every record is read once, and one large archive is
read by many tasks. Blocks are streamed; a record is held whole, a file never.

Files are opened through ``pyarrow.fs`` (file, s3/s3a, gs, hdfs).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensia.llm.common import fill, materialize, scratch_path, ship

MAGIC = b"\x1f\x8b\x08"
BLOCK = 1 << 18
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122


def open_store(uri: str):
    """(file system, path) of a Hadoop-style address."""
    from pyarrow import fs

    uri = uri.replace("s3a://", "s3://", 1)
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{page_id}/{digest}')}>"


def _field(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() else "%{:02X}".format(ord(c)) for c in value)


def encode_record(page_id, url: str | None, payload: bytes, first_id, revisit: bool, date: str) -> bytes:
    """One record as a gzip member of its own."""
    digest = digest32(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}"]
    lines += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_field(url)}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines += [f"WARC-Refers-To: {record_id(first_id, digest)}", f"X-Refers-To-Page-Id: {first_id}"]
    lines.append(f"Content-Length: {len(block)}")
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, compresslevel=6, mtime=0)


def with_first(pages: DataFrame, key: str, html: str, min_revisit_bytes: int) -> DataFrame:
    """key, url, payload and the id of the first page with an equal payload (null if alone)."""
    payload = fill(html).cast("binary")
    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col(key).alias("page_id"), url.alias("url"), payload.alias("payload"))
    long_enough = F.octet_length(F.col("payload")) >= min_revisit_bytes
    again = (
        rows.filter(long_enough)
        .groupBy(F.sha1("payload").alias("sha"))
        .agg(F.count("*").alias("n"), F.min("page_id").alias("first_id"))
        .filter("n > 1 and first_id is not null")
        .select("sha", "first_id")
    )
    return rows.withColumn("sha", F.sha1("payload")).join(again.hint("merge"), "sha", "left").drop("sha")


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    key: str = "page_id",
    html: str = "html",
    min_revisit_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    file_bytes: int = 1 << 30,
) -> int:
    """Write a record per page below ``path``; returns the number of records.

    Null html: empty payload. Null key: a record without a page id, a revisit
    where a page with an id has the payload. Rows that repeat the smallest id
    of their payload are all responses. Empty table: no file. Extra columns
    (other than ``url``) are not read; very long payloads are one record.
    """
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        out, size, count, made, names = None, 0, 0, 0, []
        store, folder = open_store(path)

        def close() -> None:
            nonlocal out
            out.close()
            store.move(names[-1][0], names[-1][1])
            out = None

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    name = f"part-{context.partitionId():05d}-{made:03d}.warc.gz"
                    names.append((posixpath.join(folder, f".{name}.{context.taskAttemptId()}"), posixpath.join(folder, name)))
                    store.create_dir(folder, recursive=True)
                    out, size, made = store.open_output_stream(names[-1][0], compression=None), 0, made + 1
                first = r["first_id"]
                revisit = first is not None and first != r["page_id"]
                member = encode_record(r["page_id"], r["url"], r["payload"], first, revisit, date)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    close()
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["records"])

    spark = pages.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    written = with_first(pages, key, html, min_revisit_bytes).mapInArrow(run, "records long")
    return written.agg(F.sum("records")).first()[0] or 0


class MemberScanner:
    """Records of one file whose gzip member starts in [start, end)."""

    def __init__(self, source, start: int, end: int):
        self.source, self.end = source, end
        self.source.seek(start)
        self.at, self.buffer = start, bytearray()  # file offset of buffer[0]

    def _more(self) -> bool:
        block = self.source.read(BLOCK)
        self.buffer += block
        return bool(block)

    def records(self) -> Iterator[tuple[int, bytes]]:
        """(offset, inflated record)."""
        while self.at < self.end:
            found = self.buffer.find(MAGIC)
            if found < 0:
                keep = min(len(self.buffer), len(MAGIC) - 1)
                self.at += len(self.buffer) - keep
                del self.buffer[: len(self.buffer) - keep]
                if not self._more():
                    return
                continue
            self._pass(found)
            if self.at >= self.end:
                return
            offset = self.at
            record = self._member()
            if record is None:
                self._pass(1)
            else:
                yield offset, record

    def _member(self) -> bytes | None:
        """Inflate the member at the buffer's start; None if it is no WARC record.

        The version line is tested on the first inflated bytes, so false magic
        costs little; the buffer moves on only past a valid member.
        """
        inflate, parts, size, fed = zlib.decompressobj(wbits=31), [], 0, 0
        while True:
            try:
                piece = inflate.decompress(self.buffer[fed:])
            except zlib.error:
                return None
            fed = len(self.buffer)
            parts.append(piece)
            size += len(piece)
            if size >= 5 and not (parts[0] if len(parts[0]) >= 5 else b"".join(parts)).startswith(b"WARC/"):
                return None
            if inflate.eof:
                break
            if not self._more():
                return None  # cut off at the end of the file
        record = b"".join(parts)
        if not record.startswith(b"WARC/") or b"\r\n\r\n" not in record:
            return None
        self._pass(fed - len(inflate.unused_data))
        return record

    def _pass(self, n: int) -> None:
        self.at += n
        del self.buffer[:n]


def parse_fields(head: bytes) -> dict[str, str]:
    """Header fields in lower case; a line that starts with white space goes on with the one before."""
    fields: dict[str, str] = {}
    name = None
    for line in head.split(b"\r\n")[1:]:
        if line[:1] in (b" ", b"\t") and name:
            fields[name] += " " + line.strip().decode("utf-8", "replace")
            continue
        key, _, value = line.partition(b":")
        name = key.strip().lower().decode("latin-1")
        fields[name] = value.strip().decode("utf-8", "replace")
    return fields


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields in lower case, block). Without a valid length: what stands before the closing empty lines."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = parse_fields(head)
    length = fields.get("content-length", "")
    return fields, rest[: int(length)] if length.isdecimal() else rest.removesuffix(b"\r\n\r\n")


def unchunked(body: bytes) -> bytes:
    """The body of a chunked transfer; ``body`` itself if it isn't one."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].partition(b";")[0].strip() if end >= 0 else b""
        try:
            n = int(size, 16)
        except ValueError:
            return body
        if n == 0:
            return b"".join(parts)
        if n < 0 or end + 2 + n > len(body):
            return body
        parts.append(body[end + 2 : end + 2 + n])
        at = end + 2 + n + 2


def payload_of(fields: dict[str, str], block: bytes) -> tuple[bytes, bytes]:
    """(payload, payload as it was sent): of an HTTP message its body, of any other block all of it."""
    kind = fields.get("content-type", "").replace(" ", "").lower()
    if not kind.startswith("application/http") and not (kind == "" and block.startswith(b"HTTP/")):
        return block, block
    head, _, body = block.partition(b"\r\n\r\n")
    chunked = "chunked" in parse_fields(head).get("transfer-encoding", "").lower()
    return (unchunked(body) if chunked else body), body


RECORDS = "file string, offset long, record_type string, record_id string, page_id {key}, url string, digest string, payload_bytes long, refers_to_record string, refers_to {key}"


def read_archives(
    spark: SparkSession, path: str, *, key_type: str = "bigint", range_bytes: int = 256 << 20, most_tasks: int = 50_000, with_payload: bool = False
) -> DataFrame:
    """The records of all archives below ``path``, of any writer and type.

    A task reads one byte range, or several in turn where there are more than
    ``most_tasks``. ``digest`` and ``payload_bytes`` of a response or resource
    are computed from the payload read (a chunked HTTP body is joined); one
    whose header states another SHA-1, of the payload or of the body as sent,
    is an error, other hash functions aren't checked. A revisit has the
    header's digest and no length of its own; other records (warcinfo, request,
    metadata ...) have the header's digest, if any, and the length of their
    block's payload. What a header doesn't state is null, and so is a page id
    that doesn't fit ``key_type``. Members that aren't WARC are passed over.
    """
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path).select("path", "length").filter("length > 0")
    starts = F.explode(F.expr(f"sequence(0L, length - 1, {range_bytes}L)"))
    ranges = files.select("path", starts.alias("start")).withColumn("end", F.col("start") + range_bytes)
    ranges = ranges.repartition(max(1, min(most_tasks, ranges.count())))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ddl = RECORDS.format(key=key_type) + (", payload binary" if with_payload else "")
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    whole = pa.types.is_integer(schema.field("page_id").type)

    def page(value: str | None):
        if not whole or value is None:
            return value
        digits = value.removeprefix("-")
        return int(value) if digits.isdecimal() and digits.isascii() and -(1 << 63) <= int(value) < 1 << 63 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                store, name = open_store(r["path"])
                rows, held = [], 0
                with store.open_input_file(name) as source:
                    for offset, record in MemberScanner(source, r["start"], r["end"]).records():
                        fields, block = parse_record(record)
                        kind, stated = fields.get("warc-type"), fields.get("warc-payload-digest")
                        payload = sent = None
                        if kind != "revisit":
                            payload, sent = payload_of(fields, block)
                        digest = stated.removeprefix("sha1:") if stated else None
                        if kind in ("response", "resource"):
                            if digest and stated.startswith("sha1:") and digest.upper() not in (digest32(payload), digest32(sent)):
                                raise ValueError(f"{r['path']} at {offset}: the payload's digest differs")
                            digest = digest32(payload)
                        row = (r["path"], offset, kind, fields.get("warc-record-id"), page(fields.get("x-page-id")), fields.get("warc-target-uri"))
                        row += (digest, None if payload is None else len(payload), fields.get("warc-refers-to"), page(fields.get("x-refers-to-page-id")))
                        rows.append((*row, payload) if with_payload else row)
                        held += len(payload or b"") if with_payload else 0
                        if len(rows) >= 8192 or held >= 1 << 24:
                            yield _batch(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, schema)

    return ranges.mapInArrow(run, ddl)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def resolve(records: DataFrame) -> DataFrame:
    """Give revisits the payload length of the response they refer to.

    ``records`` is read three times: write it first where reading is dear.
    """
    originals = (
        records.filter("record_type = 'response'")
        .groupBy(F.col("record_id").alias("refers_to_record"), F.col("digest").alias("of_digest"))
        .agg(F.max("payload_bytes").alias("of_bytes"))
    )
    revisits = records.filter("record_type = 'revisit'").join(originals.hint("merge"), "refers_to_record", "left")
    fixed = revisits.withColumn("payload_bytes", F.col("of_bytes")).withColumn("digest", F.coalesce("of_digest", "digest"))
    others = records.filter("record_type is null or record_type <> 'revisit'")
    return others.unionByName(fixed.select(records.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC and read back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    rows = resolve(materialize(read_archives(spark, path), "records"))
    return rows.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
), f AS (
  SELECT page_id, strlen(body) AS payload_bytes, hex, min(page_id) OVER (PARTITION BY body) AS first_id FROM p
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(hex, 1 + (5 * g)::INT, 5))::INT) >> s) & 31), 1)), '')), '') AS payload_digest,
  CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM f
"""
