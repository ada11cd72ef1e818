"""WARC archives: written as whole-file gzip streams, normalised to one gzip member per record with a sidecar index, read back.

``write_archives`` deals pages to tasks and writes each task's records as one gzip stream (the form that some
crawlers leave behind: no record can be reached without inflating all before it). ``normalise`` inflates each
stream once, in bounded chunks, rewrites every record as a gzip member of its own and writes an index
file beside the archive: a line per record with its offset, length and type. ``read_archives`` seeks to ranges of members through that index.

Files go to the shared folder through pyarrow's file systems (local paths, file:, hdfs:, s3: and so on), under a
temporary name that is renamed when complete, so a task that runs again replaces what a lost one left. Lists
of files are small tables in the same folder; the driver holds none of them.

Of records with equal payloads of at least ``min_revisit_bytes``, that with the smallest id is a response and the others
are revisits of it. A null payload is empty. A row with a null id is a revisit of any row with an id, and a
response if there is none; repeated rows with the smallest id are all responses. A null url gives a record without a target. An
empty table gives no archives and no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm._shared import scratch, shared_dir

ROLL_BYTES = 256 << 20  # an archive is closed once it holds so many bytes, inflated
READ_BYTES = 1 << 20
RECORDS_PER_SPLIT = 2000
MIN_REVISIT_BYTES = 0
_GZIP = 31


def open_fs(path: str):
    """(file system, path in it) of a URI or absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes | None, digest: str, refers_to: int | None, revisit: bool, length: int | None = None) -> bytes:
    """A WARC/1.1 record. A revisit keeps the HTTP header, with the payload's length (to be given where the payload isn't), and no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % (len(payload) if length is None else length)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def inflated(stream, size: int = READ_BYTES):
    """Bytes of a gzip file of one member or many, in pieces of at most ``size``."""
    z, raw = zlib.decompressobj(_GZIP), b""
    while True:
        raw = raw or stream.read(size)
        if not raw:
            break
        out = z.decompress(raw, size)
        raw = z.unconsumed_tail
        if out:
            yield out
        if z.eof:
            raw, z = z.unused_data, zlib.decompressobj(_GZIP)
    if out := z.flush():
        yield out


def records(chunks):
    """Whole records out of inflated pieces; holds one record at a time."""
    buf, need = bytearray(), 0
    for chunk in chunks:
        buf += chunk
        while len(buf) >= need:
            end = buf.find(b"\r\n\r\n")
            if end < 0:
                need = 0
                break
            need = end + 4 + int(_header(bytes(buf[:end]), "content-length")) + 4
            if len(buf) < need:
                break
            yield bytes(buf[:need])
            del buf[:need]
            need = 0
    if bytes(buf).strip():
        raise ValueError("an archive ends inside a record")


def _header(head: bytes, name: str) -> str:
    for line in head.split(b"\r\n"):
        key, _, value = line.partition(b":")
        if key.lower() == name.encode():
            return value.strip().decode()
    return ""


def _page(ref: str) -> int | None:
    digits = ref.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def parse(record: bytes) -> dict:
    """The query's columns out of a record; a response's digest and length are held against its payload."""
    head, _, block = record.partition(b"\r\n\r\n")
    http, _, rest = block.partition(b"\r\n\r\n")
    kind, digest, length = _header(head, "warc-type"), _header(head, "warc-payload-digest").removeprefix("sha1:"), int(_header(http, "content-length"))
    if kind == "response" and (base32_sha1(payload := rest[:-4]) != digest or len(payload) != length):
        raise ValueError("a payload differs from its digest")
    return {
        "page_id": _page(_header(head, "warc-record-id")), "payload_bytes": length, "payload_digest": digest, "record_type": kind,
        "refers_to": _page(_header(head, "warc-refers-to")) if kind == "revisit" else None,
    }


class _Out:
    """A file that appears under its name only when complete."""

    def __init__(self, path: str):
        self.fs, self.path = open_fs(path)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.temp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out, self.size = self.fs.open_output_stream(self.temp, compression=None), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.temp, self.path)


def with_roles(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_revisit_bytes: int) -> DataFrame:
    """id, url, payload (null for revisits), digest, payload_bytes, revisit, refers_to.

    An aggregate per digest gives the smallest id and one copy of the payload, so a payload travels once per task that has it; rows go to it without theirs, and
    Spark splits a hot digest's rows in the join.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")).withColumn("digest", F.unhex(F.sha1("payload")))
    first = rows.groupBy("digest").agg(F.min("id").alias("first"), F.any_value("payload").alias("payload"))
    light = rows.select("id", "url", "digest", F.octet_length("payload").cast("long").alias("payload_bytes"))
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")) & (F.col("payload_bytes") >= min_revisit_bytes)
    return light.join(first, "digest").select(
        "id", "url", F.when(~again, F.col("payload")).alias("payload"), "digest", "payload_bytes", again.alias("revisit"), F.when(again, F.col("first")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes whole-stream archives; the list of them: path, records."""
    import pyarrow as pa

    def run(batches):
        from pyspark import TaskContext

        part, made, done = TaskContext.get().partitionId(), 0, []
        out = None

        def close():
            out.write(z.flush())
            out.close()
            done.append((f"{folder}/raw/part-{part:06d}-{made:04d}.warc.gz", count))

        for batch in batches:
            for page, url, payload, digest, length, revisit, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out, z, count, held = _Out(f"{folder}/raw/part-{part:06d}-{made:04d}.warc.gz"), zlib.compressobj(6, zlib.DEFLATED, _GZIP), 0, 0
                data = record_bytes(page, url, payload, base64.b32encode(digest).decode(), refers, revisit, length)
                out.write(z.compress(data))
                count, held = count + 1, held + len(data)
                if held >= ROLL_BYTES:
                    close()
                    made, out = made + 1, None
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["path", "records"])

    schema = "path string, records bigint"
    with_roles(pages, id_col, url_col, payload_col, min_revisit_bytes).mapInArrow(run, schema).write.parquet(f"{folder}/raw-list")
    return pages.sparkSession.read.schema(schema).parquet(f"{folder}/raw-list")


def normalise_file(path: str, target: str) -> list[tuple[str, int, int, int, int]]:
    """One archive rewritten by members, with ``target``.idx beside it. Ranges: (target, index offset, index
    bytes, first member's offset, members' bytes)."""
    fs, at = open_fs(path)
    out, index = _Out(target), _Out(target + ".idx")
    ranges, count = [], 0
    start = (0, 0)
    with fs.open_input_stream(at, compression=None) as stream:
        for record in records(inflated(stream)):
            z = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
            member = z.compress(record) + z.flush()
            head = record.partition(b"\r\n\r\n")[0]
            index.write(f"{out.size}\t{len(member)}\t{_header(head, 'warc-type')}\t{_header(head, 'warc-record-id')}\n".encode())
            out.write(member)
            count += 1
            if count % RECORDS_PER_SPLIT == 0:
                ranges.append((target, start[0], index.size - start[0], start[1], out.size - start[1]))
                start = (index.size, out.size)
    if index.size > start[0]:
        ranges.append((target, start[0], index.size - start[0], start[1], out.size - start[1]))
    out.close()
    index.close()
    return ranges


_RANGES = "path string, index_at bigint, index_bytes bigint, at bigint, bytes bigint"


def _one_each(listing: DataFrame) -> DataFrame:
    return listing.repartition(max(1, min(listing.count(), 100_000)))


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """archives: column path. Rewrites each; the list of ranges of members that the indexes give."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                found = normalise_file(path, f"{folder}/members/{path.rpartition('/')[2]}")
                if found:
                    yield pa.RecordBatch.from_pylist([dict(zip(("path", "index_at", "index_bytes", "at", "bytes"), r)) for r in found])

    _one_each(archives.select("path")).mapInArrow(run, _RANGES).write.parquet(f"{folder}/member-list")
    return archives.sparkSession.read.schema(_RANGES).parquet(f"{folder}/member-list")


def read_member(path: str, offset: int, length: int) -> bytes:
    """One record, by its place in the index."""
    fs, at = open_fs(path)
    with fs.open_input_file(at) as f:
        return zlib.decompress(f.read_at(length, offset), _GZIP)


def read_archives(ranges: DataFrame) -> DataFrame:
    """A row per record: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    import pyarrow as pa

    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(batches):
        for batch in batches:
            for path, index_at, index_bytes, _, _ in zip(*(c.to_pylist() for c in batch.columns)):
                fs, at = open_fs(path)
                with fs.open_input_file(at + ".idx") as f:
                    lines = f.read_at(index_bytes, index_at).decode().splitlines()
                rows = []
                with fs.open_input_file(at) as f:
                    for line in lines:
                        offset, length = map(int, line.split("\t")[:2])
                        rows.append(parse(zlib.decompress(f.read_at(length, offset), _GZIP)))
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return _one_each(ranges).mapInArrow(run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def warc_round_trip(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """pages written, normalised and read back: one row per row of pages."""
    spark: SparkSession = pages.sparkSession
    shared_dir(spark)
    folder = scratch(spark, "warc")
    return read_archives(normalise(write_archives(pages, folder, min_revisit_bytes=min_revisit_bytes), folder))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (SELECT hex, string_agg(lpad(bin(('0x' || hex[i:i])::INT), 4, '0'), '' ORDER BY i) AS b
         FROM (SELECT DISTINCT hex FROM p), range(1, 41) r(i) GROUP BY hex),
b32 AS (SELECT hex, string_agg('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[v + 1:v + 1], '' ORDER BY k) AS digest
        FROM (SELECT hex, k, list_sum([CASE WHEN b[k * 5 + j:k * 5 + j] = '1' THEN 2 ** (5 - j) ELSE 0 END FOR j IN [1, 2, 3, 4, 5]])::INT AS v
              FROM bits, range(0, 32) r(k)) GROUP BY hex),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM p)
SELECT page_id, octet_length(encode(body)) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f JOIN b32 USING (hex)
"""
