"""WARC archives: write, normalise to one gzip member per record, read back through an offset index.

``write_archives`` writes each archive as a single gzip stream, the way careless tools do: no record can
be reached without inflating all before it.  ``normalise`` inflates such a stream once, in bounded pieces,
rewrites every record as a member of its own and writes a sidecar index (offset, length, type and id of
each record).  ``read_archives`` then fetches every record by its index entry alone.

Files go to a folder that all executors share, through pyarrow's file systems (file, s3, gs, hdfs).  Every
attempt of a task writes files of its own names, and only the table of files that the finished attempts
returned is read later, so a repeated task leaves at most files that nobody reads.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_path, written

END = b"\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"  # the pages carry no date, and equal input gives equal archives
CHUNK = 1 << 20
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _open(uri: str):
    """(file system, path) of a URI; Hadoop also writes local ones as a bare path or as file:/path."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def plan_records(pages: DataFrame, id_col: str, url_col: str, html_col: str, least: int = 100) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): of equal payloads of at least ``least`` bytes, rows with the
    smallest page_id are written whole (``refers_to`` null), others refer to it.  A null html is an empty
    payload; a null page_id is never the smallest; if all ids of a payload are null, each is written whole."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    first = (rows.where(F.octet_length("payload") >= least).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    return rows.join(first, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(~F.coalesce(F.col("page_id") == F.col("first"), F.lit(False)), F.col("first")).alias("refers_to"))


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit carries the HTTP head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    name = str(page_id) if page_id is not None else f"none-{uuid.uuid4().hex}"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        safe = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url)
        head.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block + END


def write_archives(records: DataFrame, folder: str, roll_bytes: int = 64 << 20, level: int = 4) -> DataFrame:
    """(archive, records): archives below ``folder``, each one gzip stream of about ``roll_bytes`` before
    compression.  An empty table writes none."""

    def run(batches):
        fs, base = _open(folder)
        fs.create_dir(f"{base}/raw", recursive=True)
        out = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name, n, size = f"raw/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out, pack = fs.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(level, zlib.DEFLATED, 31)
                data = record(*row)
                out.write(pack.compress(data))
                n, size = n + 1, size + len(data)
                if size >= roll_bytes:
                    out.write(pack.flush())
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "records": [n]})
        if out is not None:
            out.write(pack.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "records": [n]})

    return records.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(run, "archive string, records long")


def inflated(stream):
    """The bytes of a gzip file of one or several members, in pieces of bounded size."""
    unpack, data = zlib.decompressobj(31), b""
    while True:
        data = data or stream.read(CHUNK)
        if not data:
            if not unpack.eof:
                raise ValueError("the gzip stream ends early")
            return
        if unpack.eof:
            unpack = zlib.decompressobj(31)
        yield unpack.decompress(data, 4 * CHUNK)
        data = unpack.unused_data if unpack.eof else unpack.unconsumed_tail


def head_fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}


def records_of(stream):
    """(header fields, raw record) of every WARC record in the stream."""
    buf, need, head = bytearray(), None, None
    for piece in inflated(stream):
        buf += piece
        while True:
            if need is None:
                at = buf.find(END)
                if at < 0:
                    break
                head = head_fields(bytes(buf[:at]))
                if not buf.startswith(b"WARC/") or not head.get("content-length", "").isdigit():
                    raise ValueError("not a WARC record")
                need = at + len(END) + int(head["content-length"]) + len(END)
            if len(buf) < need:
                break
            yield head, bytes(buf[:need])
            del buf[:need]
            need = None
    if buf:
        raise ValueError("the last record is cut off")


def normalise(archives: DataFrame, folder: str, level: int = 4) -> DataFrame:
    """(archive, index, records): each archive rewritten with a gzip member per record, beside its index."""

    def run(batches):
        fs, base = _open(folder)
        fs.create_dir(f"{base}/normal", recursive=True)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                source_fs, source = _open(archive)
                name, at, index = f"normal/{uuid.uuid4().hex}.warc.gz", 0, []
                with source_fs.open_input_stream(source, compression=None) as stream, \
                        fs.open_output_stream(f"{base}/{name}", compression=None) as out, \
                        fs.open_output_stream(f"{base}/{name}.idx", compression=None) as side:
                    for head, raw in records_of(stream):
                        pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = pack.compress(raw) + pack.flush()
                        out.write(member)
                        index.append(json.dumps({"offset": at, "length": len(member), "type": head.get("warc-type"),
                                                 "id": head.get("warc-record-id")}))
                        at += len(member)
                        if len(index) % 4096 == 0:
                            side.write("".join(x + "\n" for x in index[-4096:]).encode())
                    side.write("".join(x + "\n" for x in index[len(index) // 4096 * 4096:]).encode())
                yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "index": [f"{folder}/{name}.idx"],
                                                  "records": [len(index)]})

    return archives.select("archive").mapInArrow(run, "archive string, index string, records long")


def _page(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text.lstrip("-").isdigit() else None


def read_archives(normal: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, archive, offset): every record, fetched by
    its index entry.  A payload that does not match its digest is an error."""

    def run(batches):
        for batch in batches:
            for archive, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, path = _open(archive)
                side_fs, side = _open(index)
                with side_fs.open_input_stream(side, compression=None) as f:
                    entries = [json.loads(x) for x in f.read().decode().splitlines()]
                rows = []
                with fs.open_input_file(path) as f:
                    for e in entries:
                        raw = zlib.decompress(f.read_at(e["length"], e["offset"]), 31)
                        head, _, block = raw.partition(END)
                        head, (http, _, payload) = head_fields(head), block[:-len(END)].partition(END)
                        digest = head["warc-payload-digest"].removeprefix("sha256:")
                        kind = head["warc-type"]
                        size = int(head_fields(http)["content-length"])
                        if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"{archive}: the record at {e['offset']} does not match its digest")
                        rows.append((_page(head["warc-record-id"]), size, digest, kind,
                                     _page(head.get("warc-refers-to")), archive, e["offset"]))
                        if len(rows) == 4096:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    return normal.select("archive", "index").mapInArrow(run, RECORD + ", archive string, offset long")


def _batch(rows) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def round_trip(pages: DataFrame, id_col: str, url_col: str, html_col: str, roll_bytes: int = 64 << 20, level: int = 4) -> DataFrame:
    """Write ``pages`` as archives below the shared checkpoint folder, normalise them and read them back: one
    row per page.  Repeated rows are records of their own.  An empty table gives an empty result."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    raw = written(write_archives(plan_records(pages, id_col, url_col, html_col), folder, roll_bytes, level), "raw")
    tasks = max(1, 2 * raw.count())  # an archive each, dealt by name
    normal = written(normalise(raw.repartition(tasks, "archive"), folder, level), "normal")
    return read_archives(normal.repartition(tasks, "archive"))
