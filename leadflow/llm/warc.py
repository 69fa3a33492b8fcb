"""WARC archives with an index: written record by record, read back by byte ranges.

Writing gives one index row per record: file, offset, length, URL, digest.  Reading takes any selection of index rows, sorts
them by file and offset, joins neighbouring ranges (``GAP``) into reads of at most ``READ`` bytes and parses the records
found there.  Records are single gzip members, so a record can be read without those before it.

Archives go to a folder that all executors share, through ``pyarrow.fs`` (local or mounted paths, HDFS, S3, GCS by URI).  A
task writes files of its own name; the index names only the files of attempts that ended well, so a lost executor leaves
at most files that no index row points to.

Null payloads are empty, null URLs are left out of the header.  Rows repeated with the same largest id are all
responses; records without an id are responses if no record of the payload has one, else revisits.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import saved
from leadflow.session import scratch_path

LEAST_SHARED = 1000
FILE_BYTES = 256 << 20
GAP = 64 << 10
READ = 8 << 20
TASK_BYTES = 32 << 20  # packed bytes that a reading task gets
DATE = "1970-01-01T00:00:00Z"  # of the records, as pages carry no time

_INDEX = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()),
                    ("payload_digest", pa.string()), ("page_id", pa.int64())])
_INDEX_SQL = "file string, offset bigint, length bigint, url string, payload_digest string, page_id bigint"
_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])
_READ_SQL = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
             "url string, payload binary")


def _header(value: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_id(digest: str, page_id) -> uuid.UUID:
    """Of a response, so that its revisits can name it; a page without id is referred to by none."""
    return uuid.uuid4() if page_id is None else uuid.uuid5(uuid.NAMESPACE_OID, f"{digest}/{page_id}")


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record as a gzip member."""
    revisit = refers_to is not None
    block = b"" if revisit else (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                                 b"Content-Length: %d\r\n\r\n" % len(payload)) + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:uuid:{uuid.uuid4() if revisit else record_id(digest, page_id)}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:uuid:{record_id(digest, refers_to)}>", f"X-Refers-To-Page: {refers_to}"]
    if page_id is not None:
        lines.append(f"X-Page: {page_id}")
    lines += [f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(block)}", "", ""]
    body = "\r\n".join(lines).encode() + block + b"\r\n\r\n"
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress(body) + pack.flush()


def parse(data: bytes) -> dict:
    """Header fields and payload of an unpacked record; a response's payload must have its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(fields["X-Payload-Length"]):
            raise ValueError(f"record {fields['WARC-Record-ID']} does not hold what its header says")
    number = {k: int(fields[k]) if k in fields else None for k in ("X-Page", "X-Refers-To-Page")}
    return {"page_id": number["X-Page"], "payload_bytes": int(fields["X-Payload-Length"]), "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": number["X-Refers-To-Page"],
            "url": fields.get("WARC-Target-URI"), "payload": payload}


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, name, offset = None, "", 0
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if out is None or offset >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                payload = row["payload"].encode()
                packed = record(row["page_id"], row["url"], payload, row["payload_digest"], row["refers_to"])
                out.write(packed)
                rows.append({"file": f"{folder}/{name}", "offset": offset, "length": len(packed), "url": row["url"],
                             "payload_digest": row["payload_digest"], "page_id": row["page_id"]})
                offset += len(packed)
            yield pa.RecordBatch.from_pylist(rows, _INDEX)
        if out is not None:
            out.close()
    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record per page and returns the index, which is stored beside the archives."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload")) \
        .withColumn("payload_digest", F.sha1(F.col("payload").cast("binary")))
    several = rows.where(F.octet_length("payload") >= LEAST_SHARED).groupBy(F.col("payload_digest").alias("digest")).agg(
        F.max("page_id").alias("holder"), F.count("*").alias("size")).where("size > 1").select("digest", "holder")
    typed = rows.join(several, F.col("payload_digest") == F.col("digest"), "left").select(
        "page_id", "url", "payload", "payload_digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder")).alias("refers_to"))
    return saved(typed.mapInArrow(_write(folder), _INDEX_SQL), "warc-index")


def _ranges(rows: list[dict]) -> Iterator[list[dict]]:
    """Index rows in order, cut into groups that one read covers."""
    group: list[dict] = []
    for row in rows:
        if group and (row["file"] != group[0]["file"] or row["offset"] > group[-1]["offset"] + group[-1]["length"] + GAP
                      or row["offset"] + row["length"] - group[0]["offset"] > READ):
            yield group
            group = []
        group.append(row)
    if group:
        yield group


def _read(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, name = None, None
        for batch in batches:
            for group in _ranges(batch.to_pylist()):
                if group[0]["file"] != name:
                    if source is not None:
                        source.close()
                    name = group[0]["file"]
                    store, path = fs.FileSystem.from_uri(name)
                    source = store.open_input_file(path)
                begin = group[0]["offset"]
                data = source.read_at(group[-1]["offset"] + group[-1]["length"] - begin, begin)
                found = [parse(zlib.decompress(data[r["offset"] - begin:r["offset"] - begin + r["length"]], 31))
                         for r in group]
                if not with_payload:
                    for r in found:
                        r["payload"] = None
                yield pa.RecordBatch.from_pylist(found, _READ)
        if source is not None:
            source.close()
    return run


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the given index rows, read by as many tasks as their bytes ask for (the index's own are few)."""
    size = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    ordered = index.select("file", "offset", "length").repartitionByRange(1 + size // TASK_BYTES, "file", "offset") \
        .sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(_read(with_payload), _READ_SQL)


def archive_folder(spark) -> str:
    """A fresh folder for archives under the shared scratch folder."""
    return scratch_path(spark, "warc")
