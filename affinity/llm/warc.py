"""WARC archives: written with an index, read back through it.

Writing: each task writes its rows as records of gzip members into archives
of its own and returns one index row per record (archive, offset, length,
URL, digest).  The index is kept in the shared folder; only archives of
attempts that finished are in it.  Records of equal payloads are found by
digest before: all but the one of the largest page id are revisits.

Reading: the selected index rows are sorted by archive and offset, and
neighbouring ranges are read at once.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import cut, prepare, stable

ARCHIVE_BYTES = 1 << 30      # an archive is closed beyond this size
MIN_REVISIT = 0              # payloads of at least so many bytes may be revisits
READ_BYTES = 8 << 20         # at most so much is read at once (a longer record is)
READ_GAP = 64 << 10          # ranges this near are read together
SLICE = 256 << 20            # bytes of an archive that one group of reads covers
LEVEL = 1                    # compression level
DATE = "2000-01-01T00:00:00Z"

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("archive string, offset long, length long, page_id long, url string, payload_digest string, "
         "record_type string")
RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "payload binary")


def open_fs(uri: str):
    """File system and path of a folder that all executors share."""
    from pyarrow import fs
    if re.match(r"file:/[^/]", uri):
        uri = "file://" + uri[len("file:"):]
    if "://" not in uri:
        uri = "file://" + uri
    return fs.FileSystem.from_uri(uri)


def _record_id(page_id, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def _clean(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def build_record(page_id, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    head = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", _record_id(page_id, digest)),
              ("WARC-Date", DATE),
              ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("Content-Type", "application/http;msgtype=response"),
              ("Content-Length", str(len(block)))]
    if url is not None:
        fields.insert(3, ("WARC-Target-URI", _clean(url)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of one record; the payload's digest is recomputed where the
    record holds it."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest or len(payload) != size:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")

    def page(record_id: str | None):
        part = record_id.split(":")[2] if record_id else ""
        return int(part) if part else None
    return {"page_id": page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": size,
            "payload_digest": digest, "record_type": kind, "refers_to": page(fields.get("WARC-Refers-To")),
            "payload": payload if kind == "response" else None}


def revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """``pages`` rows with payload, digest (hex), refers_to and revisit.

    Only digests, ids and row numbers are grouped; digests met once need
    nothing further.  The join that adds the verdicts moves each payload
    once; a digest that a third of all rows share is split by AQE, since its
    side of the join has one row."""
    p = stable(pages).select(F.monotonically_increasing_id().alias("row"), "page_id", "url",
                     F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("sha1", F.sha1("payload"))
    groups = p.filter(F.octet_length("payload") >= min_bytes).groupBy("sha1").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "row")).alias("last"))
    groups = groups.filter("n > 1").select(F.col("sha1").alias("_d"), "last")
    j = p.join(groups, (F.col("sha1") == F.col("_d")) & (F.octet_length("payload") >= min_bytes), "left")
    return j.select("page_id", "url", "payload", "sha1", F.col("last.page_id").alias("refers_to"),
                    (F.col("last").isNotNull() & (F.col("last.row") != F.col("row"))).alias("revisit"))


def write(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) into archives
    in ``folder`` and return their index.

    Null html: an empty payload.  Null url: a record without a target.  Null
    page id: less than any other.  Repeated rows: one of them is the
    response, the others revisit it.  Empty table: empty index.  Other
    columns are not read."""
    prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_fs(folder)
        files.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        try:
            for b in batches:
                rows = []
                for page_id, url, payload, sha1, refers_to, revisit in zip(*(c.to_pylist() for c in b.columns)):
                    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                    record = build_record(page_id, url, payload, digest, refers_to, revisit)
                    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    data = z.compress(record) + z.flush()
                    if out is None or at + len(data) > archive_bytes and at:
                        if out is not None:
                            out.close()
                        # a name of this attempt's own: another attempt never writes here
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{base}/{name}", compression=None)
                    out.write(data)
                    rows.append((name, at, len(data), page_id, url, digest, "revisit" if revisit else "response"))
                    at += len(data)
                cols = list(zip(*rows)) if rows else [[]] * 7
                types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 names=["archive", "offset", "length", "page_id", "url",
                                                        "payload_digest", "record_type"])
        finally:
            if out is not None:
                out.close()
    r = revisits(pages, min_bytes)
    r = r.select(F.col("page_id").cast("long"), "url", "payload", "sha1", F.col("refers_to").cast("long"), "revisit")
    return cut(r.mapInArrow(run, INDEX))


def read(selected: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the ``selected`` index rows: page_id, url,
    payload_bytes, payload_digest, record_type, refers_to, payload (null for
    revisits, or if not asked for).  Ranges are sorted within slices of an
    archive and read together where they are near."""
    spark = selected.sparkSession
    parts = prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_fs(folder)
        source, opened = None, None
        for b in batches:
            spans = list(zip(*(c.to_pylist() for c in b.columns)))
            i = 0
            while i < len(spans):
                name, start, size = spans[i]
                end, j = start + size, i + 1
                while (j < len(spans) and spans[j][0] == name and spans[j][1] - end <= READ_GAP
                       and spans[j][1] + spans[j][2] - start <= READ_BYTES):
                    end = max(end, spans[j][1] + spans[j][2])
                    j += 1
                if opened != name:
                    if source is not None:
                        source.close()
                    source, opened = files.open_input_file(f"{base}/{name}"), name
                data = source.read_at(end - start, start)
                rows = [parse_record(zlib.decompress(data[o - start:o - start + n], 31)) for _, o, n in spans[i:j]]
                if not payloads:
                    for r in rows:
                        r["payload"] = None
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], t) for k, t in _RECORD_TYPES], names=[k for k, _ in _RECORD_TYPES])
                i = j
        if source is not None:
            source.close()
    part = F.floor(F.col("offset") / SLICE)
    ranges = selected.select("archive", "offset", "length").repartition(parts, F.col("archive"), part)
    return ranges.sortWithinPartitions("archive", "offset").mapInArrow(run, RECORDS)


_RECORD_TYPES = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                 ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                 ("payload", pa.binary())]


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, read all records back: page_id, payload_bytes,
    payload_digest, record_type, refers_to.  The archives lie in a folder of
    this run under the shared checkpoint folder and go once the result is
    kept there."""
    from affinity.session import ensure_checkpoint_dir
    spark = pages.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    index = write(pages, folder)
    records = cut(read(index, folder, payloads=False).drop("payload", "url"))
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
