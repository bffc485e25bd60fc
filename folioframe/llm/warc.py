"""WARC archives: writing with revisits, a normaliser for monolithic gzip, and reading through a sidecar index.

Archives are rows of a table (archive, data), so any store that Spark reads and writes holds them and Spark's
commit keeps them whole when an executor is lost. write_archives() makes one gzip stream of a whole archive, as
careless tools do; normalise() inflates such a stream once, rewrites each record as a gzip member of its own and writes the
sidecar index of offsets; read_records() takes records by those offsets.

Of records with equal payloads of at least revisit_from bytes, that with the largest page_id is the response and the
others revisit it; smaller payloads are all responses. Null html is an empty payload. Repeated rows with the largest page_id are
all responses, for a record cannot revisit its own id; rows with a null page_id revisit one that has an id, and are all responses if
none has. A null url is left out of the record. Further columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm.common import drop_table, table, write_table

#: Bytes of records in an archive, more or less; a longer single record still goes into one.
ARCHIVE, LEVEL, CHUNK = 8 << 20, 3, 1 << 20
DATE = "2024-01-01T00:00:00Z"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, kind: str, refers_to=None, ordinal: int = 0) -> bytes:
    """A response with its payload, or a revisit with the HTTP head alone; both carry the payload's digest and length."""
    digest = digest32(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}:{ordinal}>"), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{digest32(block)}")]
    if kind == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{refers_to}:0>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


class BadArchive(ValueError):
    pass


def _inflated(data, chunk: int = CHUNK):
    """Pieces of a gzip file of any number of members."""
    view, at, z = memoryview(data), 0, zlib.decompressobj(31)
    left = b""
    while at < len(view) or left:
        piece = left or bytes(view[at : at + chunk])
        if not left:
            at += chunk
        left = b""
        while piece:
            out = z.decompress(piece, chunk)
            if out:
                yield out
            if z.eof:
                piece, z = z.unused_data, zlib.decompressobj(31)
            else:
                piece = z.unconsumed_tail
                if not piece and not out:
                    break
    if not z.eof and view.nbytes and z.decompress(b"", 1) == b"" and not _fresh(z):
        raise BadArchive("the gzip stream is cut off")


def _fresh(z) -> bool:
    """Whether an inflater has seen no data: a copy of it takes a whole empty member."""
    probe = z.copy()
    try:
        probe.decompress(zlib.compress(b"", 1, 31))
    except zlib.error:
        return False
    return probe.eof


def head_of(raw: bytes) -> dict[str, str]:
    lines = raw.split(b"\r\n\r\n", 1)[0].decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise BadArchive("no WARC version line")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def records(pieces):
    """(head, whole record) of a stream given in pieces; what is held is one record and one piece at most."""
    buf = bytearray()
    it = iter(pieces)

    def more() -> bool:
        got = next(it, None)
        if got is None:
            return False
        buf.extend(got)
        return True

    while True:
        seen = 0
        while (end := buf.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(buf)
            if not more():
                if buf.strip():
                    raise BadArchive("a record's head is cut off")
                return
        head = head_of(bytes(buf[:end]))
        size = end + 4 + int(head["content-length"]) + 4
        while len(buf) < size:
            if not more():
                raise BadArchive("a record is cut off")
        whole = bytes(buf[:size])
        if whole[-4:] != b"\r\n\r\n":
            raise BadArchive("no record end where its length says")
        del buf[:size]
        yield head, whole


def normalise_bytes(data: bytes, level: int = LEVEL) -> tuple[bytes, list[dict]]:
    """One gzip member a record, and the index: offset, length, id, type and digest of each."""
    out, index, at = [], [], 0
    for head, whole in records(_inflated(data)):
        z = zlib.compressobj(level, zlib.DEFLATED, 31)
        member = z.compress(whole) + z.flush()
        out.append(member)
        index.append({"offset": at, "length": len(member), "id": head["warc-record-id"], "type": head["warc-type"], "uri": head.get("warc-target-uri"), "digest": head["warc-payload-digest"].removeprefix("sha1:")})
        at += len(member)
    return b"".join(out), index


def read_member(data, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Head and block of the record at an offset, with its block digest verified."""
    raw = zlib.decompress(data[offset : offset + length], 31)
    head = head_of(raw)
    block = raw[raw.index(b"\r\n\r\n") + 4 : -4]
    if f"sha1:{digest32(block)}" != head["warc-block-digest"]:
        raise BadArchive("block digest")
    return head, block


def with_types(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """(page_id, url, html, kind, refers_to)."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).withColumn("h", F.sha1(F.col("html").cast("binary")))
    # rows per digest shrink before the shuffle; only digests that repeat come back to the pages
    tops = p.where(F.octet_length("html") >= revisit_from).groupBy("h").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).where("n > 1 and top is not null").drop("n")
    joined = p.join(tops, "h", "left")
    revisit = F.coalesce(F.col("page_id") < F.col("top"), F.col("top").isNotNull())
    return joined.select("page_id", "url", "html", F.when(revisit, "revisit").otherwise("response").alias("kind"), F.when(revisit, F.col("top")).alias("refers_to"))


def write_archives(typed: DataFrame, archive_bytes: int = ARCHIVE) -> DataFrame:
    """(archive, data): each one monolithic gzip stream."""
    schema = pa.schema([("archive", pa.string()), ("data", pa.binary())])

    def run(batches):
        from pyspark import TaskContext

        z, parts, size, made = None, [], 0, 0
        part = TaskContext.get().partitionId()

        def close():
            parts.append(z.flush())
            return pa.RecordBatch.from_arrays([pa.array([f"{part:07d}-{made:05d}"]), pa.array([b"".join(parts)], pa.binary())], schema=schema)

        for b in batches:
            for page_id, url, html, kind, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                if z is None:
                    z, parts, size = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), [], 0
                raw = record(page_id, url, html.encode("utf-8", "replace"), kind, refers_to)
                parts.append(z.compress(raw))
                size += len(raw)
                if size >= archive_bytes:
                    yield close()
                    z, made = None, made + 1
        if z is not None:
            yield close()

    return typed.select("page_id", "url", "html", "kind", "refers_to").mapInArrow(run, "archive string, data binary")


def normalise(archives: DataFrame) -> DataFrame:
    """(archive, data, sidecar): record-wise members, and the index as lines of JSON."""
    schema = pa.schema([("archive", pa.string()), ("data", pa.binary()), ("sidecar", pa.string())])

    def run(batches):
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                out, index = normalise_bytes(data.as_buffer())
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([out], pa.binary()), pa.array(["\n".join(map(json.dumps, index))])], schema=schema)

    return archives.select("archive", "data").mapInArrow(run, "archive string, data binary, sidecar string")


def read_records(normal: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record, taken by the sidecar's offsets; digests of
    responses are computed anew from what was read."""
    ddl = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def number(urn: str):
        part = urn.split(":")[2]
        return int(part) if part else None

    def run(batches):
        for b in batches:
            for data, sidecar in zip(b.column(0), b.column(1).to_pylist()):
                rows = []
                view = memoryview(data.as_buffer())
                for line in sidecar.split("\n") if sidecar else []:
                    x = json.loads(line)
                    head, block = read_member(view, x["offset"], x["length"])
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(http.rsplit(b"Content-Length: ", 1)[1])
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    kind = head["warc-type"]
                    if kind == "response" and (len(payload) != size or digest32(payload) != digest) or digest != x["digest"]:
                        raise BadArchive("payload digest")
                    rows.append((number(head["warc-record-id"]), size, digest, kind, number(head["warc-refers-to"]) if kind == "revisit" else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    return normal.select("data", "sidecar").mapInArrow(run, ddl)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_table(write_archives(with_types(table(spark, sf_dir, "pages"))), "monolithic")
    normal = write_table(normalise(archives), "normal")
    drop_table(archives)  # its records stand in the normal form now
    return read_records(normal)
