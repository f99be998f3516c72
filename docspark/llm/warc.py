"""WARC archives: written by tasks, read back in splits that find their own records."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAGIC = b"\x1f\x8b\x08"
#: Bytes read at a time, and the largest header block that a member may start with.
CHUNK, HEADERS = 1 << 20, 1 << 16
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIELDS = ("id", "uri", "type", "digest", "length", "refers_to", "payload", "record_id")
#: Tasks that scan ranges, at most.
TASKS = 100_000


def name_of(id: int | None) -> str:
    return f"<urn:page:{'' if id is None else id}>"


def id_of(name: str | None) -> int | None:
    """The page id that a record's name holds; None for names of other writers."""
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def record(id: int | None, uri: str | None, kind: str, digest: str, payload: bytes | None, length: int,
           refers_to: int | None) -> bytes:
    """One WARC record: a response holds an HTTP header and the payload, a revisit the header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name_of(id)}", "WARC-Date: 2024-01-01T00:00:00Z",
             f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(block)}"]
    if uri is not None:
        # a header is one line
        lines.insert(3, "WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {name_of(refers_to)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzipped(data: bytes, level: int = 4) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def headers(head: bytes) -> dict[str, str] | None:
    """The named fields of a header block, by names in lower case; None if it is not that of a WARC record."""
    first, *lines = head.decode("utf-8", "surrogatepass" if b"\xed" in head else "replace").split("\r\n")
    if not re.fullmatch(r"WARC/\d+\.\d+", first):
        return None
    fields: dict[str, str] = {}
    for line in lines:
        key, colon, value = line.partition(":")
        if not colon or not key.strip():
            return None
        fields[key.strip().lower()] = value.strip()
    if not fields.get("content-length", "").isdigit() or not {"warc-type", "warc-record-id"} <= set(fields):
        return None
    return fields


def parsed(data: bytes) -> dict:
    """The fields of a record of any type.

    The payload is the body of an HTTP message, or the whole block of a record without one; it is
    None for a revisit, whose length is what its HTTP header says of the body.
    """
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = headers(head)
    kind, payload = fields["warc-type"], rest[:int(fields["content-length"])]
    length = None
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = payload.partition(b"\r\n\r\n")
        said = [x.split(b":")[1].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        length = int(said[0]) if said and said[0].isdigit() else None
    digest = fields.get("warc-payload-digest") or fields.get("warc-block-digest")
    return {"id": id_of(fields["warc-record-id"]), "type": kind, "length": length if kind == "revisit" else len(payload),
            "uri": fields.get("warc-target-uri"), "digest": digest.removeprefix("sha1:") if digest else None,
            "refers_to": id_of(fields.get("warc-refers-to")), "payload": None if kind == "revisit" else payload,
            "record_id": fields["warc-record-id"]}


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store and the path in it of a URI: a local or shared disk, HDFS, S3 or GCS."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def archived(pages: DataFrame, folder: str, *, url: str = "url", html: str = "html", id: str = "page_id",
             least: int = 1000) -> DataFrame:
    """Write one record per row into ``folder`` and return ``(path, size)`` of the archives.

    The payload is the html in UTF-8. Of rows with equal payloads of ``least`` or more bytes the
    one with the largest id is a response and the others revisit it; rows that repeat that
    id are responses as well, and a row without an id revisits it unless none has one. The
    payload of a revisit is not written.

    Each task writes archives of its own; a task that runs again writes new ones, and only
    those of the attempt that counts are returned. An empty table writes nothing; other columns are not looked at.
    """
    body = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id).cast("long").alias("id"), F.col(url).alias("uri"), body.alias("body"))
    rows = rows.select("id", "uri", "body", F.sha1("body").alias("digest"), F.octet_length("body").cast("long").alias("length"))
    large = rows.where(F.col("length") >= least).groupBy("digest", "length").agg(
        F.max("id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1 and keeper is not null").drop("n")
    # digests and ids of payloads that repeat; a digest with very many rows is split by the
    # adaptive skew join
    joined = rows.join(large, ["digest", "length"], "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    records = joined.select("id", "uri", "digest", "length", F.when(revisit, F.col("keeper")).alias("refers_to"),
                            F.when(~revisit, F.col("body")).alias("body"), revisit.alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    fs, base = filesystem(folder)
                    fs.create_dir(base)
                    name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
                    path = f"{folder}/{name}"
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                out.write(gzipped(record(row["id"], row["uri"], "revisit" if row["revisit"] else "response",
                                         row["digest"], row["body"], row["length"], row["refers_to"])))
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64())], ["path", "size"])

    return records.mapInArrow(write, "path string, size long")


def members(read, start: int, end: int, size: int) -> Iterator[bytes]:
    """The records that begin in ``[start, end)`` of an archive of ``size`` bytes.

    ``read(at, n)`` gives n bytes. A candidate is gzip's magic number; it is a member if it decodes
    to the header block of a WARC record, with a type, a name and a length. A member is decoded
    to its end, which may lie beyond the split, and the next one is looked for from there. A magic
    number that does not decode, or not to such a block, is part of something else and skipped.
    A record that the archive's end cuts off raises ``EOFError``.
    """
    at, buffer, base = start, b"", start
    while at < end:
        # the window starts at `base`; two more bytes, so that no magic number is cut
        if at < base or at + len(MAGIC) > base + len(buffer):
            base, buffer = at, read(at, min(CHUNK, size - at))
            if len(buffer) < len(MAGIC):
                return
        found = buffer.find(MAGIC, at - base)
        if found < 0:
            at = base + len(buffer) - len(MAGIC) + 1
            if base + len(buffer) >= size:
                return
            continue
        at = base + found
        if at >= end:
            return
        data, stop = decoded(read, at, size, buffer[found:])
        if data is None:
            at += 1
        else:
            yield data
            at = stop


def decoded(read, at: int, size: int, first: bytes) -> tuple[bytes | None, int]:
    """The whole member at ``at`` and the byte after it; None if it is no WARC record.

    What decodes is a record as soon as its header block is there, within ``HEADERS`` bytes.
    """
    unpacker, out, done, chunk = zlib.decompressobj(31), [], 0, first
    checked = False
    try:
        while True:
            out.append(unpacker.decompress(chunk))
            done += len(chunk)
            if not checked:
                data = b"".join(out)
                if not data[:5] == b"WARC/"[:len(data)]:
                    return None, at
                head, blank, _ = data[:HEADERS].partition(b"\r\n\r\n")
                if blank and headers(head) is None or not blank and (unpacker.eof or len(data) >= HEADERS):
                    return None, at
                checked = bool(blank)
            if unpacker.eof:
                return b"".join(out), at + done - len(unpacker.unused_data)
            if at + done >= size:
                if checked:
                    raise EOFError(f"the archive ends inside the record at byte {at}")
                return None, at
            chunk = read(at + done, min(CHUNK, size - at - done))
    except zlib.error:
        return None, at


def records(archives: DataFrame, *, split: int = 8 << 20) -> DataFrame:
    """All records of ``archives``, rows ``(path, size)``: ``id, uri, type, digest, length,
    refers_to, payload, record_id``.

    Archives are cut into byte ranges of ``split``, each scanned by a task of its own (beyond
    ``TASKS`` ranges by as many tasks); a range owns the records that begin in it. ``digest`` is
    the SHA-1 and ``length`` the size of the full payload: of a revisit they are taken from its
    headers, of others computed from what is read. Records of other writers have any type and
    name; ``id`` and ``refers_to`` are null where the name is no page's. An empty archive, or an
    empty table, has no record; an archive that repeats in the table is read again. A cut-off last record
    fails the job: nothing is left out silently.
    """
    ranges = archives.select("path", "size", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split).cast("long"))).alias("start"))
    # a stated number: adaptive execution would put ranges, which are tiny rows, into one task
    n = archives.select(F.sum(F.greatest(F.ceil(F.col("size") / split), F.lit(1)))).first()[0] or 1
    dealt = ranges.repartition(min(int(n), TASKS), F.col("path"), F.col("start"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = filesystem(row["path"])
                with fs.open_input_file(path) as file:
                    held, weight = [], 0
                    for data in members(lambda at, n: file.read_at(n, at), row["start"],
                                        min(row["start"] + split, row["size"]), row["size"]):
                        r = parsed(data)
                        if r["payload"] is not None:
                            r["digest"], r["length"] = hashlib.sha1(r["payload"]).hexdigest(), len(r["payload"])
                        held.append(r)
                        weight += len(data)
                        if weight >= split:
                            yield table_of(held)
                            held, weight = [], 0
                    if held:
                        yield table_of(held)

    return dealt.mapInArrow(scan, "id long, uri string, type string, digest string, length long, refers_to long, payload binary, record_id string")


def table_of(rows: list[dict]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[f] for r in rows], k) for f, k in zip(FIELDS, kinds)], list(FIELDS))


def html_of(payload: Column) -> Column:
    return F.decode(payload, "UTF-8")
